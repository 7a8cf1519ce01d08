"""Venue messages to typed family rows, as declarative mappings over parsed JSON.

A mapping names the family, what a message must look like to be meant, and its fields. Every field is read
as text from the message's own key-to-text map, so numbers keep their digits and missing, null, empty and value
stay apart. A message whose required field cannot be read goes to quarantine with a code, the field and
the state of its source; nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import digest, native_to_ns, strict_decimal
from tickloom.functions.shapes import structural_fingerprint

#: Why a record was not mapped. Fixed values.
CODES = (
    "mapper_binding_unavailable", "schema_malformed", "schema_unknown", "schema_semantic_change", "schema_type_or_meaning_change",
    "invalid_field", "bounds_exceeded", "instrument_identity_unresolved", "invalid_mapper_output",
)


#: Native instrument states and what they mean. Fixed values.
NATIVE_STATES = {
    "okx": {"preopen": "pre_listing", "live": "continuous_trading", "suspend": "suspended", "expired": "expired"},
    "deribit": {
        "open": "continuous_trading", "settlement": "delivery", "delivered": "delivered", "inactive": "suspended", "locked": "suspended",
        "halted": "suspended", "archivized": "delisted",
    },
}


@dataclass(frozen=True)
class Field:
    """An output column: the path of keys to its text, and how the text is read."""

    name: str
    path: str
    kind: str = "decimal"  # decimal, uint, ms, us, text, flag, levels, levels3, flip
    required: bool = True


@dataclass(frozen=True)
class Mapping_:
    """Family, routing condition on the message, fields, and fixed columns."""

    family: str
    fields: Sequence[Field]
    when: tuple[str, str] | None = None
    items: str | None = None  # path of an array whose items are one row each
    fixed: Mapping[str, str] = field(default_factory=dict)
    header: Sequence[Field] = ()  # fields of the message around the items


def as_map(text: Column) -> Column:
    return F.from_json(text, "map<string,string>")


def text_at(message: Column, path: str) -> Column:
    """Text at a dotted path of a key-to-text map; nested objects are parsed on the way."""
    keys = path.split(".")
    at = F.try_element_at(message, F.lit(keys[0]))
    for k in keys[1:]:
        at = F.try_element_at(as_map(at), F.lit(k))
    return at


def state_at(message: Column, path: str) -> Column:
    """missing, null, empty or value at a dotted path."""
    keys = path.split(".")
    owner = message if len(keys) == 1 else as_map(text_at(message, ".".join(keys[:-1])))
    return _state(owner, F.lit(keys[-1]))


def _state(owner: Column, key: Column) -> Column:
    has = F.coalesce(F.map_contains_key(owner, key), F.lit(False))
    value = F.try_element_at(owner, key)
    return F.when(~has, "missing").when(value.isNull(), "null").when(value == "", "empty").otherwise("value")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _whole(read: Column, fine: Callable[[Column], Column]) -> Column:
    """The levels if each is fine, else null; they are read once, for the test and the result."""
    return _let(read, lambda r: F.when(F.coalesce(F.forall(r, fine), F.lit(False)), r))


def levels_of(text: Column, side: str) -> Column:
    """Levels of [[price, amount, ...], ...] as structs; null if any can't be read or text is no such array."""
    pairs = F.from_json(text, "array<array<string>>")
    read = F.transform(
        pairs,
        lambda x, i: F.struct(
            F.lit(side).alias("side"),
            i.cast("long").alias("level_ordinal"),
            strict_decimal(F.get(x, F.lit(0))).alias("price"),
            strict_decimal(F.get(x, F.lit(1))).alias("amount"),
        ),
    )
    return _whole(read, lambda x: x["price"].isNotNull() & x["amount"].isNotNull())


def texted_levels_of(text: Column, side: str) -> Column:
    """``levels_of`` with ``price_text`` and ``amount_text`` as the venue wrote them, which its checksum is over."""
    pairs = F.from_json(text, "array<array<string>>")
    read = F.transform(
        pairs,
        lambda x, i: F.struct(
            F.lit(side).alias("side"),
            i.cast("long").alias("level_ordinal"),
            strict_decimal(F.get(x, F.lit(0))).alias("price"),
            strict_decimal(F.get(x, F.lit(1))).alias("amount"),
            F.get(x, F.lit(0)).alias("price_text"),
            F.get(x, F.lit(1)).alias("amount_text"),
        ),
    )
    return _whole(read, lambda x: x["price"].isNotNull() & x["amount"].isNotNull())


def tagged_levels_of(text: Column, side: str) -> Column:
    """Levels of [[action, price, amount], ...]."""
    triples = F.from_json(text, "array<array<string>>")
    read = F.transform(
        triples,
        lambda x, i: F.struct(
            F.lit(side).alias("side"),
            i.cast("long").alias("level_ordinal"),
            strict_decimal(F.get(x, F.lit(1))).alias("price"),
            strict_decimal(F.get(x, F.lit(2))).alias("amount"),
            F.get(x, F.lit(0)).alias("action"),
        ),
    )
    return _whole(read, lambda x: x["price"].isNotNull() & x["amount"].isNotNull() & x["action"].isin("new", "change", "delete"))


def rpi_levels_of(text: Column, side: str) -> Column:
    """Levels of [[price, amount, amount of retail price improvement], ...]; each level has both amounts."""
    triples = F.from_json(text, "array<array<string>>")
    read = F.transform(
        triples,
        lambda x, i: F.struct(
            F.lit(side).alias("side"),
            i.cast("long").alias("level_ordinal"),
            strict_decimal(F.get(x, F.lit(0))).alias("price"),
            strict_decimal(F.get(x, F.lit(1))).alias("amount"),
            strict_decimal(F.get(x, F.lit(2))).alias("rpi_amount"),
        ),
    )
    return _whole(read, lambda x: x["price"].isNotNull() & x["amount"].isNotNull() & x["rpi_amount"].isNotNull())


def named_levels_of(text: Column, side: str) -> Column:
    """One side's levels of [[{px, sz, n}, ...], [{px, sz, n}, ...]], bids first."""
    sides = F.from_json(text, "array<array<struct<px:string,sz:string,n:string>>>")
    read = F.transform(
        F.get(sides, F.lit(0 if side == "buy" else 1)),
        lambda x, i: F.struct(
            F.lit(side).alias("side"),
            i.cast("long").alias("level_ordinal"),
            strict_decimal(x["px"]).alias("price"),
            strict_decimal(x["sz"]).alias("amount"),
            uint(x["n"]).alias("orders"),
        ),
    )
    return F.when(F.size(sides) == 2, _whole(read, lambda x: x["price"].isNotNull() & x["amount"].isNotNull() & x["orders"].isNotNull()))


def best_of(text: Column, name: str) -> Column:
    """Price or amount, by the column's name, of the first of [[price, amount, ...], ...]."""
    first = F.get(F.from_json(text, "array<array<string>>"), F.lit(0))
    return strict_decimal(F.get(first, F.lit(0 if name.endswith("price") else 1)))


def named_best_of(text: Column, name: str) -> Column:
    """Price or amount of bid or ask, by the column's name, of [{px, sz, n} or null, {px, sz, n} or null]."""
    sides = F.from_json(text, "array<struct<px:string,sz:string>>")
    side = F.get(sides, F.lit(0 if name.startswith("bid") else 1))
    return strict_decimal(side["px"] if name.endswith("price") else side["sz"])


def state_reader(venue: str) -> Callable[[Column, str], Column]:
    """Reads a venue's native instrument state as one of the library's; null for a state that isn't known."""
    states = F.create_map(*(F.lit(x) for pair in NATIVE_STATES[venue].items() for x in pair))
    return lambda text, name: F.try_element_at(states, text)


def uint(text: Column) -> Column:
    """Digits that fit 63 bits; null for others."""
    return F.when(text.rlike(r"^[0-9]+\z"), text.try_cast("long"))


def integer(text: Column) -> Column:
    """Digits with or without a minus that fit 64 bits; null for others."""
    return F.when(text.rlike(r"^-?[0-9]+\z"), text.try_cast("long"))


READERS: dict[str, Callable[[Column, str], Column]] = {
    "decimal": lambda t, n: strict_decimal(t),
    "uint": lambda t, n: uint(t),
    "int": lambda t, n: integer(t),
    "ms": lambda t, n: native_to_ns(uint(t), "ms"),
    "us": lambda t, n: native_to_ns(uint(t), "us"),
    "text": lambda t, n: F.when(F.length(t) > 0, t),
    "flag": lambda t, n: F.when(t == "true", F.lit(True)).when(t == "false", F.lit(False)),
    "maker": lambda t, n: F.when(t == "true", F.lit("sell")).when(t == "false", F.lit("buy")),
    "side": lambda t, n: F.when(F.lower(t).isin("buy", "b"), F.lit("buy")).when(F.lower(t).isin("sell", "a"), F.lit("sell")),
    "levels": lambda t, n: levels_of(t, "buy" if n == "bids" else "sell"),
    "texted": lambda t, n: texted_levels_of(t, "buy" if n == "bids" else "sell"),
    "rpi": lambda t, n: rpi_levels_of(t, "buy" if n == "bids" else "sell"),
    "named": lambda t, n: named_levels_of(t, "buy" if n == "bids" else "sell"),
    "best": best_of,
    "named_best": named_best_of,
    "okx_state": lambda t, n: state_reader("okx")(t, n),
    "deribit_state": lambda t, n: state_reader("deribit")(t, n),
    "zero": lambda t, n: F.when(t == "0", F.lit(0)),
    "symbol": lambda t, n: F.when(t.rlike(r"^[A-Z0-9-]{1,64}\z"), t),
    "option_kind": lambda t, n: F.when(t == "Call", F.lit("call")).when(t == "Put", F.lit("put")),
    "tagged": lambda t, n: tagged_levels_of(t, "buy" if n == "bids" else "sell"),
}


#: Kinds whose reader hangs on the column's name too: the side, or price or amount.
BY_NAME = ("levels", "texted", "rpi", "named", "best", "named_best", "tagged")


def _reader(read: Callable[[Column, str], Column], more: str) -> Callable[[Column], Column]:
    return lambda x: read(x, more)


def _read(parts: Sequence[tuple[Field, Column]]) -> tuple[dict[str, Column], list[Column]]:
    """Columns to make, and each field's value from them. Fields of a kind are read as one array.

    So a message of twenty fields is a few short expressions: as one expression a field, its generated code is longer
    than the JVM compiles.
    """
    made: dict[str, Column] = {}
    values: list[Column] = []
    texts: dict[str, list[Column]] = {}
    for n, (f, text) in enumerate(parts):
        if f.kind in BY_NAME:
            made[f"__f{n}"] = READERS[f.kind](text, f.name)
            values.append(F.col(f"__f{n}"))
        else:
            texts.setdefault(f.kind, []).append(text)
            values.append(F.get(F.col(f"__{f.kind}"), F.lit(len(texts[f.kind]) - 1)))
    for kind, given in texts.items():
        if kind in ("ms", "us"):
            numbers = F.transform(F.array(*given), uint)
            made[f"__{kind}"] = F.transform(numbers, _reader(native_to_ns, kind))
        else:
            made[f"__{kind}"] = F.transform(F.array(*given), _reader(READERS[kind], ""))
    return made, values


def _is_role(text: Column, m: Mapping_) -> Column:
    return F.coalesce(text.rlike(rf"^(?:{m.when[1]})\z"), F.lit(False))


def meant(message: Column, m: Mapping_) -> Column:
    """Whether a message's role is the one that a mapping is for."""
    return _is_role(text_at(message, m.when[0]), m) if m.when else F.lit(True)


def routed(raw: DataFrame, mappings: Mapping[str, Mapping_]) -> Column:
    """Name of the mapping that each message is meant for; null for none."""
    chosen = F.lit(None).cast("string")
    for name, m in reversed(list(mappings.items())):
        chosen = F.when(meant(F.col("message"), m), F.lit(name)).otherwise(chosen)
    return chosen


def _once(rows: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``rows`` with more columns, each computed once a row whatever reads it."""
    made = rows.select("*", F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias("__made"))
    return made.select(*rows.columns, *(F.col(f"__made.{n}").alias(n) for n in columns))


def _owners(rows: DataFrame, message: str, paths: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """``rows`` with a map for each nested object on the way of ``paths``, and these maps by the path of the object."""
    found = {"": F.col(message)}
    above = {".".join(k[:n]) for k in (p.split(".") for p in paths) for n in range(1, len(k))}
    for path in sorted(above, key=lambda p: (p.count("."), p)):
        name = f"{message}_{len(found)}"
        rows, found[path] = _once(rows, {name: as_map(_at(found, path))}), F.col(name)
    return rows, found


def _at(owners: Mapping[str, Column], path: str) -> Column:
    """Text at a dotted path, from the map of the object that it is in."""
    above, _, key = path.rpartition(".")
    return F.try_element_at(owners[above], F.lit(key))


def apply(raw: DataFrame, m: Mapping_, payload: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """Rows of one mapping: ``keep``, its columns, and ``code``, ``bad_field``, ``bad_state`` (null if accepted).

    A message of another role than the mapping's is refused as schema_unknown.
    """
    # Messages, their nested objects and their fields are read behind generators: filters on fields aren't pushed below
    # them, and nothing is parsed again for each field, its state and the code.
    rows = _once(raw, {"__m": as_map(F.col(payload))})
    paths = [f.path for f in m.header] + ([m.items] if m.items and m.items != "." else []) + ([m.when[0]] if m.when else [])
    rows, around = _owners(rows, "__m", paths if m.items else [*paths, *(f.path for f in m.fields)])
    within = around
    if m.items:
        listed = _at(around, m.items) if m.items != "." else F.col(payload)
        rows = _once(rows, {"__i": F.from_json(listed, "array<string>")})
        rows = rows.select("*", F.posexplode_outer("__i").alias("message_ordinal", "__t"))
        rows = _once(rows, {"__r": as_map(F.col("__t"))})
        rows, within = _owners(rows, "__r", [f.path for f in m.fields])
    else:
        rows = rows.withColumns({"message_ordinal": F.lit(0), "__r": F.col("__m")})
    fields = [*((f, around) for f in m.header), *((f, within) for f in m.fields)]
    made, values = _read([(f, _at(owners, f.path)) for f, owners in fields])
    if made:
        rows = _once(rows, made)
    refused = lambda code, name, state: F.struct(F.lit(code).alias("code"), name.cast("string").alias("bad_field"), state.alias("bad_state"))
    fault = [F.when(F.col("__r").isNull(), refused("schema_malformed", F.lit(None), F.lit("value")))]
    if m.when:
        above, _, key = m.when[0].rpartition(".")
        fault.append(F.when(~_is_role(_at(around, m.when[0]), m), refused("schema_unknown", F.lit(m.when[0]), _state(around[above], F.lit(key)))))
    needed = [(f, owners, v) for (f, owners), v in zip(fields, values, strict=True) if f.required]
    if needed:
        # the place of the first field that can't be read; the state of that one only is looked up
        place = F.array_position(F.array(*(v.isNull() for _, _, v in needed)), True).cast("int") - 1
        names, keys = (F.array(*map(F.lit, x)) for x in ([f.name for f, _, _ in needed], [f.path.rpartition(".")[2] for f, _, _ in needed]))
        owner = F.array(*(owners[f.path.rpartition(".")[0]] for f, owners, _ in needed))
        broken = lambda n: F.when(n >= 0, refused("invalid_field", F.get(names, n), _state(F.get(owner, n), F.get(keys, n))))
        fault.append(_let(place, broken))
    rows = _once(rows, {"__q": F.coalesce(*fault)})
    named = [v.alias(f.name) for (f, _), v in zip(fields, values, strict=True)]
    fixed = [F.lit(v).alias(k) for k, v in m.fixed.items()]
    return rows.select(*keep, F.col("message_ordinal").cast("long"), *named, *fixed, "__q.code", "__q.bad_field", "__q.bad_state")


def split(mapped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantine rows with a deterministic id)."""
    accepted = mapped.where("code IS NULL").drop("code", "bad_field", "bad_state")
    return accepted, mapped.where("code IS NOT NULL")


def quarantine_id(*coordinate: str) -> Column:
    return digest(F.lit("quarantine"), *(F.col(c) for c in coordinate))


def fingerprint_route(raw: DataFrame, rules: DataFrame, payload: str = "payload") -> DataFrame:
    """``raw`` with fingerprint, class and action: exact and additive shapes go on, others to quarantine.

    ``rules`` has fingerprint and class (exact, additive, semantic, type_change); unknown shapes have none.
    """
    rows = raw.withColumn("fingerprint", structural_fingerprint(F.col(payload)))
    rows = rows.join(F.broadcast(rules), "fingerprint", "left")
    code = (
        F.when(F.col("fingerprint").isNull(), "schema_malformed")
        .when(F.col("class").isNull(), "schema_unknown")
        .when(F.col("class") == "semantic", "schema_semantic_change")
        .when(F.col("class") == "type_change", "schema_type_or_meaning_change")
    )
    return rows.withColumn("code", code)


def drift_action(kind: Column, critical: Column) -> Column:
    """What a schema observation leads to."""
    return (
        F.when(kind.isin("exact"), "continue")
        .when(kind == "additive", "transition")
        .when(critical, "fail_closed")
        .otherwise("quarantine")
    )


def accounting(raw: DataFrame, accepted: DataFrame, quarantined: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key..., fault): raw records with neither rows nor one quarantine row, or with both, and rows of no record."""
    a = accepted.groupBy(*key).agg(F.count("*").alias("__a"))
    q = quarantined.groupBy(*key).agg(F.count("*").alias("__q"))
    both = raw.select(*key, F.lit(1).alias("__r")).join(a, list(key), "full_outer").join(q, list(key), "full_outer")
    n_a, n_q = F.coalesce("__a", F.lit(0)), F.coalesce("__q", F.lit(0))
    fault = (
        F.when(F.col("__r").isNull(), "no_record")
        .when((n_a == 0) & (n_q == 0), "lost")
        .when((n_a > 0) & (n_q > 0), "both")
        .when(n_q > 1, "repeated")
    )
    return both.select(*key, fault.alias("fault")).where("fault IS NOT NULL")


def merged_stream_route(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Records of merged futures messages with their market: native st 1 is usdm, 2 coinm, others rejected."""
    items = F.from_json(F.col(payload), "array<string>")
    rows = raw.select("*", F.posexplode(items).alias("message_ordinal", "record"))
    st = text_at(as_map(F.col("record")), "st")
    market = F.when(st == "1", "usdm").when(st == "2", "coinm").otherwise("rejected")
    return rows.withColumn("market", market)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


class Registry:
    """Mappers by (source, channel, version): functions from a raw frame to (rows, quarantine)."""

    def __init__(self) -> None:
        self._mappers: dict[tuple[str, str, str], Callable[[DataFrame], tuple[DataFrame, DataFrame]]] = {}

    def register(self, source: str, channel: str, version: str, mapper: Callable[[DataFrame], tuple[DataFrame, DataFrame]]) -> None:
        if (source, channel, version) in self._mappers:
            raise ValueError(f"{source}/{channel}/{version} is registered already")
        self._mappers[source, channel, version] = mapper

    def run(self, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Each mapper over the rows of its source, channel and mapper_version; others go to quarantine."""
        done, refused = [], []
        known = F.lit(False)
        for (source, channel, version), mapper in self._mappers.items():
            mine = (F.col("source_id") == source) & (F.col("channel_id") == channel) & (F.col("mapper_version") == version)
            rows, bad = mapper(raw.where(mine))
            done.append(rows)
            refused.append(bad)
            known = known | F.coalesce(mine, F.lit(False))
        refused.append(raw.where(~known).withColumn("code", F.lit("mapper_binding_unavailable")))
        return union_all(done), union_all(refused)
