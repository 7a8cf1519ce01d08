"""Bounded queries, predicates and row contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import QUALITY_FLAGS, liquidation_window_fits

#: Limits of one bounded query. Fixed values.
MOST_SOURCES, MOST_CHANNELS, MOST_INSTRUMENTS, MOST_ROWS, MOST_NS = 64, 64, 256, 10_000, 24 * 3_600_000_000_000
DAY_NS = 24 * 3_600_000_000_000
#: What rows of some families may say. Fixed values.
SIDE_MEANINGS = ("order_side", "liquidated_position_side", "unspecified")
PRICE_KINDS = ("order_price", "average_fill_price", "bankruptcy_price", "mark_price", "unspecified")
IV_UNITS = ("implied_volatility", "rate")
RESOLUTIONS = ("resolved", "unresolved", "ambiguous", "unsupported")
INSTRUMENT_STATES = (
    "unknown", "pre_listing", "listed", "auction", "continuous_trading", "suspended", "expired", "delivery", "delivered", "delisted",
)
HEALTH_SCOPES = ("source", "channel", "instrument", "writer", "dataset", "service")
HEALTH_DIMENSIONS = (
    "dns", "tls", "connect", "auth", "subscription_ack", "ping", "pong", "useful_data_silence", "channel_message_rate", "channel_byte_rate",
    "channel_inter_arrival", "exchange_lag", "clock", "sequence", "snapshot", "checksum", "reconstruction", "decode", "schema", "rest_latency",
    "rest_status", "rest_timeout", "rest_weight", "rest_ban", "writer_queue", "spool", "commit", "catalog_age", "catalog_association",
    "parquet_lag", "clickhouse_lag", "replay_pressure", "query_pressure",
)
HEALTH_STATUSES = (
    "unknown", "up", "down", "pending", "acknowledged", "timed_out", "within_limit", "rate_limited", "banned", "compatible", "incompatible",
    "contiguous", "gap", "valid", "invalid", "available", "unavailable", "current", "stale", "associated", "unassociated", "idle", "pressured",
    "queued", "committed",
)
#: Longest identities in bytes, and what the common columns of a row may say. Fixed values.
MOST_BYTES = {"schema_name": 64, "source_id": 128, "channel_id": 128, "instrument_uid": 256, "mapper_version": 128}
EPOCH_KINDS = ("connection", "poll_cycle")
TIME_RESOLUTIONS = ("absent", "nanosecond", "microsecond", "millisecond", "second")
ORDER = ("source_id", "instrument_uid", "received_time_ns", "epoch_id", "arrival_ordinal", "message_ordinal", "event_id")


@dataclass(frozen=True)
class QuerySpec:
    """What a bounded query asks for: half-open receive time, sorted unique id lists, a row limit."""

    start_ns: int
    end_ns: int
    sources: Sequence[str] = field(default=())
    channels: Sequence[str] = field(default=())
    instruments: Sequence[str] = field(default=())
    limit: int = MOST_ROWS

    def problems(self) -> list[str]:
        found = []
        for name, ids, most in (
            ("sources", self.sources, MOST_SOURCES),
            ("channels", self.channels, MOST_CHANNELS),
            ("instruments", self.instruments, MOST_INSTRUMENTS),
        ):
            if list(ids) != sorted(set(ids)):
                found.append(f"{name} are not sorted and unique")
            if len(ids) > most:
                found.append(f"more than {most} {name}")
        if not 0 < self.limit <= MOST_ROWS:
            found.append("limit out of range")
        if not 0 <= self.start_ns < self.end_ns:
            found.append("empty or negative time range")
        elif self.end_ns - self.start_ns > MOST_NS:
            found.append("more than 24 hours")
        return found

    def predicate(self) -> Column:
        where = (F.col("received_time_ns") >= self.start_ns) & (F.col("received_time_ns") < self.end_ns)
        for name, ids in (("source_id", self.sources), ("channel_id", self.channels), ("instrument_uid", self.instruments)):
            if ids:
                where = where & F.col(name).isin(*ids)
        return where


def spec_faults(start_ns: Column, end_ns: Column, limit: Column, sources: Column, channels: Column, instruments: Column) -> Column:
    """What is wrong with specs that are themselves rows, by the rules of ``QuerySpec.problems``."""
    faults = []
    for name, ids, most in (("sources", sources, MOST_SOURCES), ("channels", channels, MOST_CHANNELS), ("instruments", instruments, MOST_INSTRUMENTS)):
        fine = (ids == F.array_sort(F.array_distinct(ids))) & (F.size(ids) <= most)
        faults.append(F.when(~F.coalesce(fine, F.lit(False)), F.lit(name)))
    faults.append(F.when(~F.coalesce(limit.between(1, MOST_ROWS), F.lit(False)), F.lit("limit")))
    ordered = F.coalesce((start_ns >= 0) & (start_ns < end_ns), F.lit(False))
    faults.append(F.when(~ordered, F.lit("range")).when(end_ns - start_ns > MOST_NS, F.lit("span")))
    return F.array_compact(F.array(*faults))


def bounded_query(df: DataFrame, spec: QuerySpec, order: Sequence[str] = ORDER) -> DataFrame:
    """Rows of the spec in stable order, one more than its limit; only a top-n leaves the executors.

    A frame with a ``date`` partition column is pruned to the dates of the range.
    """
    if problems := spec.problems():
        raise ValueError("; ".join(problems))
    rows = df.where(spec.predicate())
    if "date" in df.columns:
        day = lambda ns: F.date_from_unix_date(F.lit(ns // 86_400_000_000_000).cast("int"))
        rows = rows.where(F.col("date").between(day(spec.start_ns), day(spec.end_ns - 1)))
    return rows.orderBy(*(c for c in order if c in df.columns)).limit(spec.limit + 1)


def escapes(df: DataFrame, spec: QuerySpec) -> DataFrame:
    """Rows that a result of the spec may not hold."""
    return df.where(~F.coalesce(spec.predicate(), F.lit(False)))


def decimals_as_text(df: DataFrame) -> DataFrame:
    """All columns, decimals as plain text."""
    return df.select(*(F.col(n).cast("string").alias(n) if t.startswith("decimal") else F.col(n) for n, t in df.dtypes))


def overlaps(start: str, end: str, from_ns: int, to_ns: int) -> Column:
    """Half-open intervals that share a moment with [from, to)."""
    return (F.col(start) < to_ns) & (F.col(end) > from_ns)


def committed(df: DataFrame) -> DataFrame:
    return df.where((F.col("state") == "committed") & F.col("committed_at").isNotNull())


def violations(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that a row breaks; a rule that is null counts as broken."""
    named = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return F.array_compact(F.array(*named))


def _positive(*names: str) -> Column:
    rule = F.lit(True)
    for n in names:
        rule = rule & (F.col(n) > 0)
    return rule


def identity(name: str, optional: bool = False) -> Column:
    """Whether a text is there (unless ``optional``), within its bound of bytes and free of NUL."""
    text = F.col(name)
    fits = (F.octet_length(text) <= MOST_BYTES[name]) & ~F.contains(text, F.lit("\0"))
    return F.coalesce(fits, F.lit(True)) if optional else (F.length(text) > 0) & fits


def common_rules() -> dict[str, Column]:
    return {
        "source": identity("source_id"),
        "instrument": identity("instrument_uid"),
        "receive_time": F.col("received_time_ns") > 0,
    }


def metadata_rules(hashes: Sequence[str], instrument_optional: bool = False, most_flags: int = 64) -> dict[str, Column]:
    """Rules of the columns that rows of all families share.

    ``hashes`` name the columns of immutable identities: 64 lowercase hex digits, not all zero. An exchange time is there
    exactly if its resolution is not absent; a source time always has a resolution. Flags are ascending and known.
    """
    sealed = F.lit(True)
    for h in hashes:
        sealed = sealed & F.col(h).rlike(r"^(?!0{64})[0-9a-f]{64}\z")
    flags = F.col("quality_flags")
    known = F.forall(flags, lambda x: x.isin(*QUALITY_FLAGS))
    return {
        "schema": identity("schema_name"),
        "source": identity("source_id"),
        "channel": identity("channel_id"),
        "instrument": identity("instrument_uid", instrument_optional),
        "ordinal": F.col("arrival_ordinal") > 0,
        "receive_time": F.col("received_time_ns") >= 0,
        "mapper": identity("mapper_version"),
        "epoch": F.col("epoch_kind").isin(*EPOCH_KINDS) & (F.length("epoch_id") > 0),
        "immutable": sealed,
        "exchange_time": F.col("exchange_resolution").isin(*TIME_RESOLUTIONS) & (F.col("exchange_time_ns").isNotNull() == (F.col("exchange_resolution") != "absent")),
        "source_time": F.col("source_resolution").isin(*TIME_RESOLUTIONS[1:]),
        "flags": (F.size(flags) <= most_flags) & known & (flags == F.array_sort(F.array_distinct(flags))),
    }


def contract(family: str) -> dict[str, Column]:
    """The rules of a family, over its own column names."""
    own: dict[str, dict[str, Column]] = {
        "trade": {
            "price": _positive("price"),
            "amount": _positive("amount"),
            "side": F.col("side").isin("buy", "sell"),
            "maker": F.col("buyer_is_maker") == (F.col("side") == "sell"),
        },
        "book_update": {
            "sequence": F.col("first_sequence") <= F.col("last_sequence"),
            "kind": F.col("update_kind").isin("snapshot", "delta"),
            "levels": F.forall(
                "levels", lambda x: (x["price"] > 0) & (x["amount"] >= 0) & ((x["action"] == "delete") == (x["amount"] == 0))
            ),
        },
        "quote": {
            "bid": _positive("bid_price") & (F.col("bid_amount") >= 0),
            "ask": _positive("ask_price") & (F.col("ask_amount") >= 0),
            "not_crossed": F.col("bid_price") < F.col("ask_price"),
        },
        "ticker": {
            "window": F.col("window_end_ns") - F.col("window_start_ns") == F.col("window_ns"),
            "duration": (F.col("window_start_ns") >= 0) & (F.col("window_end_ns") - F.col("window_start_ns") == DAY_NS),
            "trade_ids": F.coalesce(F.col("first_trade_id") <= F.col("last_trade_id"), F.lit(True)),
            "range": F.col("low").between(F.lit(0), F.col("high")) & F.col("last").between(F.col("low"), F.col("high")),
        },
        "derivative_ticker": {
            "role": F.length("source_role") > 0,
            "open_interest": F.size("open_interest_units") == F.size(F.array_distinct("open_interest_units")),
            "mark": F.coalesce(F.col("mark_price") > 0, F.lit(True)),
            "age": F.coalesce(F.col("age_ns") >= 0, F.lit(True)),
        },
        "liquidation": {
            "side": F.col("side").isin("buy", "sell"),
            "side_meaning": F.col("side_meaning").isin(*SIDE_MEANINGS),
            "price": _positive("price"),
            "price_kind": F.col("price_kind").isin(*PRICE_KINDS),
            "window": liquidation_window_fits(
                *(F.col(c) for c in ("completeness", "selection", "window_start_ns", "window_end_ns", "window_ns", "per_symbol"))
            ),
        },
        "option_summary": {
            "identity": (F.length("underlying") > 0) & (F.length("index") > 0),
            "kind": F.col("option_kind").isin("call", "put"),
            "strike": _positive("strike"),
            "expiry": F.col("expiry_ns") > 0,
            "volatility_unit": F.col("mark_iv").isNull() | ((F.col("mark_iv") >= 0) & F.col("iv_unit").isin(*IV_UNITS)),
        },
        "instrument_event": {
            "generation": F.col("generation").isNotNull(),
            "resolution": F.col("resolution").isin(*RESOLUTIONS),
            "change": ~F.col("state_before").eqNullSafe(F.col("state_after")) | (F.size("changed_terms") > 0),
            "states": F.coalesce(F.col("state_before").isin(*INSTRUMENT_STATES), F.lit(True))
            & F.coalesce(F.col("state_after").isin(*INSTRUMENT_STATES), F.lit(True)),
        },
        "source_health": {
            "dimension": F.col("dimension").isin(*HEALTH_DIMENSIONS),
            "scope": F.col("scope").isin(*HEALTH_SCOPES),
            "status": F.col("status").isin(*HEALTH_STATUSES),
            "window": (F.col("window_start_ns").isNull() == F.col("window_end_ns").isNull())
            & F.coalesce(F.col("window_end_ns") >= F.col("window_start_ns"), F.lit(True)),
            "change": ~F.col("status").eqNullSafe(F.col("previous_status")),
        },
    }
    return common_rules() | own[family]


def with_violations(df: DataFrame, family: str) -> DataFrame:
    return df.withColumn("violations", violations(contract(family)))


def scope_difference(requested: Column, returned: Column) -> Column:
    """Symbols asked for and not returned, and returned and not asked for."""
    return F.struct(
        F.array_sort(F.array_except(requested, returned)).alias("absent"),
        F.array_sort(F.array_except(returned, requested)).alias("extra"),
    )
