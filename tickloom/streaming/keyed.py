"""Keyed streams with state and event-time timers: sparse tickers, the gap ledger, silences and sequential books.

Each is a processor over the rows of a key. State lives in the state store, so a restarted query goes on where it was;
timers fire when the watermark passes them. The watermark has milliseconds and rows at it are dropped as late, so it stays
one millisecond behind unless told otherwise: rows with one time may then be in two batches. Rows of a key are taken in order within a micro-batch, and batches in the order
in which the source gives them, so a batch is bounded by the source's files per trigger.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tickloom.operators import engine as books
from tickloom.streaming.jobs import drain

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: All state stores of an executor share one bounded memory; by default each has its own.
BOUNDED = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB, which state with timers needs and which may exceed memory."""
    wanted = {PROVIDER: ROCKSDB, BOUNDED: "true"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)


def drained(stream: DataFrame, folder: str) -> DataFrame:
    """``jobs.drain`` of a keyed stream."""
    with keyed_state(stream.sparkSession):
        return drain(stream, folder)


def _timed(stream: DataFrame, time: str, late: str) -> DataFrame:
    """``stream`` with an event time, for the watermark, from a column of nanoseconds."""
    return stream.withColumn("event_time", F.timestamp_micros(F.call_function("div", F.col(time), F.lit(1000)))).withWatermark("event_time", late)


def _schema(stream: DataFrame, names: Sequence[str], more: str) -> StructType:
    picked = StructType([stream.schema[n] for n in names])
    return StructType(picked.fields + StructType.fromDDL(more).fields)


# ---- sparse ticker ----------------------------------------------------------------------------------------------


class _Ticker(StatefulProcessor):
    def __init__(self, out: StructType, by: Sequence[str], order: Sequence[str], time: str, fields: Sequence[str], kept: Sequence[str], state: StructType):
        self.row, self.by, self.order, self.time, self.fields, self.kept, self.schema = Row(*out.names), by, order, time, fields, kept, state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("ticker", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        held = self.state.get()
        epoch, seeded, seen, *values = held if held is not None else (None, False, None, *[None] * len(self.fields))
        for r in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            if r["epoch_id"] != epoch:  # a new connection knows nothing of the one before
                epoch, seeded, seen, values = r["epoch_id"], False, None, [None] * len(self.fields)
            fresh = r["kind"] == "snapshot"
            refused = None if fresh or seeded else "unseeded"
            refused = refused or ("time_regressed" if seen is not None and r[self.time] < seen else None)
            if refused is None:
                values = [r[f] if r[f"has_{f}"] else None if fresh else v for f, v in zip(self.fields, values, strict=True)]
                seeded, seen = True, r[self.time]
            now = values if refused is None else [None] * len(self.fields)
            yield self.row(*key, *(r[c] for c in self.kept), *now, refused)
        self.state.update((epoch, seeded, seen, *values))

    def close(self) -> None:
        pass


def ticker(stream: DataFrame, by: Sequence[str], order: Sequence[str], time: str, fields: Sequence[str], kept: Sequence[str]) -> DataFrame:
    """(by..., kept..., now_<field>..., refused): ``books.ticker_state`` as a stream.

    Rows have epoch_id, kind (snapshot or delta) and ``has_<field>``. A snapshot sets all fields, a delta those that it
    names; a new epoch clears them; a delta before a snapshot, and a row whose ``time`` lies before the last accepted
    one, are refused and change nothing.
    """
    types = {f: stream.schema[f].dataType.simpleString() for f in fields}
    more = ", ".join([f"now_{f} {t}" for f, t in types.items()] + ["refused string"])
    out = _schema(stream, [*by, *kept], more)
    state = StructType.fromDDL(", ".join(["epoch string", "seeded boolean", "seen long", *(f"`{f}` {t}" for f, t in types.items())]))
    processor = _Ticker(out, by, order, time, fields, kept, state)
    return stream.groupBy(*by).transformWithState(processor, out, "append", "none")


# ---- gap ledger ---------------------------------------------------------------------------------------------------


class _Ledger(StatefulProcessor):
    def __init__(self, out: StructType):
        self.row = Row(*out.names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "gap_id string, start_ns long, end_ns long")

    def handleInputRows(self, key, rows, timerValues):
        held = self.open.get() if self.open.exists() else None
        for r in sorted(rows, key=lambda r: (r["at_ns"], r["kind"] != "gap", r["gap_id"] or "")):
            if r["kind"] == "gap":
                if held is None:  # one open gap a tuple
                    held = (r["gap_id"], r["start_ns"], r["end_ns"])
                    yield self.row(*key, *held, None, "open")
            elif held is not None:
                yield self.row(*key, *held, r["at_ns"], r["kind"])
                held = None
        self.open.update(held) if held is not None else self.open.clear()

    def close(self) -> None:
        pass


def gap_ledger(stream: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., gap_id, start_ns, end_ns, resolved_ns, state): each change of a gap's state, as it happens.

    ``stream`` has at_ns, kind (gap, recovered or permanent), gap_id, start_ns and end_ns. A gap opens if its tuple has none
    open; the next recovered or permanent row ends it, once. ``quality.gap_lifecycle`` is the batch form.
    """
    out = _schema(stream, [*by, "gap_id", "start_ns", "end_ns"], "resolved_ns long, state string")
    return stream.groupBy(*by).transformWithState(_Ledger(out), out, "append", "none")


# ---- silence --------------------------------------------------------------------------------------------------------


class _Silence(StatefulProcessor):
    def __init__(self, out: StructType, limit_ns: int):
        self.row, self.limit = Row(*out.names), limit_ns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", "at_ns long, timer_ms long, told boolean")

    def handleInputRows(self, key, rows, timerValues):
        last, timer, told = self.last.get() if self.last.exists() else (None, None, False)
        for at in sorted(r["at_ns"] for r in rows):
            if last is not None and not told and at - last > self.limit:
                yield self.row(*key, last)
            if last is None or at >= last:
                told, last = (told and at == last), at
        if timer is not None:
            self.handle.deleteTimer(timer)
        timer = -(-(last + self.limit + 1) // 1_000_000)  # timers have milliseconds
        self.handle.registerTimer(timer)
        self.last.update((last, timer, told))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last, timer, told = self.last.get()
        if not told:
            self.last.update((last, timer, True))
            yield self.row(*key, last)

    def close(self) -> None:
        pass


def silences(stream: DataFrame, by: Sequence[str], time: str, limit_ns: int, late: str = "1 millisecond") -> DataFrame:
    """(by..., from_ns): told once for each stretch without a row that is longer than the limit.

    A timer at the limit's end tells it while the key is still silent, when the watermark, that is the other keys' time,
    has passed it; a later row of the key tells it otherwise. ``quality.silent_since`` is the batch form.
    """
    rows = _timed(stream.select(*by, F.col(time).alias("at_ns")), "at_ns", late)
    out = _schema(rows, by, "from_ns long")
    return rows.groupBy(*by).transformWithState(_Silence(out, limit_ns), out, "append", "eventtime")


# ---- deadlines ----------------------------------------------------------------------------------------------------------


class _Deadlines(StatefulProcessor):
    def __init__(self, out: StructType, limit_ns: int):
        self.row, self.limit = Row(*out.names), limit_ns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.asked = handle, handle.getListState("asked", "request_id long, at_ns long")

    def handleInputRows(self, key, rows, timerValues):
        open_ = [(r[0], r[1]) for r in self.asked.get()] if self.asked.exists() else []
        for r in sorted(rows, key=lambda r: (r["at_ns"], r["request_id"] is None)):
            if r["request_id"] is not None:
                open_.append((r["request_id"], r["at_ns"]))
                # any row after the deadline settles it, and the timer does where none comes
                self.handle.registerTimer((r["at_ns"] + self.limit) // 1_000_000 + 1)
                continue
            for request, at in open_:
                yield self.row(request, "acknowledged" if r["at_ns"] <= at + self.limit else "missed")
            open_ = []
        self._keep(open_)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = expiredTimerInfo.getExpiryTimeInMs() * 1_000_000
        open_ = [(r[0], r[1]) for r in self.asked.get()] if self.asked.exists() else []
        left = [(request, at) for request, at in open_ if at + self.limit >= passed]
        for request, at in open_:
            if at + self.limit < passed:
                yield self.row(request, "missed")
        self._keep(left)

    def _keep(self, open_: list) -> None:
        self.asked.put(open_) if open_ else self.asked.clear()

    def close(self) -> None:
        pass


def deadlines(stream: DataFrame, by: Sequence[str], limit_ns: int, late: str = "1 millisecond") -> DataFrame:
    """(request_id, outcome), once for each request whose deadline the watermark has passed or that is answered.

    ``stream`` has at_ns and request_id, null for an answer. A request is acknowledged by the next answer of its key if
    that comes within the limit, and missed if that comes later or when the timer at its deadline fires. State is the
    open requests of a key. ``quality.deadlines`` is the batch form.
    """
    rows = _timed(stream.select(*by, "at_ns", "request_id"), "at_ns", late)
    out = StructType.fromDDL("request_id long, outcome string")
    return rows.groupBy(*by).transformWithState(_Deadlines(out, limit_ns), out, "append", "eventtime")


# ---- sequential books -------------------------------------------------------------------------------------------------

BOOK = "event_id long, kind string, epoch_no long, state string, last_sequence long, best_bid decimal(38,18), best_ask decimal(38,18), bids long, asks long, applied long, gaps long, close_reason string"


#: Rows that are objects at a time, and bytes of a value in the state store.
TURN, PART = 20_000, 1 << 20
LEVEL = tuple(books.LEVEL)


def _packed(levels: Column) -> Column:
    """Levels as one JSON text: a row's nested values are read one by one, which takes longer than all the rest."""
    return F.to_json(F.transform(levels, lambda x: F.array(*(x[c].cast("string") for c in LEVEL))))


def _unpacked(text: str | None) -> list[dict] | None:
    if text is None:
        return None
    levels = [dict(zip(LEVEL, x, strict=True)) for x in json.loads(text)]
    for x in levels:
        x["price"], x["amount"] = Decimal(x["price"]), Decimal(x["amount"])
        x["rpi_amount"] = None if x["rpi_amount"] is None else Decimal(x["rpi_amount"])
    return levels


class _Books(StatefulProcessor):
    def __init__(self, out: StructType, by: int, order: Sequence[str], policy: str, crossed: bool | None, bounds: books.Bounds | None, idle_ns: int):
        self.names, self.by, self.order, self.policy, self.crossed, self.bounds, self.idle = out.names, by, order, policy, crossed, bounds, idle_ns
        self.row = Row(*out.names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.engine = handle.getValueState("engine", "parts int, timer_ms long")
        self.parts = handle.getMapState("parts", "n int", "part binary")

    def _given(self, key, row: dict):
        return self.row(*key, *(row.get(c) for c in self.names[self.by :]))

    def _held(self) -> tuple[books.Engine | None, int, int | None]:
        """The engine, its number of parts and its timer."""
        if not self.engine.exists():
            return None, 0, None
        parts, timer = self.engine.get()
        return pickle.loads(b"".join(bytes(self.parts.getValue((n,))[0]) for n in range(parts))), parts, timer

    def _keep(self, engine: books.Engine, before: int, timer: int) -> None:
        held = pickle.dumps(engine)
        starts = range(0, len(held), PART)
        for n, start in enumerate(starts):
            self.parts.updateValue((n,), (held[start : start + PART],))
        for n in range(len(starts), before):
            self.parts.removeKey((n,))
        self.engine.update((len(starts), timer))

    def handleInputRows(self, key, rows, timerValues):
        engine, parts, timer = self._held()
        engine = engine or books.Engine(books.POLICIES[self.policy](), self.bounds, self.crossed)
        latest = 0
        ordered = sorted(rows, key=lambda r: tuple(r[c] for c in self.order))
        for start in range(0, len(ordered), TURN):
            events = [{**r.asDict(), "levels": _unpacked(r["levels"])} for r in ordered[start : start + TURN]]
            engine.book.unfold(events)
            for event in events:
                event["coordinate"] = tuple(event[c] for c in self.order)
                latest = max(latest, event["received_time_ns"])
                for row in engine.accept(event):
                    yield self._given(key, row)
            engine.book.fold()
        if timer is not None:
            self.handle.deleteTimer(timer)
        timer = (latest + self.idle) // 1_000_000 + 1
        self.handle.registerTimer(timer)
        self._keep(engine, parts, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """A connection that is silent for long has ended: its evidence is given and its state goes."""
        engine, _, _ = self._held()
        self.engine.clear()
        self.parts.clear()
        if engine.observed:
            yield self._given(key, engine.evidence(books.EXPLICIT))

    def close(self) -> None:
        pass


def sequential_books(
    stream: DataFrame, policy: str = "bridge", check_crossed: bool | None = None, order: Sequence[str] = ("received_time_ns", "event_id"), key: Sequence[str] = ("instrument_uid", "epoch_id"),
    bounds: books.Bounds | None = None, idle_ns: int = 86_400_000_000_000, late: str = "1 millisecond",
) -> DataFrame:
    """Rows of kind book and epoch as ``engine.reconstruct`` gives them, from a stream of mapped messages.

    The state of a connection is its engine: the book it holds and what it buffers, both bounded by ``bounds``. It is
    dropped, with a last row of evidence, when the connection has been silent for ``idle_ns`` of event time. A book is kept as
    compressed tables, in values of a megabyte, and only the levels that the next messages name are made objects.
    """
    ids = [c for c in books.IDS if c in stream.columns and c not in (*key, *order)]
    kept = [*dict.fromkeys([*key, *order, "event_id", "update_kind", *ids])]
    rows = _timed(stream.select(*kept, _packed(books.with_levels(stream)).alias("levels")), "received_time_ns", late)
    out = _schema(rows, key, BOOK)
    return rows.groupBy(*key).transformWithState(_Books(out, len(key), order, policy, check_crossed, bounds, idle_ns), out, "append", "eventtime")
