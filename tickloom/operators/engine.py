"""Sequential order books: each venue's chain of ids, buffering and seeding, price ladders, checksums, epoch evidence."""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators.windows import carried, spans

# Why an epoch ends, and the time from which the checksum of the fourth venue is documented as zero.
EXPLICIT, RECONNECT, DISCONTINUITY = "explicit_close", "raw_connection_epoch_changed", "raw_discontinuity"
GAP, BOUNDARY, OVERFLOW = "forward_sequence_gap", "seed_boundary_not_spanned", "buffer_overflow"
MALFORMED, LEVEL_LIMIT, CROSSED, OUTPUT_LIMIT = "malformed_input", "level_limit", "crossed_book", "output_limit"
CHECKSUM_CUTOVER_NS = 1_782_172_800_000_000_000
#: Reasons of this library: a later snapshot of the stream takes over, a checksum differs.
RESEEDED, CHECKSUM = "reseeded", "checksum_mismatch"
#: What venues call the kinds of a message.
SNAPSHOTS, DISCONTINUITIES = ("snapshot", "partial"), ("discontinuity",)


# ---- price ladder -------------------------------------------------------------------------------------------

#: What a level of a folded ladder keeps.
HELD = {
    "price": pa.decimal128(38, 18), "amount": pa.decimal128(38, 18), "action": pa.string(), "rpi_amount": pa.decimal128(38, 18), "price_text": pa.string(), "amount_text": pa.string(),
}


class Ladder:
    """The levels of one side in order of price, best first.

    Prices lie in sorted blocks of bounded length, so adding, dropping, the best price and the best few cost the
    same for a hundred levels and for a hundred thousand.

    A ladder that waits for later messages is a table (``fold``), of which a level takes a twentieth of its objects' memory;
    it is pickled so. ``unfold`` makes objects of the levels at the prices that come next; only those may be asked for.
    """

    BLOCK = 512

    def __init__(self, descending: bool):
        self.sign = -1 if descending else 1
        self._clear()
        self._rest(None)

    def _clear(self) -> None:
        self.levels: dict[Decimal, dict] = {}
        self.blocks: list[list[Decimal]] = []
        self.ends: list[Decimal] = []

    def _rest(self, rest: pa.Table | None) -> None:
        """The levels that are no objects, in no order, with the best price and the best few, once they are asked for."""
        self.rest = rest if rest is not None and len(rest) else None
        self.left = len(self.rest) if self.rest is not None else 0
        self.first = pc.min_max(self.rest["price"])["max" if self.sign < 0 else "min"].as_py() if self.left else None
        self.near: list[dict] = []
        self.asked: set[Decimal] = set()

    def fold(self) -> None:
        """Make a table of all levels."""
        if self.levels:
            levels = self.levels.values()
            columns = [pa.array([x.get(c) for x in levels], t) for c, t in HELD.items()]
            own = pa.table(columns, names=list(HELD))
            rest = own if self.rest is None else pa.concat_tables([self.rest, own])
            self._clear()
            self._rest(rest)

    def unfold(self, prices: Iterable[Decimal]) -> None:
        """Make objects of the levels at ``prices``."""
        if not self.left:
            return
        asked = {*prices} - self.asked
        hit = pc.is_in(self.rest["price"], value_set=pa.array(asked, HELD["price"]))
        found, before = _rows(self.rest.filter(hit)), self.asked
        if found:
            self._rest(self.rest.filter(pc.invert(hit)))
            self.levels |= {x["price"]: x for x in found}
            keys = sorted(p * self.sign for p in self.levels)
            self.blocks = [keys[n : n + self.BLOCK // 2] for n in range(0, len(keys), self.BLOCK // 2)]
            self.ends = [b[-1] for b in self.blocks]
        self.asked = before | asked

    def __getstate__(self) -> tuple[int, bytes | None]:
        self.fold()
        if self.rest is None:
            return self.sign, None
        used = self.rest.select([c for c in HELD if self.rest[c].null_count < self.left]).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, used.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(used)
        return self.sign, sink.getvalue().to_pybytes()

    def __setstate__(self, state: tuple[int, bytes | None]) -> None:
        self.__init__(state[0] < 0)
        if state[1]:
            held = pa.ipc.open_stream(state[1]).read_all()
            columns = [held[c] if c in held.column_names else pa.nulls(len(held), t) for c, t in HELD.items()]
            self._rest(pa.table(columns, names=list(HELD)))

    def __len__(self) -> int:
        return len(self.levels) + self.left

    def _known(self, price: Decimal) -> None:
        if price not in self.asked:
            raise ValueError(f"price {price} of a folded ladder was not unfolded")

    def get(self, price: Decimal) -> dict | None:
        found = self.levels.get(price)
        if found is None and self.left:
            self._known(price)
        return found

    def put(self, price: Decimal, level: dict) -> None:
        if price not in self.levels:
            if self.left:
                self._known(price)
            self._insert(price * self.sign)
        self.levels[price] = level

    def pop(self, price: Decimal) -> None:
        if self.levels.pop(price, None) is None:
            return
        key = price * self.sign
        n = bisect_left(self.ends, key)
        block = self.blocks[n]
        del block[bisect_left(block, key)]
        if block:
            self.ends[n] = block[-1]
        else:
            del self.blocks[n], self.ends[n]

    def _insert(self, key: Decimal) -> None:
        if not self.blocks:
            self.blocks, self.ends = [[key]], [key]
            return
        n = min(bisect_left(self.ends, key), len(self.ends) - 1)
        block = self.blocks[n]
        insort(block, key)
        if len(block) > self.BLOCK:
            half = len(block) // 2
            self.blocks[n : n + 1] = [block[:half], block[half:]]
            self.ends[n : n + 1] = [block[half - 1], block[-1]]
        else:
            self.ends[n] = block[-1]

    def best(self) -> Decimal | None:
        own = self.blocks[0][0] * self.sign if self.blocks else None
        if self.first is None or own is None:
            return self.first if own is None else own
        return max(own, self.first) if self.sign < 0 else min(own, self.first)

    def top(self, depth: int) -> list[dict]:
        found: list[dict] = []
        for block in self.blocks:
            found += [self.levels[key * self.sign] for key in block[: depth - len(found)]]
            if len(found) == depth:
                break
        if not self.left:
            return found
        if len(self.near) < min(depth, self.left):
            order = "descending" if self.sign < 0 else "ascending"
            self.near = _rows(self.rest.take(pc.select_k_unstable(self.rest, depth, [("price", order)])))
        return sorted([*found, *self.near[:depth]], key=lambda x: x["price"] * self.sign)[:depth]


def _rows(held: pa.Table) -> list[dict]:
    return [dict(zip(HELD, x, strict=True)) for x in zip(*(plain(held[c].combine_chunks()) for c in HELD), strict=True)]


#: Where a level that a book holds keeps its digest; one that was folded has none until it is needed.
WEIGHT = "weight"


def _weight(side: str, level: dict) -> int:
    text = "|".join((side, str(level["price"].normalize()), str(level["amount"].normalize()), str(level.get("rpi_amount"))))
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=16).digest(), "big")


def _repeats(levels: Sequence[dict]) -> bool:
    return len({(x["side"], x["price"]) for x in levels}) < len(levels)


@dataclass
class Book:
    """Both ladders and a digest of the levels held, whatever their order. Levels of one event apply together or not at all."""

    sides: dict[str, Ladder] = field(default_factory=lambda: {"buy": Ladder(True), "sell": Ladder(False)})
    held: int = 0

    def fold(self) -> None:
        """Keep all levels as tables; what later events name must be unfolded first."""
        for ladder in self.sides.values():
            ladder.fold()

    def unfold(self, events: Iterable[dict]) -> None:
        """Get ready for the levels of ``events``."""
        prices: dict[str, set[Decimal]] = {side: set() for side in self.sides}
        for event in events:
            for x in event["levels"] or ():
                prices[x["side"]].add(x["price"])
        for side, ladder in self.sides.items():
            ladder.unfold(prices[side])

    def _set(self, side: str, price: Decimal, level: dict | None) -> dict | None:
        ladder = self.sides[side]
        before = ladder.get(price)
        if before is not None:
            self.held -= before[WEIGHT] if WEIGHT in before else _weight(side, before)
        if level is None:
            ladder.pop(price)
        else:
            if WEIGHT not in level:  # a level is digested once, also if it is taken back or replaced
                level[WEIGHT] = _weight(side, level)
            ladder.put(price, level)
            self.held += level[WEIGHT]
        return before

    def change(self, levels: Sequence[dict], strict: bool = False, crossed: bool = True, most: int | None = None, fits=None) -> str | None:
        """None, or why the levels are refused; then the book is as before.

        ``strict`` asks that new, change and delete match what the book holds, ``crossed`` that the best bid stays
        below the best ask, ``most`` bounds the levels of a side, and ``fits`` is a last test of the changed book.
        """
        done: list[tuple[str, Decimal, dict | None]] = []
        why = None
        for x in levels:
            price, amount = x["price"], x["amount"]
            if price <= 0 or amount < 0:
                why = MALFORMED
                break
            empty = amount == 0 and not x.get("rpi_amount")
            action, known = x.get("action"), self.sides[x["side"]].get(price) is not None
            if strict and (action not in ("new", "change", "delete") or known != (action != "new") or (empty and action != "delete")):
                why = MALFORMED
                break
            done.append((x["side"], price, self._set(x["side"], price, None if empty or action == "delete" else x)))
        if not why and most and max(map(len, self.sides.values())) > most:
            why = LEVEL_LIMIT
        if not why and crossed:
            bid, ask = self.best()
            why = CROSSED if bid is not None and ask is not None and bid >= ask else None
        why = why or (fits(self) if fits else None)
        for side, price, before in reversed(done) if why else ():
            self._set(side, price, before)
        return why

    def best(self) -> tuple[Decimal | None, Decimal | None]:
        return self.sides["buy"].best(), self.sides["sell"].best()

    def checksum(self, depth: int = 25) -> int:
        """Signed CRC32 over the best levels, bid and ask in turn, as price:amount in the venue's own text."""
        bids, asks = (self.sides[s].top(depth) for s in ("buy", "sell"))
        parts: list[str] = []
        for n in range(max(len(bids), len(asks))):
            for x in (*bids[n : n + 1], *asks[n : n + 1]):
                parts += [x["price_text"], x["amount_text"]]
        code = zlib.crc32(":".join(parts).encode())
        return code - (1 << 32) if code >> 31 else code


# ---- chains of ids --------------------------------------------------------------------------------------------


class Policy:
    """How a venue's ids chain. ``first`` and ``next`` say apply, stale, gap or refuse of an update.

    ``distinct`` refuses messages that name a price twice. ``polled``: snapshots come from requests beside the stream, and updates wait for one; otherwise they come in the
    stream, replace the book at any time, and updates before one are refused. ``bridges``: the first update after a
    snapshot has a rule of its own, ``first``.
    """

    name, polled, bridges, strict, crossed, distinct = "bridge", True, True, False, True, False

    def waits(self, buffer: Sequence[dict], u: dict) -> str:
        """append, restart (the buffer begins with this update) or refuse."""
        return "append"

    def seed(self, snapshot: dict, buffer: Sequence[dict]) -> int | None:
        """Where to begin with the buffered updates; None if the snapshot can't be used."""
        return None if buffer and snapshot["last_sequence"] + 1 < buffer[0]["first_sequence"] else 0

    def first(self, snapshot: dict, u: dict) -> str:
        if u["last_sequence"] <= snapshot["last_sequence"]:
            return "stale"
        return "apply" if u["first_sequence"] <= snapshot["last_sequence"] + 1 else "gap"

    def next(self, last: dict, u: dict) -> str:
        if u["last_sequence"] <= last["last_sequence"]:
            return "stale"
        return "gap" if u["first_sequence"] > last["last_sequence"] + 1 else "apply"

    def fits(self, event: dict, book: Book) -> str | None:
        return None


class ChainPolicy(Policy):
    """The first update must span the snapshot; later ones name the previous final id."""

    name, crossed = "chain", False

    def seed(self, snapshot: dict, buffer: Sequence[dict]) -> int | None:
        return 0

    def first(self, snapshot: dict, u: dict) -> str:
        if u["last_sequence"] < snapshot["last_sequence"]:
            return "stale"
        return "apply" if u["first_sequence"] <= snapshot["last_sequence"] else "gap"

    def next(self, last: dict, u: dict) -> str:
        if u["last_sequence"] <= last["last_sequence"]:
            return "stale"
        return "apply" if u["previous_sequence"] == last["last_sequence"] else "gap"


class ResetPolicy(Policy):
    """Snapshots in the stream reset the book and deltas apply as they come, but id 1 means that a snapshot is needed."""

    name, polled, bridges, crossed = "reset", False, False, False

    def seed(self, snapshot: dict, buffer: Sequence[dict]) -> int | None:
        return 0

    def next(self, last: dict, u: dict) -> str:
        return "gap" if u["last_sequence"] == 1 else "apply"


class ContiguousPolicy(Policy):
    """Ids rise by one. A polled snapshot fits at the buffered update with its cross sequence, which has its id too."""

    name, bridges, crossed = "contiguous", False, False

    def waits(self, buffer: Sequence[dict], u: dict) -> str:
        if u["last_sequence"] == 1 or not buffer:
            return "restart"
        if u["cross_sequence"] < buffer[-1]["cross_sequence"]:
            return "refuse"
        return "append" if u["last_sequence"] == buffer[-1]["last_sequence"] + 1 else "restart"

    def seed(self, snapshot: dict, buffer: Sequence[dict]) -> int | None:
        at = next((n for n, u in enumerate(buffer) if u["cross_sequence"] >= snapshot["cross_sequence"]), None)
        if at is None:
            return None
        same_id = [n for n in range(at, len(buffer)) if buffer[n]["cross_sequence"] == snapshot["cross_sequence"]]
        if not same_id or any(buffer[n]["last_sequence"] != snapshot["last_sequence"] for n in same_id):
            return None
        return same_id[-1] + 1

    def next(self, last: dict, u: dict) -> str:
        if u["last_sequence"] == 1:
            return "gap"
        if u["cross_sequence"] < last["cross_sequence"]:
            return "refuse"
        if u["last_sequence"] <= last["last_sequence"]:
            return "stale"
        return "apply" if u["last_sequence"] == last["last_sequence"] + 1 else "gap"


class PreviousPolicy(Policy):
    """A snapshot has no previous id (-1); an update's previous id is the last one seen. An equal id is a message without
    levels, a smaller one a maintenance reset. Until the cutover the checksum must be that of the book."""

    name, polled, bridges, crossed, distinct = "previous", False, False, False, True

    def seed(self, snapshot: dict, buffer: Sequence[dict]) -> int | None:
        return 0 if snapshot["previous_sequence"] == -1 else None

    def next(self, last: dict, u: dict) -> str:
        if u["previous_sequence"] != last["last_sequence"] or (u["last_sequence"] == u["previous_sequence"] and u["levels"]):
            return "gap"
        return "apply"

    def fits(self, event: dict, book: Book) -> str | None:
        given, time = event.get("checksum"), event.get("event_time_ns")
        if given is None:
            return None
        right = 0 if time is not None and time >= CHECKSUM_CUTOVER_NS else book.checksum()
        return None if given == right else CHECKSUM


class ChangePolicy(Policy):
    """Change ids chain by the previous one and rise, and each new, change or delete must fit the book."""

    name, polled, bridges, strict, crossed = "change", False, False, True, False

    def seed(self, snapshot: dict, buffer: Sequence[dict]) -> int | None:
        return 0

    def next(self, last: dict, u: dict) -> str:
        return "apply" if u["previous_sequence"] == last["last_sequence"] < u["last_sequence"] else "gap"


POLICIES: dict[str, type[Policy]] = {p.name: p for p in (Policy, ChainPolicy, ResetPolicy, ContiguousPolicy, PreviousPolicy, ChangePolicy)}


# ---- engine ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Bounds:
    """What an epoch may hold or give. Beyond a bound it closes with the reason, and stays closed until the connection does."""

    messages: int = 10_000
    payload_bytes: int | None = None
    span_ns: int | None = None
    levels: int | None = None
    outputs: int | None = None


COUNTS = ("accepted", "applied", "stale", "gaps", "refused", "outputs")


def _chained(before: str, entry: str) -> str:
    """Digest of all entries so far; the first has the empty text before it."""
    return hashlib.sha256(f"{before}|{entry}".encode()).hexdigest()


class Engine:
    """One instrument's books within one connection epoch.

    States: buffering (updates wait for a polled snapshot), needs_snapshot (of the stream), seeded (no update has met
    the snapshot yet), live, closed. Each reconstruction epoch ends with a row of evidence, with its reason. Without
    ``changes`` the books are the same, but only epochs give a row.
    """

    def __init__(self, policy: Policy, bounds: Bounds | None = None, check_crossed: bool | None = None, changes: bool = True):
        self.policy, self.bounds, self.changes = policy, bounds or Bounds(), changes
        self.crossed = policy.crossed if check_crossed is None else check_crossed
        self.number, self.seen = 0, None
        self._start("initial")

    def _start(self, reason: str) -> None:
        self.number, self.opened, self.closed = self.number + 1, reason, None
        self.book, self.last, self.buffer, self.buffered = Book(), None, [], 0
        self.state = "buffering" if self.policy.polled else "needs_snapshot"
        self.counts = dict.fromkeys(COUNTS, 0)
        self.observed: list = []
        self.accepted: list = []
        self.inputs, self.results = "", ""

    def _observe(self, event: dict) -> None:
        self.observed = [*self.observed[:1], event["event_id"]]

    def _take(self, event: dict, what: str) -> None:
        self.counts["accepted"] += 1
        if what in self.counts:
            self.counts[what] += 1
        self.accepted = [*self.accepted[:1], event["event_id"]]
        self.inputs = _chained(self.inputs, f"{what}|{event['event_id']}|{event['last_sequence']}")

    def _restart(self, reason: str) -> Iterator[dict]:
        """End the epoch, if it has seen anything, and begin the next."""
        if self.observed:
            yield self.evidence(reason)
            self._start(reason)
        else:  # nothing was seen of it: the next one takes its number
            self.number -= 1
            self._start(reason)

    def _close(self, reason: str) -> None:
        self.state, self.closed, self.buffer = "closed", reason, []

    def _fail(self, reason: str) -> Iterator[dict]:
        """A polled book stays closed for the rest of its connection; one of the stream waits for the next snapshot."""
        if self.policy.polled:
            self._close(reason)
        else:
            yield from self._restart(reason)

    def accept(self, event: dict) -> Iterator[dict]:
        """Take a message; give a row for each change of the book and for each epoch that ends."""
        if event["update_kind"] in DISCONTINUITIES:
            yield from self._restart(DISCONTINUITY)
            return
        if event.get("coordinate") is not None:
            if event["coordinate"] == self.seen and self.state != "closed":
                yield from self._restart(DISCONTINUITY)
            self.seen = event["coordinate"]
        if self.state == "closed":
            self.counts["refused"] += 1
            return
        if event["update_kind"] in SNAPSHOTS:
            yield from self._snapshot(event)
        elif self.state in ("seeded", "live"):
            self._observe(event)
            yield from self._update(event)
        elif self.policy.polled:
            yield from self._wait(event)
        else:
            self._observe(event)
            self.counts["refused"] += 1

    def _wait(self, event: dict) -> Iterator[dict]:
        verdict = self.policy.waits(self.buffer, event)
        if verdict == "refuse":
            self.counts["refused"] += 1
            return
        if verdict == "restart" and self.buffer:
            self.counts["gaps"] += 1
            yield from self._restart(GAP)
        self._observe(event)
        self.buffered = (self.buffered if self.buffer else 0) + (event.get("payload_bytes") or 0)
        self.buffer.append(event)
        times = [self.buffer[0].get("received_time_ns"), event.get("received_time_ns")]
        long = self.bounds.span_ns is not None and None not in times and times[1] - times[0] > self.bounds.span_ns
        heavy = self.bounds.payload_bytes is not None and self.buffered > self.bounds.payload_bytes
        if long or heavy or len(self.buffer) > self.bounds.messages:
            self._close(OVERFLOW)

    def _snapshot(self, event: dict) -> Iterator[dict]:
        if self.policy.polled and (self.state == "live" or (at := self.policy.seed(event, self.buffer)) is None):
            self.counts["refused"] += 1
            return
        if not self.policy.polled:
            if self.last is not None:
                yield from self._restart(RESEEDED)
            at = self.policy.seed(event, ())
        self._observe(event)
        book = Book()
        given = event["levels"]
        odd = self.policy.strict and (_repeats(given) or any(x["amount"] == 0 or x.get("action") == "delete" for x in given))
        why = MALFORMED if at is None or odd else self._changed(book, event, strict=False)
        if why:
            self.counts["refused"] += 1
            yield from self._fail(why)
            return
        self.book, self.last, self.state = book, event, "seeded" if self.policy.bridges else "live"
        self._take(event, "seed")
        yield from self._give(event)
        waiting, self.buffer = self.buffer[at:], []
        for n, update in enumerate(waiting):
            if self.state not in ("seeded", "live"):
                # what follows a gap waits for the next snapshot, in its own epoch
                for left in waiting[n:]:
                    if self.state != "closed":
                        yield from self._wait(left)
                return
            self._observe(update)
            yield from self._update(update)

    def _update(self, event: dict) -> Iterator[dict]:
        first = self.state == "seeded"
        action = (self.policy.first if first else self.policy.next)(self.last, event)
        if action == "refuse":
            self.counts["refused"] += 1
        elif action == "stale":
            self._take(event, "stale")
        elif action == "gap":
            self.counts["gaps"] += 1
            yield from self._restart(BOUNDARY if first else GAP)
            if self.policy.polled:
                yield from self._wait(event)
        elif self.bounds.outputs is not None and self.counts["outputs"] >= self.bounds.outputs:
            yield from self._fail(OUTPUT_LIMIT)
        elif why := self._changed(self.book, event, self.policy.strict):
            self.counts["refused"] += 1
            yield from self._fail(why)
        else:
            self.last, self.state = event, "live"
            self._take(event, "applied")
            yield from self._give(event)

    def _changed(self, book: Book, event: dict, strict: bool) -> str | None:
        if self.policy.distinct and _repeats(event["levels"]):
            return MALFORMED
        return book.change(event["levels"], strict, self.crossed, self.bounds.levels, lambda b: self.policy.fits(event, b))

    def _give(self, event: dict) -> Iterator[dict]:
        self.counts["outputs"] += 1
        self.results = _chained(self.results, f"{event['event_id']}|{event['last_sequence']}|{self.book.held % (1 << 128):032x}")
        if self.changes:
            yield self._row("book", event["event_id"])

    def _row(self, kind: str, event_id) -> dict:
        bid, ask = self.book.best()
        sizes = {"bids": len(self.book.sides["buy"]), "asks": len(self.book.sides["sell"])}
        last = self.last["last_sequence"] if self.last else None
        return {"kind": kind, "epoch_no": self.number, "event_id": event_id, "state": self.state, "last_sequence": last, "best_bid": bid, "best_ask": ask, **sizes}

    def evidence(self, reason: str | None = None) -> dict:
        """What the epoch came to; ``reason`` holds where it isn't closed already."""
        ends = {"opened_by": self.opened, "close_reason": self.closed or reason}
        ids = [x for pair in (self.observed, self.accepted) for x in (pair[0] if pair else None, pair[-1] if pair else None)]
        ranges = dict(zip(("first_observed", "last_observed", "first_accepted", "last_accepted"), ids, strict=True))
        digests = {"input_digest": self.inputs, "output_digest": self.results}
        return {**self._row("epoch", None), **self.counts, **ends, **ranges, **digests}


# ---- over frames ----------------------------------------------------------------------------------------------

IDS = ("first_sequence", "last_sequence", "previous_sequence", "cross_sequence", "checksum", "event_time_ns", "received_time_ns", "payload_bytes")
LEVEL = {"side": "string", "price": "decimal(38,18)", "amount": "decimal(38,18)", "action": "string", "rpi_amount": "decimal(38,18)", "price_text": "string", "amount_text": "string"}


def with_levels(events: DataFrame) -> Column:
    """The levels of mapped rows: ``levels``, or ``bids`` and ``asks`` together, with nulls for what a venue doesn't give."""
    name = "levels" if "levels" in events.columns else "bids"
    has = set(events.schema[name].dataType.elementType.names)
    whole = lambda x: F.struct(*((x[c] if c in has else F.lit(None)).cast(t).alias(c) for c, t in LEVEL.items()))
    given = F.col("levels") if name == "levels" else F.concat(F.coalesce("bids", F.array()), F.coalesce("asks", F.array()))
    return F.transform(given, whole)


def reconstruct(
    events: DataFrame,
    policy: str = "bridge",
    check_crossed: bool | None = None,
    order: Sequence[str] = ("received_time_ns", "event_id"),
    key: Sequence[str] = ("instrument_uid", "epoch_id"),
    bounds: Bounds | None = None,
    span: int = 3_600_000_000_000,
    changes: bool = True,
    runs: Sequence[str] = (),
) -> DataFrame:
    """Rows of kind book (one per change) and epoch (evidence of one reconstruction epoch) for mapped messages.

    Without ``changes`` only epochs are given; books are rebuilt and digested as ever, but no row per change leaves the task.

    ``events`` has the columns of ``key`` (instrument, then connection epoch), ``order``, event_id, update_kind and levels
    or bids and asks; those of the ids that a venue doesn't give may be absent. ``runs`` are boolean columns: each names the
    events of a run, whose books are rebuilt from these alone and whose rows have its name as ``run``; all runs share one
    pass over the events. Snapshots of the stream would cut one run at another's, so runs are for polled ones. Two messages with one place in
    ``order`` are a discontinuity, as is a row of kind ``discontinuity``.

    Epochs restart from a snapshot, so each is a sequence of its own: a task streams through its sorted epochs and holds
    one book at a time. Where snapshots come in the stream, each starts a sequence too (``segment``), so that a busy epoch
    spreads over its snapshots (they are counted in two passes, in chunks of ``span`` of the first order column). An
    epoch seeded by polled snapshots can't be cut. ``epoch_no`` counts within a sequence, and the last epoch of a
    sequence ends as ``explicit_close``; ``linked_epochs`` names what really followed.
    """
    rules = POLICIES[policy]
    if not set(key[:2]) <= set(events.columns):
        raise ValueError(f"events must have {key}")
    if runs and not rules.polled:
        raise ValueError("runs need a policy with polled snapshots")
    kept = [*key, *dict.fromkeys(c for c in (*order, "event_id", "update_kind", *IDS, *runs) if c in events.columns and c not in key)]
    rows = events.select(*kept, with_levels(events).alias("levels"))
    cut = [] if rules.polled else ["segment"]
    if cut:
        seeds = F.when(F.col("update_kind").isin(*SNAPSHOTS), 1).otherwise(0).cast("long")
        rows = carried(rows, key, spans(order[0], span), order, sums={"segment": seeds})
    named = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    group = {**{c: named[c] for c in key}, "segment": "long"}
    event_id = named["event_id"]
    result = {
        "kind": "string", "epoch_no": "long", "event_id": event_id, "state": "string", "last_sequence": "long", "best_bid": "decimal(38,18)", "best_ask": "decimal(38,18)",
        "bids": "long", "asks": "long", **dict.fromkeys(COUNTS, "long"), "opened_by": "string", "close_reason": "string", "first_observed": event_id,
        "last_observed": event_id, "first_accepted": event_id, "last_accepted": event_id, "input_digest": "string", "output_digest": "string",
    }
    if runs:
        result["run"] = "string"
    schema = ", ".join(f"`{c}` {t}" for c, t in {**group, **result}.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engines: dict[str | None, Engine] = {}
        current, types = None, None
        done: list[dict] = []

        def end() -> None:
            done.extend({**current, **engine.evidence(EXPLICIT), "run": name} for name, engine in engines.items() if engine.observed)

        for batch in batches:
            types = types or _arrow_types(batch.schema, group, result)
            for event in _events(batch):
                here = {c: event.get(c) if c != "segment" or cut else 0 for c in group}
                if here != current:
                    end()
                    engines, current = {name: Engine(rules(), bounds, check_crossed, changes) for name in runs or (None,)}, here
                event["coordinate"] = tuple(event[c] for c in order)
                for name, engine in engines.items():
                    if name is None or event[name]:
                        done += [{**here, **row, "run": name} for row in engine.accept(event)]
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=types)
                done = []
        end()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=types)

    grouping = [*key, *cut]
    # dealt by a hash of its own: over a union of sides that are dealt by these columns already Spark leaves the shuffle out,
    # but coalesces the sides' partitions apart
    made = rows.repartition(F.xxhash64(*grouping)).sortWithinPartitions(*grouping, *order).mapInArrow(run, schema)
    return made


def _events(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch as ``to_pylist`` gives them, read by column: levels are many and most of their fields null."""
    at = batch.schema.get_field_index("levels")
    lists = batch.column(at)
    flat = lists.flatten()
    names = [f.name for f in flat.type]
    fields = [plain(c) for c in flat.flatten()]
    levels = [dict(zip(names, x, strict=True)) for x in zip(*fields, strict=True)]
    sizes = [n or 0 for n in pc.list_value_length(lists).to_pylist()]
    others = [(c, plain(batch.column(i))) for i, c in enumerate(batch.schema.names) if i != at]
    absent, start = lists.is_null().to_pylist(), 0
    for n, size in enumerate(sizes):
        yield {**{c: values[n] for c, values in others}, "levels": None if absent[n] else levels[start : start + size]}
        start += size


def plain(column: pa.Array) -> list:
    """``to_pylist``, with texts and decimals made once for each value that differs."""
    if column.null_count == len(column):
        return [None] * len(column)
    if not (pa.types.is_string(column.type) or pa.types.is_decimal128(column.type)):
        return column.to_pylist()
    coded = column.dictionary_encode()
    values = coded.dictionary.cast(pa.string()).to_pylist()
    if pa.types.is_decimal128(column.type):
        values = [Decimal(v) for v in values]
    return [None if n is None else values[n] for n in coded.indices.to_pylist()]


def _arrow_types(given: pa.Schema, group: dict, result: dict) -> pa.Schema:
    ids, price = given.field("event_id").type, pa.decimal128(38, 18)
    named = {"long": pa.int64(), "string": pa.string(), "decimal(38,18)": price}
    key = [(c, given.field(c).type if c in given.names else pa.int64()) for c in group]
    of_ids = ("event_id", "first_observed", "last_observed", "first_accepted", "last_accepted")
    return pa.schema([*key, *((c, ids if c in of_ids else named[t]) for c, t in result.items())])


def linked_epochs(rows: DataFrame, key: Sequence[str] = ("instrument_uid", "epoch_id")) -> DataFrame:
    """The evidence rows of ``reconstruct`` in one chain per instrument: ``number`` from 1 and ``parent``, the number before.

    Where a sequence was cut at a snapshot, the earlier epoch was closed and the later one opened by it; the last epoch
    of a connection that another one follows was closed by that. An instrument has few epochs, so they are sorted whole.
    """
    epochs = rows.where("kind = 'epoch'")
    along = Window.partitionBy(key[0]).orderBy(key[1], "segment", "epoch_no")
    lead = F.struct(key[1], "segment")
    after = F.lead(lead).over(along)
    ended = F.col("close_reason") == EXPLICIT
    same = after[key[1]] == F.col(key[1])
    closes = F.when(ended & same & (after["segment"] != F.col("segment")), RESEEDED).when(ended & ~same, RECONNECT).otherwise(F.col("close_reason"))
    found = epochs.withColumn("close_reason", closes).withColumn("number", F.row_number().over(along).cast("long"))
    opens = F.when(F.col("opened_by") == "initial", F.coalesce(F.lag("close_reason").over(along), "opened_by")).otherwise(F.col("opened_by"))
    return found.withColumn("opened_by", opens).withColumn("parent", F.when(F.col("number") > 1, F.col("number") - 1))
