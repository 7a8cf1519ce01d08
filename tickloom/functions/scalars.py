"""Scalar expressions over market-data columns, all of Spark's own functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_SCALE, PERCENT_SCALE, MAX_DIGITS = 18, 8, 38
INT64_MAX = (1 << 63) - 1

#: Quality flags that a row may carry. Fixed values.
QUALITY_FLAGS = (
    "clock_uncertain", "exchange_time_regression", "schema_additive_field", "source_duplicate_candidate",
)


def strict_decimal(text: Column, scale: int = PRICE_SCALE) -> Column:
    """Strict decimal(38, scale): optional minus, digits, an optional dot with digits on both sides; else null.

    More fraction digits than ``scale`` or more than 38 digits are refused, where a bare cast would round.
    """
    shape = text.rlike(rf"^-?[0-9]+(\.[0-9]{{1,{scale}}})?\z")
    return F.when(shape, text.try_cast(f"decimal({MAX_DIGITS},{scale})"))  # null where the digits don't fit


def decimal_text(value: Column) -> Column:
    """A decimal as plain text at its full scale."""
    return value.cast("string")


def json_state(payload: Column, field: str) -> Column:
    """missing, null, empty or value: what a JSON object says about a field."""
    value = F.get_json_object(payload, f"$.{field}")
    present = F.coalesce(F.array_contains(F.json_object_keys(payload), field), F.lit(False))
    return F.when(~present, "missing").when(value.isNull(), "null").when(value == "", "empty").otherwise("value")


def digest(*parts: Column) -> Column:
    """SHA-256, in hex, of length-prefixed parts; null parts are told apart from empty ones."""
    tagged = [F.coalesce(F.concat(F.octet_length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")), F.lit("-")) for p in parts]
    return F.sha2(F.concat_ws("|", *tagged), 256)


def uuid_of(domain: str, *parts: Column) -> Column:
    """A UUID-shaped text that depends on domain and parts only."""
    h = digest(F.lit(domain), *parts)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *(F.substring(h, a, n) for a, n in cuts))


def native_to_ns(value: Column, unit: str) -> Column:
    """Epoch nanoseconds of a native time; null where the product leaves 64 bits or the time is negative."""
    factor = {"s": 1_000_000_000, "ms": 1_000_000, "us": 1_000, "ns": 1}[unit]
    fits = (value >= 0) & (value <= INT64_MAX // factor)
    return F.when(fits, F.when(fits, value).otherwise(0).cast("long") * F.lit(factor).cast("long"))


def exact_multiply(a: Column, b: Column, scale: int = 6) -> Column:
    """Product of two decimals at ``scale``; null where digits would be lost."""
    product = a.cast(f"decimal(18,{scale})") * b.cast(f"decimal(18,{scale})")
    narrow = product.try_cast(f"decimal(36,{scale})")
    return F.when(narrow == product, narrow)


def exact_divide(a: Column, b: Column, scale: int = 6) -> Column:
    """Quotient at ``scale``; null for a zero divisor or where a remainder is left."""
    x, y = a.cast(f"decimal(18,{scale})"), b.cast(f"decimal(18,{scale})")
    quotient = F.try_divide(x, y).try_cast(f"decimal(18,{scale})")
    return F.when(quotient * y == x, quotient)


def signed_crc32(text: Column) -> Column:
    """CRC32 as a signed 32-bit number."""
    crc = F.crc32(text.cast("binary"))
    return F.when(crc >= 1 << 31, crc - (1 << 32)).otherwise(crc)


def book_checksum(bids: Column, asks: Column, depth: int = 25) -> Column:
    """Signed CRC32 over 'price:amount' texts of the best levels of both sides in turn."""
    top = F.greatest(F.size(bids), F.size(asks))
    turns = F.transform(
        F.slice(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), F.least(top, F.lit(depth))),
        lambda i: F.array_compact(F.array(F.try_element_at(bids, i), F.try_element_at(asks, i))),
    )
    return signed_crc32(F.array_join(F.flatten(turns), ":"))


def ns_date(ns: Column) -> Column:
    """UTC date of epoch nanoseconds, free of the session's time zone."""
    day = F.lit(86_400_000_000_000)
    return F.date_from_unix_date(F.call_function("div", ns - F.pmod(ns, day), day).cast("int"))


def ns_hour(ns: Column) -> Column:
    return F.pmod(F.call_function("div", ns, F.lit(3_600_000_000_000)), F.lit(24)).cast("int")


def quality_flags(flags: Column, allowed: Sequence[str] = QUALITY_FLAGS, most: int = 64) -> Column:
    """Flags sorted and distinct; null if any is not allowed or there are too many."""
    clean = F.array_sort(F.array_distinct(flags))
    fine = F.forall(clean, lambda f: f.isin(*allowed)) & (F.size(clean) <= most)
    return F.when(fine, clean)


def unit_agrees(kind: Column, base: Column, quote: Column, want: str) -> Column:
    """Whether a unit is of the wanted kind and names the assets that this kind needs."""
    assets = {
        "base": base.isNotNull() & quote.isNull(),
        "quote": base.isNull() & quote.isNotNull(),
        "quote_per_base": base.isNotNull() & quote.isNotNull() & (base != quote),
        "percent": base.isNull() & quote.isNull(),
    }
    return F.coalesce((kind == want) & assets[want], F.lit(False))


def field_age(received_ns: Column, source_ns: Column) -> Column:
    """Received minus source time; null without a source time, also if it lies in the future."""
    return F.when(source_ns <= received_ns, received_ns - source_ns)


#: How complete a liquidation feed is, and how the events of its window were chosen. Fixed values.
LIQUIDATION_COMPLETENESS = ("complete", "largest_in_window", "partial_nonchronological", "trade_flag_only")
WINDOW_SELECTIONS = ("all_observed", "largest_per_symbol", "unknown")


def liquidation_window_fits(completeness: Column, selection: Column, start: Column, end: Column, duration: Column, per_symbol: Column) -> Column:
    """Whether a window agrees with what its feed claims.

    Bounds come both or not at all and lie a duration apart. A complete feed selects nothing, the largest in a window
    needs a window per symbol, and partial feeds may say what they like.
    """
    bounds = F.when(start.isNull() & end.isNull(), True).otherwise((start >= 0) & (end >= start) & (end - start == duration))
    claims = {
        "complete": (selection == "all_observed") & (duration == 0) & ~per_symbol,
        "largest_in_window": (selection == "largest_per_symbol") & (duration > 0) & per_symbol,
        "partial_nonchronological": F.lit(True),
        "trade_flag_only": F.lit(True),
    }
    fits = F.lit(False)
    for name in LIQUIDATION_COMPLETENESS:
        fits = F.when(completeness == name, claims[name]).otherwise(fits)
    return F.coalesce(bounds & selection.isin(*WINDOW_SELECTIONS) & fits, F.lit(False))


def has_denominator(expectation: Column, silence_is_random: Column) -> Column:
    """Whether silence of a channel can be counted as a missed event."""
    return F.coalesce(expectation.isin("deterministic", "request_bound") & ~silence_is_random, F.lit(False))


def valid_text(text: Column, most_bytes: int = 256) -> Column:
    """Not empty, no control characters, within the length."""
    return F.coalesce(~text.rlike(r"[\x00-\x1f\x7f]") & F.octet_length(text).between(1, most_bytes), F.lit(False))


def aggressor_side(buyer_is_maker: Column) -> Column:
    """The maker rests, so a buying maker was hit by a seller."""
    return F.when(buyer_is_maker, "sell").when(~buyer_is_maker, "buy")


def flat_json(**fields: Column) -> Column:
    """Canonical JSON of flat text fields: keys sorted, nulls left out."""
    entries = F.array(*(F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in sorted(fields.items())))
    return F.to_json(F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())))
