"""Instrument metadata pages: identities written into option symbols, and pages that stand or fall as a whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Month names in option symbols, the longest page, and the form of an asset name. Fixed values.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
MOST_ITEMS = 1000
ASSET = "[A-Z0-9]{1,16}"

_OPTION = rf"^({ASSET})-([0-9]{{2}})({'|'.join(MONTHS)})([0-9]{{2}})-(-?(?:[0-9]+\.?[0-9]*|\.[0-9]+))-([CP])(?:-({ASSET}))?\z"


def option_identity(symbol: Column) -> Column:
    """(base, expiry, strike, kind, quote) of base-DDMONYY-strike-C, with or without a quote; null for other texts.

    ``quote`` is null where the symbol has none. Years from 69 on lie in the last century. A day that its month lacks
    and symbols of more than 64 characters are no identity.
    """
    part = lambda n: F.regexp_extract(symbol, _OPTION, n)
    month = F.array_position(F.array(*map(F.lit, MONTHS)), part(3))
    century = F.when(part(4) >= "69", "19").otherwise("20")
    expiry = F.try_to_date(F.concat(century, part(4), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"), part(2)), "yyyy-MM-dd")
    found = F.struct(
        part(1).alias("base"), expiry.alias("expiry"), part(5).alias("strike"), F.when(part(6) == "C", "call").otherwise("put").alias("kind"), F.nullif(part(7), F.lit("")).alias("quote")
    )
    return F.when(symbol.rlike(_OPTION) & (F.length(symbol) <= 64) & expiry.isNotNull(), found)


def option_faults(rows: DataFrame) -> Column:
    """First respect in which a mapped option contradicts its own symbol; null if in none."""
    identity = option_identity(F.col("symbol"))
    asset = lambda c: F.col(c).rlike(rf"^{ASSET}\z")
    checks = {
        "symbol": identity.isNotNull(),
        "base": F.col("base_asset") == identity["base"],
        "quote": asset("quote_asset") & (F.col("quote_asset") == F.coalesce(identity["quote"], F.col("quote_asset"))),
        "settlement": asset("settlement_asset"),
        "kind": F.col("option_kind") == identity["kind"],
        "expiry": F.timestamp_seconds(F.col("expiry_ns") / F.lit(1_000_000_000)).cast("date") == identity["expiry"],
    }
    return F.coalesce(*(F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in checks.items()))


def whole_pages(mapped: DataFrame, by: Sequence[str], own_fault: Column | None = None, cursor: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of sound pages, faults of the others): a page with one bad instrument is refused as a whole.

    ``mapped`` has the columns that name a page, ``symbol``, ``message_ordinal`` and ``code``; ``own_fault`` is a further
    reason to refuse a row, and ``cursor`` a column that must be null or empty, where a venue gives all in one page.
    Faults are ``fault`` (invalid_field and the other codes, own reasons, repeated_symbol, too_many, unexpected_cursor) and
    ``at``, the smallest ordinal that has it (null for faults of the page). Repeats are counted by page and symbol
    before a page is, so no task gathers a page, and page names may be null.
    """
    reason = F.coalesce(F.col("code"), own_fault if own_fault is not None else F.lit(None))
    rows = mapped.withColumn("__reason", reason)
    ill = F.struct("message_ordinal", "__reason")
    symbols = rows.groupBy(*by, "symbol").agg(
        F.min(F.when(F.col("__reason").isNotNull(), ill)).alias("ill"),
        F.count("*").alias("n"),
        F.when(F.col("symbol").isNotNull(), F.get(F.array_sort(F.collect_list("message_ordinal")), 1)).alias("again"),
        *([F.max(F.coalesce(F.length(cursor), F.lit(0)) > 0).alias("more")] if cursor else [F.lit(False).alias("more")]),
    )
    pages = symbols.groupBy(*by).agg(F.min("ill").alias("ill"), F.sum("n").alias("n"), F.min("again").alias("again"), F.max("more").alias("more"))
    fault = (
        F.when(F.col("more"), F.struct(F.lit("unexpected_cursor").alias("fault"), F.lit(None).cast("long").alias("at")))
        .when(F.col("n") > MOST_ITEMS, F.struct(F.lit("too_many").alias("fault"), F.lit(None).cast("long").alias("at")))
        .when(F.col("ill").isNotNull() & (F.col("again").isNull() | (F.col("ill.message_ordinal") <= F.col("again"))), F.struct(F.col("ill.__reason").alias("fault"), F.col("ill.message_ordinal").cast("long").alias("at")))
        .when(F.col("again").isNotNull(), F.struct(F.lit("repeated_symbol").alias("fault"), F.col("again").cast("long").alias("at")))
    )
    faults = pages.select(*by, fault.alias("__f")).where("__f IS NOT NULL").select(*by, "__f.fault", "__f.at")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in by]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    sound = rows.drop("__reason").alias("r").join(faults.alias("f"), condition, "left_anti")
    return sound.drop("code", "bad_field", "bad_state"), faults
