"""Registered queries: a Spark function of (spark, sf_dir) and, where SQL can say it, the DuckDB text of its rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: Iterable[str] = ()) -> Callable[[Run], Run]:
    """Register the decorated function under its name; ``views`` are put before ``sql`` as common tables."""

    def register(run: Run) -> Run:
        QUERIES[run.__name__] = run
        if sql is not None:
            from tickloom.plans.views import with_views

            ORACLES[run.__name__] = with_views(sql, views)
        return run

    return register
