"""Query registry shared by ``__spark_entry__``, the bench and the tests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register a query; ``oracle`` is DuckDB SQL over the test tables giving
    the same rows (column names equal). ``None`` means no SQL form."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


# DuckDB form of the canonical behaviours (same mapping as
# uvlens.sources.behaviors): epoch_us // 1000 floors like Spark's div.
B_SQL = ("b AS (SELECT event_id, cast(user_id AS VARCHAR) AS user_id, user_id AS user_num, "
         "event_type AS page, epoch_us(ts) // 1000 AS behavior_ms, ts FROM events)")
