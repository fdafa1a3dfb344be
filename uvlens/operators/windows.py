"""Windowed UV in the result shape ``(page, window_time, uv)``.

``window_time`` is the window *end* in epoch ms for tumbling windows (Plans
1-7) and the bucket *start* for year-anchored batch buckets (Plans 8-10).
Batch jobs compute the bucket with integer arithmetic on ``behavior_ms``
(no TIMESTAMP round trip); streams use ``F.window`` on ``behavior_time``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uvlens.functions.time import UNIT_MS, batch_time, window_end_ms
from uvlens.operators.strategies import distinct_users

MINUTE = UNIT_MS["minute"]
HOUR = UNIT_MS["hour"]
DAY = UNIT_MS["day"]


def with_window_end(df: DataFrame, width_ms: int, ms: str = "behavior_ms",
                    out: str = "window_time") -> DataFrame:
    return df.withColumn(out, window_end_ms(ms, width_ms))


def uv_per_window(behaviors: DataFrame, width_ms: int = MINUTE, strategy: str = "exact",
                  **opts) -> DataFrame:
    """Distinct users per page per epoch-aligned tumbling window."""
    user = "user_num" if strategy == "bitmap" else "user_id"
    keyed = with_window_end(behaviors, width_ms).select("page", "window_time", user)
    return distinct_users(keyed, ["page", "window_time"], strategy, **opts)


def uv_per_batch_time(behaviors: DataFrame, n: int = 1, unit: str = "minutes",
                      zone: str = "UTC", strategy: str = "dedup") -> DataFrame:
    """Distinct users per page per year-anchored bucket, labelled by start."""
    keyed = behaviors.select("page", "user_id",
                             batch_time("behavior_ms", n, unit, zone).alias("window_time"))
    return distinct_users(keyed, ["page", "window_time"], strategy)


def page_views(behaviors: DataFrame, width_ms: int = HOUR) -> DataFrame:
    """Counter per (page, bucket): page views."""
    return (with_window_end(behaviors, width_ms)
            .groupBy("page", "window_time")
            .agg(F.count(F.lit(1)).cast("bigint").alias("pv")))
