"""Stored, mergeable distinct structures: HLL sketches and id bitmaps.

A sketch or bitmap column is a plain ``BINARY`` value, so it can be written
to Parquet, read back and merged by any later job (A4, A10, G3). Merging is
an ordinary aggregate (``hll_union_agg`` / ``bitmap_or_agg``), partially
aggregated before the shuffle; per key only constant-size values move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uvlens.functions.time import window_end_ms
from uvlens.operators.strategies import DEFAULT_LGK, bitmap_chunks, hll_sketch

SKETCH_SCHEMA = "page STRING, window_time BIGINT, sketch BINARY"


def window_sketches(behaviors: DataFrame, width_ms: int, lgk: int = DEFAULT_LGK,
                    user: str = "user_id") -> DataFrame:
    """(page, window_time, sketch) with window_time = window end."""
    return (behaviors.select("page", window_end_ms("behavior_ms", width_ms).alias("window_time"),
                             user)
            .groupBy("page", "window_time").agg(hll_sketch(user, lgk).alias("sketch")))


def merge_sketches(sketches: DataFrame, keys: Sequence[str], sketch: str = "sketch") -> DataFrame:
    """Union sketches per key (pfmerge)."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg(sketch).alias(sketch))


def estimate(sketch: str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch).cast("bigint")


def rollup_sketches(sketches: DataFrame, to_width_ms: int, src: str = "window_time") -> DataFrame:
    """Re-bucket sketches labelled by window end to coarser windows.

    A window ending at ``e`` starts at ``e - 1``'s bucket, so its coarse
    label is the coarse end of ``e - 1``.
    """
    coarse = window_end_ms(f"({src} - 1)", to_width_ms)
    return merge_sketches(sketches.withColumn(src, coarse), ["page", src])


def write_sketches(sketches: DataFrame, path: str, mode: str = "append") -> None:
    sketches.write.mode(mode).parquet(path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SKETCH_SCHEMA).parquet(path)


# --- bitmaps over dense numeric ids (G5, G6) ------------------------------------

def window_bitmaps(behaviors: DataFrame, width_ms: int, id_col: str = "user_num") -> DataFrame:
    """(page, window_time, chunk, bm)."""
    keyed = behaviors.select("page", window_end_ms("behavior_ms", width_ms).alias("window_time"),
                             id_col)
    return bitmap_chunks(keyed, ["page", "window_time"], id_col)


def rollup_bitmaps(bitmaps: DataFrame, to_width_ms: int) -> DataFrame:
    """OR-merge bitmaps into coarser windows (the union Plan 7 intended)."""
    coarse = window_end_ms("(window_time - 1)", to_width_ms)
    return (bitmaps.withColumn("window_time", coarse)
            .groupBy("page", "window_time", "chunk")
            .agg(F.expr("bitmap_or_agg(bm)").alias("bm")))


def overlap_next(bitmaps: DataFrame, width_ms: int) -> DataFrame:
    """Users present in window ``w`` and in the following window, per page.

    Each (page, window) with a non-empty following window gets a row; the
    intersection is ``bitmap_and_agg`` over the two chunk bitmaps.
    """
    # every bitmap counts for its own window (role 0) and for the one before (role 1):
    # one scan, one shuffle, and no join
    role = F.explode(F.sequence(F.lit(0), F.lit(1)))
    both = (bitmaps.select("page", "window_time", "chunk", "bm", role.alias("role"))
            .withColumn("window_time", F.col("window_time") - F.col("role") * width_ms))
    per_chunk = (both.groupBy("page", "window_time", "chunk")
                 .agg(F.count(F.lit(1)).alias("n"), F.expr("bitmap_and_agg(bm)").alias("bm"),
                      F.max(F.expr("role = 0")).alias("here"), F.max(F.expr("role = 1")).alias("next")))
    return (per_chunk.groupBy("page", "window_time")
            .agg(F.sum(F.expr("CASE WHEN n = 2 THEN bitmap_count(bm) ELSE 0 END")).alias("overlap"),
                 F.max("here").alias("here"), F.max("next").alias("next"))
            .where("here AND next").select("page", "window_time", F.col("overlap").cast("bigint").alias("overlap")))


# --- theta sketches: set algebra on text ids (G3, G6) ---------------------------

THETA_LGK = 15  # 2^15 kept hashes: exact up to 32,768 users, standard error 0.6 % beyond


def window_thetas(behaviors: DataFrame, width_ms: int, lgk: int = THETA_LGK, user: str = "user_id") -> DataFrame:
    """(page, window_time, theta), mergeable by ``theta_union_agg``."""
    return (behaviors.select("page", window_end_ms("behavior_ms", width_ms).alias("window_time"), user)
            .groupBy("page", "window_time").agg(F.theta_sketch_agg(user, lgk).alias("theta")))


def theta_estimate(theta: Column) -> Column:
    return F.theta_sketch_estimate(theta).cast("bigint")


def theta_with_next(thetas: DataFrame, width_ms: int, lgk: int = THETA_LGK) -> DataFrame:
    """(page, window_time, both, only_here, only_next, either): users of a window and of the
    following one, for windows that have both. Sketches are shifted and grouped: constant-size
    rows, one shuffle and no join."""
    role = F.explode(F.sequence(F.lit(0), F.lit(1))).alias("role")
    two = thetas.select("*", role).withColumn("window_time", F.col("window_time") - F.col("role") * width_ms)
    side = lambda r: F.first(F.when(F.col("role") == r, F.col("theta")), ignorenulls=True)
    a, b = F.col("a"), F.col("b")
    return (two.groupBy("page", "window_time").agg(side(0).alias("a"), side(1).alias("b"))
            .where(a.isNotNull() & b.isNotNull())
            .select("page", "window_time", theta_estimate(F.theta_intersection(a, b)).alias("both"),
                    theta_estimate(F.theta_difference(a, b)).alias("only_here"),
                    theta_estimate(F.theta_difference(b, a)).alias("only_next"),
                    theta_estimate(F.theta_union(a, b, lgk)).alias("either")))
