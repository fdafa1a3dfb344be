"""Exact sets of 64-bit values as stored, mergeable columns (A7, G5, G6 for text ids).

A value is cut into its high bits and its low 15. All values with the same high bits form
a *container*: the sorted array ``lows`` of the low parts, or, beyond ``FULL`` of them, the
4 KiB bitmap ``bm`` of 2^15 bits, whichever is smaller. A set is the rows of its containers,
so it is split over tasks by (keys, high) however large it grows, is written to Parquet as it
is, and is merged and intersected container by container: sparse hashes cost a few bytes a
value, dense ids one bit. Text ids are taken as 63-bit hashes.

All operations are built-in aggregates. Groups hold at most 2^15 low parts (times the
number of sets merged into one).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uvlens.functions.time import window_end_ms

LOW_BITS = 15
FULL = 2_048  # low parts of two bytes that take the space of a bitmap


def hash_value(user: str = "user_id") -> Column:
    """A text id as a value: the upper 63 bits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(user), 1)


def _stored(lists: DataFrame, group: list[str]) -> DataFrame:
    """Containers from (group..., lows): long lists become bitmaps."""
    few = lists.where(F.size("lows") <= FULL).select(
        *group, F.array_sort("lows").alias("lows"), F.lit(None).cast("binary").alias("bm"))
    many = lists.where(F.size("lows") > FULL).select(*group, F.explode("lows").alias("low"))
    return few.unionByName(_bitmaps(many, group))


def _bitmaps(values: DataFrame, group: list[str]) -> DataFrame:
    return (values.groupBy(*group).agg(F.expr("bitmap_construct_agg(low)").alias("bm"))
            .select(*group, F.lit(None).cast("array<int>").alias("lows"), "bm"))


def containers(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """(keys..., high, lows, bm) of the distinct non-negative values per key."""
    group = [*keys, "high"]
    low = F.col("_v").bitwiseAND(F.lit((1 << LOW_BITS) - 1)).cast("int").alias("low")
    cut = (df.select(*keys, value.cast("bigint").alias("_v")).where("_v >= 0")
           .select(*keys, F.shiftright("_v", LOW_BITS).alias("high"), low).distinct())
    return _stored(cut.groupBy(*group).agg(F.collect_list("low").alias("lows")), group)


def union(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The containers of all sets with the same ``keys``, merged. Where a bitmap takes part,
    the arrays are turned into one first; elsewhere the arrays are."""
    group = [*keys, "high"]
    # (apart, so that sparse containers do not carry the 4 KiB buffer of a bitmap aggregate)
    has_bitmap = sets.where("bm IS NOT NULL").select(*group).distinct()
    lists = sets.join(has_bitmap, group, "left_anti").groupBy(*group).agg(F.collect_list("lows").alias("parts"))
    narrow = _stored(lists.select(*group, F.array_distinct(F.flatten("parts")).alias("lows")), group)
    wide = sets.join(has_bitmap, group, "left_semi")
    loose = _bitmaps(wide.where("bm IS NULL").select(*group, F.explode("lows").alias("low")), group)
    merged = (wide.where("bm IS NOT NULL").select(*group, "bm").unionByName(loose.select(*group, "bm")).groupBy(*group)
              .agg(F.expr("bitmap_or_agg(bm)").alias("bm")))
    return narrow.unionByName(merged.select(*group, F.lit(None).cast("array<int>").alias("lows"), "bm"))


def _holds(bm: Column, low: Column) -> Column:
    """Whether a bitmap holds a low part (bit i of byte j is 8 j + i)."""
    byte = F.conv(F.hex(F.substring(bm, F.floor(low / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, low % 8) == 1


def common(a_lows: Column, a_bm: Column, b_lows: Column, b_bm: Column) -> Column:
    """Number of values that two containers with the same high bits share; one of the two
    may be missing (null). Null for two bitmaps: these are counted by ``bitmap_and_agg``."""
    return (F.when(a_lows.isNotNull() & b_lows.isNotNull(), F.size(F.array_intersect(a_lows, b_lows)))
            .when(a_lows.isNotNull() & b_bm.isNotNull(), F.size(F.filter(a_lows, lambda x: _holds(b_bm, x))))
            .when(a_bm.isNotNull() & b_lows.isNotNull(), F.size(F.filter(b_lows, lambda x: _holds(a_bm, x)))))


def size_of() -> Column:
    """Number of values of one container."""
    return F.when(F.col("bm").isNotNull(), F.expr("bitmap_count(bm)")).otherwise(F.size("lows")).cast("bigint")


def cardinality(sets: DataFrame, keys: Sequence[str], out: str = "uv") -> DataFrame:
    return sets.groupBy(*keys).agg(F.sum(size_of()).cast("bigint").alias(out))


def window_containers(behaviors: DataFrame, width_ms: int, value: Column | None = None) -> DataFrame:
    """(page, window_time, high, lows, bm): the users of every page and window."""
    keyed = behaviors.withColumn("window_time", window_end_ms("behavior_ms", width_ms))
    return containers(keyed, ["page", "window_time"], hash_value() if value is None else value)


def rollup(sets: DataFrame, to_width_ms: int) -> DataFrame:
    """Sets of windows, labelled by their ends, merged into wider windows."""
    return union(sets.withColumn("window_time", window_end_ms("(window_time - 1)", to_width_ms)), ["page", "window_time"])


def overlap_next(sets: DataFrame, width_ms: int) -> DataFrame:
    """(page, window_time, here, next, overlap): values in a window, in the following one,
    and in both, for windows that have both. Every container counts for its own window and
    for the one before: one shuffle and no join."""
    role = F.explode(F.sequence(F.lit(0), F.lit(1))).alias("role")
    both = sets.select("*", role).withColumn("window_time", F.col("window_time") - F.col("role") * width_ms)
    side = lambda c, r: F.first(F.when(F.col("role") == r, F.col(c)), ignorenulls=True).alias(f"{c}{r}")
    size = lambda r: F.sum(F.when(F.col("role") == r, size_of())).alias(f"n{r}")
    per = both.groupBy("page", "window_time", "high").agg(
        *[side(c, r) for c in ("lows", "bm") for r in (0, 1)], size(0), size(1))
    n = F.coalesce(common(F.col("lows0"), F.col("bm0"), F.col("lows1"), F.col("bm1")), F.lit(0))
    two = (per.where("bm0 IS NOT NULL AND bm1 IS NOT NULL")
           .select("page", "window_time", "high", F.explode(F.array("bm0", "bm1")).alias("bm"))
           .groupBy("page", "window_time", "high").agg(F.expr("bitmap_count(bitmap_and_agg(bm))").alias("n")))
    none = F.lit(None).cast("bigint")
    return (per.select("page", "window_time", "n0", "n1", n.cast("bigint").alias("n"))
            .unionByName(two.select("page", "window_time", none.alias("n0"), none.alias("n1"), "n"))
            .groupBy("page", "window_time")
            .agg(F.sum("n0").alias("here"), F.sum("n1").alias("next"), F.sum("n").cast("bigint").alias("overlap"))
            .where("here > 0 AND next > 0"))
