"""Ranked and positional slices, formatted report lines.

Slices follow the sorted-set / list range rule of the reference's store:
inclusive 0-based bounds, negative bounds count from the end (-1 = last),
out-of-range bounds are clamped, an empty range gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uvlens.functions.time import format_ms
from uvlens.session import written


Order = tuple[str, bool]  # (column, ascending)
DEEP = 10_000  # rows of one key that a ranking task may hold


def _cols(order: Sequence[Order], reverse: bool = False) -> list[Column]:
    return [F.col(c).asc() if asc_ != reverse else F.col(c).desc() for c, asc_ in order]


def rank_slice(df: DataFrame, partition: Sequence[str], order: Sequence[Order],
               start: int, end: int, pos: str = "pos") -> DataFrame:
    """Rows at positions ``start..end`` of each partition under ``order``.

    Non-negative bounds use ``row_number() <= end + 1``, which Spark turns
    into a per-partition group limit before the shuffle (WindowGroupLimit),
    so a hot partition key ships at most ``end + 1`` rows per task. Negative
    bounds rank in the reverse order the same way and take the partition
    size from a partial aggregate. Bounds deeper than ``DEEP`` rows, and bounds of
    mixed sign, go by exact positions instead, which no single task ranks.
    """
    part = list(partition)
    if start >= 0 and DEEP <= end:
        return (positions(df, part, order, "_rn").where((F.col("_rn") >= start) & (F.col("_rn") <= end))
                .withColumn(pos, F.col("_rn").cast("bigint")).drop("_rn"))
    if start >= 0 and end >= 0:
        w = Window.partitionBy(*part).orderBy(*_cols(order))
        ranked = df.withColumn("_rn", F.row_number().over(w))
        return (ranked.where(F.col("_rn") <= end + 1).where(F.col("_rn") >= start + 1)
                .withColumn(pos, (F.col("_rn") - 1).cast("bigint")).drop("_rn"))
    sizes = df.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
    if -DEEP <= start < 0 and end < 0:
        w = Window.partitionBy(*part).orderBy(*_cols(order, reverse=True))
        ranked = (df.withColumn("_rd", F.row_number().over(w))
                  .where(F.col("_rd") <= -start).where(F.col("_rd") >= -end))
        return (ranked.join(sizes, part).withColumn(pos, (F.col("_n") - F.col("_rd")).cast("bigint"))
                .drop("_rd", "_n"))
    # Mixed signs or far from the end: exact positions from the start, bounds normalised by size.
    ranked = positions(df, part, order, "_rn", size="_n")
    lo = F.lit(start) if start >= 0 else F.col("_n") + start
    hi = F.lit(end) if end >= 0 else F.col("_n") + end
    return (ranked.where((F.col("_rn") >= lo) & (F.col("_rn") <= hi))
            .withColumn(pos, F.col("_rn").cast("bigint")).drop("_rn", "_n"))


def positions(df: DataFrame, partition: Sequence[str], order: Sequence[Order],
              pos: str = "pos", n_parts: int | None = None, size: str | None = None) -> DataFrame:
    """Exact 0-based position of every row in its partition under ``order`` (and, as
    ``size``, the number of rows of the partition).

    No partition is ranked in one task. Rows are dealt by ranges of the whole key: partition
    columns, all order columns, and a hash of the row, so that ties are cut too (only rows
    equal in every column share a place). Spark samples the splitters and finds a row's range
    by binary search. The dealt rows are written with the number of their range, so all uses
    see the same cuts; rows are numbered inside (partition, range), and the sizes of the ranges
    before give the offset.
    """
    part = list(partition)
    n = n_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    key = [*_cols(order), F.col("_tie").asc()]
    rows = written(df.withColumn("_tie", F.xxhash64(*hashed)).repartitionByRange(n, *part, *key)
                   .withColumn("_range", F.spark_partition_id()), "position-ranges")
    counts = rows.groupBy(*part, "_range").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*part).orderBy("_range")
    offsets = counts.select(
        F.col("_range").alias("_r"), *[F.col(p).alias(f"_k{i}") for i, p in enumerate(part)],
        F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(*part)).alias("_size"))
    inside = Window.partitionBy(*part, "_range").orderBy(*key)
    local = rows.withColumn("_local", F.row_number().over(inside) - 1)
    same = [F.col(p).eqNullSafe(F.col(f"_k{i}")) for i, p in enumerate(part)]
    out = (local.join(offsets, reduce(lambda a, b: a & b, [*same, F.col("_range") == F.col("_r")]))
           .withColumn(pos, (F.col("_off") + F.col("_local")).cast("bigint")))
    if size:
        out = out.withColumn(size, F.col("_size").cast("bigint"))
    return out.drop("_range", "_local", "_off", "_r", "_tie", "_size", *[f"_k{i}" for i in range(len(part))])


def asc(name: str) -> Order:
    return (name, True)


def desc(name: str) -> Order:
    return (name, False)


def top_by_score(df: DataFrame, partition: Sequence[str], member: str, score: str,
                 start: int, end: int) -> DataFrame:
    """Highest scores first, ties by member descending (zrevrange)."""
    return rank_slice(df, partition, [desc(score), desc(member)], start, end, "rank")


def bottom_by_score(df: DataFrame, partition: Sequence[str], member: str, score: str,
                    start: int, end: int) -> DataFrame:
    """Lowest scores first, ties by member ascending (zrange)."""
    return rank_slice(df, partition, [asc(score), asc(member)], start, end, "rank")


def report_lines(uv: DataFrame, zone: str = "UTC") -> DataFrame:
    """K1: ``key:<page>,window time:<yyyy-MM-dd HH:mm:ss>,uv:<n>`` per row."""
    return uv.withColumn("line", F.concat(
        F.lit("key:"), F.col("page"),
        F.lit(",window time:"), format_ms("window_time", "yyyy-MM-dd HH:mm:ss", zone),
        F.lit(",uv:"), F.col("uv").cast("string")))


def store_lines(store, touched: DataFrame, as_of_ms: int) -> DataFrame:
    """K2: ``page:<page>,batch time:<ms>,uv:<n>`` of the buckets (page, window_time) in
    ``touched``, read back from a keyed store as of a time; expired buckets read 0."""
    return (store.lookup(touched, as_of_ms=as_of_ms).withColumn("line", F.concat(
        F.lit("page:"), F.col("page"), F.lit(",batch time:"), F.col("window_time").cast("string"),
        F.lit(",uv:"), F.col("uv").cast("string"))))
