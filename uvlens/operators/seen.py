"""Bloom filters over (page, window_time, user_id), as columns.

A filter is a set of rows (page, window_time, block, bits): a user's hash names one of
``blocks`` blocks of 32,768 bits (4 KiB) and ``PROBES`` bits in it. A block is a partial
aggregate of constant size, blocks of several batches are merged with ``bitmap_or_agg``,
and a user is tested by one join, unique on the filter's side. Up to about 4,000 users
a block fewer than 3 % of the unseen are taken for seen; fuller filters only send more
rows to the exact check that follows, whatever their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = 2
PROBES = 4
BITS = 32_768
_KEY = ["page", "window_time", "block"]


def _block(blocks: int) -> Column:
    return F.expr(f"cast(pmod(xxhash64(user_id, 0), {blocks}) as int)")


def _probes() -> list[Column]:
    return [F.expr(f"pmod(xxhash64(user_id, {i + 1}), {BITS})") for i in range(PROBES)]


def seen_filters(rows: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(page, window_time, block, bits) of (page, window_time, user_id) rows."""
    return (rows.select("page", "window_time", _block(blocks).alias("block"),
                        F.explode(F.array(*_probes())).alias("bit"))
            .groupBy(*_KEY).agg(F.bitmap_construct_agg("bit").alias("bits")))


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1


def unseen_for_sure(rows: DataFrame, filters: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``rows`` (page, window_time, user_id) with ``new``: true if no filter holds the
    row; false if one may."""
    merged = filters.groupBy(*_KEY).agg(F.bitmap_or_agg("bits").alias("bits"))
    all_set = None
    for at in _probes():
        hit = _is_set(F.col("bits"), at)
        all_set = hit if all_set is None else all_set & hit
    return (rows.withColumn("block", _block(blocks)).join(merged, _KEY, "left")
            .select("page", "window_time", "user_id", (~F.coalesce(all_set, F.lit(False))).alias("new")))
