"""Distinct-user strategies: one result shape, several ways to count.

Every strategy is a function ``(df, keys, user) -> DataFrame[keys..., uv]``
built from native aggregates, so Spark plans a partial (map-side) aggregate
before the shuffle:

* ``exact``   count_distinct: planned as dedup on (keys, user) then count. The
              first exchange hashes on (keys, user), so a hot page is spread
              over all tasks by user; the second one carries one partial count
              per task and key.
* ``dedup``   the same as an explicit dropDuplicates + count (A8).
* ``hll``     HyperLogLog sketch, 2^lgk registers (A3). Constant-size partial
              state per key and task, so hot keys cost nothing extra.
* ``approx``  approx_count_distinct (HLL++), alternative only.
* ``hash64``  distinct 63-bit hashes (A7): exact but for hash collisions.
* ``bitmap``  dense non-negative numeric ids into 32,768-bit chunks (A7 on
              dense ids); OR-mergeable.
* ``slots``   2^31 hash slots (A6): counts occupied slots, with an optional
              linear-counting correction.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_LGK = 14            # 2^14 registers, as the reference's HLL(14, 6)
DEFAULT_SLOTS = 2**31       # the range of a non-negative 32-bit hash
MAX63 = 0x7FFFFFFFFFFFFFFF


def hash63(user: str) -> Column:
    """Non-negative 63-bit hash of the user key (top bit cleared; never abs)."""
    return F.expr(f"xxhash64({user}) & {MAX63}")


def md5_slot(user: str, slots: int = DEFAULT_SLOTS) -> Column:
    """Slot from the first 32 bits of md5; reproducible outside Spark."""
    return F.expr(f"cast(conv(substring(md5(cast({user} as string)), 1, 8), 16, 10) as bigint)"
                  f" % {int(slots)}")


def _keys(keys: Sequence[str]) -> list[str]:
    return list(keys)


def uv_exact(df: DataFrame, keys: Sequence[str], user: str = "user_id") -> DataFrame:
    return df.groupBy(*_keys(keys)).agg(F.count_distinct(user).cast("bigint").alias("uv"))


def uv_dedup(df: DataFrame, keys: Sequence[str], user: str = "user_id") -> DataFrame:
    ks = _keys(keys)
    return (df.select(*ks, user).dropDuplicates()
            .groupBy(*ks).agg(F.count(F.lit(1)).cast("bigint").alias("uv")))


def hll_sketch(user: str, lgk: int = DEFAULT_LGK) -> Column:
    return F.hll_sketch_agg(F.col(user).cast("string"), lgk)


def uv_hll(df: DataFrame, keys: Sequence[str], user: str = "user_id",
           lgk: int = DEFAULT_LGK) -> DataFrame:
    return (df.groupBy(*_keys(keys))
            .agg(F.hll_sketch_estimate(hll_sketch(user, lgk)).cast("bigint").alias("uv")))


def uv_approx(df: DataFrame, keys: Sequence[str], user: str = "user_id",
              rsd: float = 0.0087) -> DataFrame:
    return (df.groupBy(*_keys(keys))
            .agg(F.approx_count_distinct(user, rsd).cast("bigint").alias("uv")))


def uv_hash64(df: DataFrame, keys: Sequence[str], user: str = "user_id") -> DataFrame:
    return (df.groupBy(*_keys(keys))
            .agg(F.count_distinct(hash63(user)).cast("bigint").alias("uv")))


def bitmap_chunks(df: DataFrame, keys: Sequence[str], id_col: Column | str) -> DataFrame:
    """(keys..., chunk, bm): one 4 KiB bitmap per key and 32,768-id chunk."""
    idc = F.col(id_col) if isinstance(id_col, str) else id_col
    return (df.select(*_keys(keys), idc.alias("_id"))
            .groupBy(*_keys(keys), F.expr("bitmap_bucket_number(_id)").alias("chunk"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_id))").alias("bm")))


def count_bitmaps(chunks: DataFrame, keys: Sequence[str], bm: str = "bm") -> DataFrame:
    return (chunks.groupBy(*_keys(keys))
            .agg(F.sum(F.expr(f"bitmap_count({bm})")).cast("bigint").alias("uv")))


def uv_bitmap(df: DataFrame, keys: Sequence[str], user: str = "user_num") -> DataFrame:
    """Exact UV over dense numeric ids (e.g. the original bigint user ids)."""
    return count_bitmaps(bitmap_chunks(df, keys, user), keys)


def uv_slots(df: DataFrame, keys: Sequence[str], user: str = "user_id",
             slots: int = DEFAULT_SLOTS, correct: bool = False) -> DataFrame:
    """Occupied hash slots per key (A6), counted as distinct slots: planned as a
    dedup on (keys, slot), spread over all tasks by slot. ``correct`` applies
    linear counting ``-m * ln(1 - n/m)`` (a rounded bigint); null when every slot
    is occupied, as nothing can be estimated then."""
    occupied = (df.groupBy(*_keys(keys))
                .agg(F.count_distinct(md5_slot(user, slots)).cast("bigint").alias("uv")))
    if not correct:
        return occupied
    m = float(slots)
    est = F.when(F.col("uv") < slots, F.round(-m * F.log1p(-F.col("uv") / m)))
    return occupied.withColumn("uv", est.cast("bigint"))


STRATEGIES: dict[str, Callable[..., DataFrame]] = {
    "exact": uv_exact,
    "dedup": uv_dedup,
    "hll": uv_hll,
    "approx": uv_approx,
    "hash64": uv_hash64,
    "bitmap": uv_bitmap,
    "slots": uv_slots,
}


def distinct_users(df: DataFrame, keys: Sequence[str], strategy: str = "exact",
                   user: str | None = None, **opts) -> DataFrame:
    fn = STRATEGIES[strategy]
    if user is None:
        user = "user_num" if strategy == "bitmap" else "user_id"
    return fn(df, keys, user, **opts)
