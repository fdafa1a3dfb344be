"""The UV plans (A1-A10 batch forms) and sketch / bitmap set operators."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from uvlens.operators import containers as C
from uvlens.operators import sketches as S
from uvlens.functions.time import window_end_ms
from uvlens.operators.admissions import (active_windows, admissions_of_pieces, piece_times, ttl_pieces,
                                          uv_cumulative, uv_new_visitors)
from uvlens.operators.strategies import count_bitmaps, hll_sketch
from uvlens.operators.windows import DAY, HOUR, MINUTE, page_views, uv_per_batch_time, uv_per_window
from uvlens.plans.registry import B_SQL, ORACLE, register
from uvlens.session import scratch_path, written
from uvlens.sources.behaviors import behaviors_from_events, load_behaviors
from uvlens.sources.tables import read_table


def _b(spark: SparkSession, sf_dir: str):
    return load_behaviors(spark, sf_dir, keep=("event_id",))


@register("uv_exact", f"""
WITH {B_SQL}
SELECT page, (behavior_ms // 60000 + 1) * 60000 AS window_time,
       count(DISTINCT user_id)::BIGINT AS uv
FROM b GROUP BY 1, 2""")
def uv_exact(spark, sf_dir):
    """A1: exact distinct users per page per 1-minute window."""
    return uv_per_window(_b(spark, sf_dir), MINUTE, "exact")


@register("uv_exact_hour", f"""
WITH {B_SQL}
SELECT page, (behavior_ms // 3600000 + 1) * 3600000 AS window_time,
       count(DISTINCT user_id)::BIGINT AS uv
FROM b GROUP BY 1, 2""")
def uv_exact_hour(spark, sf_dir):
    """A1 with 1-hour windows."""
    return uv_per_window(_b(spark, sf_dir), HOUR, "exact")


@register("uv_exact_day", f"""
WITH {B_SQL}
SELECT page, (behavior_ms // 86400000 + 1) * 86400000 AS window_time,
       count(DISTINCT user_id)::BIGINT AS uv
FROM b GROUP BY 1, 2""")
def uv_exact_day(spark, sf_dir):
    """A1 with 1-day windows."""
    return uv_per_window(_b(spark, sf_dir), DAY, "exact")


# --- HLL (A3, A4, G3) ------------------------------------------------------------
# The queries return the sketches' UV. Up to a few thousand users per group a sketch
# of 2^14 registers counts exactly, so at test scale the oracle is the exact count;
# the error on large groups is tested apart (tests/test_sketches_store.py).

@register("uv_hll", ORACLE["uv_exact"])
def uv_hll(spark, sf_dir):
    """A3: HLL(2^14) per page per minute; one sketch per task and group moves."""
    return uv_per_window(_b(spark, sf_dir), MINUTE, "hll")


@register("uv_hll_store", ORACLE["uv_exact"])
def uv_hll_store(spark, sf_dir):
    """A4: sketches persisted per (page, window), read back and merged."""
    path = scratch_path(spark, "sketch-store")
    S.write_sketches(S.window_sketches(_b(spark, sf_dir), MINUTE), path)
    stored = S.merge_sketches(S.read_sketches(spark, path), ["page", "window_time"])
    return stored.select("page", "window_time", S.estimate().alias("uv"))


@register("uv_hll_rollup", f"""
WITH {B_SQL},
d AS (SELECT page, user_id, (behavior_ms // 86400000 + 1) * 86400000 AS window_time FROM b)
SELECT page, window_time, count(DISTINCT user_id)::BIGINT AS uv FROM d GROUP BY 1, 2
UNION ALL
SELECT '*' AS page, window_time, count(DISTINCT user_id)::BIGINT AS uv FROM d GROUP BY 1, 2""")
def uv_hll_rollup(spark, sf_dir):
    """Hourly sketches merged into days, per page and across pages ('*').
    One scan: every hourly sketch counts for its page and for '*'."""
    hourly = S.window_sketches(_b(spark, sf_dir), HOUR)
    both = hourly.withColumn("page", F.explode(F.array("page", F.lit("*"))))
    return S.rollup_sketches(both, DAY).select("page", "window_time", S.estimate().alias("uv"))


# --- exact hash / bitmap strategies (A6, A7) ----------------------------------

@register("uv_hash_slots", f"""
WITH {B_SQL}
SELECT page, (behavior_ms // 86400000 + 1) * 86400000 AS window_time,
       count(DISTINCT ('0x' || substr(md5(user_id), 1, 8))::BIGINT % 2147483648)::BIGINT AS uv
FROM b GROUP BY 1, 2""")
def uv_hash_slots(spark, sf_dir):
    """Occupied md5 hash slots (2^31) per page and day."""
    return uv_per_window(_b(spark, sf_dir), DAY, "slots")


@register("uv_hash_slots_corrected", f"""
WITH {B_SQL},
n AS (SELECT page, (behavior_ms // 86400000 + 1) * 86400000 AS window_time,
             count(DISTINCT ('0x' || substr(md5(user_id), 1, 8))::BIGINT % 2147483648) AS occupied
      FROM b GROUP BY 1, 2)
SELECT page, window_time,
       (CASE WHEN occupied < 2147483648
             THEN round(-2147483648.0::DOUBLE * ln(1 - occupied / 2147483648.0::DOUBLE)) END)::BIGINT AS uv
FROM n""")
def uv_hash_slots_corrected(spark, sf_dir):
    """A6 with the linear-counting correction -m ln(1 - n/m) of the slot count."""
    return uv_per_window(_b(spark, sf_dir), DAY, "slots", correct=True)


@register("uv_hash_exact", f"""
WITH {B_SQL}
SELECT page, (behavior_ms // 3600000 + 1) * 3600000 AS window_time,
       count(DISTINCT user_id)::BIGINT AS uv
FROM b GROUP BY 1, 2""")
def uv_hash_exact(spark, sf_dir):
    """A7 (sparse ids): distinct 63-bit hashes per page and hour."""
    return uv_per_window(_b(spark, sf_dir), HOUR, "hash64")


@register("uv_bitmap", f"""
WITH {B_SQL}
SELECT page, (behavior_ms // 3600000 + 1) * 3600000 AS window_time,
       count(DISTINCT user_num)::BIGINT AS uv
FROM b GROUP BY 1, 2""")
def uv_bitmap(spark, sf_dir):
    """A7 (dense ids): bitmaps over the numeric user ids per page and hour."""
    return uv_per_window(_b_num(spark, sf_dir), HOUR, "bitmap")


def _b_num(spark, sf_dir):
    """Behaviours that keep the numeric user id for bitmap strategies."""
    ev = read_table(spark, sf_dir, "events").withColumn("user_num", F.col("user_id"))
    return behaviors_from_events(ev, keep=("user_num",))


@register("uv_bitmap_rollup", f"""
WITH {B_SQL}
SELECT page, (behavior_ms // 86400000 + 1) * 86400000 AS window_time,
       count(DISTINCT user_num)::BIGINT AS uv
FROM b GROUP BY 1, 2""")
def uv_bitmap_rollup(spark, sf_dir):
    """Hourly bitmaps OR-merged into days, then counted."""
    daily = S.rollup_bitmaps(S.window_bitmaps(_b_num(spark, sf_dir), HOUR), DAY)
    return count_bitmaps(daily, ["page", "window_time"])


@register("uv_overlap", f"""
WITH {B_SQL},
d AS (SELECT DISTINCT page, (behavior_ms // 86400000 + 1) * 86400000 AS window_time, user_num FROM b),
w AS (SELECT DISTINCT page, window_time FROM d)
SELECT w.page, w.window_time,
       (SELECT count(*) FROM d x JOIN d y ON x.page = y.page AND x.user_num = y.user_num
         AND y.window_time = x.window_time + 86400000
        WHERE x.page = w.page AND x.window_time = w.window_time)::BIGINT AS overlap
FROM w WHERE EXISTS (SELECT 1 FROM w v WHERE v.page = w.page
                     AND v.window_time = w.window_time + 86400000)""")
def uv_overlap(spark, sf_dir):
    """Visitors present on a day and on the following day (bitmap AND)."""
    return S.overlap_next(S.window_bitmaps(_b_num(spark, sf_dir), DAY), DAY)


@register("pv_counter", f"""
WITH {B_SQL}
SELECT page, (behavior_ms // 3600000 + 1) * 3600000 AS window_time, count(*)::BIGINT AS pv
FROM b GROUP BY 1, 2""")
def pv_counter(spark, sf_dir):
    """Page views per page and hour."""
    return page_views(_b(spark, sf_dir), HOUR)


@register("uv_dedup_bucket", f"""
WITH {B_SQL},
y AS (SELECT *, epoch_us(date_trunc('year', ts)) // 1000 AS ys FROM b)
SELECT page, ys + ((behavior_ms - ys) // 60000) * 60000 AS window_time,
       count(DISTINCT user_id)::BIGINT AS uv
FROM y GROUP BY 1, 2""")
def uv_dedup_bucket(spark, sf_dir):
    """Dedup (page, user, year-anchored minute) then count; label = start."""
    return uv_per_batch_time(_b(spark, sf_dir), 1, "minutes", strategy="dedup")


# --- admissions (A2, A5) -------------------------------------------------------

TTL_TEST_MS = 3_600_000  # 1 h: long enough to matter, short enough to reset pages

_ADM_TTL_SQL = f"""
t AS (SELECT DISTINCT page, user_id, behavior_ms AS ms FROM b),
adm(page, user_id, a) AS (
  SELECT page, user_id, min(ms) FROM t GROUP BY 1, 2
  UNION ALL
  SELECT t.page, t.user_id, min(t.ms) FROM adm JOIN t
    ON t.page = adm.page AND t.user_id = adm.user_id AND t.ms >= adm.a + {TTL_TEST_MS}
  GROUP BY 1, 2)"""

_ADM_FIRST_SQL = """
adm AS (SELECT page, user_id, min(behavior_ms) AS a FROM b GROUP BY 1, 2)"""


def _new_visitors_sql(adm_sql: str, width: int) -> str:
    return f"""
WITH RECURSIVE {B_SQL}, {adm_sql},
aw AS (SELECT DISTINCT page, (behavior_ms // {width} + 1) * {width} AS window_time FROM b),
nw AS (SELECT page, (a // {width} + 1) * {width} AS window_time, count(DISTINCT user_id) AS n
       FROM adm GROUP BY 1, 2)
SELECT aw.page, aw.window_time, coalesce(nw.n, 0)::BIGINT AS uv
FROM aw LEFT JOIN nw ON aw.page = nw.page AND aw.window_time = nw.window_time"""


@register("uv_new_visitors", _new_visitors_sql(_ADM_FIRST_SQL, MINUTE))
def q_uv_new_visitors(spark, sf_dir):
    """A5 without expiry: first-time visitors per page and minute."""
    return uv_new_visitors(_b(spark, sf_dir), MINUTE)


@register("uv_new_visitors_ttl", _new_visitors_sql(_ADM_TTL_SQL, MINUTE))
def q_uv_new_visitors_ttl(spark, sf_dir):
    """A5: visitors new to the page within a 1-hour TTL, per minute."""
    return uv_new_visitors(_b(spark, sf_dir), MINUTE, TTL_TEST_MS)


@register("uv_new_visitors_hll", ORACLE["uv_new_visitors_ttl"])
def q_uv_new_visitors_hll(spark, sf_dir):
    """A5 with a sketch: admitted users (1-hour TTL) added to an HLL per page and
    minute; 0 for windows with events but nobody admitted."""
    b = _b(spark, sf_dir)
    pieces = ttl_pieces(b, TTL_TEST_MS)
    adm = (admissions_of_pieces(pieces, TTL_TEST_MS)
           .select("page", "user_id", window_end_ms("admit_ms", MINUTE).alias("window_time")))
    new = adm.groupBy("page", "window_time").agg(F.hll_sketch_estimate(hll_sketch("user_id")).alias("n"))
    active = active_windows(piece_times(pieces, "page"), MINUTE).select("page", "window_time")
    return (active.join(new, ["page", "window_time"], "left")
            .select("page", "window_time", F.coalesce("n", F.lit(0)).cast("bigint").alias("uv")))


CUM_W = 30_000


@register("uv_cumulative", f"""
WITH {B_SQL}, {_ADM_FIRST_SQL},
aw AS (SELECT DISTINCT page, (behavior_ms // {CUM_W} + 1) * {CUM_W} AS window_time FROM b),
nw AS (SELECT page, (a // {CUM_W} + 1) * {CUM_W} AS window_time, count(*) AS n FROM adm GROUP BY 1, 2)
SELECT aw.page, aw.window_time,
       (sum(coalesce(nw.n, 0)) OVER (PARTITION BY aw.page ORDER BY aw.window_time
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS uv
FROM aw LEFT JOIN nw ON aw.page = nw.page AND aw.window_time = nw.window_time""")
def q_uv_cumulative(spark, sf_dir):
    """A2 without expiry: running distinct users per page at each 30-s window."""
    return uv_cumulative(_b(spark, sf_dir), CUM_W)


@register("uv_cumulative_ttl", f"""
WITH RECURSIVE {B_SQL}, {_ADM_TTL_SQL},
g AS (SELECT page, behavior_ms, lag(behavior_ms) OVER (PARTITION BY page ORDER BY behavior_ms, event_id) AS prev
      FROM b),
e AS (SELECT page, behavior_ms,
             sum(CASE WHEN prev IS NULL OR behavior_ms - prev >= {TTL_TEST_MS} THEN 1 ELSE 0 END)
               OVER (PARTITION BY page ORDER BY behavior_ms ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               AS epoch FROM g),
aw AS (SELECT page, (behavior_ms // {CUM_W} + 1) * {CUM_W} AS window_time, max(epoch) AS epoch
       FROM e GROUP BY 1, 2),
nw AS (SELECT page, (a // {CUM_W} + 1) * {CUM_W} AS window_time, count(DISTINCT user_id) AS n
       FROM adm GROUP BY 1, 2)
SELECT aw.page, aw.window_time,
       (sum(coalesce(nw.n, 0)) OVER (PARTITION BY aw.page, aw.epoch ORDER BY aw.window_time
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS uv
FROM aw LEFT JOIN nw ON aw.page = nw.page AND aw.window_time = nw.window_time""")
def q_uv_cumulative_ttl(spark, sf_dir):
    """A2: running distinct users per page with a 1-hour entry TTL and page reset."""
    return uv_cumulative(_b(spark, sf_dir), CUM_W, TTL_TEST_MS)


# --- set algebra on text ids ---------------------------------------------------

_DAYS_SQL = f"""{B_SQL},
d AS (SELECT DISTINCT page, (behavior_ms // 86400000 + 1) * 86400000 AS window_time, user_id FROM b),
p AS (SELECT x.page, x.window_time FROM (SELECT DISTINCT page, window_time FROM d) x
      JOIN (SELECT DISTINCT page, window_time FROM d) y ON x.page = y.page AND y.window_time = x.window_time + 86400000),
u AS (SELECT p.page, p.window_time, d.user_id, bool_or(d.window_time = p.window_time) AS here,
             bool_or(d.window_time > p.window_time) AS nxt
      FROM p JOIN d ON d.page = p.page AND d.window_time IN (p.window_time, p.window_time + 86400000) GROUP BY 1, 2, 3)"""


@register("uv_theta_algebra", f"""
WITH {_DAYS_SQL}
SELECT page, window_time, count(*) FILTER (here AND nxt) AS both, count(*) FILTER (NOT nxt) AS only_here,
       count(*) FILTER (NOT here) AS only_next, count(*) AS either
FROM u GROUP BY 1, 2""")
def uv_theta_algebra(spark, sf_dir):
    """G3/G6 on sketches: users of a day and of the next one: in both, in one only, in
    either, from one theta sketch per (page, day)."""
    return S.theta_with_next(S.window_thetas(_b(spark, sf_dir), DAY), DAY)


@register("uv_sparse_bitmap", f"""
WITH {B_SQL}
SELECT page, (behavior_ms // 3600000 + 1) * 3600000 AS window_time, count(DISTINCT user_id)::BIGINT AS uv
FROM b GROUP BY 1, 2""")
def uv_sparse_bitmap(spark, sf_dir):
    """A7 for text ids: hourly users as container bitmaps of 63-bit hashes."""
    return C.cardinality(C.window_containers(_b(spark, sf_dir), HOUR), ["page", "window_time"])


@register("uv_sparse_rollup", f"""
WITH {B_SQL}
SELECT page, (behavior_ms // 86400000 + 1) * 86400000 AS window_time, count(DISTINCT user_id)::BIGINT AS uv
FROM b GROUP BY 1, 2""")
def uv_sparse_rollup(spark, sf_dir):
    """G5 for text ids: hourly containers, stored, merged into days."""
    hours = written(C.window_containers(_b(spark, sf_dir), HOUR), "containers")
    return C.cardinality(C.rollup(hours, DAY), ["page", "window_time"])


@register("uv_sparse_overlap", f"""
WITH {_DAYS_SQL}
SELECT page, window_time, count(*) FILTER (here) AS here, count(*) FILTER (nxt) AS next,
       count(*) FILTER (here AND nxt) AS overlap
FROM u GROUP BY 1, 2""")
def uv_sparse_overlap(spark, sf_dir):
    """G6 for text ids: users of a day, of the next one and of both, from containers."""
    return C.overlap_next(C.window_containers(_b(spark, sf_dir), DAY), DAY)
