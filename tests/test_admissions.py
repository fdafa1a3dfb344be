"""Meaning of the metric: per window, cumulative, new visitors (with TTL)."""

import random

import pytest

from conftest import BASE_MS, HOUR, MINUTE
from uvlens.operators.admissions import ttl_admissions, uv_cumulative, uv_new_visitors
from uvlens.operators.windows import uv_per_window

TTL3 = 3 * HOUR


def _series(df):
    return [r.uv for r in df.orderBy("window_time").collect()]


CASES = [
    # events, per window (A1), cumulative (A2), new visitors (A5)
    ([("u", 0), ("u", 5 * MINUTE)], [1, 1], [1, 1], [1, 0]),
    ([("u", 0), ("v", 2 * HOUR), ("u", 3 * HOUR + 30 * MINUTE)], [1, 1, 1], [1, 2, 3], [1, 1, 1]),
    ([("u", 0), ("u", 3 * HOUR + 30 * MINUTE)], [1, 1], [1, 1], [1, 1]),
]


@pytest.mark.parametrize("events,a1,a2,a5", CASES)
def test_semantic_separators(mk, events, a1, a2, a5):
    df = mk([(u, "p", BASE_MS + t) for u, t in events])
    assert _series(uv_per_window(df, MINUTE, "exact")) == a1
    assert _series(uv_cumulative(df, 30_000, TTL3)) == a2
    assert _series(uv_new_visitors(df, MINUTE, TTL3)) == a5


def _brute(events, ttl):
    out = set()
    by_key = {}
    for u, p, t in events:
        by_key.setdefault((p, str(u)), set()).add(t)
    for key, ts in by_key.items():
        last = None
        for t in sorted(ts):
            if last is None or t - last >= ttl:
                out.add((key[0], key[1], t))
                last = t
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ttl_fold_matches_brute_force(mk, seed):
    rnd = random.Random(seed)
    ttl = 1000
    events = []
    for u in range(6):
        for p in ("a", "b"):
            t = rnd.randint(0, 500)
            for _ in range(rnd.randint(1, 400)):
                # mostly dense (long sessions through the fold), some big gaps
                t += rnd.choice([1, 7, 50, 120, 300, 999, 1000, 2500])
                events.append((u, p, t))
    got = {(r.page, r.user_id, r.admit_ms) for r in ttl_admissions(mk(events), ttl).collect()}
    assert got == _brute(events, ttl)


def test_hot_key_is_split_into_sessions(mk):
    # One (page, user) with many sessions separated by gaps >= ttl.
    ttl = 100
    events = [(1, "p", s * 1000 + k * 10) for s in range(50) for k in range(30)]
    got = sorted(r.admit_ms for r in ttl_admissions(mk(events), ttl).collect())
    assert got == sorted(_x[2] for _x in _brute(events, ttl))


def test_cumulative_without_ttl_never_resets(mk):
    df = mk([("u", "p", BASE_MS), ("v", "p", BASE_MS + 5 * HOUR), ("u", "p", BASE_MS + 9 * HOUR)])
    assert _series(uv_cumulative(df, 30_000)) == [1, 2, 2]
    assert _series(uv_new_visitors(df, MINUTE)) == [1, 1, 0]


def test_dense_session_across_small_arrow_batches(mk, spark):
    # one session with many events per 1,024-ms piece, folded across batches
    rnd = random.Random(11)
    ttl = 5000
    events = [(7, "p", t) for t in sorted(rnd.randrange(200_000) for _ in range(20_000))]
    events += [(8, "p", t) for t in range(0, 200_000, 333)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = {(r.page, r.user_id, r.admit_ms) for r in ttl_admissions(mk(events), ttl).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == _brute(events, ttl)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_dense_sessions_by_pointer_doubling(mk, seed):
    """All long sessions split (dense_times=0): equal to the fold and to brute force."""
    rnd = random.Random(seed)
    ttl, events = 1000, []
    for u in range(5):
        t = rnd.randint(0, 500)
        for _ in range(rnd.randint(1, 500)):
            t += rnd.choice([1, 7, 50, 120, 300, 999, 1000, 1001, 2500] if u else [250, 333])
            events.append((u, "p", t))
    events += [(9, "p", k * 100) for k in range(700)]  # a periodic bot
    got = {(r.page, r.user_id, r.admit_ms) for r in ttl_admissions(mk(events), ttl, dense_times=0).collect()}
    assert got == _brute(events, ttl)


def test_one_dense_session_is_spread_over_tasks(spark):
    """200,000 times without a pause: no task of the successor table holds over half of
    them, no Python worker takes part, and the result equals the fold."""
    from pyspark.sql import functions as F

    from uvlens.operators import admissions as A

    ttl = 3_600_000
    ms = F.col("id") * 977 + F.pmod(F.xxhash64("id"), F.lit(900))
    b = spark.range(200_000).select(F.lit("p").alias("page"), F.lit("bot").alias("user_id"), ms.alias("behavior_ms"))
    folded = sorted(r["admit_ms"] for r in A.ttl_admissions(b, ttl).collect())
    split = A.ttl_admissions(b, ttl, dense_times=1_000)
    assert sorted(r["admit_ms"] for r in split.collect()) == folded and len(folded) > 50
    times = b.select(F.lit(0).alias("session"), F.col("behavior_ms").alias("t")).distinct()
    jump = A.successors(times, ttl, ["session"])
    assert "Python" not in jump._jdf.queryExecution().toString()
    sizes = [r["count"] for r in jump.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) > 190_000 and max(sizes) < sum(sizes) / 2


def test_ttl_reports_scan_the_events_once(spark, tmp_path, monkeypatch):
    from uvlens.operators import admissions as A
    from uvlens.plans.uv import CUM_W, TTL_TEST_MS, _b

    reads = []
    monkeypatch.setattr(A, "ttl_pieces", lambda b, *a, f=A.ttl_pieces: (reads.append(b), f(b, *a))[1])
    for report, width in ((A.uv_new_visitors, 60_000), (A.uv_cumulative, CUM_W)):
        plan = report(_b(spark, "/root/testdata/sf0.001"), width, TTL_TEST_MS)._jdf.queryExecution().toString()
        assert "events.parquet" not in plan
    assert len(reads) == 2
