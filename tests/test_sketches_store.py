"""Sketch laws and the keyed store."""

import random

from conftest import BASE_MS, HOUR
from uvlens.operators import sketches as S
from uvlens.operators.store import UVStore
from uvlens.operators.strategies import count_bitmaps
from uvlens.operators.windows import DAY, uv_per_window
from uvlens.session import scratch_path


def _day_rows(mk, n_users=400, n_events=3000, seed=7):
    rnd = random.Random(seed)
    return mk([(rnd.randrange(n_users), f"p{rnd.randrange(3)}", BASE_MS + rnd.randrange(DAY))
               for _ in range(n_events)])


def test_hourly_sketch_rollup_equals_daily(mk):
    df = _day_rows(mk)
    rolled = S.rollup_sketches(S.window_sketches(df, HOUR), DAY) \
        .select("page", "window_time", S.estimate().alias("uv"))
    exact = {(r.page, r.window_time): r.uv for r in uv_per_window(df, DAY, "exact").collect()}
    for r in rolled.collect():
        assert abs(r.uv - exact[(r.page, r.window_time)]) <= max(1, 0.03 * exact[(r.page, r.window_time)])


def test_bitmap_rollup_exact_and_overlap(mk):
    df = _day_rows(mk)
    daily = count_bitmaps(S.rollup_bitmaps(S.window_bitmaps(df, HOUR), DAY), ["page", "window_time"])
    exact = uv_per_window(df, DAY, "exact")
    assert sorted(map(tuple, daily.collect())) == sorted(map(tuple, exact.collect()))
    two_days = mk([(1, "p", BASE_MS), (2, "p", BASE_MS), (2, "p", BASE_MS + DAY), (3, "p", BASE_MS + DAY)])
    ov = S.overlap_next(S.window_bitmaps(two_days, DAY), DAY).collect()
    assert [(r.window_time, r.overlap) for r in ov] == [(BASE_MS + DAY, 1)]


def _batch(spark, rows):
    return spark.createDataFrame(rows, "page string, window_time bigint, user_id string")


def test_store_replay_is_idempotent_and_lookup(spark):
    store = UVStore(spark, scratch_path(spark, "test-store"), "set")
    store.write_batch(_batch(spark, [("p", 0, "a"), ("p", 0, "b")]), 0)
    store.write_batch(_batch(spark, [("p", 0, "b"), ("p", 0, "c"), ("q", 0, "a")]), 1)
    store.write_batch(_batch(spark, [("p", 0, "b"), ("p", 0, "c"), ("q", 0, "a")]), 1)
    got = {(r.page, r.window_time): r.uv for r in store.uv().collect()}
    assert got == {("p", 0): 3, ("q", 0): 1}
    keys = spark.createDataFrame([("p", 0), ("z", 0)], "page string, window_time bigint")
    look = {r.page: r.uv for r in store.lookup(keys).collect()}
    assert look == {"p": 3, "z": 0}


def test_store_expiry_and_compaction(spark):
    store = UVStore(spark, scratch_path(spark, "test-store"), "set", ttl_ms=1000)
    store.write_batch(_batch(spark, [("p", 0, "a"), ("p", 5000, "b")]), 0)
    assert {r.window_time for r in store.uv(as_of_ms=5500).collect()} == {5000}
    store.compact(9, as_of_ms=5500)
    assert [(r.window_time, r.uv) for r in store.uv().collect()] == [(5000, 1)]


def test_hll_store_merges_batches(spark):
    store = UVStore(spark, scratch_path(spark, "test-hll"), "hll")
    store.write_batch(_batch(spark, [("p", 0, str(i)) for i in range(300)]), 0)
    store.write_batch(_batch(spark, [("p", 0, str(i)) for i in range(200, 500)]), 1)
    assert abs(store.uv().first().uv - 500) <= 15


def test_empty_store_reads_as_empty(spark):
    store = UVStore(spark, scratch_path(spark, "never-written"), "set")
    assert store.uv().count() == 0
    keys = spark.createDataFrame([("p", 0)], "page string, window_time bigint")
    assert [r.uv for r in store.lookup(keys).collect()] == [0]
