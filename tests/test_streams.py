"""Stream = batch on staged files; late data; stateful TTL admissions."""

import os
import time

import pytest
from pyspark.sql import functions as F

from uvlens.functions.time import epoch_ms_sql
from uvlens.operators.admissions import ttl_admissions
from uvlens.operators.windows import DAY, uv_per_window
from uvlens.session import scratch_path
from uvlens.sources.behaviors import behaviors_from_events
from uvlens.sources.streams import stream_behaviors
from uvlens.streaming import jobs as J

SF = "/root/testdata/sf0.01"
SCHEMA = "page STRING, window_time BIGINT, uv BIGINT"


def stage(spark, cuts, order=(0, 1, 2)):
    """Events cut at mid-day times into three files, written one at a time
    with increasing modification times."""
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("_ms", F.expr(epoch_ms_sql("ts")))
    bounds = [None, *cuts, None]
    folder = scratch_path(spark, "staged")
    base = time.time() - 1000
    for k, i in enumerate(order):
        lo, hi = bounds[i], bounds[i + 1]
        part = ev
        if lo is not None:
            part = part.where(F.col("_ms") >= lo)
        if hi is not None:
            part = part.where(F.col("_ms") < hi)
        sub = f"{folder}/tmp{i}"
        part.drop("_ms").coalesce(1).write.parquet(sub)
        src = [f for f in os.listdir(sub) if f.endswith(".parquet")][0]
        dst = f"{folder}/events-{k}.parquet"
        os.link(f"{sub}/{src}", dst)
        os.utime(dst, (base + 10 * k, base + 10 * k))
    return folder


MIDDAY_CUTS = (1_704_067_200_000 + 9 * DAY + DAY // 2, 1_704_067_200_000 + 19 * DAY + DAY // 2)


@pytest.fixture(scope="module")
def batch_daily(spark):
    b = behaviors_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    return {(r.page, r.window_time): r.uv for r in uv_per_window(b, DAY, "exact").collect()}


def test_update_mode_last_value_equals_batch(spark, batch_daily):
    folder = stage(spark, MIDDAY_CUTS)
    s = stream_behaviors(spark, folder, glob="events-*.parquet", max_files=1)
    log = J.run_update(spark, J.exact_uv_stream(s, "1 day", "1 hour"), "t-upd")
    got = {(r.page, r.window_time): r.uv for r in
           J.read_changelog(spark, log, SCHEMA, ["page", "window_time"], ["uv"]).collect()}
    assert got == batch_daily
    assert spark.read.parquet(log).select("batch_id").distinct().count() == 3


def test_append_mode_closed_windows(spark, batch_daily):
    folder = stage(spark, MIDDAY_CUTS)
    s = stream_behaviors(spark, folder, glob="events-*.parquet", max_files=1)
    out = J.run_append(spark, J.exact_uv_stream(s, "1 day", "1 hour"), "t-app")
    got = {(r.page, r.window_time): r.uv for r in spark.read.schema(SCHEMA).parquet(out).collect()}
    assert len(got) == 145
    assert all(batch_daily[k] == v for k, v in got.items())


@pytest.mark.parametrize("order,since", [((1, 0, 2), 0), ((1, 2, 0), MIDDAY_CUTS[0])])
def test_late_files_do_not_change_closed_windows(spark, batch_daily, order, since):
    """A micro-batch is held against the watermark before its predecessor: the first days
    are still counted one batch late, and dropped as a whole two batches late."""
    folder = stage(spark, MIDDAY_CUTS, order=order)
    s = stream_behaviors(spark, folder, glob="events-*.parquet", max_files=1)
    out = J.run_append(spark, J.exact_uv_stream(s, "1 day", "1 hour"), "t-late")
    rows = sorted(tuple(r) for r in spark.read.schema(SCHEMA).parquet(out).collect())
    b = behaviors_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    closed = b.agg(F.max("behavior_ms")).first()[0] - 3_600_000
    kept = uv_per_window(b.where(F.col("behavior_ms") >= since), DAY, "exact")
    want = sorted(tuple(r) for r in kept.select("page", "window_time", "uv").collect() if r.window_time <= closed)
    assert rows == want  # each window once, with its final value
    assert any(uv < batch_daily[(page, end)] for page, end, uv in want) == (since > 0)


def test_stateful_admissions_equal_batch_fold(spark):
    folder = stage(spark, MIDDAY_CUTS)
    ttl = 3_600_000
    s = stream_behaviors(spark, folder, glob="events-*.parquet", max_files=1)
    out = J.run_append(spark, J.admissions_stream(s, ttl, "1 hour"), "t-adm")
    got = {tuple(r) for r in spark.read.schema(J.ADMIT_SCHEMA).parquet(out).collect()}
    b = behaviors_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    want = {tuple(r) for r in ttl_admissions(b, ttl).select("page", "user_id", "admit_ms").collect()}
    assert got == want


def test_store_seeded_admissions_equal_batch_fold(spark):
    folder = stage(spark, MIDDAY_CUTS)
    ttl = 3_600_000
    s = stream_behaviors(spark, folder, glob="events-*.parquet", max_files=1)
    out = scratch_path(spark, "adm-store")
    J.admissions_store_stream(spark, s, ttl, out, "t-adm-store")
    log = spark.read.parquet(out)
    assert log.select("batch_id").distinct().count() == 3
    got = {tuple(r) for r in log.select("page", "user_id", "admit_ms").collect()}
    b = behaviors_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    want = {tuple(r) for r in ttl_admissions(b, ttl).select("page", "user_id", "admit_ms").collect()}
    assert got == want


def test_cumulative_streams_equal_batch_over_three_batches(spark):
    from uvlens.operators.admissions import uv_cumulative
    folder = stage(spark, MIDDAY_CUTS)

    def s():
        return stream_behaviors(spark, folder, glob="events-*.parquet", max_files=1)
    new_log = J.run_update(spark, J.first_seen_stream(s(), "30 seconds"), "t-cum-new")
    act_log = J.run_update(spark, J.active_windows_stream(s(), "30 seconds"), "t-cum-act")
    new = J.read_changelog(spark, new_log, "page STRING, window_time BIGINT, new_users BIGINT",
                           ["page", "window_time"], ["new_users"])
    act = J.read_changelog(spark, act_log, "page STRING, window_time BIGINT, first_ms BIGINT",
                           ["page", "window_time"], ["first_ms"]).drop("first_ms")
    got = {tuple(r) for r in J.cumulative_from(act, new).collect()}
    b = behaviors_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    want = {tuple(r) for r in uv_cumulative(b, 30_000).collect()}
    assert got == want


def test_cumulative_ttl_stream_equals_batch_over_three_batches(spark):
    from uvlens.operators.admissions import uv_cumulative
    folder = stage(spark, MIDDAY_CUTS)
    ttl = 3_600_000

    def s():
        return stream_behaviors(spark, folder, glob="events-*.parquet", max_files=1)
    active = J.start_update(spark, J.active_windows_stream(s(), "30 seconds"), "t-cumt-act")
    out = J.admissions_store_stream(spark, s(), ttl, scratch_path(spark, "t-adm"), "t-cumt-adm")
    (act_log,) = J.await_all(active)
    admitted = spark.read.schema(f"{J.ADMIT_SCHEMA}, batch_id BIGINT").parquet(out)
    new = (admitted.selectExpr("page", "user_id",
                               "admit_ms - pmod(admit_ms, 30000) + 30000 AS window_time")
           .groupBy("page", "window_time").agg(F.count_distinct("user_id").alias("new_users")))
    act = J.read_changelog(spark, act_log,
                           "page STRING, window_time BIGINT, first_ms BIGINT, last_ms BIGINT",
                           ["page", "window_time"], ["first_ms", "last_ms"])
    got = {tuple(r) for r in J.cumulative_ttl_from(act, new, ttl).collect()}
    b = behaviors_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    want = {tuple(r) for r in uv_cumulative(b, 30_000, ttl).collect()}
    assert got == want
