"""The streaming launcher end to end on a JSON-lines folder."""

import pytest
from pyspark.sql import functions as F

from uvlens.session import scratch_path
from uvlens.sources.behaviors import events_as_messages
from uvlens.streaming import launcher as L

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def json_folder(spark):
    folder = scratch_path(spark, "json-in")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    events_as_messages(ev).select("value").coalesce(1).write.text(folder)
    return folder


@pytest.mark.parametrize("strategy", ["exact", "hash", "slots", "hll", "set-store",
                                      "new-visitors", "new-visitors/keyed"])
def test_launcher_runs(spark, json_folder, strategy):
    strategy, _, state = strategy.partition("/")
    out = scratch_path(spark, f"launch-{strategy}")
    args = L.parser().parse_args(["--strategy", strategy, "--source", "json", "--path", json_folder,
                                  "--sink", "parquet", "--out", out, "--once",
                                  "--window", "1 hour", "--bucket-unit", "hours",
                                  "--state", state or "seeded"])
    L.start(spark, args).awaitTermination()
    df = spark.read.parquet(out)
    assert df.count() > 0
    if strategy in ("exact", "hash", "set-store"):
        from uvlens.operators.store import UVStore
        got = (UVStore(spark, out, "set").uv() if strategy == "set-store"
               else df.groupBy("page", "window_time").agg(F.max("uv").alias("uv")))
        ev = spark.read.parquet(f"{SF}/events.parquet")
        if strategy == "set-store":
            exact = ev.groupBy("event_type", F.expr("unix_millis(date_trunc('HOUR', cast(ts as timestamp)))")).agg(
                F.count_distinct("user_id")).count()
        else:
            exact = ev.groupBy("event_type", F.expr("floor(unix_micros(cast(ts as timestamp)) / 3600000000)")).count().count()
        assert got.count() == exact


@pytest.fixture(scope="module")
def three_files(spark, tmp_path_factory):
    """Events cut by time into three files with growing modification times."""
    import os
    import time

    from uvlens.functions.time import epoch_ms
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("_ms", epoch_ms("ts"))
    lo, hi = ev.agg(F.min("_ms"), F.max("_ms")).first()
    folder, base = tmp_path_factory.mktemp("three"), time.time() - 1000
    for k in range(3):
        a, b = lo + (hi + 1 - lo) * k // 3, lo + (hi + 1 - lo) * (k + 1) // 3
        sub = str(tmp_path_factory.mktemp("part") / "x")
        ev.where((F.col("_ms") >= a) & (F.col("_ms") < b)).drop("_ms").coalesce(1).write.parquet(sub)
        src = [f for f in os.listdir(sub) if f.endswith(".parquet")][0]
        os.link(f"{sub}/{src}", folder / f"events-{k}.parquet")
        os.utime(folder / f"events-{k}.parquet", (base + 10 * k,) * 2)
    return str(folder)


@pytest.mark.parametrize("strategy", ["exact", "hash", "slots", "hll", "set-store", "hll-store", "new-visitors",
                                      "cumulative"])
def test_launcher_equals_batch_over_three_batches(spark, three_files, strategy):
    from uvlens.operators.admissions import uv_cumulative, uv_new_visitors
    from uvlens.operators.store import UVStore
    from uvlens.operators.windows import uv_per_batch_time, uv_per_window
    from uvlens.sources.behaviors import load_behaviors
    out = scratch_path(spark, f"launch3-{strategy}")
    args = L.parser().parse_args(["--strategy", strategy, "--source", "parquet", "--path", three_files,
                                  "--max-files", "1", "--sink", "parquet", "--out", out, "--once",
                                  "--window", "30 seconds", "--ttl-hours", "3"])
    L.start(spark, args).awaitTermination()
    b = load_behaviors(spark, SF)
    if strategy.endswith("-store"):
        got = UVStore(spark, out, strategy[:-6]).uv()
        want = uv_per_batch_time(b, 1, "minutes")
    else:
        got = spark.read.parquet(out)
        assert got.select("batch_id").distinct().count() == 3
        got = got.groupBy("page", "window_time").agg(F.max_by("uv", "batch_id").alias("uv"))
        want = (uv_cumulative(b, 30_000, 10_800_000) if strategy == "cumulative"
                else uv_new_visitors(b, 30_000, 10_800_000) if strategy == "new-visitors"
                else uv_per_window(b, 30_000, "exact"))
    key = lambda df: sorted((r.page, r.window_time, r.uv) for r in df.collect())
    assert key(got) == key(want)


def test_long_running_needs_a_checkpoint(spark, three_files):
    args = L.parser().parse_args(["--source", "parquet", "--path", three_files])
    with pytest.raises(ValueError, match="checkpoint"):
        L.start(spark, args)


def _windows(spark, state, hour=3_600_000):
    active = spark.read.schema(L.ACTIVE_SCHEMA).parquet(f"{state}/active")
    seen = active.groupBy("page", "window_time").agg(F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"))
    admitted = spark.read.schema(L.J.ADMIT_TABLE).parquet(f"{state}/admissions")
    return L.J.cumulative_ttl_from(seen, L.new_users(admitted, hour), 3 * hour)


def test_running_totals_read_a_ttl_back_only(spark, monkeypatch):
    """A batch a day, every fifth with events of the day before: the last total of every
    window equals the totals from all stored rows, and the days opened do not grow."""
    import random
    hour, day, rng = 3_600_000, 86_400_000, random.Random(5)
    state, out, opened = scratch_path(spark, "t-running"), scratch_path(spark, "t-running-out"), []
    read = L.J.read_days

    def counted(*a):
        df = read(*a)
        opened[-1] |= {f.split("/day=")[1].split("/")[0] for f in df.inputFiles()}
        return df
    monkeypatch.setattr(L.J, "read_days", counted)
    args = L.parser().parse_args(["--strategy", "cumulative", "--window", "1 hour", "--ttl-hours", "3",
                                  "--sink", "parquet", "--out", out])
    write = L._admissions_batch(args, state, 3 * hour, out)
    for k in range(12):
        rows = [(f"p{rng.randrange(3)}", f"u{rng.randrange(6)}", k * day + rng.randrange(day)) for _ in range(30)]
        if k % 5 == 4:
            rows += [("p0", f"v{i}", (k - 1) * day + rng.randrange(day)) for i in range(10)]
        opened.append(set())
        batch = spark.createDataFrame(rows, "page string, user_id string, behavior_ms bigint")
        write(batch, k)
        if k in (4, 7):  # a replay changes nothing
            write(batch, k)
    got = (spark.read.parquet(out).groupBy("page", "window_time").agg(F.max_by("uv", "batch_id").alias("uv")))
    key = lambda df: sorted((r.page, r.window_time, r.uv) for r in df.collect())
    assert key(got) == key(_windows(spark, state))
    assert max(len(o) for o in opened) <= 4


def test_store_strategy_compacts_and_keeps_new_rows_only(spark, three_files):
    from uvlens.operators.store import UVStore
    from uvlens.operators.windows import uv_per_batch_time
    from uvlens.sources.behaviors import load_behaviors
    out = scratch_path(spark, "launch-compact")
    args = L.parser().parse_args(["--strategy", "hll-store", "--source", "parquet", "--path", three_files,
                                  "--max-files", "1", "--sink", "parquet", "--out", out, "--once",
                                  "--compact-every", "2"])
    L.start(spark, args).awaitTermination()
    store = UVStore(spark, out, "hll")
    assert store.snapshot() == (1, 1)
    args = L.parser().parse_args(["--strategy", "set-store", "--source", "parquet", "--path", three_files,
                                  "--max-files", "1", "--sink", "parquet", "--out", f"{out}-set", "--once",
                                  "--only-new"])
    L.start(spark, args).awaitTermination()
    key = lambda df: sorted((r.page, r.window_time, r.uv) for r in df.collect())
    assert key(UVStore(spark, f"{out}-set").uv()) == key(uv_per_batch_time(load_behaviors(spark, SF), 1, "minutes"))
