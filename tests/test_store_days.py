"""The day-partitioned store: pruning, the duplicate filter; late rows; active-window logs."""

import pytest
from pyspark.sql import functions as F

from uvlens.operators.seen import BITS, seen_filters, unseen_for_sure
from uvlens.operators.store import UVStore
from uvlens.operators.windows import DAY, HOUR
from uvlens.session import scratch_path, subfolders
from uvlens.streaming.late import late_report, late_writer

SCHEMA = "page string, window_time bigint, user_id string"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _files(df):
    return {f.split("/day=")[1] for f in df.inputFiles()}


@pytest.fixture
def ten_days(spark):
    store = UVStore(spark, scratch_path(spark, "t-days"), "set", ttl_ms=DAY)
    for k in range(10):
        store.write_batch(_rows(spark, [("p", k * DAY + h * HOUR, f"u{k}") for h in range(3)]), k)
    return store


def test_lookups_read_the_days_of_their_keys(spark, ten_days):
    assert len(subfolders(spark, ten_days.root)) == 10
    rows = ten_days.live_rows(first_ms=4 * DAY, last_ms=5 * DAY + HOUR)
    assert {f.split("/")[0] for f in _files(rows)} == {"4", "5"}
    keys = spark.createDataFrame([("p", 4 * DAY), ("p", 4 * DAY + 5 * HOUR)], "page string, window_time bigint")
    assert {(r.window_time, r.uv) for r in ten_days.lookup(keys).collect()} == {(4 * DAY, 1), (4 * DAY + 5 * HOUR, 0)}
    read = [f for f in ten_days.lookup(keys).inputFiles() if "/day=" in f]
    assert read and all("/day=4/" in f for f in read)
    assert ten_days.lookup(keys.limit(0)).collect() == []


def test_expired_days_are_not_opened_nor_compacted(spark, ten_days):
    as_of = 9 * DAY + 2 * HOUR
    assert {f.split("/")[0] for f in _files(ten_days.live_rows(as_of))} == {"8", "9"}
    assert {r.window_time for r in ten_days.uv(as_of).collect()} == {9 * DAY, 9 * DAY + HOUR, 9 * DAY + 2 * HOUR}
    ten_days.compact(as_of_ms=as_of)
    assert {r.window_time for r in ten_days.uv().collect()} == {9 * DAY, 9 * DAY + HOUR, 9 * DAY + 2 * HOUR}


def test_a_long_batch_writes_few_files(spark):
    store = UVStore(spark, scratch_path(spark, "t-few"), "set")
    store.write_batch(spark.range(0, 20_000, 1, 8).select(
        F.lit("p").alias("page"), (F.col("id") % 40 * DAY).alias("window_time"), F.col("id").cast("string").alias("user_id")), 0)
    assert len(store.rows().inputFiles()) <= 80


def test_redelivered_rows_are_stored_once(spark):
    store = UVStore(spark, scratch_path(spark, "t-new"), "set")
    first = _rows(spark, [("p", 0, f"u{i}") for i in range(500)] + [("q", DAY, "u1"), ("q", DAY, "u1")])
    more = first.union(_rows(spark, [("p", 0, f"u{i}") for i in range(400, 900)] + [("r", 0, "u1")]))
    store.write_new(first, 0)
    store.write_new(more, 1)
    store.write_new(more, 1)            # replay of the batch
    store.write_new(more, 2)            # delivered again
    store.write_new(first.limit(0), 3)
    assert store.rows().count() == 902
    assert {(r.page, r.uv) for r in store.uv().collect()} == {("p", 900), ("q", 1), ("r", 1)}
    assert {r.batch_id for r in store.rows().select("batch_id").distinct().collect()} == {0, 1}
    store.compact()
    store.write_new(more, 4)            # now held by the snapshot
    assert store.rows().count() == 902
    with pytest.raises(ValueError, match="sketches"):
        UVStore(spark, scratch_path(spark, "t-new"), "hll").write_new(first, 0)


def test_a_crash_before_the_filters_are_written(spark):
    store = UVStore(spark, scratch_path(spark, "t-crash"), "set")
    rows = _rows(spark, [("p", 0, "a"), ("p", 0, "b")])
    store._write(store.batch_rows(rows), 0)   # rows written, filters not
    store.write_new(rows, 0)                  # the replay
    store.write_new(rows, 1)
    assert sorted(r.user_id for r in store.rows().collect()) == ["a", "b"]


@pytest.mark.parametrize("users", [1, 2_000, 60_000])
def test_filters_miss_nothing(spark, users):
    ids = spark.range(users).select(F.lit("p").alias("page"), F.lit(0).cast("bigint").alias("window_time"),
                                    F.col("id").cast("string").alias("user_id"))
    seen = seen_filters(ids)
    assert unseen_for_sure(ids, seen).where("new").count() == 0
    others = ids.withColumn("user_id", F.concat(F.lit("x"), "user_id"))
    wrong = unseen_for_sure(others, seen).where("not new").count()
    if users <= 2_000:
        assert wrong <= 0.03 * users
    assert unseen_for_sure(ids.withColumn("page", F.lit("q")), seen).where("not new").count() == 0
    assert seen.select(F.max(F.bitmap_count("bits"))).first()[0] <= BITS


B = "page string, user_id string, behavior_ms bigint"


def test_late_rows_by_value(spark):
    root = scratch_path(spark, "t-late")
    write = late_writer(root, HOUR, HOUR)
    assert late_report(spark, root).collect() == []
    batches = [
        [("p", "a", 10), ("p", "b", 20), ("p", "a", 5 * HOUR)],
        # mark 5 h, watermark 4 h: the window that ends at 4 h is closed, the one that ends at 5 h is not
        [("p", "c", 30), ("p", "a", 40), ("p", "c", 31), ("p", "d", 4 * HOUR - 1), ("p", "e", 4 * HOUR)],
        [],
        [("p", "f", 9 * HOUR)],
        [("p", "b", 5 * HOUR + 1), ("q", "z", 1)],
    ]
    for k, rows in enumerate(batches):
        write(spark.createDataFrame(rows, B), k)
    write(spark.createDataFrame(batches[4], B), 4)   # replay
    got = {tuple(r) for r in late_report(spark, root).collect()}
    assert got == {
        ("p", HOUR, 2, 3, 1, 3), ("p", 4 * HOUR, 0, 1, 1, 1), ("p", 5 * HOUR, 1, 0, 0, 1),
        ("p", 6 * HOUR, 1, 1, 1, 2), ("p", 10 * HOUR, 1, 0, 0, 1), ("q", HOUR, 0, 1, 1, 1)}
