"""Large groups, other session zones, long words, compaction, exact positions."""

import time

import pytest
from pyspark.sql import functions as F

from uvlens.functions import keys as K
from uvlens.functions import text as TX
from uvlens.functions import time as TM
from uvlens.operators.reports import asc, desc, positions, rank_slice
from uvlens.operators.store import UVStore
from uvlens.operators.strategies import distinct_users
from uvlens.plans import QUERIES
from uvlens.plans.calendar import gap_fill
from uvlens.session import checkpoint_root, scratch_path


@pytest.fixture(scope="module")
def million(spark):
    return spark.range(2_000_000).selectExpr("concat('u', id) AS user_id", "'p' AS page")


@pytest.mark.parametrize("strategy,opts", [("slots", {}), ("slots", {"correct": True}), ("hll", {})])
def test_large_groups(million, strategy, opts):
    assert abs(distinct_users(million, ["page"], strategy, **opts).first().uv / 2_000_000 - 1) < 0.03


def test_merged_sketches_on_large_groups(spark, million):
    store = UVStore(spark, scratch_path(spark, "t-large"), "hll")
    keyed = million.withColumn("window_time", F.lit(0).cast("bigint"))
    for k in range(2):
        store.write_batch(keyed.where(F.pmod(F.hash("user_id"), F.lit(2)) == k), k)
    assert abs(store.uv().first().uv / 2_000_000 - 1) < 0.03


def test_full_slots_estimate_nothing(spark):
    df = spark.range(1000).selectExpr("cast(id AS string) AS user_id", "'p' AS page")
    assert distinct_users(df, ["page"], "slots", slots=8).first().uv == 8
    assert distinct_users(df, ["page"], "slots", slots=8, correct=True).first().uv is None


@pytest.fixture
def zone(spark):
    yield lambda z: spark.conf.set("spark.sql.session.timeZone", z)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_time_does_not_depend_on_the_session_zone(spark, zone):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-03-10 02:30:00.1239'), "  # skipped in New York
                   "(TIMESTAMP_NTZ'2024-11-03 01:30:00'), (TIMESTAMP_NTZ'1969-12-31 23:59:59.9995') t(ts)")
    exprs = [TM.format_ms("ms", "yyyy-MM-dd HH:mm:ss.SSS").alias("f"), TM.shift_ms("ms", -1, "MONTH").alias("s"),
             TM.batch_time("ms", 7, "days", "America/New_York").alias("b"), TM.day_of_year("ms").alias("d"),
             TM.previous_batch_time("ms", 7, "minutes").alias("p")]
    exprs += [f("ms", u, z).alias(f"{f.__name__}{u}{z}") for f in (TM.calendar_start, TM.calendar_end)
              for u in TM.CALENDAR_UNITS for z in ("UTC", "America/New_York", "Asia/Shanghai")]
    seen = []
    for z in ("UTC", "America/New_York", "Asia/Shanghai"):
        zone(z)
        seen.append([tuple(r) for r in df.select(TM.epoch_ms("ts").alias("ms")).select("ms", *exprs).collect()])
    assert seen[0] == seen[1] == seen[2]
    assert [r[0] for r in seen[0]] == [1710037800123, 1730597400000, -1]
    assert seen[0][0][1] == "2024-03-10 02:30:00.123"


@pytest.mark.parametrize("name", ["uv_by_day_zones", "uv_shift_units", "uv_gap_filled", "report_formats"])
def test_queries_in_other_session_zones(spark, zone, name):
    def run():
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        return sorted(map(str, df.select(sorted(df.columns)).collect()))
    want = run()
    for z in ("America/New_York", "Asia/Shanghai"):
        zone(z)
        assert run() == want


@pytest.mark.parametrize("first", ["2024-03-05", "2024-10-30"])  # over either clock change
def test_gap_fill_keeps_days_across_clock_changes(spark, first):
    days = spark.sql(f"SELECT explode(sequence(DATE'{first}', date_add(DATE'{first}', 9))) AS d")
    ms = F.expr(TM.local_to_ms_sql("cast(d as timestamp_ntz)", "America/New_York"))
    daily = days.select(F.lit("p").alias("page"), ms.alias("window_time"), F.lit(1).cast("bigint").alias("uv"), "d")
    assert sorted(map(tuple, gap_fill(daily.drop("d"), "America/New_York").collect())) == sorted(
        map(tuple, daily.drop("d").collect()))
    ends = daily.where(f"d IN (DATE'{first}', date_add(DATE'{first}', 9))").drop("d")
    got = gap_fill(ends, "America/New_York").collect()
    assert sorted(r.window_time for r in got) == sorted(r.window_time for r in daily.collect())
    assert sum(r.uv for r in got) == 2


LONG = {"letters": "a" * 100_000, "digits": "7" * 100_000, "digits end": "7" * 100_000 + "x", "blanks": "x" + " " * 100_000 + "x",
        "mail": "a" * 100_000 + "@", "host": "ab@" + "a." * 50_000 + "1", "dashes": "a-" * 50_000, "signs": "+" * 100_000}


@pytest.mark.parametrize("kind", sorted(LONG))
def test_long_words(spark, kind):
    df = spark.createDataFrame([(LONG[kind],)], "t string")
    df.select(*[rule("t").alias(n) for n, rule in TX.RULES.items()], TX.java_trim("t").alias("trim")).collect()
    began = time.time()
    got = df.select(*[rule("t").alias(n) for n, rule in TX.RULES.items()], TX.java_trim("t").alias("trim")).first()
    assert time.time() - began < 2
    assert got.is_email is False and got.trim == LONG[kind]
    assert got.is_int == (kind == "digits") and got.is_letter == (kind == "letters")


def test_linear_patterns_accept_the_same_texts():
    import itertools
    import re
    for alphabet, patterns in (("a1-@.", [TX.EMAIL]), ("1+E.", [TX.SCIENTIFIC, TX.DOUBLE, TX.INT, TX.NUMBER])):
        for n in range(8):
            for t in map("".join, itertools.product(alphabet, repeat=n)):
                for p in patterns:
                    assert bool(re.fullmatch(p, t)) == bool(re.fullmatch(TX.LINEAR[p], t)), (p, t)


def test_string_hash_of_a_batch():
    texts = ["", "abc", "polygenelubricants", "🙂x", "", "ö", "a" * 5000]

    def one(t):
        h, u = 0, t.encode("utf-16-le")
        for k in range(0, len(u), 2):
            h = (31 * h + u[k] + 256 * u[k + 1]) % 2**32
        return h
    assert K.hash_texts(texts).tolist() == [one(t) for t in texts]
    assert K.hash_texts([]).tolist() == [] and K.hash_texts([""]).tolist() == [0]


def _users(spark, *users):
    return spark.createDataFrame([("p", 0, u) for u in users], "page string, window_time bigint, user_id string")


@pytest.mark.parametrize("kind", ["set", "hll"])
def test_writes_after_compaction(spark, kind):
    root = scratch_path(spark, "t-compact")
    store = UVStore(spark, root, kind)
    store.write_batch(_users(spark, "a", "b"), 0)
    assert store.compact(1) == 1
    store.write_batch(_users(spark, "c"), 1)
    assert store.uv().first().uv == 3
    store.write_batch(_users(spark, "c"), 1)  # replay
    assert store.compact() == 2
    store.write_batch(_users(spark, "c"), 1)  # replay of a batch that is folded in
    store.write_batch(_users(spark, "d", "a"), 2)
    assert store.uv().first().uv == 4
    other = UVStore(spark, root, kind)  # another reader: the pointer is stored
    assert other.uv().first().uv == 4 and other.snapshot() == (2, 1)
    with pytest.raises(ValueError, match="negative"):
        store.write_batch(_users(spark, "z"), -1)


def test_store_is_read_by_another_process(spark, tmp_path):
    import subprocess
    import sys
    root = str(tmp_path / "store")
    store = UVStore(spark, root, "set")
    store.write_batch(_users(spark, "a", "b"), 0)
    store.compact()
    store.write_batch(_users(spark, "c"), 1)
    code = ("from uvlens.session import build_session; from uvlens.operators.store import UVStore; "
            f"s = build_session('local[1]'); print('UV', UVStore(s, {root!r}, 'set').uv().first().uv)")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert "UV 3" in out.stdout, out.stderr[-500:]


def test_positions_without_exchange_reuse(spark):
    df = (spark.range(60_000).selectExpr("IF(id % 3 < 2, 'hot', 'cold') AS page", "pmod(hash(id), 5000) AS ms", "id",
                                         "cast(pmod(hash(id, 7), 900) AS string) AS name")
          .unionAll(spark.sql("SELECT 'hot', cast(null AS int), -1L, cast(null AS string)")))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        for order, sql in (([asc("ms"), asc("id")], "ms, id"), ([desc("ms"), asc("id")], "ms DESC, id"),
                           ([asc("name"), desc("id")], "name, id DESC")):
            want = df.selectExpr("*", f"row_number() OVER (PARTITION BY page ORDER BY {sql}) - 1 AS p")
            got = positions(df, ["page"], order, "p", n_parts=7)
            assert got.count() == df.count()
            assert got.join(want, ["page", "id", "p"]).count() == df.count()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInPandas" not in plan


def test_deep_slices(spark):
    df = spark.range(30_000).selectExpr("'p' AS page", "id")
    for start, end in ((20_000, 20_004), (-20_000, -19_996), (29_990, 99_999)):
        ids = list(range(30_000))
        want = ids[start:end + 1 if end != -1 else None]
        got = rank_slice(df, ["page"], [asc("id")], start, end)
        assert sorted((r.id, r.pos) for r in got.collect()) == [(i, i) for i in want]


def test_scratch_folder_must_be_shared_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


@pytest.mark.parametrize("name", ["uv_overlap", "uv_vs_previous", "uv_shift_compare", "uv_shift_units", "uv_gap_filled",
                                  "uv_hll_rollup", "uv_new_visitors", "uv_cumulative"])
def test_one_scan(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
