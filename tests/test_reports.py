"""Ranked and positional slices, including a hot partition split over tasks."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from uvlens.operators.reports import asc, bottom_by_score, positions, rank_slice, top_by_score


@pytest.fixture
def skewed(spark):
    rnd = random.Random(3)
    rows = [("hot", rnd.randrange(10_000), i) for i in range(3000)]
    rows += [(f"k{j}", rnd.randrange(10_000), 10_000 + j * 10 + i) for j in range(20) for i in range(7)]
    return spark.createDataFrame(rows, "page string, ms bigint, id bigint")


def _expected(df):
    w = Window.partitionBy("page").orderBy("ms", "id")
    return {(r.page, r.id): r.p for r in
            df.select("page", "id", (F.row_number().over(w) - 1).alias("p")).collect()}


def test_positions_match_row_number(spark, skewed):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = positions(skewed, ["page"], [asc("ms"), asc("id")], "p", n_parts=7)
        assert {(r.page, r.id): r.p for r in got.collect()} == _expected(skewed)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("start,end", [(0, 4), (-3, -1), (2, -3), (-5, 3), (5, 2), (100, 200)])
def test_rank_slice_bounds(spark, skewed, start, end):
    exp = _expected(skewed)
    sizes = {}
    for (p, _), _v in exp.items():
        sizes[p] = sizes.get(p, 0) + 1
    want = set()
    for (p, i), v in exp.items():
        n = sizes[p]
        lo = start if start >= 0 else max(n + start, 0)
        hi = min(end if end >= 0 else n + end, n - 1)
        if lo <= v <= hi:
            want.add((p, i, v))
    got = rank_slice(skewed, ["page"], [asc("ms"), asc("id")], start, end)
    assert {(r.page, r.id, r.pos) for r in got.collect()} == want


def test_top_and_bottom_ties(spark):
    df = spark.createDataFrame([("d", "a", 3), ("d", "b", 3), ("d", "c", 1), ("d", "e", 5)],
                               "day string, page string, uv bigint")
    top = [r.page for r in top_by_score(df, ["day"], "page", "uv", 0, 2).orderBy("rank").collect()]
    bottom = [r.page for r in bottom_by_score(df, ["day"], "page", "uv", 0, 2).orderBy("rank").collect()]
    assert top == ["e", "b", "a"]
    assert bottom == ["c", "a", "b"]


@pytest.mark.parametrize("kind", ["one day", "one second, ties", "long common prefix"])
def test_positions_spread_one_hot_page(spark, kind):
    """One page of 200,000 rows whose order column hardly differs: no range holds over 5 %
    of them, and positions are exact."""
    import uvlens.operators.reports as R

    n, seen = 200_000, []
    key = {"one day": F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.col("id") * 7919, F.lit(86_400))),
           "one second, ties": F.lit(1_704_067_200),
           "long common prefix": F.concat(F.lit("page_with_a_long_name_"), F.lpad(F.pmod(F.col("id") * 7919, F.lit(n)), 6, "0"))}[kind]
    df = spark.range(n).select(F.lit("p").alias("page"), key.alias("k"), "id")
    old = R.written
    R.written = lambda d, name: (seen.append(old(d, name)), seen[-1])[1]
    try:
        got = positions(df, ["page"], [asc("k")], "pos", n_parts=64, size="n")
        rows = got.select("k", "pos", "n").orderBy("pos").collect()
    finally:
        R.written = old
    sizes = [r["count"] for r in seen[0].groupBy("_range").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 0.05 * n
    assert [r["pos"] for r in rows] == list(range(n)) and {r["n"] for r in rows} == {n}
    keys = [r["k"] for r in rows]
    assert keys == sorted(keys)
