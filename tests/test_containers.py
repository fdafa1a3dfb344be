"""Container bitmaps and theta sketches against Python sets."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import BASE_MS, HOUR
from uvlens.operators import containers as C
from uvlens.operators import sketches as S

DAY = 24 * HOUR


def _sets(seed):
    """Sparse, dense and mixed windows of two pages; containers on both sides of FULL."""
    rnd = random.Random(seed)
    out = {}
    for page in ("a", "b"):
        for d in range(5):
            kind = rnd.choice(["sparse", "dense", "edge", "mixed"]) if page == "a" else "mixed"
            s = set()
            if kind in ("sparse", "mixed"):
                s |= {rnd.randrange(2**62) for _ in range(200)} | {rnd.randrange(50) << 40 for _ in range(30)}
            if kind in ("dense", "mixed"):
                s |= set(rnd.sample(range(3 << C.LOW_BITS), rnd.choice([3_000, 9_000])))
            if kind == "edge":
                s |= set(range(C.FULL + d % 2))
            out[page, d] = s
    del out["b", 2]
    return out


@pytest.fixture(scope="module", params=[1, 2])
def stored(request, spark):
    sets = _sets(request.param)
    rows = [(p, BASE_MS + d * DAY + v % HOUR, v) for (p, d), s in sets.items() for v in s]
    rows += rows[::7]
    df = spark.createDataFrame(rows, "page string, behavior_ms bigint, v bigint")
    return sets, C.window_containers(df, DAY, F.col("v")).cache()


def _by(df, *cols):
    return {(r["page"], (r["window_time"] - BASE_MS) // DAY - 1): tuple(r[c] for c in cols) for r in df.collect()}


def test_cardinality_and_kinds(stored):
    sets, got = stored
    assert _by(C.cardinality(got, ["page", "window_time"]), "uv") == {k: (len(s),) for k, s in sets.items()}
    kinds = got.select(F.col("bm").isNull().alias("k"), C.size_of().alias("n")).collect()
    assert all((r["n"] <= C.FULL) == r["k"] for r in kinds) and {r["k"] for r in kinds} == {True, False}


def test_union(stored):
    sets, got = stored
    wide = C.union(got.select("page", "high", "lows", "bm"), ["page"])
    want = {p: len(set().union(*[s for (q, _), s in sets.items() if q == p])) for p in ("a", "b")}
    assert {r["page"]: r["uv"] for r in C.cardinality(wide, ["page"]).collect()} == want
    # merging merged sets changes nothing
    assert {r["page"]: r["uv"] for r in C.cardinality(C.union(wide.unionByName(wide), ["page"]), ["page"]).collect()} == want


def test_overlap(stored):
    sets, got = stored
    want = {(p, d): (len(s), len(sets[p, d + 1]), len(s & sets[p, d + 1]))
            for (p, d), s in sets.items() if (p, d + 1) in sets}
    assert _by(C.overlap_next(got, DAY), "here", "next", "overlap") == want


def test_text_ids_and_empty_input(mk, spark):
    b = mk([(f"user-{k % 37}", "p", BASE_MS + k * 60_000) for k in range(200)] + [("", "p", BASE_MS), (None, "p", BASE_MS)])
    assert [r["uv"] for r in C.cardinality(C.window_containers(b, DAY), ["page"]).collect()] == [39]
    empty = b.where("1 = 0")
    for df in (C.window_containers(empty, DAY), C.overlap_next(C.window_containers(empty, DAY), DAY),
               S.theta_with_next(S.window_thetas(empty, DAY), DAY)):
        assert df.count() == 0


def test_theta_algebra_is_exact_on_small_sets(mk):
    days = [set(range(0, 500)), set(range(300, 900)), set(range(850, 860))]
    b = mk([(u, "p", BASE_MS + d * DAY + u) for d, s in enumerate(days) for u in s])
    got = _by(S.theta_with_next(S.window_thetas(b, DAY), DAY), "both", "only_here", "only_next", "either")
    assert got == {("p", d): (len(x & y), len(x - y), len(y - x), len(x | y))
                   for d, (x, y) in enumerate(zip(days, days[1:]))}


def test_theta_error_on_millions(spark):
    """2 million users a day, half of them in common: under 3 %."""
    n = 2_000_000
    day = lambda d, lo: spark.range(lo, lo + n).select(
        F.lit("p").alias("page"), F.lit(BASE_MS + d * DAY).alias("behavior_ms"), F.col("id").cast("string").alias("user_id"))
    r = S.theta_with_next(S.window_thetas(day(0, 0).unionAll(day(1, n // 2)), DAY), DAY).first()
    for c, want in (("both", n / 2), ("only_here", n / 2), ("only_next", n / 2), ("either", 1.5 * n)):
        assert abs(r[c] / want - 1) < 0.03
