"""Operator 11 against dense linear algebra, and the cases of its contract."""

import math

import numpy as np
import pytest

from uvlens.llm import whitening as W
from uvlens.llm.queries import QUERIES


def expected(vectors, k=4):
    x = [[math.floor(256 * float(c)) for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), object)
    n, s = len(fit), fit.sum(0)
    c = ((fit * n - s) / n).astype(float)
    e, vec = np.linalg.eigh(c.T @ c / n)
    e, vec = e[::-1], vec[:, ::-1]
    k = min(k, int((e > e[0] * 1e-12).sum()))
    dev = [int(sum((n * a - b) ** 2 for a, b in zip(r, s))) for r in x]
    white = ((np.array(x, object) * n - s) / n).astype(float) @ vec[:, :k] / np.sqrt(e[:k])
    return n, dev, white, e[:k] / e.sum()


def check(rows, ids, vectors, tol=1e-8):
    n, dev, white, share = expected(vectors)
    assert len(rows) == len(ids) * len(share)
    for j in range(len(share)):
        part = {r["vec_id"]: r for r in rows if r["component"] == j + 1}
        got = np.array([part[i]["whitened"] for i in ids])
        sign = np.sign(got @ white[:, j])
        assert np.allclose(got * sign, white[:, j], rtol=tol, atol=tol)
        assert [part[i]["deviation"] for i in ids] == dev
        assert all(part[i]["n"] == n and abs(part[i]["explained"] - share[j]) < 1e-10 * share[j] and
                   part[i]["identity_error"] < 1e-9 for i in ids)


def test_whole_table_equals_dense_algebra(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ok = [r for r in rows if r["embedding"] is not None and None not in r["embedding"] and np.isfinite(r["embedding"]).all()]
    got = QUERIES["op11_embedding_whitening"](spark, sf).collect()
    check(got, [r["vec_id"] for r in ok], [r["embedding"] for r in ok])


@pytest.mark.parametrize("d", [1, 2, 3, 7, 40])
def test_solver_finds_all_values_and_vectors(d):
    rng = np.random.default_rng(d)
    for scale in (np.ones(d), 10.0 ** -np.arange(d) if d < 9 else np.linspace(1, 2, d), 1 + 1e-9 * np.arange(d)):
        q = np.linalg.qr(rng.normal(size=(d, d)))[0]
        r = np.linalg.qr(rng.normal(size=(d, d)))[0] * scale @ q
        squares, v = W.principal(r, d)
        want = np.linalg.svd(r)[1] ** 2
        assert np.allclose(squares, want[:len(squares)], rtol=1e-12 * max(1, scale.max() / scale.min()))
        assert len(squares) == d
        assert np.abs(v.T @ v - np.eye(d)).max() < 1e-13
        back = r.T @ (r @ v) - v * squares
        assert np.abs(back).max() < 1e-13 * max(squares)


def test_small_values_keep_relative_accuracy():
    a = np.array([1.0, 1e-4, 1e-8, 1e-12])
    b = a[:-1] * 0.5
    got = W.dqds(a, b)
    # the product of the values is that of the diagonal, to full relative accuracy
    assert abs(np.prod(got) / np.prod(a * a) - 1) < 1e-13


@pytest.mark.parametrize("r", [np.eye(5), np.diag([3.0, 3, 1, 0, 0]), np.ones((4, 4)), np.zeros((3, 3)),
                               np.kron(np.eye(3), np.array([[1.0, 2], [0, 1]]))])
def test_ties_and_missing_rank(r):
    squares, v = W.principal(r, 4)
    s = np.linalg.svd(r)[1] ** 2
    rank = int((s > 1e-20).sum())
    assert len(squares) == min(4, rank) and np.allclose(squares, s[:len(squares)])
    assert np.allclose(v.T @ v, np.eye(len(squares)), atol=1e-12)
    assert np.allclose(r.T @ r @ v, v * squares, atol=1e-12)


def test_cases(spark, table_dir):
    rng = np.random.default_rng(3)
    base = [[float(np.float32(c)) for c in rng.normal(size=5) * [4, 3, 2, 1, 0.5]] for _ in range(400)]
    base[1] = base[0]
    good = [(i, v) for i, v in enumerate(base)] + [(1000, [-0.0, 0.0, 1e-9, -1e-9, 1.0]), (1001, base[7])]
    bad = [(2000, None), (2001, []), (2002, [1.0, None, 2.0, 3.0, 4.0]), (2003, [float("nan")] * 5),
           (2004, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (2005, [1.0, 2.0])]
    d = table_dir(("embeddings", [(*r, "w", 1) for r in good + bad], "vec_id bigint, embedding array<double>, x string, n int"))
    got = QUERIES["op11_embedding_whitening"](spark, d).collect()
    check(got, [i for i, _ in good], [v for _, v in good])
    # rows without an id and rows that repeat one are all returned
    twice = spark.createDataFrame(good + [(None, base[3]), (5, base[5])], "vec_id bigint, embedding array<double>")
    assert W.whiten(twice).count() == 4 * (len(good) + 2)
    for rows in ([], [(1, [1.0, 2.0])] * 3, [(1, None)]):
        assert W.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).count() == 0
    two = W.whiten(spark.createDataFrame([(1, [1.0, 2.0, 0.0]), (2, [2.0, 1.0, 0.0])],
                                         "vec_id bigint, embedding array<double>")).collect()
    assert sorted((r["vec_id"], r["component"], round(abs(r["whitened"]), 12)) for r in two) == [(1, 1, 1.0), (2, 1, 1.0)]
    huge = W.whiten(spark.createDataFrame([(1, [1e16, 2.0]), (2, [-1e16, 1.0])], "vec_id bigint, embedding array<double>"))
    assert {r["deviation"] for r in huge.collect()} == {None}


def test_factors_join_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(W, "FAN", 3)
    monkeypatch.setattr(W, "BLOCK", 16)
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.normal(size=6)]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        check(W.whiten(df).collect(), [i for i, _ in rows], [v for _, v in rows])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
