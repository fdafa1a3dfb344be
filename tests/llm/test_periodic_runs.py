"""Operator 12 against brute force, and the cases of its contract."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest

from uvlens.llm import periodic_runs as P
from uvlens.llm.queries import QUERIES


def words_of(text):
    return (text or "").encode().split()


def brute(words, least=24, times=3):
    """Every period, every maximal stretch, word by word."""
    n, spans = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                spans.setdefault((i, j - i + q), q)  # periods rise: the first is the smallest
            i = j + 1
    return sorted((s, length, q) for (s, length), q in spans.items())


def brute_row(doc_id, text):
    w = words_of(text)
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (len(runs), *top, top[1] * 1000 // top[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def row(r):
    return (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["runs_sha256"],
            r["collapsed_sha256"])


def found(texts, **kw):
    ids, flat = {}, []
    for t in texts:
        flat += [ids.setdefault(w, len(ids)) for w in t]
    return P.runs_of(np.array(flat, np.int64), np.array([len(t) for t in texts], np.int64), **kw)


def test_whole_table_equals_brute_force(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op12_periodic_runs"](spark, sf).collect()
    assert len(got) == len(docs)
    small = [r for r in got if len(words_of(docs[r["doc_id"]])) <= 1_500]
    assert len(small) > 150 and sum(r["n_runs"] > 0 for r in small) > 10
    for r in small:
        assert row(r) == brute_row(r["doc_id"], docs[r["doc_id"]])


@pytest.mark.parametrize("seed", range(6))
def test_random_runs_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(150):
        t = []
        for _ in range(rng.integers(1, 6)):
            q = int(rng.integers(1, 60))
            unit = list(rng.integers(0, rng.choice([2, 3, 9, 1000]), q))
            t += (unit * int(rng.integers(1, 6)))[:int(rng.integers(1, 5 * q + 2))]
            t += list(rng.integers(0, 5, rng.integers(0, 30)))
        texts.append(t)
    assert found(texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("q", [1, 15, 16, 17, 21, 22, 28, 29, 37, 50, 133, 400])
def test_shortest_runs_of_every_scale(q):
    rng = np.random.default_rng(q)
    unit = list(rng.permutation(10_000)[:q])
    least = max(24, 3 * q)
    for extra, want in ((0, 1), (-1, 0), (1, 1)):
        text = [-5 + 20_000] + (unit * (least // q + 2))[:least + extra] + [30_000]
        assert found([text]) == [[(1, least + extra, q)] if want else []]


def test_runs_do_not_cross_texts():
    a = ["a", "b"] * 11
    assert found([a, a, a]) == [[], [], []]
    assert found([a + ["a", "b"], [], ["x"], a]) == [[(0, 24, 2)], [], [], []]


def test_thue_morse_has_no_cube_and_long_period_powers_do():
    t = [0]
    for _ in range(12):
        t += [1 - x for x in t]
    assert found([t]) == [[]]
    assert found([t[:1000] * 3]) == [brute(t[:1000] * 3)]


def test_cases(spark, table_dir):
    rep = "la la " * 40
    nested = ("x " * 30 + "y ") * 4
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, rep), (5, rep), (4, rep), (None, rep), (None, None),
            (6, nested), (7, "w " * 100_000), (8, "a b " * 30), (9, "é\u0085ß ñ\n" * 20), (10, "a" * 500_000)]
    rows += [(i, " ".join(f"w{k}" for k in range(90))) for i in range(11, 60)]
    d = table_dir(("documents", [(*r, "clash", "x", "y") for r in rows],
                   "doc_id bigint, text string, runs string, found string, _w string"))
    got = QUERIES["op12_periodic_runs"](spark, d).collect()
    fast = [r for r in got if r["doc_id"] != 7]
    want = sorted(((i, *brute_row(i, t)) for i, t in rows if i != 7), key=str)
    assert sorted(((r["doc_id"], *row(r)) for r in fast), key=str) == want
    long = [r for r in got if r["doc_id"] == 7][0]
    assert (long["n_runs"], long["start"], long["length"], long["period"]) == (1, 0, 100_000, 1)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert P.with_runs(empty).count() == 0
    kept = P.with_runs(spark.createDataFrame([(1, rep, 2)], "a int, text string, b int"), out="r").first()
    assert kept["r"]["collapsed"] == "la" and kept["a"] == 1 and kept["b"] == 2
