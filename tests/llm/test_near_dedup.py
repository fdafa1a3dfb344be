"""Operator 5 against brute force over all pairs."""

import math
import random
import re

import numpy as np
import pytest

from uvlens.llm import near_dedup as N
from uvlens.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k=5):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, threshold):
    """{id: component} of (id, text) rows by comparing all pairs."""
    num = round(100 * threshold)
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= num * len(x | y):
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return {i: root(i) for i in parent}


def check(spark, rows, threshold, schema="doc_id bigint, text string"):
    df = spark.createDataFrame(rows, schema)
    got = N.components(df, threshold).collect()
    assert len(got) == len(rows)
    want = brute([(r[0], r[1]) for r in rows], threshold)
    assert {(r["id"], r["component_id"]) for r in got} == {(r[0], want.get(r[0])) for r in rows}
    assert sorted(r["n_shingles"] for r in got) == sorted(len(shingle_set(r[1])) for r in rows)


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        at = rng.randrange(len(w))
        w[at:at + 1] = rng.choice([[], [f"new{rng.random()}"], [w[at], "more"]])
    return " ".join(w)


@pytest.mark.parametrize("threshold", [0.85, 0.8])
def test_groups_of_near_copies(spark, threshold):
    """A large group of near copies with few to many edits, small groups, texts
    that share a passage, and short texts around the threshold."""
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(300)]
    make = lambda n: [rng.choice(vocab) for _ in range(n)]
    base, passage, texts = make(110), make(60), []
    texts += [edited(rng, base, rng.randrange(1, 8)) for _ in range(160)] + [" ".join(base)] * 5
    for _ in range(25):
        own = make(rng.randrange(30, 300))
        texts += [edited(rng, own, k) for k in range(rng.randrange(1, 5))]
    texts += [" ".join(make(rng.randrange(5, 150)) + passage + make(20)) for _ in range(60)]
    short = make(11)
    texts += [" ".join(short[:k]) for k in range(1, 12)] + [" ".join(short[k:]) for k in range(8)]
    texts += ["", "  \n", None, "Short Text", "short text", "SHORT  text ", "ß ä", "SS Ä"]
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)), threshold)


def test_cases(spark):
    t = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(5, t, "a"), (5, "other words entirely in this text of eight", "b"), (3, t, None), (None, t, "c"), (None, None, ""),
            (9, "other words entirely in this text of eight", "a"), (9, "other words entirely in this text of eight", "a"),
            (7, "", "x"), (8, None, "y"), (11, "long " * 150_000, ""), (12, "long " * 150_001, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, id string")
    got = {(r["id"], r["component_id"]) for r in N.components(df, 0.85).collect()}
    assert got == {(5, 3), (3, 3), (None, None), (9, 3), (7, 7), (8, 8), (11, 11), (12, 11)}
    kept = [r["doc_id"] for r in N.keep_one(df, 0.85).collect()]
    assert sorted(k for k in kept if k is not None) == [3, 7, 8, 11] and kept.count(None) == 1  # of the two without an id one equals 3
    empty = df.where("1 = 0")
    assert N.components(empty).collect() == [] and N.keep_one(empty).collect() == []


def test_one_row_of_each_group_stays(spark):
    """Rows that repeat an id, rows without an id, and both at once."""
    a, b = "some words that make a text of more than five", "quite another text with other words in it"
    rows = [(1, a, k) for k in range(5)] + [(None, a, k) for k in range(5)]
    rows += [(None, b, 0), (None, b.upper(), 1), (None, "  " + b.replace(" ", "\n"), 2), (None, "", 0), (None, "", 1),
             (2, "", 0), (2, "", 1), (None, None, 0), (4, a[::-1], 0), (4, b[::-1], 0), (4, a[::-1] + " ", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, node_key int")
    got = N.keep_one(df, 0.8)
    assert got.columns == df.columns
    kept = [(r["doc_id"], (r["text"] or "").lower().split()) for r in got.collect()]
    want = [(1, a.split()), (None, b.split()), (None, []), (None, []), (None, []), (2, []), (4, a[::-1].split()),
            (4, b[::-1].split())]
    assert sorted(kept, key=str) == sorted(want, key=str)


def test_pairs_around_a_common_passage_are_not_enumerated(spark, monkeypatch):
    """76 words, 60 of them shared, the rest from a small pool: the rows of the last join
    grow with the texts, not with their pairs, and no link is lost."""
    seen = []
    monkeypatch.setattr(N, "_rare_pairs", lambda *a, f=N._rare_pairs: (seen.append((r := f(*a)).count()), r)[1])
    for n in (300, 600):
        rng = random.Random(n)
        shared, pool = [f"s{i}" for i in range(60)], [f"p{i}" for i in range(400)]
        texts = [" ".join(shared + [rng.choice(pool) for _ in range(16)]) for _ in range(n)]
        texts += [edited(rng, t.split(), 1) for t in texts[:20]]
        check(spark, list(enumerate(texts)), 0.8)
    assert seen[1] <= 3 * seen[0] + 200


def test_ids_with_several_texts(spark):
    """Shingles of one text of an id say nothing of its other texts."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(200)}" for _ in range(120)]
    far = [" ".join(f"v{rng.random()}" for _ in range(90)) for _ in range(3)]
    near = [" ".join([*base[:k], "changed", *base[k + 1:]]) for k in (20, 60, 100)]
    rows = [(1, " ".join(base)), (2, near[0]), (2, far[0]), (3, far[1]), (3, near[1]), (4, near[2]), (5, far[2]), (5, far[1])]
    got = {(r["id"], r["component_id"]) for r in N.components(spark.createDataFrame(rows, "doc_id bigint, text string"),
                                                             0.85).collect()}
    assert got == {(i, 1) for i in (1, 2, 3, 4, 5)}


def test_registers_by_definition():
    rng = np.random.default_rng(1)
    h = np.unique(rng.integers(0, 2**64, 3000, dtype=np.uint64))
    regs = N.registers(h)
    for b in range(N.REGISTERS):
        own = [int(x) >> 9 for x in h if int(x) % N.REGISTERS == b]
        if not own:
            assert regs[b] == N._EMPTY
            continue
        bits = f"{min(own):055b}"
        zeros = len(bits) - len(bits.lstrip("0"))
        assert regs[b] >> N.MANTISSA == zeros
        assert regs[b] % 2**N.MANTISSA == int((bits[zeros + 1:] + "0" * N.MANTISSA)[:N.MANTISSA], 2)


def test_estimate_is_corrected_for_collisions():
    rng = np.random.default_rng(2)
    for share in (0.0, 0.5, 0.85):
        a = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
        b = a.copy()
        new = int(len(a) * (1 - share) / (1 + share))
        b[:new] = rng.integers(0, 2**64, new, dtype=np.uint64)
        n = np.array([len(a)])
        j, m = N.estimate(N.registers(np.unique(a))[None], N.registers(np.unique(b))[None], n, n)
        assert m[0] == N.REGISTERS and abs(j[0] - share) < 5 * np.sqrt(max(share * (1 - share), 0.004) / N.REGISTERS)


def test_densified_registers_do_not_depend_on_the_path():
    for n in (1, 5, 40, 60, 200):
        regs = np.full(N.REGISTERS, N._EMPTY, np.uint16)
        on = np.random.default_rng(n).choice(N.REGISTERS, n, replace=False)
        regs[on] = np.arange(n)
        want = [next(regs[k] for k in N._ORDER[j] if regs[k] != N._EMPTY) if regs[j] == N._EMPTY else regs[j]
                for j in range(N.REGISTERS)]
        assert N.densified(regs).tolist() == want


def test_bands_miss_rarely():
    for t in (0.8, 0.85, 0.9):
        r = N.rows_per_band(t)
        assert (1 - t**r) ** (N.REGISTERS // r) <= 1e-7


def sketch_miss(threshold, union):
    """Probability that a pair at the threshold with so many shingles differs in more bits
    than the sketch allows. m registers are full, d of them differ, the others borrow."""
    def log_choose(n, k):
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    def binomial(n, p):
        return np.array([math.exp(log_choose(n, k) + k * math.log(p) + (n - k) * math.log1p(-p)) for k in range(n + 1)])

    full = np.zeros(N.REGISTERS + 1)
    full[0] = 1
    k = np.arange(N.REGISTERS + 1)
    for _ in range(union):
        full = full * k / N.REGISTERS + np.concatenate([[0], (full * (N.REGISTERS - k) / N.REGISTERS)[:-1]])
    apart, out = int((1 - threshold) * union + 1e-9), 0.0
    for m in np.flatnonzero(full > 1e-13):
        for d in range(max(1, m - union + apart), min(apart, m) + 1):
            p = full[m] * math.exp(log_choose(apart, d) + log_choose(union - apart, m - d) - log_choose(union, m))
            if p > 1e-13:
                bits = np.convolve(binomial(d, 0.5), binomial(N.REGISTERS - m, d / (2 * m)))
                out += p * bits[N.sketch_limit(threshold) + 1:].sum()
    return out


@pytest.mark.parametrize("threshold", [0.85, 0.8])
def test_sketch_misses_rarely(threshold):
    assert all(sketch_miss(threshold, n) < 1e-8 for n in (20, 40, 60, 100, 200))


def test_small_sets_are_not_dropped_by_the_sketch(spark):
    """Five shingles in three buckets: 101 of 512 bits differ at Jaccard 0.8."""
    words = [f"t527137x{i}" for i in range(9)]
    check(spark, [(1, " ".join(words)), (2, " ".join(words[:8]))], 0.8)


def test_connected_by_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)]
    edges += [(i, i + 1) for i in range(1000, 1100)] + [(5000, i) for i in range(2000, 2300)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = sorted((root(a), root(b)))
        parent[q] = p
    got = {r["id"]: r["comp"] for r in N.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}


def test_query_over_the_table(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(docs, 0.85)
    got = QUERIES["op5_near_dedup"](spark, sf).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
