"""Operator 13: held-out quality, the network against plain loops, and the cases of its contract."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from uvlens.llm import toxicity as T
from uvlens.llm.common import crc_mod, hash_below
from uvlens.llm.queries import QUERIES


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op13_toxicity"](spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
               and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    test = [r for r in got if r["held_out"] and r["doc_id"] in toxic]
    bad = np.array([r["score"] for r in test if toxic[r["doc_id"]]])
    good = np.array([r["score"] for r in test if not toxic[r["doc_id"]]])
    assert np.mean(good < 0.5) > 0.98 and np.mean(bad >= 0.5) > 0.7
    assert (bad[:, None] > good).mean() + (bad[:, None] == good).mean() / 2 > 0.93


def test_held_out_labels_are_not_learned_from(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    other = labels.withColumn("toxic", F.when(crc_mod("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (T.fit(docs, x, learn_from=crc_mod("id", 5) != 0) for x in (labels, other))
    assert np.array_equal(a.net.table, b.net.table) and a.threshold == b.threshold and a.prior == b.prior
    # neither language, source nor id is read when scoring
    blind = docs.select(F.lit(None).cast("string").alias("lang"), F.lit(0).alias("doc_id"), "text")
    key = F.md5("text")
    x = dict(T.score(docs, a).select(key, "score").collect())
    assert x == dict(T.score(blind, a).select(key, "score").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_network_equals_plain_loops(seed):
    rng = np.random.default_rng(seed)
    net = T.Net.start(seed)
    net.table = rng.normal(size=net.table.shape).astype(np.float32)
    texts = [rng.integers(-2**62, 2**62, n) for n in (0, 1, 2, 3, 40, 0, 7)]
    got = net.read(texts)
    for t, z in zip(texts, got):
        v = np.zeros((len(t) + 2, T.DIM))
        for i, h in enumerate(t):
            u = int(h) % 2**64
            v[i] = net.table[u % T.BUCKETS].astype(float) + net.table[(u >> 40) % T.BUCKETS]
        want = float(net.bias[0])
        for i, (w, f) in enumerate(zip(T.WIDTHS, net.filters)):
            for k in range(T.FILTERS):
                responses = [sum(float(v[p + j] @ f[j][:, k]) for j in range(w)) for p in range(len(t))]
                if responses:
                    c = i * T.FILTERS + k
                    want += max(0.0, max(responses) + float(net.offset[c])) * float(net.out[c])
        assert abs(want - z) < 1e-3 * max(1, abs(want))


def test_thresholds():
    z, y = np.array([3.0, 2.0, 1.0, 0.0, -1.0]), np.array([1.0, 1.0, 0.0, 0.0, 0.0])
    assert T.best_threshold(z, y, 0.4) == 1.5
    assert T.best_threshold(np.zeros(4), np.array([1.0, 0, 1, 0]), 0.5) == -1.0  # ties: all or none
    rng = np.random.default_rng(0)
    y = (rng.random(400) < 0.5).astype(float)
    langs = np.array(["a", "b"] * 200)
    z = 4 * y + rng.normal(0, 0.3, 400) + np.where(langs == "b", 10, 0)
    model = T._calibrate(T.ToxicityModel(0.5), z, y, langs)
    assert {x for x, _ in model.by_language} == {"a", "b"}
    assert np.mean((model.scores(z, list(langs)) >= 0.5) == (y > 0)) > 0.99


def test_cases(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(400):
        t = list(rng.choice(words, 30))
        if i % 4 == 0:
            t[int(rng.integers(30))] = "Awful!"
        rows.append((i, " ".join(t), "xx", "s"))
    rows += [(900, None, None, ""), (901, "", "xx", ""), (902, " .,!? ", "xx", ""), (None, "awful w1", None, ""),
             (903, "w1 " * 400_000 + "AWFUL", None, None), (0, rows[0][1], "xx", "s"), (904, "ﬀ ÄÖ awful", "xx", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0), "x") for i in range(400)] +
                                   [(5, 1, "x"), (6, None, "x"), (None, 1, "x"), (7777, 1, "x")],
                                   "doc_id bigint, toxic int, text string")
    model = T.fit(docs, labels)
    got = T.score(docs, model, out="p").collect()
    assert len(got) == len(rows) and "score" in got[0].asDict()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["p"])
    assert all(len(x) == 1 for x in by.values())  # repeated rows alike
    assert by[900] == by[901] == by[902]
    assert all(min(by[i]) >= 0.5 for i in (0, 4, 903, 904, None)) and all(max(by[i]) < 0.5 for i in (1, 2, 3, 900))
    # nothing to learn from: the share of label 1
    only = spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, toxic int")
    assert {r["score"] for r in T.score(docs.drop("score"), T.fit(docs, only)).collect()} == {0.75}
    assert T.fit(docs, only.where("1 = 0")).prior == 0.5
    empty = docs.where("1 = 0")
    assert T.score(empty, model).count() == 0 and T.fit(empty, labels).net is None


def test_shares_of_hashes(spark):
    n = 200_000
    ids = spark.range(n)
    for share in (1.0, 2.0, 0.3, 0.001):
        got = ids.where(hash_below(share, "id")).count()
        assert abs(got - n * min(share, 1)) <= 5 * (n * share) ** 0.5 * (share < 1)
    # a language of 10^12 rows still gets its threshold
    assert int(1500 / 1e12 * 2.0**63) > 10**9


def test_all_rows_are_learned_from(spark, monkeypatch):
    monkeypatch.setattr(T, "FIRST_EPOCHS", 3, raising=False)
    n = 20_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("lang"), F.concat_ws(
        " ", F.when(F.col("id") % 7 == 0, "vile"), F.concat(F.lit("w"), F.col("id") % 50)).alias("text"))
    model = T.fit(docs, docs.select("doc_id", (F.col("doc_id") % 7 == 0).cast("int").alias("toxic")))
    assert model.prior == ((n + 6) // 7 + 1) / (n + 2)  # counted, not estimated
    got = T.score(docs.limit(500), model).select("doc_id", "score").collect()
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 7 == 0) for r in got)


def test_long_rows_are_learned_from(spark, monkeypatch):
    monkeypatch.setattr(T, "FIRST_EPOCHS", 1, raising=False)
    bad = "vile " + "w1 " * 20_001
    docs = spark.createDataFrame([(i, bad + str(i) if i % 2 else f"w1 w2 {i}", "xx") for i in range(40)],
                                 "doc_id bigint, text string, lang string")
    model = T.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")))
    assert model.net is not None and model.prior == 0.5


def test_rounds_over_all_rows(spark, monkeypatch):
    """What only the other tasks' rows hold is learned as well, and alike in any run."""
    docs = spark.range(0, 3_000, 1, 3).select(F.col("id").alias("doc_id"), F.lit("xx").alias("lang"), F.concat_ws(
        " ", F.when(F.col("id") % 5 == 0, F.concat(F.lit("vile"), F.col("id") % 3)),
        F.concat(F.lit("w"), F.col("id") % 50)).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    whole = T.fit(docs, labels)
    monkeypatch.setattr(T, "FIRST_ROWS", 300)
    a, b = T.fit(docs, labels), T.fit(docs, labels)
    assert np.array_equal(a.net.table, b.net.table) and not np.array_equal(a.net.table, whole.net.table)
    got = T.score(docs, a).select("doc_id", "score").collect()
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 5 == 0) for r in got]) > 0.99


def test_moves_are_put_together():
    start = T.Training.start()
    a, b = start.copy(), start.copy()
    a.net.out[0] += 1
    a.past[-2][0] += 3
    b.net.out[0] -= 1
    b.past[-2][0] += 1
    b.net.out[1] += 2
    b.past[-2][1] += 1
    got = start.moved(a.change(start) + b.change(start))
    assert np.allclose(got.net.out[:3] - start.net.out[:3], [0.5, 2, 0])
    assert np.allclose(got.past[-2][:3] - start.past[-2][:3], [2, 0.5, 0])


def test_counts_at_one_logit():
    z, y = np.array([2.0, 2, 2, 1, 1, 0, 0, 0]), np.array([1.0, 1, 0, 1, 0, 0, 0, 1])
    u = np.unique(z)
    cells = np.array([y[z == x].sum() for x in u]), np.array([(z == x).sum() for x in u])
    assert T.best_threshold(u, cells[0], 0.3, cells[1]) == T.best_threshold(z, y, 0.3)
    rng = np.random.default_rng(1)
    z = np.round(rng.normal(size=500), 1)
    y = (rng.random(500) < 1 / (1 + np.exp(-3 * z))).astype(float)
    u = np.unique(z)
    y_at, n_at = np.array([y[z == x].sum() for x in u]), np.array([(z == x).sum() for x in u])
    one = T._calibrate(T.ToxicityModel(0.4), z, y, np.full(500, "a"))
    two = T._calibrate(T.ToxicityModel(0.4), u, y_at, np.full(len(u), "a"), n_at)
    assert one == two
