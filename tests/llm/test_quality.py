"""Operators 3 and 9: statistics by brute force, planted junk, held-out accuracy."""

import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from uvlens.llm import rule_ensemble as R
from uvlens.llm import textstats, weak_rules
from uvlens.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_chars": len(text),
            "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": dups, "n_repeat_words": len(covered),
            "n_lines": len([x for x in text.split("\n") if WORD.search(x)]), "n_distinct_words": len(set(words))}


TEXTS = [None, "", " \n\t ", "one", "a b c a b c", "a b c d a b c", "x x x x", "x x", "l\nl\n\n \nl\nL", "ö ü\x85ß\xa0d e\x0bf",
         "#*$ %&| <>", "ÄÖ A", "word " * 200_000, "a" * 300_000, "🙂 \x1c\x1f z", "l \nl\n"]


def test_statistics_by_brute_force(spark, sf):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "one", None), (3, "one", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.lit("x").alias("n_words"))
    got = textstats.with_stats(df.unionByName(docs), "text", "s").collect()
    assert len(got) == len(rows) + docs.count()
    for r in got:
        for k, v in brute(r["text"]).items():
            assert r["s"][k] == v, (r["text"][:80] if r["text"] else r["text"], k)


def test_statistics_take_little_memory_beside_the_batch(monkeypatch):
    texts = pa.array([f"Line {i} of text, #{i % 7}!\nand an\xe4ther line. " * 60 for i in range(4_000)])
    tracemalloc.start()
    try:
        got = textstats.batch_stats(texts)
        assert tracemalloc.get_traced_memory()[1] < 8 << 20  # of 11 MB of text
    finally:
        tracemalloc.stop()
    for size in (1, 1 << 30):  # slices change no result: text by text, all at once
        monkeypatch.setattr(textstats, "SLICE_BYTES", size)
        again = textstats.batch_stats(texts)
        assert all((again[f] == got[f]).all() for f in textstats.FIELDS)


def test_many_distinct_words_take_the_ranked_path(monkeypatch):
    words = [b"%d" % (i % 700_000) for i in range(2_100_000)]
    n, v = textstats.repeat_words(words)
    assert (n, v) == (2_100_000, 700_000)
    assert textstats.repeat_words([b"%d" % i for i in range(2_100_000)] + [b"0", b"1", b"2"]) == (6, 2_100_000)


def test_op3_counts_and_base_rules(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op3_quality_rules"](spark, sf).collect():
        b = brute(docs[r["doc_id"]])
        assert all(r[k] == b[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        failed = b["n_words"] < 50 or 100 * b["n_repeat_words"] > 50 * b["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_op3_finds_junk_and_keeps_clean(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = weak_rules.judge(docs).join(labels, "doc_id").where(~F.col("rule_base_failed"))
    got = {(r["quality"], r["rule_kept"]): r["count"] for r in got.groupBy("quality", "rule_kept").count().collect()}
    assert got.get((1, False), 0) <= 0.002 * got[(1, True)]
    assert got.get((0, True), 0) <= 0.02 * got[(0, False)]


def test_op3_em_recovers_rule_accuracies():
    """Votes drawn from a known model: EM finds its rates without labels."""
    rng = np.random.default_rng(3)
    n = 60_000
    kind = rng.choice(4, n, p=[0.85, 0.08, 0.04, 0.03])  # good, then junk of rule 0, 1, 2
    rate = np.array([[0.01, 0.004, 0.02], [0.95, 0.05, 0.02], [0.03, 0.9, 0.3], [0.01, 0.2, 0.85]])
    votes = np.where(rng.random((n, 3)) < rate[kind], -1, 1)
    votes[rng.random((n, 3)) < 0.1] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    m = weak_rules.fit_label_model(patterns, counts.astype(float))
    assert abs(m.share[0] - 0.85) < 0.03
    assert np.abs(np.array(m.bad[0]) - rate[0]).max() < 0.02
    assert all(abs(m.bad[k + 1][k] - rate[k + 1, k]) < 0.1 for k in range(3))


def test_op3_posterior_equals_bayes(spark):
    m = weak_rules.fit_label_model(np.array([[1, 1, -1], [-1, 0, 1], [1, 1, 1]]), np.array([5.0, 9.0, 80.0]))
    votes = [[a, b, c] for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)]
    df = spark.createDataFrame([(v,) for v in votes], "v array<int>").withColumn("p", m.posterior(F.col("v")))
    for r in df.collect():
        p = np.array(m.share)
        for j, v in enumerate(r["v"]):
            t = np.array(m.bad)[:, j]
            p = p * (t if v == -1 else 1 - t if v == 1 else 1)
        assert r["p"] == pytest.approx(p[0] / p.sum())


def test_op3_written_votes_give_the_same_verdict(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    weak_rules.vote(docs).drop("text").write.parquet(str(tmp_path / "votes"))
    got = weak_rules.decide(spark.read.parquet(str(tmp_path / "votes")))
    assert got.exceptAll(weak_rules.judge(docs).drop("text")).isEmpty()


def test_op3_cases(spark):
    schema = "doc_id bigint, text string, rule_stats string, rule_kept string"
    df = spark.createDataFrame([(None, None, "a", "b"), (1, "", None, None), (1, "w " * 100, "", ""), (1, "w " * 100, "", "")],
                               schema)
    got = weak_rules.judge(df).collect()
    assert len(got) == 4 and not any(r["_rule_kept"] for r in got)
    assert {r["rule_stats"] for r in got} == {"a", None, ""}
    assert weak_rules.judge(df.where("1 = 0")).collect() == []


def held(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


def test_op9_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op9_quality_classifier"](spark, sf).collect()
    assert all(r["held_out"] == (held(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1
               and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    test = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    right = {y: np.mean([r["predicted"] == y for r in test if labels[r["doc_id"]] == y]) for y in (0, 1)}
    assert min(right.values()) > 0.95, right


def test_op9_learns_from_its_rows_only(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rule = F.crc32(F.col("id").cast("string").cast("binary")) % 3 != 1
    spoiled = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                                                  1 - F.col("quality")).otherwise(F.col("quality")))
    assert R.fit(docs, labels, learn_from=rule) == R.fit(docs, spoiled, learn_from=rule)


def test_op9_compiled_rules_equal_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.random((3000, len(R.RATIOS)))
    y = ((x[:, 1] > 0.6) & (x[:, 2] < 0.5) | (x[:, 6] > 0.9)).astype(float)
    model = R.fit_rules(x, y)
    assert ((model.score_numpy(x) >= 0.5) == y).mean() > 0.98
    df = spark.createDataFrame([tuple(map(float, r)) for r in x[:300]], list(R.RATIOS))
    got = [r["s"] for r in df.select(model.score([F.col(c) for c in R.RATIOS]).alias("s")).collect()]
    assert got == pytest.approx(model.score_numpy(x[:300]))
    assert 0 < len(model.rules) < 120 and all(1 <= len(r) <= R.DEPTH for r in model.rules)


def test_op9_cases(spark):
    docs = spark.createDataFrame([(1, None, "a"), (None, "", "b"), (2, "words here", None), (2, "words here", "c")],
                                 "doc_id bigint, text string, _stats string")
    none = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 1)], "doc_id bigint, quality int")
    got = R.score(docs, R.fit(docs, none)).collect()
    assert [r["score"] for r in got] == [0.5] * 4 and {r["_stats"] for r in got} == {"a", "b", None, "c"}
    one = spark.createDataFrame([(1, 1), (2, 1), (2, 1)], "doc_id bigint, quality int")
    assert all(r["score"] > 0.5 for r in R.score(docs, R.fit(docs, one)).collect())
    assert R.score(docs.where("1 = 0"), R.fit(docs.where("1 = 0"), one)).collect() == []


def test_op9_sample_holds_whatever_repeats(spark, monkeypatch):
    """A labelled id with a third of the rows, as equal rows or as many texts."""
    sizes = []
    monkeypatch.setattr(R, "fit_rules", lambda x, y: sizes.append(len(y)))
    labels = spark.createDataFrame([(i, i % 2) for i in range(1_000)], "doc_id bigint, quality int")
    for hot in ("same text", "text {}"):
        rows = [(i, f"words of row {i}") for i in range(1_000)] + [(k, hot.format(j)) for j in range(500) for k in (0, 1, 2)]
        R.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), labels, sample_rows=200)
    assert all(130 < n < 270 for n in sizes) and len(sizes) == 2
    R.fit(spark.createDataFrame(rows[:3] * 5, "doc_id bigint, text string"), labels)
    assert sizes[2] == 3
