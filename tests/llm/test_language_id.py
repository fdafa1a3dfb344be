"""Operator 4: held-out accuracy, calibration, and the cases of its contract."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from uvlens.llm import language_id as L
from uvlens.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op4_language_id"](spark, sf).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    test = [r for r in got if r["held_out"] and truth[r["doc_id"]]["lang"] and truth[r["doc_id"]]["text"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in test]) > 0.97
    sure = [r for r in test if not r["rejected"]]
    assert len(sure) > 0.9 * len(test)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in sure]) > 0.98


def test_held_out_rows_are_not_learned_from(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    rule = F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0
    a = L.fit(docs, learn_from=rule)
    b = L.fit(docs.withColumn("lang", F.when(crc == 0, "xx").otherwise(F.col("lang"))), learn_from=rule)
    assert a.langs == b.langs and np.array_equal(a.scores, b.scores)


def test_subwords_of_parts_equal_the_whole(monkeypatch):
    text = "Ein Wörterbuch, 12 mal größer: ab c d\n" * 50
    whole = L.subword_counts(text)
    monkeypatch.setattr(L, "_PART", 7)
    assert np.array_equal(L.subword_counts(text), whole)
    # windows of 1 to 3 code points with no blank inside
    clean = " ab c "
    want = sum(" " not in clean[i:i + n][1:-1] and not (n == 1 and clean[i] == " ")
               for n in (1, 2, 3) for i in range(len(clean) - n + 1))
    assert L.subword_counts("ab 1 c!").sum() == want


def test_cases(spark):
    rows = [(i, w * 30, lang, "s") for i, (w, lang) in enumerate(
        [("the house of ", "en"), ("das haus der ", "de"), ("la casa de ", "es")] * 20)]
    rows += [(100, None, "en", "s"), (101, "123 !?", "en", ""), (102, "", "de", None), (None, "the of", "en", None),
             (103, "x" * 2_000_000, None, None), (0, rows[0][1], "en", "s")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    got = L.predict(df, L.fit(df)).collect()
    assert len(got) == len(rows)
    for r in got:
        p = r["language"]
        if r["text"] in (None, "", "123 !?"):
            assert (p["lang_pred"], p["score"], p["rejected"]) == ("und", 0.0, True)
        else:
            assert p["lang_pred"] in ("de", "en", "es") and 0 <= p["score"] <= 1
            assert p["lang_pred"] == r["lang"] or r["lang"] is None
    empty = df.where("1 = 0")
    assert L.predict(empty, L.fit(empty)).collect() == []
    assert {r["language"]["lang_pred"] for r in L.predict(df, L.fit(empty)).collect()} == {"und"}


def test_sample_holds_whatever_repeats(spark, monkeypatch):
    """An id with a third of the rows, as equal rows or as many texts."""
    sizes, train = [], L.train

    def counted(x, y, *rest):
        sizes.append(len(y))
        return train(x, y, *rest)

    monkeypatch.setattr(L, "train", counted)
    for hot in ("same text", "text {}"):
        rows = [(i, f"words of row {i}", "en") for i in range(1_000)]
        rows += [(k, hot.format(j), "en") for j in range(500) for k in (0, 1, 2)]
        L.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), sample_rows=200)
    assert all(130 < n < 270 for n in sizes) and len(sizes) == 2
    L.fit(spark.createDataFrame(rows[:3] * 5, "doc_id bigint, text string, lang string"))
    assert sizes[2] == 3


def test_sample_has_six_thousand_rows(spark, monkeypatch):
    sizes = []

    def counted(x, y, use, langs):
        sizes.append(len(y))
        return np.zeros((L.BUCKETS, len(langs))), np.zeros(len(langs))

    monkeypatch.setattr(L, "train", counted)
    rows = [(i, f"row {i}", "en") for i in range(6_000)]
    L.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert sizes == [6_000]


def test_every_language_brings_its_rows_at_any_size(spark):
    """The share of a language of 10^12 rows is not rounded to nothing."""
    from uvlens.llm.common import hash_bound

    n = [10.0, 6e3, 2.5e8, 1.6e9, 1e12]
    got = spark.createDataFrame([(x,) for x in n], "n double").select("n", hash_bound(F.lit(1500.0) / F.col("n")).alias("b"))
    for r in got.collect():
        assert abs((r["b"] + 1) / 2**63 * r["n"] - min(1500, r["n"])) < 1e-3 * min(1500, r["n"])


def test_more_languages_than_were_once_allowed(spark):
    rows = [(300 * k + i, f"{chr(0x4e00 + 3 * k)}{chr(0x4e00 + 3 * k + 1)} " * (i + 1), f"l{k:03d}")
            for k in range(300) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert len(L.fit(docs, sample_rows=2_400).langs) == 300
    assert len(L.fit(docs, sample_rows=2_400, max_langs=7).langs) == 7


def test_predictions_by_plain_loops(spark, sf):
    """Subwords one by one, their mean embedding scores, softmax and temperature."""
    import math
    import unicodedata

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = L.fit(docs)
    mask = 2**32 - 1

    def bucket(window):
        h = len(window) * 40503
        for k, c in enumerate(window):
            h = (h ^ ord(c)) * int(L._MIX[k]) & mask
            h ^= h >> 15
        return (h * int(L._MIX[0]) & mask) >> (32 - (L.BUCKETS.bit_length() - 1))

    for r in L.predict(docs.orderBy("doc_id").limit(12), model).collect():
        letters = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (r["text"] or "").lower())
        clean, z, n = " " + " ".join(letters.split()) + " ", [0.0] * len(model.langs), 0
        for i in range(len(clean)):
            for w in (clean[i:i + k] for k in (1, 2, 3) if i + k <= len(clean)):
                if w == " " or (len(w) == 3 and w[1] == " "):
                    continue
                n += 1
                for j in range(len(z)):
                    z[j] += model.scores[bucket(w)][j]
        e = [math.exp((x / n + b) / model.temperature) for x, b in zip(z, model.bias)]
        assert r["language"]["lang_pred"] == model.langs[e.index(max(e))]
        assert abs(r["language"]["score"] - max(e) / sum(e)) < 1e-6


def test_counts_of_all_rows(spark):
    rows = [(i, t, x) for i, (t, x) in enumerate([("der Hund läuft", "de"), ("the dog runs", "en"), ("die Katze", "de"),
                                                  ("the cat", "en"), (None, "de"), ("no language", None), ("123", "en")])]
    rows += [(None, "no id", "en"), (50, "le chien", "fr")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    model = L.fit_counts(docs, learn_from=F.col("id") != 50)
    assert model.langs == ("de", "en")
    n = np.stack([sum(L.subword_counts(t) for i, t, x in rows if x == y and i is not None and t and t != "123")
                  for y in ("de", "en")], 1) + 0.5
    assert np.allclose(model.scores, np.log(n / n.sum(0)))
    c = L.subword_counts("the dog")
    assert model.probabilities(c / c.sum()).argmax() == 1
    assert L.fit_counts(docs.where("1 = 0")).langs == ()
