"""N-best segmentation against the enumeration of all paths, and round trips."""

import heapq
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from uvlens.llm import sentencepieces as S

TEXTS = ["", " ", "  ", "a", "Hello world", " two  blanks   here ", "line\nbreak\n\n", "▁literal ▁ mark", "日本語 ö 🙂 \x00\x01",
         "﻿x\r\n\ty", "the the the", "aaaaaaaaaa", "é ▁▁"]


@pytest.fixture(scope="module")
def seg():
    return S.Segmenter(S.load_vocabulary())


def all_paths(seg, text):
    """(score, ids) of every path through the whole text's lattice."""
    s = " " + text
    v = seg.v
    paths = {0: [(0, ())]}
    for i in range(len(s)):
        for j in range(i + 1, min(len(s), i + seg.longest) + 1):
            hit = seg.known.get(s[i:j])
            if hit:
                paths.setdefault(j, []).extend((a + hit[1], (*b, hit[0])) for a, b in paths.get(i, []))
        if s[i] not in seg.known:
            ids = tuple(v.byte_ids[b] for b in s[i].encode())
            paths.setdefault(i + 1, []).extend((a + v.unknown, (*b, *ids)) for a, b in paths.get(i, []))
    return paths[len(s)]


@pytest.mark.parametrize("text", [t for t in TEXTS if 0 < len(t) < 14] + ["on the in", "thein er\na", "of  it"])
def test_nbest_equals_all_paths(seg, text):
    paths = all_paths(seg, text)
    for n in (1, 2, 3, 7):
        want = heapq.nlargest(n, [p[0] for p in paths])
        got = seg.encode(text, n)
        assert [s for s, _ in got] == want
        assert len({tuple(i) for _, i in got}) == len(got)
        scores = dict((ids, s) for s, ids in paths)
        assert all(scores[tuple(i.tolist())] == s for s, i in got)
        ids, sizes, sums = seg.encode_many([text, "", text], n)
        one = got[0][1].tolist()
        assert sums == [want, [0], want] and ids.tolist() == one * 2 and sizes.tolist() == [len(one), 0, len(one)]


@pytest.mark.parametrize("text", TEXTS)
def test_round_trip(seg, text):
    for _, ids in seg.encode(text, 4):
        assert seg.decode(ids.tolist()) == text


def test_decoding_agrees_with_the_library(seg):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=S.default_model())
    for text in TEXTS:
        if text:
            assert sp.decode(seg.encode(text)[0][1].tolist()).replace("▁", " ") == text.replace("▁", " ")


def test_random_words(seg):
    rng = random.Random(3)
    for _ in range(150):
        text = "".join(rng.choice(["th", "e", "in", " ", "er", "\n", "ö", "1", "zq"]) for _ in range(rng.randrange(1, 7)))
        want = heapq.nlargest(3, [p[0] for p in all_paths(seg, text)])
        assert [s for s, _ in seg.encode(text, 3)] == want


def test_many_texts_equal_one_by_one(spark, seg, sf):
    texts = TEXTS + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + ["x" * 100, "ab " * 999]
    ids, sizes, sums = seg.encode_many(texts, 3)
    at = 0
    for text, size, s in zip(texts, sizes, sums):
        one = seg.encode(text, 3)
        assert [x for x, _ in one] == s
        assert ids[at:at + size].tolist() == one[0][1].tolist()
        at += size
    assert seg.decode_many(ids, np.cumsum(sizes)).to_pylist() == texts


def test_long_words_stay_cheap(seg):
    text = "a" * 100_000 + " " + "7" * 50_000 + " " * 20_000
    got = seg.encode(text, 3)
    assert len(got) == 3 and got[0][0] >= got[1][0] >= got[2][0]
    assert all(seg.decode(i.tolist()) == text for _, i in got)


def test_columns_and_cases(spark):
    rows = [(1, "Hello world", "a"), (2, None, "b"), (3, "", "c"), (1, "Hello world", "a"), (None, "ö▁\n", "d")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = S.decode(S.encode(df, out="p").withColumn("q", F.col("p.ids")), "q").collect()
    assert len(got) == 5
    for r in got:
        assert r["decoded"] == r["text"]
        assert (r["p"]["ids"] is None) == (r["text"] is None)
        if r["text"]:
            assert r["p"]["nbest_scores"] == sorted(r["p"]["nbest_scores"], reverse=True) != []
    many = {(r["doc_id"], r["text"]): r["segmentations"] for r in S.encode_nbest(df).collect()}
    assert [x["score"] for x in many[(1, "Hello world")]] == got[0]["p"]["nbest_scores"]
    assert S.encode(df.where("1 = 0")).collect() == []


def test_query_over_the_table(spark, seg):
    from uvlens.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op2_sentencepiece"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["round_trip"] and r["n_pieces"] == len(r["ids"])
        assert seg.decode(r["ids"]) == docs[r["doc_id"]]


def test_all_segmentations_of_many_texts(seg):
    rng = random.Random(4)
    bits = ["th", "e", "in", " ", "er", "\n", "ö", "1", "zq", "🙂"]
    texts = TEXTS + ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    for part in (texts, texts[::-1]):  # the second time from the store
        ids, sizes, scores, others = seg.segment_many(part, 3)
        best = np.split(ids, np.cumsum(sizes)[:-1])
        for text, own, sums, more in zip(part, best, scores, others):
            want = seg.encode(text, 3)
            assert [s for s, _ in want] == sums
            assert [i.tolist() for _, i in want] == [x.tolist() for x in (own, *more)]


def test_store_is_begun_anew(seg, monkeypatch):
    monkeypatch.setattr(S, "STORE_UNITS", 3)
    for text in ("one two three four five", "six", "one two"):
        ids, _, scores, others = seg.segment_many([text], 3)
        want = seg.encode(text, 3)
        assert scores == [[s for s, _ in want]] and others[0][1].tolist() == want[2][1].tolist()
        assert ids.tolist() == want[0][1].tolist()


def test_query_gives_every_segmentation(spark, seg, table_dir):
    from uvlens.llm.queries import QUERIES

    rows = [(1, "the other inner thing"), (1, "the other inner thing"), (2, None), (3, ""), (None, "ö▁ in the\nend"), (4, "a")]
    got = QUERIES["op2_sentencepiece"](spark, table_dir(("documents", rows, "doc_id bigint, text string"))).collect()
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        text = texts[r["doc_id"]]
        assert r["round_trip"]
        if text is None:
            assert r["other_ids"] is None
        elif text:
            want = seg.encode(text, 3)
            assert [r["ids"], *r["other_ids"]] == [i.tolist() for _, i in want]
            assert r["nbest_scores"] == [s for s, _ in want]
        else:
            assert r["other_ids"] == []
