"""The pipeline's stages, each on its own input, against brute force."""

import re

import pytest

import corpus_pipeline as C
from uvlens.llm import mixing
from uvlens.llm import sentencepieces as S
from .test_near_dedup import brute as near_brute
from .test_quality import brute as text_brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(C.STAGES):
        path = str(tmp_path_factory.mktemp("pipeline") / str(k))
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns_and_order(steps):
    assert [n for n, _ in C.STAGES] == ["quality classifier", "quality rules", "near-duplicates", "source mix",
                                       "SentencePiece ids"]
    assert all(df.columns == COLUMNS for df in steps[:-1])


def test_filters_drop_junk_and_keep_clean(spark, steps):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    bad = {r["doc_id"] for r in labels.where("quality = 0").collect()}
    after = set(ids(steps[1]))
    assert len(bad & after) <= 0.1 * len(bad) and len(good - after) <= 0.02 * len(good)
    kept = set(ids(steps[2]))
    for r in steps[1].collect():
        b = text_brute(r["text"])
        if b["n_words"] < 50 or 100 * b["n_repeat_words"] > 50 * b["n_words"]:
            assert r["doc_id"] not in kept
    clean = [r for r in steps[1].collect() if r["doc_id"] in good and text_brute(r["text"])["n_words"] >= 50]
    assert sum(r["doc_id"] not in kept for r in clean) <= 0.02 * len(clean)


def test_one_document_of_each_group_stays(steps):
    want = near_brute([(r["doc_id"], r["text"]) for r in steps[2].collect()], 0.8)
    assert ids(steps[3]) == sorted(i for i, c in want.items() if i == c)


def test_mix_repeats_whole_rows(steps):
    docs = {r["doc_id"]: tuple(r) for r in steps[3].collect()}
    mixed = steps[4].collect()
    assert all(docs[r["doc_id"]] == tuple(r) for r in mixed)
    counts = {}
    for r in mixed:
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    n = {}
    for d in docs.values():
        s = d[3] if d[3] in C.MIX_WEIGHTS else mixing.OTHER
        n[s] = n.get(s, 0) + 1
    rate = mixing.rates(n, C.MIX_WEIGHTS, sum(n.values()))
    import hashlib

    for i, d in docs.items():
        lam = rate[d[3] if d[3] in C.MIX_WEIGHTS else mixing.OTHER]
        parts = max(1, -(-lam // mixing.STEP))
        want = 0
        for k in range(int(parts)):
            text = hashlib.md5((d[1] or "").encode()).hexdigest()
            u = int(hashlib.md5(f"{i}#{text}#{C.MIX_SEED}#{k}".encode()).hexdigest()[:13], 16) / 2**52
            want += sum(c <= u for c in mixing.poisson_table(lam / parts))
        assert counts.get(i, 0) == want


def test_ids_decode_to_the_texts(steps):
    seg = S.Segmenter(S.load_vocabulary())
    text = {r["doc_id"]: r["text"] for r in steps[3].collect()}
    rows = steps[5].collect()
    assert sorted(r["doc_id"] for r in rows) == ids(steps[4])
    assert all(seg.decode(r["ids"]) == text[r["doc_id"]] and r["n_pieces"] == len(r["ids"]) for r in rows)


def test_last_stage_has_the_scores_of_the_three_best(spark):
    texts = ["a plain text with some words", "", None, "other words " * 50]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    seg = S.Segmenter(S.load_vocabulary())
    for r in C.sentencepiece_ids(spark, docs, "").collect():
        text = texts[r["doc_id"]]
        want = None if text is None else seg.encode(text, 3)
        assert r["nbest_scores"] == (want and [score for score, _ in want])
        assert r["ids"] == (want and want[0][1].tolist()) and (r["doc_id"] != 3 or len(r["nbest_scores"]) == 3)


def test_run_equals_the_stages(spark, steps):
    got = C.run(spark, "/root/testdata/sf0.001")
    key = lambda df: sorted((r["doc_id"], tuple(r["ids"])) for r in df.collect())
    assert key(got) == key(steps[5])


def test_awkward_rows(spark, table_dir):
    t = "A plain sentence with enough different words to be kept by rule number {}. " * 1
    rows = [(i, " ".join(t.format(j * (i + 3)) for j in range(9)), "en", "src0", 1) for i in range(30)]
    rows += [(None, rows[0][1], None, None, None), (3, rows[3][1], "en", "src0", 1), (40, None, None, "src1", None),
             (41, "", "en", "src1", 0), (42, re.sub("plain", "Plain", rows[2][1]), "en", None, 2)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, gone_id int"
    folder = table_dir(("documents", [(*r, "s", 1) for r in rows], schema),
                       ("labels", [(i, 1, 0) for i in range(20)] + [(None, 1, 0), (41, 0, None)],
                        "doc_id bigint, quality int, toxic int"))
    assert C.run(spark, folder).columns[:2] == ["doc_id", "lang"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
        assert stage(spark, docs.where("1 = 0"), folder).collect() == []
