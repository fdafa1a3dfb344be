"""Edit-aware token counts against encoding the edited text from scratch."""

import random
import time

import pytest

from uvlens.llm import token_counts as T

BITS = ["the", " token", "  ", "\n", "\n\n  ", "'ll", "'re", "'", "r", "e", " 123", "7", "!?", " \t", "ö", "日本", " ",
        "\x1c", "\x85", "<EMAIL>", "a@b.de", " ", "x" * 50, "🙂"]


@pytest.fixture(scope="module")
def counter():
    data, pattern, _ = T._model(None, None)
    return T.Counter(data, pattern)


def brute(counter, text):
    return len(counter.encoding.encode_ordinary(text))


def test_count_equals_the_encoder(counter):
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice(BITS) for _ in range(rng.randrange(40)))
        assert sum(counter.counts(counter.split(text))) == brute(counter, text), repr(text)


def test_edits_equal_encoding_from_scratch(counter, monkeypatch):
    monkeypatch.setattr(T, "LEAF", 4)  # many leaves on short texts
    rng = random.Random(2)
    for _ in range(1500):
        text = "".join(rng.choice(BITS) for _ in range(rng.randrange(80)))
        tree = T.TokenTree.build(text, counter)
        for _ in range(rng.randrange(1, 5)):
            a = rng.randrange(len(text) + 1)
            b = min(len(text), a + rng.choice([0, 1, 2, 5, 30]))
            new = "".join(rng.choice(BITS) for _ in range(rng.randrange(4)))
            before = text
            text = text[:a] + new + text[b:]
            tree.edit(a, b, new)
            assert "".join(tree.texts) == text
            assert tree.total() == brute(counter, text), (before, a, b, new)
        chars, tokens = tree.leaves()
        again = T.TokenTree.restore(text, chars, tokens, counter)
        assert again.total() == tree.total() and sum(chars) == len(text)


def test_edit_of_a_long_text_encodes_little(counter):
    text = "some words in a long text, " * 20_000
    tree = T.TokenTree.build(text, counter)
    tree.edit(300_000, 300_010, "edited")
    assert tree.encoded < 4 * T.LEAF
    assert tree.total() == brute(counter, text[:300_000] + "edited" + text[300_010:])


def test_columns_and_cases(spark, counter):
    rows = [(1, "mail me at a.b@example.com or 555 123 4567.", "x"), (2, None, "x"), (3, "", "y"),
            (1, "mail me at a.b@example.com or 555 123 4567.", "x"), (None, "see https://a.example/x?y now", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    got = T.with_edits(T.mask_edits(T.with_trees(df)), "edits").collect()
    want = {rows[0][1]: "mail me at <EMAIL> or <NUMBER>.", rows[4][1]: "see <URL> now", "": ""}
    assert len(got) == 5
    for r in got:
        if r["text"] is None:
            assert r["tree"]["n_tokens"] is None and r["edited"]["n_tokens"] is None
        else:
            assert r["tree"]["n_tokens"] == brute(counter, r["text"])
            assert r["edited"]["n_tokens"] == brute(counter, want[r["text"]])
    empty = T.with_edits(T.mask_edits(T.with_trees(df.where("1 = 0"))), "edits")
    assert empty.collect() == []


def test_bad_edits_are_skipped(spark, counter):
    df = spark.createDataFrame([(1, "abcdefgh" * 10, [(5, 9, "X"), (7, 12, "Y"), (None, 3, "Z"), (70, 999, None)])],
                               f"doc_id bigint, text string, e {T.EDITS}")
    r = T.with_edits(T.with_trees(df), "e").first()
    t = "abcdefgh" * 10
    assert r["edited"]["n_edits"] == 2 and r["edited"]["n_skipped"] == 2
    assert r["edited"]["n_tokens"] == brute(counter, t[:5] + "X" + t[9:70])


MASKED = [("see https://a.example/" + "x" * 5_000 + " now", "see <URL> now"),
          ("no. " + "1234567890" * 3 + "!", "no. <NUMBER>!"), ("1 2-3 " * 20 + "x", "<NUMBER> x"),
          ("to " + "ab.c" * 50 + "@example.com.", "to <EMAIL>."), ("a@" + "b" * 100 + ".c" * 20 + " x", "<EMAIL> x"),
          ("5551234567@mail.com", "<EMAIL>"), ("call 555 123 4567@mail.com now", "call <EMAIL> now"),
          ("https://me@mail.com/1234567890 a@b.c+d@e.f", "<URL> <EMAIL><EMAIL>"), ("12345 a@b 123456", "12345 a@b 123456")]


def test_masks_take_whole_runs(spark, counter, table_dir):
    from uvlens.llm.queries import QUERIES

    folder = table_dir(("documents", [(i, t) for i, (t, _) in enumerate(MASKED)], "doc_id bigint, text string"))
    for r in QUERIES["op1_token_counts"](spark, folder).collect():
        text, want = MASKED[r["doc_id"]]
        assert r["n_tokens"] == brute(counter, text) and r["n_tokens_masked"] == brute(counter, want), want
        assert r["n_edits"] == want.count("<") and r["n_skipped"] == 0


@pytest.mark.parametrize("part", ["a", "1", "1 ", "a@", "a+", "a.", "a@b.", "123456 -"])
def test_masks_are_linear(part):
    began = time.monotonic()
    T.masks(part * 300_000)
    assert time.monotonic() - began < 10


def test_query_over_the_table(spark, counter):
    from uvlens.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op1_token_counts"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        text = docs[r["doc_id"]]
        assert r["n_tokens"] == brute(counter, text)
        marks = sorted((m.start(), m.end(), new) for rule, new in T.MASKS for m in rule.finditer(text))
        at, parts = 0, []
        for a, b, new in marks:
            if a >= at:
                parts += [text[at:a], new]
                at = b
        assert r["n_tokens_masked"] == brute(counter, "".join(parts) + text[at:])
    assert any(r["n_edits"] for r in got)
