"""Operators 6, 7, 8 and 10: brute force, distributions, round trips, bad archives."""

import hashlib
import math
import os
import struct

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from uvlens.llm import chat_format, kdtree_topk, mixing, warc


def brute_topk(rows, k):
    out = []
    for q, x in rows:
        if q % 7 == 0:
            best = sorted(((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q and len(x) == len(y)))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["random", "ties", "huge", "clusters", "lengths"])
def test_topk_over_many_shards(spark, kind):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 0.2, (700, 6))
    if kind == "ties":
        x = np.round(x * 4) / 4
        x[:250] = x[0]
    if kind == "huge":
        x *= 1e6
    if kind == "clusters":
        x += 4 * rng.normal(0, 1, (9, 6))[rng.integers(0, 9, 700)]
    x = [y[:1 + i % 6] for i, y in enumerate(x)] if kind == "lengths" else x
    rows = [(i, [math.floor(256 * float(v)) for v in y]) for i, y in enumerate(x)]
    df = spark.createDataFrame([(i, [float(v) for v in y]) for i, y in enumerate(x)],
                               "vec_id bigint, embedding array<double>")
    got = kdtree_topk.top_k(df, F.col("vec_id") % 7 == 0, 4, shard_rows=90, block_rows=30).collect()
    assert sorted(tuple(r) for r in got) == brute_topk(rows, 4)


def test_cells_bound_all_rows_and_skip_far_ones():
    rng = np.random.default_rng(5)
    x = np.floor(256 * (rng.normal(0, 0.1, (4000, 16)) + 2 * rng.normal(0, 1, (20, 16))[rng.integers(0, 20, 4000)]))
    cells = kdtree_topk.Cells({16: x[:1000]}, 40)
    column = pa.array(list(x), pa.list_(pa.float64()))
    cell = cells.of(column)
    assert len(set(cell)) > 15 and cells.count <= 1 + 1000 // 16 and 0 not in cell
    cells.boxes = {int(c): (x[cell == c].min(0), x[cell == c].max(0)) for c in set(cell)}
    products = x[:100] @ x.T
    floors = np.sort(products, 1)[:, -6]
    reached = cells.reached(column[:100], floors)
    for r, p, f in zip(reached, products, floors):
        assert set(cell[p >= f]) <= set(r)
    assert np.mean([len(r) for r in reached]) < 0.2 * len(cells.boxes)
    other = pa.array([[1.0, 2.0]], pa.list_(pa.float64()))  # a length that the sample lacks
    assert cells.of(other).tolist() == [0] and [c.tolist() for c in cells.reached(other, np.array([9.0]))] == [[0]]


def test_quantized_values_beyond_a_long(spark):
    df = spark.createDataFrame([(1, [1e20, -1e25]), (2, [-0.5, 1.7e308]), (3, [float("inf")]), (4, [-1 / 512, 2.0**45 + 0.5])],
                               "vec_id bigint, embedding array<double>")
    got = dict(df.select("vec_id", kdtree_topk.quantize(F.col("embedding"))).collect())
    assert got == {1: [256e20, -256e25], 2: [-128.0, 1.7976931348623157e308], 3: None, 4: [-1.0, 2.0**53 + 128]}


def test_tree_bounds_are_tight_and_leaves_small():
    rng = np.random.default_rng(2)
    p = np.floor(rng.normal(0, 60, (5000, 8)))
    tree = kdtree_topk.KDTree(p, np.arange(5000), leaf_rows=64)
    q = np.floor(rng.normal(0, 60, (20, 8)))
    bounds = tree.bounds(q)
    for node, (a, b) in enumerate(tree.span):
        part = tree.points[a:b]
        assert (tree.lo[node] == part.min(0)).all() and (tree.hi[node] == part.max(0)).all()
        assert (bounds[:, node] >= (q @ part.T).max(1)).all()
        assert b - a <= 64 or tree.kids[node][0] >= 0
    assert sorted(tree.ids) == list(range(5000))


def test_mix_draws_poisson_counts(spark):
    df = spark.range(60_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").when(
        F.col("id") % 3 == 1, "b").otherwise("c").alias("source"), F.lit("x").alias("copy"))
    got = mixing.mix(df, {"a": 0.1, "b": 0.8, "c": 0.1}, total=250_000)
    assert got.columns == ["doc_id", "source", "copy", "_copy", "shuffle_key"]
    n = {(r["source"], r["doc_id"]): r["count"] for r in got.groupBy("source", "doc_id").count().collect()}
    for s, k, rate in (("a", 0, 1.25), ("b", 1, 10.0), ("c", 2, 1.25)):
        c = np.array([n.get((s, i), 0) for i in range(k, 60_000, 3)])
        assert abs(c.mean() - rate) < 5 * math.sqrt(rate / len(c))
        assert abs(c.var() / rate - 1) < 0.06
    want = sum(n.values())
    again = mixing.mix(df.repartition(7), {"a": 0.1, "b": 0.8, "c": 0.1}, total=250_000)
    assert again.count() == want and again.exceptAll(got).count() == 0
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_mix_weights(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(["a", "b", None, "z"] * 50)], "doc_id bigint, source string")
    only = mixing.mix(df, {"a": 1.0, "b": 0.0, "gone": 3.0})
    assert {r["source"] for r in only.select("source").distinct().collect()} == {"a"}
    rest = mixing.mix(df, {mixing.OTHER: 1.0}, total=4000)
    assert rest.select("source").distinct().count() == 4
    assert mixing.mix(df.where("1 = 0"), {"a": 1.0, mixing.OTHER: 1.0}).count() == 0
    assert len(mixing.poisson_table(8.0)) < 80 and abs(mixing.poisson_table(0.3)[-1] - 1) < 1e-12


@pytest.mark.parametrize("kind", ["null", "one"])
def test_mix_shares_with_null_and_hot_ids(spark, kind):
    """30 % of the rows without an id, or a third with one and the same: target shares
    within 1 %, and no partition above twice the mean."""
    n = 60_000
    odd = F.col("id") % 10 < 3 if kind == "null" else F.col("id") % 3 == 0
    df = spark.range(n).select(
        F.when(odd, F.lit(None if kind == "null" else 7).cast("bigint")).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("text "), F.col("id")).alias("text"), F.when(F.col("id") % 7 < 2, "a").otherwise("b").alias("source"))
    got = mixing.mix(df, {"a": 0.7, "b": 0.3}, seed=5)
    rows = got.groupBy("source").count().collect()
    total = sum(r["count"] for r in rows)
    assert abs(total / n - 1) < 0.02
    assert all(abs(r["count"] / total - {"a": 0.7, "b": 0.3}[r["source"]]) < 0.01 for r in rows)
    # copies are whole rows, and rows that are equal draw alike
    twice = df.limit(50)
    both = mixing.mix(twice.unionAll(twice), {"a": 0.7, "b": 0.3}, total=300).groupBy("doc_id", "text", "copy").count()
    assert {r["count"] for r in both.collect()} == {2}
    parts = [r["count"] for r in got.groupBy(F.pmod(F.xxhash64("shuffle_key"), F.lit(16))).count().collect()]
    assert len(parts) == 16 and max(parts) < 2 * total / 16


def test_chat_of_many_turns(spark):
    said = [("assistant" if i % 3 else "user", f"t{i}<|" * (i % 4)) for i in range(4000)]
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(said)], "conv_id int, turn int, role string, text string")
    got = chat_format.read_back(chat_format.format_chats(df)).first()
    assert [tuple(t) for t in got["turns"]] == said
    assert got["loss_texts"] == [t for r, t in said if r == "assistant"]


def test_chat_spans_cover_the_assistant_texts_only(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b<|c"), (1, 2, "assistant", "d&"), (1, 3, "user", "e")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    chats = chat_format.format_chats(df)
    r = chats.first()
    assert r["formatted"] == ("<|turn|>user<|says|>a<|end|><|turn|>assistant<|says|>b&lt;|c<|more|>d&amp;<|end|>"
                              "<|turn|>user<|says|>e<|end|>")
    assert [r["formatted"][s["start"]:s["start"] + s["length"]] for s in r["loss_spans"]] == ["b&lt;|c", "d&amp;"]
    back = chat_format.read_back(chats).first()
    assert [(t["role"], t["text"]) for t in back["turns"]] == [x[2:] for x in rows]
    assert back["loss_texts"] == ["b<|c", "d&"]
    assert "Python" not in chats._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def archive(spark, tmp_path):
    """(manifest, path of its one archive) of 40 pages."""
    rows = [(i, f"http://a/{i}", f"<p>{i % 5} " + "text of the page " * 80) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    manifest = warc.write_archives(df, str(tmp_path / "w"))
    files = [r["archive"] for r in manifest.collect()]
    return manifest, files


def test_archive_layout(archive):
    manifest, files = archive
    total = 0
    for f in files:
        raw = open(f, "rb").read()
        if struct.unpack("<I", raw[:4])[0] == warc.DICT_MAGIC:
            size = struct.unpack("<I", raw[4:8])[0]
            d = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw[8:8 + size]))
            one = zstandard.ZstdDecompressor(dict_data=d).decompressobj()
            first = one.decompress(raw[8 + size:])
            assert first.startswith(b"WARC/1.1\r\n") and one.unused_data[:4] == b"\x28\xb5\x2f\xfd"
        with open(f, "rb") as s:
            total += len(list(warc.frames(s, chunk=37)))
    assert total == 40


def test_payloads_survive(archive):
    got = warc.read_archives(archive[0]).collect()
    assert sorted(r["page_id"] for r in got) == list(range(40))
    by_id = {r["page_id"]: r for r in got}
    for r in got:
        keep = by_id[r["refers_to"]] if r["record_type"] == "revisit" else r
        assert keep["record_type"] == "response" and keep["payload"].decode().startswith(f"<p>{r['page_id'] % 5} ")
        assert hashlib.sha1(keep["payload"]).hexdigest() == r["payload_digest"] and len(keep["payload"]) == r["payload_bytes"]
    assert sum(r["record_type"] == "response" for r in got) == 5


@pytest.mark.parametrize("harm", ["cut", "flip", "lost"])
def test_bad_archives_raise(archive, harm):
    manifest, files = archive
    f = max(files, key=os.path.getsize)
    raw = bytearray(open(f, "rb").read())
    if harm == "flip":
        raw[len(raw) // 2] ^= 0xFF
    elif harm == "cut":
        raw = raw[:-5]
    else:  # whole last frame lost
        raw = raw[:raw.rfind(b"\x28\xb5\x2f\xfd")]
    open(f, "wb").write(raw)
    with pytest.raises(Exception, match="WarcError|records|frame"):
        warc.read_archives(manifest).collect()


def test_bad_records_raise():
    good = warc.record_bytes(1, "http://a/", b"payload", 7, hashlib.sha1(b"payload").hexdigest(), None, "2024-01-01T00:00:00Z")
    assert warc.parse_record(good)["payload"] == b"payload"
    for bad in (good[:-1], good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"payload", b"payloaD"),
                good.replace(b"Content-Length: 7", b"Content-Length: 8"), good.replace(b"WARC-Date", b"X-Date"),
                good.replace(b"WARC-Type: response", b"WARC-Type: revisit"), good.replace(b"sha1:", b"md5:")):
        with pytest.raises(warc.WarcError):
            warc.parse_record(bad)
