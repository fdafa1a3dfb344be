"""Near-duplicate documents with HyperMinHash (operator 5).

Signature. The distinct word shingles of a text are hashed to 64 bits. The low bits
pick one of ``REGISTERS`` buckets; a bucket's register keeps the smallest remaining
hash as a leading-zero count (6 bits) and ``MANTISSA`` bits behind it. Registers
are banded; empty registers borrow from the first full one in a fixed random order
of their own, so short texts are banded like long ones.

Links. 1. Texts with equal shingle sets are one node (smallest id). 2. Every band of
a node is hashed; keys that several nodes share are candidates. 3. If there are many
candidate pairs, all nodes of a key are compared with one leader, and links found are
contracted. This repeats with other leaders while many candidate pairs between
components are left and links are still found, so a large group of near copies costs a few
comparisons per member instead of all its pairs. 4. Nodes that share a key with another
component are paired by an exact prefix filter: only if they share one of the rarest
shingles that two linked sets must share. A passage that many texts hold is among these of no
text that has enough else, so texts around it are not compared; pairs whose nodes are
connected already are not either. No link between components is lost. A comparison first
checks, inside the join, the sizes without the shingles that only one node has, how much of
both sets is left behind the shared shingle (exact bounds) and a
512-bit sketch, then the collision-corrected Jaccard estimate of the registers, both
with six standard deviations of slack, then the full sets. The sketch's deviation counts
in that borrowed registers are correlated; sets with fewer than ``SKETCH_LEAST`` shingles
skip it, as a few buckets that clash move half of their bits.
5. Components: alternating large-star and small-star steps on the verified links.

Misses. ``rows_per_band`` keeps a pair at the threshold from missing all bands with
probability 1e-7 at most if registers are independent. Few full registers vary more, so
bands, sketch and estimate together lose such a pair with a probability of 4e-8 at 0.85
and 4e-7 at 0.80 at most, but 1.2e-6 for sets of 5 shingles at 0.80 (computed for unions
of 1 to 2,000 shingles, bands as if independent given the share of differing registers).
Nearly all of it is the bands; the sketch's part is 6e-9 at most.

No step collects rows on the driver, gathers a key's nodes in one task or emits the
pairs of a group of copies; joins on hot keys are plain equi-joins that adaptive
execution splits. Intermediate tables lie in the shared checkpoint folder.

Cases. Null text or no word: empty set, linked with nothing. Fewer words than a
shingle: the whole word sequence is the one shingle. Null ids: ``components`` links the row
with nothing (component null); ``keep_one`` links it by its words. Rows that repeat an id: the
id is one node with several texts, linked if any of them is; ``keep_one`` keeps one row of
those with the same words. Empty table: empty result.
Extra columns are ignored by ``components`` and kept by ``keep_one``.
Only A-Z are lower-cased. Sets hold 64-bit shingle hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uvlens.llm.common import as_strings, fresh, give_back, materialize

REGISTERS, MANTISSA, SKETCH_BITS = 512, 10, 512
BROADCAST_IDS, ROWS_PER_PART = 1_000_000, 50_000
PAIR = ["a", "b", "ca", "cb"]  # two nodes and their components
SIGMAS, SKETCH_LEAST = 6, 20
_LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ORDER = np.argsort(np.random.default_rng(5).random((REGISTERS, REGISTERS)), axis=1).astype(np.int16)
_RANK = np.argsort(_ORDER, axis=1).astype(np.int16)
_SALT = np.random.default_rng(6).integers(1, 2**63, REGISTERS, dtype=np.uint64) | np.uint64(1)
_EMPTY = 0xFFFF
_WORDS: dict[bytes, int] = {}


def rows_per_band(threshold: float, miss: float = 1e-7) -> int:
    """The longest bands that lose a pair at the threshold with probability
    ``miss`` at most, if registers are independent (the module says what borrowing
    adds)."""
    ok = [r for r in range(1, 33) if (1 - threshold**r) ** (REGISTERS // r) <= miss]
    return max(ok, default=1)


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a UTF-8 text."""
    words = text.translate(_LOW).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_WORDS) > 150_000:
        _WORDS.clear()
    ids = []
    for w in words:
        h = _WORDS.get(w)
        if h is None:
            h = _WORDS[w] = xxhash.xxh64_intdigest(w)
        ids.append(h)
    a = np.array(ids, np.uint64)
    n = min(k, len(a))
    h = np.full(len(a) - n + 1, n, np.uint64)
    for i in range(n):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + a[i:len(a) - n + 1 + i])
    return np.unique(h)


def _digest(hashes: np.ndarray) -> tuple[int, int]:
    """Identity of a set: 128 bits as two signed 64-bit numbers."""
    d = xxhash.xxh3_128_intdigest(hashes.tobytes())
    return (d >> 64) - 2**63, (d & (2**64 - 1)) - 2**63


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of sorted hashes (uint16; _EMPTY where no hash fell)."""
    bucket = (hashes & np.uint64(REGISTERS - 1)).astype(np.int64)
    value = hashes >> np.uint64(9)  # 55 bits
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    least[bucket[::-1]] = value[::-1]  # sorted: the smallest of a bucket is written last
    full = least != np.iinfo(np.uint64).max
    v = least[full]
    # bit length by a float exponent, corrected where rounding went up
    length = np.frexp(v.astype(np.float64))[1].astype(np.int64)
    length -= (v >> np.maximum(length - 1, 0).astype(np.uint64) == 0) & (v > 0)
    zeros = 55 - length
    behind = np.maximum(length - 1, 0)  # bits behind the leading one
    tail = v & ((np.uint64(1) << behind.astype(np.uint64)) - np.uint64(1))
    up = np.maximum(MANTISSA - behind, 0).astype(np.uint64)
    down = np.maximum(behind - MANTISSA, 0).astype(np.uint64)
    mantissa = (tail << up) >> down
    out = np.full(REGISTERS, _EMPTY, np.uint16)
    out[full] = (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)
    return out


def densified(regs: np.ndarray) -> np.ndarray:
    """Empty registers take the value of the first full register in their own
    fixed random order (uint64)."""
    full = regs != _EMPTY
    out = regs.astype(np.uint64)
    todo = np.flatnonzero(~full)
    if not len(todo):
        return out
    on = np.flatnonzero(full)
    if len(on) <= 48:
        out[todo] = out[on[_RANK[np.ix_(todo, on)].argmin(1)]]
        return out
    at, width = 0, 16
    while len(todo):
        order = _ORDER[todo, at:at + width]
        hit = full[order]
        first = hit.argmax(1)
        found = hit[np.arange(len(todo)), first]
        out[todo[found]] = out[order[np.arange(len(todo)), first][found]]
        todo, at, width = todo[~found], at + width, width * 2
    return out


def band_keys(dense: np.ndarray, r: int) -> np.ndarray:
    """One 64-bit key per band of r registers."""
    bands = REGISTERS // r
    x = dense[:bands * r].reshape(bands, r)
    h = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(r):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + x[:, k])
    return h.view(np.int64)


def sketch(dense: np.ndarray) -> np.ndarray:
    """One bit per register of the first ``SKETCH_BITS``, as int64 words."""
    bits = mix64((dense[:SKETCH_BITS] + np.uint64(1)) * _SALT[:SKETCH_BITS]) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def sketch_limit(threshold: float) -> int:
    """Differing bits that a pair at the threshold stays under (six sigmas). Borrowing
    raises the variance of the differing registers to 1.5 times the binomial one at most
    (few full registers); each of them gives a differing bit half of the time."""
    p = 1 - threshold
    return math.ceil(SKETCH_BITS * p / 2 + SIGMAS * math.sqrt(SKETCH_BITS * (p + 1.5 * p * (1 - p)) / 4))


def collision_rate(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Probability that the registers of two disjoint sets agree by chance.

    A register's minimum is close to exponential with rate lambda = n / REGISTERS
    on [0, 1); within leading-zero level i the cells are 2^-(i+1+MANTISSA) wide, so
    the chance is the sum over levels of width * integral of both densities."""
    la, lb = n_a / REGISTERS, n_b / REGISTERS
    s = np.maximum(la + lb, 1e-12)
    out = np.zeros(len(s))
    for i in range(40):
        low, high = 2.0 ** -(i + 1), 2.0 ** -i
        out += low / 2**MANTISSA * la * lb / s * (np.exp(-s * low) - np.exp(-s * high))
    return np.clip(out, 0, 0.5)


def estimate(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of rows of registers, and the number
    of registers that they rest on."""
    used = (regs_a != _EMPTY) | (regs_b != _EMPTY)
    same = ((regs_a == regs_b) & used).sum(1)
    m = np.maximum(used.sum(1), 1)
    c = collision_rate(n_a.astype(float), n_b.astype(float))
    return np.clip((same / m - c) / (1 - c), 0, 1), m


def _sign(r: int, k: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                n, hi, lo, keys, bits = [], [], [], [], []
                for t in as_strings(part.column(1)):
                    s = shingles(t.as_buffer().to_pybytes() if t.is_valid else b"", k)
                    n.append(len(s))
                    d = _digest(s)
                    hi.append(d[0])
                    lo.append(d[1])
                    if len(s):
                        dense = densified(registers(s))
                        keys.append(band_keys(dense, r))
                        bits.append(sketch(dense))
                    else:
                        keys.append(None)
                        bits.append(None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
                    ["id", "n", "hi", "lo", "bands", "bits"])
            give_back()
    return fn


def _sets(k: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingles(t.as_buffer().to_pybytes() if t.is_valid else b"", k)
                        for t in as_strings(part.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([_digest(s)[0] for s in sets], pa.int64()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([registers(s).tobytes() for s in sets], pa.binary()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["id", "hi", "n", "regs", "hashes"])
            give_back()
    return fn


def _estimated(threshold: float):
    """Keeps the pairs whose estimate does not rule the threshold out."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                p = batch.slice(at, 2_000)
                a, b = (np.frombuffer(b"".join(p.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                        for c in ("regs_a", "regs_b"))
                j, m = estimate(a, b, p.column("n_a").to_numpy(), p.column("n_b").to_numpy())
                # the used registers are a draw of m without replacement from the union
                union = np.maximum((p.column("n_a").to_numpy() + p.column("n_b").to_numpy()) / (1 + threshold), 2)
                rest = np.clip((union - m) / (union - 1), 0, 1)
                slack = SIGMAS * np.sqrt(threshold * (1 - threshold) / m * rest) + 1 / m + 0.005
                yield p.select(PAIR).filter(pa.array(j >= threshold - slack))
            give_back()
    return fn


def _parts(rows: int) -> int:
    """Partitions to write a table of at most ``rows`` small rows in: many tiny
    files cost more than the work on them."""
    return max(1, math.ceil(rows / ROWS_PER_PART))


def connected(links: DataFrame) -> DataFrame:
    """(id, comp): the smallest id reachable over links (a, b), for every linked
    id. Alternating large-star and small-star steps until nothing changes. Minima
    are written before they are joined back, so that adaptive execution can split
    the join on a vertex with many links."""
    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()

    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a <> b").distinct(), "cc")
    last = state(edges)
    while last["n"]:
        parts = _parts(2 * last["n"])  # no step makes more rows than twice its edges
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "cc", parts)
        large = materialize(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .distinct(), "cc", parts)
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "cc", parts)
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(low.select("a", F.col("m").alias("b"))).distinct())
        edges = materialize(small, "cc", parts)
        now = state(edges)
        if now == last:
            break
        last = now
    return materialize(
        edges.select(F.col("a").alias("id"), F.col("b").alias("comp"))
        .unionAll(edges.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct()), "cc", _parts(2 * last["n"]))


def hook(links: DataFrame, parts: int) -> DataFrame:
    """(comp, to): a cheap part of the contraction of links (ca, cb) between
    components. Every component takes the smallest one it is linked to, four hops far
    at most. Equal labels are connected; connected components may still differ."""
    to = materialize(links.groupBy(F.greatest("ca", "cb").alias("comp")).agg(F.min(F.least("ca", "cb")).alias("to")),
                     "hook", parts)
    for _ in range(2):
        further = to.select(F.col("comp").alias("to"), F.col("to").alias("next"))
        to = materialize(to.join(further, "to", "left").select("comp", F.coalesce("next", "to").alias("to")),
                         "hook", parts)
    return to


def _small(df: DataFrame) -> DataFrame:
    """A written table of ids, to be broadcast if it has a million rows at most
    (8 MB); beyond that Spark shuffles."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def verify(pairs: DataFrame, sets: DataFrame, threshold: float, parts: int) -> DataFrame:
    """The true links of distinct pairs (a, b, ca, cb), as a written table: estimates
    of the registers, then the full sets."""
    num, den = round(threshold * 100), 100

    def sides(p: DataFrame, *cols: str) -> DataFrame:
        for x in ("a", "b"):
            p = p.join(sets.select(F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in cols]), x)
        return p

    near = materialize(sides(pairs, "n", "regs").select(*PAIR, "n_a", "n_b", "regs_a", "regs_b")
                       .mapInArrow(_estimated(threshold), ", ".join(f"{c} BIGINT" for c in PAIR)), "estimated", parts)
    both = F.size(F.array_intersect("hashes_a", "hashes_b"))
    full = sides(near, "hashes").withColumn("both", both)
    return materialize(full.where(den * F.col("both") >= num * (
        F.size("hashes_a") + F.size("hashes_b") - F.col("both"))).select(*PAIR), "links", parts)


def _cross(nodes: DataFrame) -> int:
    """Candidate pairs between different components, counted once per shared key."""
    per = nodes.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    got = (per.groupBy("key").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("s"))
           .agg(F.sum(F.expr("(cast(n AS DECIMAL(38,0)) * n - s) / 2")).alias("x"))).first()
    return int(got["x"] or 0)


_BITS = [f"x{i}" for i in range(SKETCH_BITS // 64)]


def _close(threshold: float, other: str) -> Column:
    """Whether two nodes (the second one's columns have the prefix ``other``) are in
    different components and can reach the threshold: by their sizes and the shingles
    that only one node has (the intersection holds none of these), and by sketch unless
    one of them is small."""
    num, den = round(threshold * 100), 100
    differ = F.lit(0)
    for x in _BITS:
        differ = differ + F.bit_count(F.col(x).bitwiseXOR(F.col(other + x)))
    most = F.least(F.col("n") - F.col("own"), F.col(other + "n") - F.col(other + "own"))
    return ((F.col("comp") != F.col(other + "comp"))
            & (den * most >= num * (F.col("n") + F.col(other + "n") - most))
            & ((F.least("n", other + "n") < SKETCH_LEAST) | (differ <= sketch_limit(threshold))))


def _pairs(joined: DataFrame) -> DataFrame:
    """Distinct pairs (a < b, and their components) of joined nodes."""
    first = F.col("node") < F.col("o_node")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    return joined.select(pick("node", "o_node").alias("a"), pick("o_node", "node").alias("b"),
                         pick("comp", "o_comp").alias("ca"), pick("o_comp", "comp").alias("cb")).distinct()


def _rare_pairs(now: DataFrame, sets: DataFrame, about: DataFrame, threshold: float, parts: int) -> DataFrame:
    """Joined nodes in different components that can reach the threshold, by an exact
    prefix filter: with the shingles of every node in one order, rarest first, two linked
    sets of n >= m shingles share one among the first n - ceil(t n) + 1 of the larger and the
    first m - ceil(2 t m / (1 + t)) + 1 of the smaller. Only nodes take part that share a band
    with another component. Of a shingle's components the one with most nodes there is paired
    with the others, never with itself."""
    num, den = round(threshold * 100), 100
    open_keys = now.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("key")
    apart = materialize(now.join(open_keys, "key", "left_semi").select("node", "comp").distinct(), "apart", parts)
    has = (sets.select(F.col("id").alias("node"), "hi", F.explode("hashes").alias("h"))
           .join(about.select("node", "hi"), ["node", "hi"], "left_semi"))
    common = materialize(has.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "common")
    # (the ceilings in integers; own shingles come first in the order and are in no other set)
    larger = F.col("n") - F.expr(f"(n * {num} + {den - 1}) div {den}") + 1
    smaller = F.col("n") - F.expr(f"(n * {2 * num} + {num + den - 1}) div {num + den}") + 1
    known = about.join(apart, "node").where(larger > F.col("own"))
    listed = (has.join(known.select("node", "n", "own", larger.alias("most")), "node").join(common, "h")
              .groupBy("node", "n", "own", "most").agg(F.array_sort(F.collect_list(F.struct("c", "h"))).alias("s"))
              .select("node", F.posexplode(F.slice("s", F.lit(1), (F.col("most") - F.col("own")).cast("int")))
                      .alias("at", "s")).select("node", "at", "s.h"))
    rare = materialize(listed.join(known, "node").select(
        "h", (F.col("at") + F.col("own")).alias("at"), "node", "comp", "n", "own", smaller.alias("short"), *_BITS), "rare")
    per = rare.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("c"))
    top = materialize(per.groupBy("h").agg(F.max_by("comp", F.struct("c", "comp")).alias("top"), F.count(F.lit(1)).alias("m"))
                      .where("m > 1").select("h", "top"), "top")
    left = materialize(rare.join(top, "h"), "left")
    right = left.select("h", "top", *[F.col(c).alias("o_" + c) for c in rare.columns if c != "h"])
    # the larger one's whole list against the smaller one's shorter list; what is left behind
    # the first common shingle must hold the needed intersection
    bigger = F.struct("n", "node") > F.struct("o_n", "o_node")
    within = F.when(bigger, F.col("o_at") < F.col("o_short")).otherwise(F.col("at") < F.col("short"))
    left_over = F.least(F.col("n") - F.col("at"), F.col("o_n") - F.col("o_at"))
    enough = left_over * (num + den) >= num * (F.col("n") + F.col("o_n"))
    once = (F.col("o_comp") == F.col("top")) | (F.col("node") < F.col("o_node"))
    return (left.where("comp <> top").drop("top").join(right, "h")
            .where(once & within & enough & _close(threshold, "o_")))


def components(df: DataFrame, threshold: float = 0.8, k: int = 5, id_col: str = "doc_id",
               text: str = "text") -> DataFrame:
    """id, n_shingles, component_id (null for null ids) of every row.
    ``threshold`` is taken in hundredths."""
    r = rows_per_band(threshold)
    num, den = round(threshold * 100), 100
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("t"))
    signed = materialize(docs.mapInArrow(
        _sign(r, k), "id BIGINT, n BIGINT, hi BIGINT, lo BIGINT, bands ARRAY<BIGINT>, bits ARRAY<BIGINT>"), "signed")
    alive = signed.where("n > 0 AND id IS NOT NULL")

    # 1. texts with equal sets are one node
    nodes = materialize(alive.groupBy("hi", "lo").agg(
        F.min("id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands"),
        F.first("bits").alias("bits")), "nodes")
    member = materialize(alive.select("id", "hi", "lo").join(nodes.select("hi", "lo", "node"), ["hi", "lo"])
                         .select("id", "node"), "member")

    # 2. keys that several nodes share
    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = materialize(banded.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y"))
                         .where("x < y").select("key"), "shared")
    keyed = materialize(banded.join(shared, "key").select("key", "node"), "keyed")
    rows = keyed.count()
    parts = _parts(rows)
    involved = materialize(keyed.select(F.col("node").alias("id")).distinct(), "involved", parts)
    wanted = _small(involved)
    sets = materialize(docs.join(wanted, "id", "left_semi")
                       .mapInArrow(_sets(k), "id BIGINT, hi BIGINT, n BIGINT, regs BINARY, hashes ARRAY<BIGINT>"), "sets")
    # shingles that no other set of these has can be in no intersection
    alone = (sets.select("id", "hi", F.explode("hashes").alias("h")).groupBy("h")
             .agg(F.min("id").alias("id"), F.min("hi").alias("hi"), F.count(F.lit(1)).alias("c")).where("c = 1")
             .groupBy("id", "hi").agg(F.count(F.lit(1)).alias("own")))
    about = (nodes.select(F.col("node").alias("id"), "hi", "n", *[F.col("bits")[i].alias(x) for i, x in enumerate(_BITS)])
             .join(wanted, "id", "left_semi").join(alone, ["id", "hi"], "left")
             .select(F.col("id").alias("node"), "hi", "n", F.coalesce("own", F.lit(0)).alias("own"), *_BITS))
    about = materialize(about.where((F.col("n") - F.col("own")) * den >= F.col("n") * num), "about", parts)
    now = materialize(keyed.join(about.drop("hi"), "node").withColumn("comp", F.col("node")), "near", parts)

    # an id with several texts belongs to several nodes: these are linked
    split = member.groupBy("id").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x < y")
    links = [member.join(materialize(split, "split", parts), "id").where("node <> x").select(
        F.col("node").alias("a"), F.col("x").alias("b"))]

    # 3. one leader per key: first the node with the fewest shingles of its own, which is
    # the middle of a group of copies, then any
    for turn in count():
        if _cross(now) <= 4 * rows:
            break
        order = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 40))
        if not turn:
            order = order + F.least("own", F.lit(1 << 20)) * (1 << 40)
        leads = materialize(now.groupBy("key").agg(
            *[F.min_by(c, order).alias("o_" + c) for c in ("node", "comp", "n", "own", *_BITS)]), "leads", parts)
        new = verify(_pairs(now.join(leads, "key").where(_close(threshold, "o_"))), sets, threshold, parts)
        links.append(new.select("a", "b"))
        found = new.count()
        if found:
            to = hook(new, parts)
            now = materialize(now.join(to, "comp", "left").withColumn("comp", F.coalesce("to", "comp")).drop("to"),
                              "near", parts)
        if found * den < about.count():  # few are left that a leader finds
            break

    # 4. pairs that are still apart and share a rare shingle
    links.append(verify(_pairs(_rare_pairs(now, sets, about, threshold, parts)), sets, threshold, parts).select("a", "b"))

    # 5. every row's component
    comp = connected(reduce(DataFrame.unionAll, links))
    home = (member.groupBy("id").agg(F.min("node").alias("node"))
            .join(comp.withColumnRenamed("id", "node"), "node", "left")
            .select("id", F.coalesce("comp", "node").alias("component_id")))
    home = materialize(home, "home")
    return (signed.select("id", F.col("n").alias("n_shingles")).join(home, "id", "left")
            .select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id")))


def keep_one(df: DataFrame, threshold: float = 0.8, k: int = 5, id_col: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One row of each group of near-duplicates of ``df``: that of the smallest id. Rows
    without an id are told apart by their words and come after those that have one; of rows
    that repeat an id and its words one stays, an id's different texts stay or go together. Rows
    without id and words are linked with nothing and stay."""
    key, gone_id = fresh(df, "node_key"), fresh(df, "gone_id")
    low = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.trim(F.regexp_replace(low, r"[\x20\x09-\x0D]+", " "))
    # above any id in use: 62 bits of a hash of the words
    nameless = F.when(words != "", F.xxhash64(words).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62))
    keyed = df.withColumn(key, F.coalesce(F.col(id_col).cast("bigint"), nameless))
    found = materialize(components(keyed, threshold, k, key, text).where("id IS NOT NULL")
                        .select(F.col("id").alias(gone_id), "component_id"), "found")
    gone = materialize(found.where(f"{gone_id} <> component_id").select(gone_id).distinct(), "gone")
    again = materialize(found.groupBy(gone_id).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(gone_id), "again")
    kept = keyed.join(_small(gone), F.col(key) == F.col(gone_id), "left_anti")
    if again.isEmpty():
        return kept.drop(key)
    again, digest = _small(again), fresh(keyed, "words_digest")
    one = (kept.join(again, F.col(key) == F.col(gone_id), "left_semi")
           .withColumn(digest, F.md5(F.coalesce(words, F.lit("")))).dropDuplicates([key, digest]).drop(digest))
    return kept.join(again, F.col(key) == F.col(gone_id), "left_anti").unionByName(one).drop(key)
