"""Toxicity (operator 13): a convolutional text classifier.

A text is lower-cased and read as words between blanks and ASCII punctuation. A word's
vector is the sum of two rows of one table of ``BUCKETS`` embeddings, picked by two hashes
(two words rarely share both). Filters over 1, 2 and 3 neighbouring words (``WIDTHS``,
``FILTERS`` of each) slide over the whole text, the largest response of each is kept (max
pooling), and a logistic layer on these gives the logit. All weights are trained in numpy
by Adagrad on mini-batches; a training pass hides a share of the words, so that no single rare
word is learned by heart.

Training rows are all distinct labelled rows, whole: their words are written once as embedding
rows. A share of about ``FIRST_ROWS``, drawn by a hash of id and text (all rows, if not more),
gives the net its start in ``FIRST_EPOCHS`` passes; then all tasks pass over all rows, each with
its own copy, ``ROUNDS`` times, and after each the copies are put together by Spark: every weight
moves by the mean of the tasks' moves, weighed by the squared gradients it had there.

Thresholds. A fifth of all labelled rows, by a hash, is kept apart from the net. On these rows a
temperature makes the logits probabilities, and one threshold per language (with the share of
label 1 of the whole table) gives the best F1; languages with fewer than ``LEAST_PER_LANG`` rows
of either label use the threshold over all languages. Rows are counted by language and logit,
rounded to 1 / ``GRID``. The score is the logistic function of (logit - threshold) / temperature,
so 0.5 is the threshold in every language. The language of a text is guessed from the text by
operator 4's subwords, counted in every row with a language (``language_id.fit_counts``), never
read from a column. Every text is scored whole, in slices of about a megabyte (one text at least).

Cases. Null or empty text, or no word: the score of a text without any word. Without labels, or
with one label only: the share of label 1, smoothed, for all rows. Labels that contradict each
other for one id are left out, as are ids without a row. Repeated rows count once in training and
are scored alike. Extra columns are kept by ``score``; it replaces a column named ``out``. Empty
table: empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from uvlens.llm import language_id
from uvlens.llm.common import (VECTOR_PARTS, as_strings, byte_slices, hash63, materialize, utf8, vector_parts,
                                vector_sums)
from uvlens.llm.rule_ensemble import training_labels

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 15, 16, 12, (1, 2, 3)
BITS = 15  # of a bucket number
FIRST_ROWS, FIRST_EPOCHS, ROUNDS, LEAST_PER_LANG = 8_000, 16, 2, 20
LOT_WORDS, HELD_WORDS, GRID = 200_000, 8_000_000, 1_024
_PAD = max(WIDTHS) - 1
_PLAIN = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(128)).lower() + bytes(range(128, 256))
_WORDS: dict[bytes, int] = {}


def word_hash(word: bytes) -> int:
    """Signed 64-bit hash of a word without case and compatibility forms."""
    h = _WORDS.get(word)
    if h is None:
        if len(_WORDS) > 150_000:
            _WORDS.clear()
        form = word if word.isascii() else unicodedata.normalize("NFKC", word.decode("utf-8", "replace")).casefold().encode()
        h = _WORDS[word] = xxhash.xxh64_intdigest(form) - 2**63
    return h


def buckets(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two embedding rows of every word hash."""
    h = hashes.view(np.uint64)
    return (h % np.uint64(BUCKETS)).astype(np.int64), (h >> np.uint64(40)).astype(np.int64) % BUCKETS


@F.arrow_udf(ArrayType(IntegerType()))
def _words(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The two embedding rows of every word, packed into one number."""
    for batch in texts:
        for i, j in byte_slices(as_strings(batch), 1 << 22):
            split = [t.as_buffer().to_pybytes().translate(_PLAIN).split() if t.is_valid else [] for t in batch[i:j]]
            one, two = buckets(np.fromiter((word_hash(w) for ws in split for w in ws), np.int64))
            ends = np.cumsum([0, *map(len, split)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array((one << BITS | two).astype(np.int32)))


@dataclass
class Net:
    """Embeddings, filters (one array of width x DIM x FILTERS a width), pool offsets,
    output weights and bias."""
    table: np.ndarray
    filters: list[np.ndarray]
    offset: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def params(self) -> list[np.ndarray]:
        return [self.table, *self.filters, self.offset, self.out, self.bias]

    @staticmethod
    def start(seed: int) -> Net:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
        k = FILTERS * len(WIDTHS)
        return Net(draw(BUCKETS, DIM, s=0.05), [draw(w, DIM, FILTERS, s=(w * DIM) ** -0.5) for w in WIDTHS],
                   np.full(k, 0.1, np.float32), np.abs(draw(k, s=0.3)), np.zeros(1, np.float32))

    def pooled(self, words: np.ndarray, inverse: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Largest responses (rows x filters) of texts: ``words`` are distinct hashes,
        ``inverse`` numbers the texts' words, ``sizes`` counts them."""
        return self.pooled_rows(*buckets(words), inverse, sizes)

    def pooled_rows(self, one: np.ndarray, two: np.ndarray, inverse: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        v = np.vstack([self.table[one] + self.table[two], np.zeros((1, DIM), np.float32)])  # last: padding
        ends = np.cumsum(sizes + _PAD)
        begin = ends - sizes - _PAD
        at = np.full(int(ends[-1]) if len(ends) else 0, len(one), np.int64)
        at[np.arange(len(inverse)) + np.repeat(np.arange(len(sizes)) * _PAD, sizes)] = inverse
        res = np.zeros((len(sizes), FILTERS * len(WIDTHS)), np.float32)
        some = np.flatnonzero(sizes > 0)
        if not len(some):
            return res
        edges = np.stack([begin[some], begin[some] + sizes[some]], 1).ravel()
        for i, (w, f) in enumerate(zip(WIDTHS, self.filters)):
            z = (v @ f[0])[at]
            for k in range(1, w):
                z[:-k] += (v @ f[k])[at[k:]]
            res[some, i * FILTERS:(i + 1) * FILTERS] = np.maximum.reduceat(z, edges, axis=0)[::2]
        return res

    def logits(self, pooled: np.ndarray, empty: np.ndarray) -> np.ndarray:
        r = np.maximum(pooled + self.offset, 0)
        r[empty] = 0
        return (r @ self.out + self.bias[0]).astype(float)

    def read(self, texts: list[np.ndarray]) -> np.ndarray:
        """Logits of texts given as word hashes."""
        sizes = np.array([len(t) for t in texts], np.int64)
        words, inverse = np.unique(np.concatenate([*texts, np.zeros(0, np.int64)]).astype(np.int64), return_inverse=True)
        return self.logits(self.pooled(words, inverse, sizes), sizes == 0)


@dataclass
class Training:
    """A net and the sums of its squared gradients (Adagrad)."""
    net: Net
    past: list[np.ndarray]

    @staticmethod
    def start(seed: int = 13) -> Training:
        net = Net.start(seed)
        return Training(net, [np.full(p.shape, 1e-3, np.float32) for p in net.params()])

    def copy(self) -> Training:
        n = self.net
        return Training(Net(n.table.copy(), [f.copy() for f in n.filters], n.offset.copy(), n.out.copy(), n.bias.copy()),
                        [p.copy() for p in self.past])

    def change(self, since: Training) -> np.ndarray:
        """What a task learned: by weight, the growth of its squared gradients, and this times its move."""
        grown = np.concatenate([(a - b).ravel() for a, b in zip(self.past, since.past)]).astype(np.float64)
        moved = np.concatenate([(a - b).ravel() for a, b in zip(self.net.params(), since.net.params())])
        return np.concatenate([grown, grown * moved, [1.0]])

    def moved(self, total: np.ndarray) -> Training:
        """By the sum of all tasks' changes: each weight moves by the mean of the tasks'
        moves, which count as their squared gradients grew."""
        new, at, n = self.copy(), 0, (len(total) - 1) // 2
        for p, q in zip(new.net.params(), new.past):
            grown, push = (total[k + at:k + at + p.size].reshape(p.shape) for k in (0, n))
            p += np.divide(push, grown, out=np.zeros(p.shape), where=grown > 0).astype(np.float32)
            q += (grown / max(total[-1], 1)).astype(np.float32)
            at += p.size
        return new

    def learn(self, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rng: np.random.Generator,
              epochs: int, rate: float = 0.1, hide: float = 0.3) -> None:
        """Mini-batch passes over texts given as the two embedding rows of each word (``one_two``)."""
        for _ in range(epochs):
            order = rng.permutation(len(y))
            size = np.array([len(texts[k]) for k in order])
            lot = np.arange(len(y)) // 32 + np.cumsum(size) // LOT_WORDS
            for rows in np.split(order, np.flatnonzero(np.diff(lot)) + 1):
                self.step([texts[k][rng.random(len(texts[k]), np.float32) >= hide] for k in rows], y[rows], weight[rows], rate)

    def step(self, seqs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rate: float) -> None:
        net, params, past = self.net, self.net.params(), self.past

        def move(i: int, grad: np.ndarray, rows=slice(None)) -> None:
            past[i][rows] += grad * grad
            params[i][rows] -= rate * grad / np.sqrt(past[i][rows])

        sizes = np.array([len(t) for t in seqs], np.int64)
        ends = np.cumsum(sizes + _PAD)
        begin = ends - sizes - _PAD
        real = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(seqs)) * _PAD, sizes)
        packed = np.concatenate(seqs)
        one, two = packed >> BITS, packed & (BUCKETS - 1)
        v = np.zeros((int(ends[-1]), DIM), np.float32)
        v[real] = net.table[one] + net.table[two]
        best, pool = [], np.zeros((len(seqs), FILTERS * len(WIDTHS)), np.float32)
        for i, (w, f) in enumerate(zip(WIDTHS, net.filters)):
            z = v @ f[0]
            for k in range(1, w):
                z[:-k] += v[k:] @ f[k]
            pos = np.zeros((len(seqs), FILTERS), np.int64)
            for j, (b, n) in enumerate(zip(begin, sizes)):
                if n:
                    pos[j] = b + z[b:b + n].argmax(0)
            best.append(pos)
            pool[:, i * FILTERS:(i + 1) * FILTERS] = z[pos, np.arange(FILTERS)]
        p = pool + net.offset
        live = (p > 0) & (sizes > 0)[:, None]
        r = np.where(live, p, 0)
        z = r @ net.out + net.bias[0]
        slope = ((1 / (1 + np.exp(-z)) - y) * weight / len(seqs)).astype(np.float32)
        back = slope[:, None] * net.out * live
        to_words = np.zeros_like(v)
        for i, (w, f) in enumerate(zip(WIDTHS, net.filters)):
            part = back[:, i * FILTERS:(i + 1) * FILTERS]
            grad = np.zeros_like(f)
            for k in range(w):
                at = np.minimum(best[i] + k, len(v) - 1)
                grad[k] = np.einsum("nf,nfd->df", part, v[at])
                np.add.at(to_words, at, part[:, :, None] * f[k].T[None])
            move(1 + i, grad)
        n = len(WIDTHS)
        move(n + 1, back.sum(0))
        move(n + 2, r.T @ slope)
        move(n + 3, slope.sum(keepdims=True))
        to_words = to_words[real]
        on = np.flatnonzero(to_words.any(1))
        rows, where = np.unique(np.concatenate([one[on], two[on]]), return_inverse=True)
        grad = np.zeros((len(rows), DIM), np.float32)
        np.add.at(grad, where, np.vstack([to_words[on], to_words[on]]))
        move(0, grad, rows)


def _lists(column: pa.Array) -> list[np.ndarray]:
    off, flat = column.offsets.to_numpy(), column.values.to_numpy()
    return [flat[a:b] for a, b in zip(off[:-1], off[1:])]


def learned(rows: DataFrame, model: Training, weights: tuple[float, float], epochs: int, seed: int) -> Training:
    """``model`` after ``epochs`` passes of every task over its rows (key, y, words), the tasks'
    nets put together. A task holds at most about ``HELD_WORDS`` words (one batch at least)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, held, rng = None, [], np.random.default_rng(seed)

        def passes() -> None:
            key = np.concatenate([b.column(0).to_numpy() for b in held])
            y = np.concatenate([b.column(1).to_numpy() for b in held]).astype(float)
            texts = [t for b in held for t in _lists(b.column(2))]
            order = np.argsort(key, kind="stable")
            y = y[order]
            mine.learn([texts[k] for k in order], y, np.where(y > 0, weights[1], weights[0]).astype(np.float32), rng, epochs)

        for b in batches:
            if not b.num_rows:
                continue
            mine = mine or model.copy()
            held.append(b)
            if sum(len(x.column(2).values) for x in held) >= HELD_WORDS:
                passes()
                held.clear()
        if held:
            passes()
        if mine is not None:
            yield vector_parts("", mine.change(model))

    total = vector_sums(rows.select("key", "y", "words").mapInArrow(run, VECTOR_PARTS))
    return model.moved(total[""]) if total else model


@dataclass(frozen=True)
class ToxicityModel:
    """``prior`` is all that is known without training rows."""
    prior: float = 0.5
    net: Net | None = None
    languages: language_id.LanguageModel = field(default_factory=language_id.LanguageModel)
    temperature: float = 1.0
    threshold: float = 0.0
    by_language: tuple[tuple[str, float], ...] = ()

    def scores(self, logits: np.ndarray, langs: list[str]) -> np.ndarray:
        own = dict(self.by_language)
        t = np.array([own.get(x, self.threshold) for x in langs])
        return 1 / (1 + np.exp(-np.clip((logits - t) / self.temperature, -500, 500)))


def _language(text: str | None, model: language_id.LanguageModel) -> str:
    c = language_id.subword_counts(text) if model.langs else None
    return model.langs[int(model.probabilities(c / c.sum()).argmax())] if c is not None else language_id.UNKNOWN


def best_threshold(z: np.ndarray, y: np.ndarray, share: float, n: np.ndarray | None = None) -> float:
    """The logit from which on label 1 is answered with the best F1, if ``share`` of the
    rows have label 1: the middle of the gap between two neighbouring logits. ``y`` counts the
    rows of label 1 at a logit, ``n`` all rows there (one each, if not given)."""
    n = np.ones(len(z)) if n is None else n
    order = np.argsort(-z, kind="stable")
    z, y, n = z[order], y[order], n[order]
    hit = np.cumsum(y) / max(y.sum(), 1) * share
    false = np.cumsum(n - y) / max((n - y).sum(), 1) * (1 - share)
    f1 = 2 * hit / (hit + false + share)
    f1[:-1][z[:-1] == z[1:]] = -1  # equal logits get the same answer
    k = int(f1.argmax())
    return float((z[k] + z[k + 1]) / 2) if k + 1 < len(z) else float(z[k]) - 1.0


def _calibrate(model: ToxicityModel, z: np.ndarray, y: np.ndarray, langs: np.ndarray,
               n: np.ndarray | None = None) -> ToxicityModel:
    n = np.ones(len(z)) if n is None else n
    if not len(y) or not 0 < y.sum() < n.sum():
        return model
    model = replace(model, threshold=best_threshold(z, y, model.prior, n))
    own = tuple((x, best_threshold(z[at], y[at], model.prior, n[at])) for x in sorted(set(langs))
                if (at := langs == x) is not None and min(y[at].sum(), (n - y)[at].sum()) >= LEAST_PER_LANG)
    model = replace(model, by_language=own)
    hit, false = model.prior / y.sum() * y, (1 - model.prior) / (n - y).sum() * (n - y)
    best = (np.inf, 1.0)
    for t in np.geomspace(0.25, 10, 33):
        p = np.clip(replace(model, temperature=float(t)).scores(z, list(langs)), 1e-9, 1 - 1e-9)
        best = min(best, (float(-(hit * np.log(p) + false * np.log(1 - p)).sum()), float(t)))
    return replace(model, temperature=best[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", lang: str = "lang",
        id_col: str = "doc_id", learn_from: Column | None = None) -> ToxicityModel:
    """Fit on every distinct labelled row; ``learn_from`` is a condition on the id (column
    ``id``) and also bounds what the language model learns from."""
    known = training_labels(labels, label, id_col)
    if learn_from is not None:
        known = known.where(learn_from)
    known = materialize(known, "toxic-labels")
    shards = max(1, -(-known.count() // FIRST_ROWS))
    languages = language_id.fit_counts(docs, text, lang, id_col, learn_from)
    guess = F.arrow_udf(lambda ts: pa.array([_language(t, languages) for t in ts.to_pylist()], pa.string()), "string")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"), F.xxhash64(text).alias("digest"))
    if learn_from is not None:
        rows = rows.where(learn_from)
    draw = lambda m, k: hash63("id", "digest", F.lit(k)) % m
    apart = draw(5, 14) == 4
    # merged at any size: what a small table saves by a broadcast says nothing about a large one
    table = materialize(rows.join(known.hint("merge"), "id").dropDuplicates(["id", "digest"])
                        .withColumn("apart", apart).withColumn("first", draw(shards, 15) == 0)
                        .select(hash63("id", "digest", F.lit(13)).alias("key"), "y", "apart", "first",
                                _words("t").alias("words"), guess(F.when(F.col("apart"), F.col("t"))).alias("lang")),
                        "toxic-words")
    sizes = {(r["apart"], r["y"]): r["n"] for r in table.groupBy("apart", "y").agg(F.count("*").alias("n")).collect()}
    total, ones = sum(sizes.values()), sum(n for (_, y), n in sizes.items() if y)
    prior = (ones + 1) / (total + 2)
    good, bad = sizes.get((False, 0), 0), sizes.get((False, 1), 0)
    if not good or not bad:
        return ToxicityModel(prior)
    weights = ((good + bad) / (2 * good), (good + bad) / (2 * bad))
    use = table.where("not apart")
    first = use.where("first").repartition(1).sortWithinPartitions("key")  # only these rows meet in one task
    model = learned(first, Training.start(), weights, FIRST_EPOCHS, 13)
    for k in range(ROUNDS if shards > 1 else 0):
        model = learned(use, model, weights, 1, 14 + k)
    net = model.net

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = _lists(b.column(2))
            edges = np.cumsum([len(t) for t in texts]) // LOT_WORDS
            z = np.zeros(len(texts))
            for rows in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(edges)) + 1):
                if len(rows):
                    words, inverse = np.unique(np.concatenate([texts[k] for k in rows]), return_inverse=True)
                    size = np.array([len(texts[k]) for k in rows], np.int64)
                    z[rows] = net.logits(net.pooled_rows(words >> BITS, words & (BUCKETS - 1), inverse, size), size == 0)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(np.rint(z * GRID).astype(np.int64))],
                                  ["lang", "y", "z"])

    # by language and rounded logit, so that the driver gets as few rows for any number of documents
    got = (table.where("apart").select("lang", "y", "words").mapInArrow(read, "lang string, y int, z bigint")
           .groupBy("lang", "z").agg(F.sum("y").alias("y"), F.count("*").alias("n")).toPandas()
           .sort_values(["lang", "z"], kind="stable"))
    return _calibrate(ToxicityModel(prior, net, languages), got["z"].to_numpy(float) / GRID, got["y"].to_numpy(float),
                      got["lang"].to_numpy(str), got["n"].to_numpy(float))


def score(df: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with column ``out``: probability of label 1 (0 to 1)."""
    if model.net is None:
        return df.withColumn(out, F.lit(float(model.prior)))

    @F.arrow_udf("double")
    def read(texts: pa.Array) -> pa.Array:
        texts = as_strings(texts)
        res = np.zeros(len(texts))
        for i, j in byte_slices(texts, 1 << 20):
            data, at = utf8(texts, i, j)
            raw = data.tobytes()
            plain = raw.translate(_PLAIN)
            split = [plain[at[k]:at[k + 1]].split() for k in range(j - i)]
            number: dict[bytes, int] = {}
            inverse = np.fromiter((number.setdefault(w, len(number)) for ws in split for w in ws), np.int64)
            words = np.fromiter((word_hash(w) for w in number), np.int64, len(number))
            sizes = np.array([len(ws) for ws in split], np.int64)
            z = model.net.logits(model.net.pooled(words, inverse, sizes), sizes == 0)
            langs = [_language(raw[at[k]:at[k + 1]].decode("utf-8", "replace"), model.languages) for k in range(j - i)]
            res[i:j] = model.scores(z, langs)
        return pa.array(res)

    return df.withColumn(out, read(F.col(text)))
