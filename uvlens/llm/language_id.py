"""Language identification (operator 4): averaged hashed subword embeddings with
a linear softmax, trained by stochastic gradient descent in numpy, with
calibrated rejection.

A text is lower-cased and read as words of letters, each with a blank on either
side. Its subwords are all windows of 1 to 3 code points that have no blank
inside; each is hashed to one of ``BUCKETS`` rows of an embedding table. The text
vector is the mean of its subword vectors; a linear softmax gives the language.

Training rows are a bounded sample (about ``SAMPLE_ROWS``, at most a tenth more in expectation, spread evenly
over all languages by thresholds for a 63-bit hash of id and text, rows that repeat both
counting once), so a language of 10^12 rows brings as many as one of thousands. The executors
turn them into sparse subword counts; the driver
trains on these. A fifth of the sample is kept apart to fit the temperature of
the softmax and the confidence below which a prediction is marked rejected. ``max_langs``
bounds the languages to the most frequent ones if a caller asks for it.

Cases. Null text, or no letter: ``und`` with score 0. Any text with a letter gets
a learned language; ``rejected`` says whether its confidence is below the
calibrated bound. Nothing to learn from: ``und``, 0, rejected. Repeated rows are
predicted alike. Whole texts are read; memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, FloatType, IntegerType, StringType,
                               StructField, StructType)

from uvlens.llm.common import (MARGIN, VECTOR_PARTS, about_distinct, hash63, hash_bound, materialize, vector_parts,
                                vector_sums)

BUCKETS, DIM = 1 << 12, 16
SAMPLE_ROWS = 6_000
BROADCAST_LANGS = 100_000
UNKNOWN = "und"
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")
_MIX = [np.uint32(x) for x in (2654435761, 2246822519, 3266489917)]  # fixed odd multipliers
_PART = 1 << 20  # code points hashed at a time


def subword_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed subwords of a whole text (length BUCKETS); None
    without a letter."""
    if not text or not _LETTER.search(text):
        return None
    clean = " " + _NOT_LETTERS.sub(" ", text.lower()).strip(" ") + " "
    out = np.zeros(BUCKETS, np.int64)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    for i in range(0, len(clean), _PART):  # parts overlap by two code points
        c = np.frombuffer(clean[i:i + _PART + 2].encode("utf-32-le", "surrogatepass"), np.uint32)
        own = min(_PART, len(clean) - i)
        blank = c == 32
        for n in (1, 2, 3):
            m = min(own, len(c) - n + 1)
            if m <= 0:
                continue
            h = np.full(m, n * 40503, np.uint32)
            for k in range(n):
                h = (h ^ c[k:k + m]) * _MIX[k]
                h ^= h >> np.uint32(15)
            keep = ~blank[:m] if n == 1 else np.ones(m, bool) if n == 2 else ~blank[1:m + 1]
            h = h[keep] * _MIX[0]
            out += np.bincount(h >> shift, minlength=BUCKETS)
    return out


@F.arrow_udf(StructType([StructField("idx", ArrayType(IntegerType())), StructField("n", ArrayType(FloatType()))]))
def _sparse(texts: pa.Array) -> pa.Array:
    idx, n = [], []
    for t in texts.to_pylist():
        c = subword_counts(t)
        on = np.flatnonzero(c) if c is not None else None
        idx.append(on.astype(np.int32) if on is not None else None)
        n.append(c[on].astype(np.float32) if on is not None else None)
    return pa.StructArray.from_arrays([pa.array(idx, pa.list_(pa.int32())), pa.array(n, pa.list_(pa.float32()))],
                                      ["idx", "n"])


@dataclass(frozen=True)
class LanguageModel:
    langs: tuple[str, ...] = ()
    scores: np.ndarray | None = None  # BUCKETS x languages: embedding times output weights
    bias: np.ndarray | None = None
    temperature: float = 1.0
    reject_below: float = 1.0

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        z = (means @ self.scores + self.bias) / self.temperature
        z = np.exp(z - z.max(-1, keepdims=True))
        return z / z.sum(-1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, use: np.ndarray, langs: tuple[str, ...], epochs: int = 30,
          rate: float = 4.0, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """SGD on the embeddings and the softmax over the rows ``use`` of ``x`` (mean
    subword frequencies, float32). Returns (bucket scores, bias)."""
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.3, (BUCKETS, DIM)).astype(np.float32)
    w = rng.normal(0, 0.3, (DIM, len(langs))).astype(np.float32)
    b = np.zeros(len(langs), np.float32)
    weight = (len(use) / (len(langs) * np.maximum(np.bincount(y[use], minlength=len(langs)), 1))).astype(np.float32)
    for epoch in range(epochs):
        step = np.float32(rate * (1 - epoch / epochs))
        order = rng.permutation(use)
        for i in range(0, len(use), 32):
            rows = order[i:i + 32]
            xb, yb = x[rows], y[rows]
            h = xb @ e
            z = h @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), yb] -= 1
            p *= (weight[yb] / len(rows))[:, None]
            dh = p @ w.T
            w -= step * (h.T @ p)
            b -= step * p.sum(0)
            on = np.flatnonzero(xb.any(0))
            e[on] -= step * 50 * (xb[:, on].T @ dh)
    return (e @ w).astype(np.float64), b.astype(np.float64)


def _calibrate(model: LanguageModel, x: np.ndarray, y: np.ndarray, accept_error: float) -> LanguageModel:
    """Temperature by likelihood on held-apart rows; rejection bound: the lowest
    confidence from which on at most ``accept_error`` of the answers are wrong."""
    if not len(y):
        return LanguageModel(model.langs, model.scores, model.bias, 1.0, 0.5)
    best = (np.inf, 1.0)
    for t in np.geomspace(0.1, 10, 41):
        p = LanguageModel(model.langs, model.scores, model.bias, float(t)).probabilities(x)
        loss = -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()
        best = min(best, (float(loss), float(t)))
    fit = LanguageModel(model.langs, model.scores, model.bias, best[1])
    p = fit.probabilities(x)
    conf, wrong = p.max(1), p.argmax(1) != y
    order = np.argsort(-conf, kind="stable")
    rate = np.cumsum(wrong[order]) / np.arange(1, len(y) + 1)
    ok = np.flatnonzero(rate <= accept_error)
    bound = float(conf[order][ok[-1]]) if len(ok) else 1.0
    return LanguageModel(fit.langs, fit.scores, fit.bias, fit.temperature, min(bound, 0.9))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
        learn_from: Column | None = None, sample_rows: int = SAMPLE_ROWS,
        accept_error: float = 0.01, max_langs: int | None = None) -> LanguageModel:
    """Train on about ``sample_rows`` distinct rows with text, language and id."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"), F.col(lang).alias("lang"),
                        F.xxhash64(text).alias("digest"))
    known = known.where("t is not null and lang is not null and id is not null")
    if learn_from is not None:
        known = known.where(learn_from)
    sizes = known.groupBy("lang").agg(about_distinct("id", "digest").alias("n"))
    if max_langs is not None:
        sizes = sizes.orderBy(F.desc("n"), "lang").limit(max_langs)
    sizes = materialize(sizes, "languages", 1)
    langs = sizes.count()
    if not langs:
        return LanguageModel()
    # per language a hash threshold: no sort, no window, the same rows in any run
    bounds = sizes.select("lang", hash_bound(F.lit(MARGIN * sample_rows / langs) / F.col("n")).alias("bound"))
    picked = (known.join(F.broadcast(bounds) if langs <= BROADCAST_LANGS else bounds, "lang")
              .where(hash63("id", "digest", F.lit(4)) <= F.col("bound")).dropDuplicates(["id", "lang", "digest"]))
    rows = (picked.select("id", "lang", _sparse("t").alias("c")).where("c.idx is not null")
            .select("id", "lang", "c.idx", "c.n").toPandas())
    if not len(rows):
        return LanguageModel()
    rows["sum"] = [float(np.sum(n)) for n in rows["n"]]
    rows = rows.sort_values(["id", "lang", "sum"], kind="stable").reset_index(drop=True)
    langs = tuple(sorted(rows["lang"].unique()))
    y = np.searchsorted(langs, rows["lang"].to_numpy(str)).astype(np.int64)
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for k, (idx, n) in enumerate(zip(rows["idx"], rows["n"])):
        x[k, idx] = n / np.sum(n)
    apart = np.arange(len(y)) % 5 == 4
    if len(y) < 50:
        apart[:] = False
    del rows
    scores, bias = train(x, y, np.flatnonzero(~apart), langs)
    return _calibrate(LanguageModel(langs, scores, bias), x[apart], y[apart], accept_error)


def fit_counts(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
               learn_from: Column | None = None) -> LanguageModel:
    """A multinomial model from the subword counts of every row with text, language and id:
    counts are added up by task and language, then over all tasks. A language is as likely as
    any other beforehand."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"), F.col(lang).alias("lang"))
    known = known.where("t is not null and lang is not null and id is not null")
    if learn_from is not None:
        known = known.where(learn_from)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for x, t in zip(b.column(0).to_pylist(), b.column(1)):
                c = subword_counts(t.as_py())
                if c is not None:
                    sums[x] = sums[x] + c if x in sums else c
                    if len(sums) > 1_000:
                        yield from (vector_parts(k, v) for k, v in sums.items())
                        sums.clear()
        yield from (vector_parts(k, v) for k, v in sums.items())

    sums = vector_sums(known.select("lang", "t").mapInArrow(count, VECTOR_PARTS))
    if not sums:
        return LanguageModel()
    n = np.stack(list(sums.values()), 1) + 0.5
    return LanguageModel(tuple(sums), np.log(n / n.sum(0)), np.zeros(len(sums)))


def predict(df: DataFrame, model: LanguageModel, text: str = "text", out: str = "language") -> DataFrame:
    """``df`` with struct column ``out``: lang_pred, score (confidence, 0 to 1),
    rejected."""
    kind = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                       StructField("rejected", BooleanType())])

    @F.arrow_udf(kind)
    def guess(texts: pa.Array) -> pa.Array:
        lang, score = [], np.zeros(len(texts))
        for k, t in enumerate(texts):
            c = subword_counts(t.as_py()) if model.langs else None
            if c is None:
                lang.append(UNKNOWN)
                continue
            p = model.probabilities(c / c.sum())
            best = int(p.argmax())
            lang.append(model.langs[best])
            score[k] = min(max(float(p[best]), 0.0), 1.0)
        rejected = (score < model.reject_below) | (pd.array(lang) == UNKNOWN)
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score), pa.array(np.asarray(rejected, bool))],
            ["lang_pred", "score", "rejected"])

    return df.withColumn(out, guess(F.col(text)))
