"""Quality classifier: a sparse rule ensemble (operator 9).

1. Text statistics (``textstats``) and their ratios are the only inputs.
2. Shallow boosted trees are grown in numpy on a bounded sample of labelled rows.
3. Every path from a root to a node becomes a conjunctive rule
   (``ratio <= cut and ...``); lasso logistic regression on the 0/1 rule matrix
   keeps a few of them.
4. The kept rules and weights are compiled into one Spark expression, so scoring
   runs over all rows inside the JVM, once the statistics are there.

``SAMPLE_ROWS`` bounds the rows that are learned from (in expectation: rows are
taken by a hash of id and text against a threshold derived from the number of labelled
rows, equal rows counting once). Only their statistics reach the driver, so no id
brings more than its share, however many rows repeat it.

Cases. Null and empty texts have statistics 0 and get a score like any other row.
Labels: rows without id or label are ignored; a document whose labels contradict
each other is not learned from; repeated equal labels count once, as do rows that repeat an
id and its text; an id with several texts is learned from with each. With no label,
or one class only, the score is the smoothed share of label 1 (0.5 without
labels). Repeated documents are scored alike. Extra columns are passed through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uvlens.llm.common import MARGIN, about_distinct, fresh, hash_below
from uvlens.llm.textstats import with_stats

SAMPLE_ROWS = 20_000
TREES, DEPTH, CUTS, MIN_LEAF = 24, 3, 24, 8

# name -> (numerator, denominator): fixed list of inputs.
RATIOS = {
    "words": ("n_words", None),
    "symbols_per_word": ("n_symbols", "n_words"),
    "word_length": ("word_chars", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "capital_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "ends_per_word": ("n_ends", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "bangs_per_word": ("n_bangs", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "blank_share": ("word_chars", "n_chars"),
    "longest_word": ("n_longest", None),
}


def features(stats: Column) -> list[Column]:
    """The inputs as Spark expressions (0 where a denominator is 0)."""
    out = []
    for name, (top, base) in RATIOS.items():
        x = stats[top].cast("double")
        out.append((F.when(stats[base] > 0, x / stats[base]).otherwise(F.lit(0.0)) if base else x).alias(name))
    return out


@dataclass(frozen=True)
class Condition:
    feature: int
    cut: float
    below: bool  # x <= cut, else x > cut

    def holds(self, x: np.ndarray) -> np.ndarray:
        return (x[:, self.feature] <= self.cut) == self.below

    def column(self, cols: list[Column]) -> Column:
        c = cols[self.feature]
        return c <= self.cut if self.below else c > self.cut


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[tuple[Condition, ...], ...] = ()
    weights: tuple[float, ...] = ()

    def score(self, cols: list[Column]) -> Column:
        z = F.lit(float(self.bias))
        for rule, w in zip(self.rules, self.weights):
            hit = rule[0].column(cols)
            for c in rule[1:]:
                hit = hit & c.column(cols)
            z = z + F.when(hit, F.lit(float(w))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))

    def score_numpy(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for rule, w in zip(self.rules, self.weights):
            z += w * np.logical_and.reduce([c.holds(x) for c in rule])
        return 1 / (1 + np.exp(-z))


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    """Candidate cuts of each feature: midpoints between distinct quantiles."""
    out = []
    for k in range(x.shape[1]):
        q = np.unique(np.quantile(x[:, k], np.linspace(0, 1, CUTS + 1)))
        tails = np.unique(np.quantile(x[:, k], [0.002, 0.005, 0.01, 0.02, 0.98, 0.99, 0.995, 0.998]))
        q = np.unique(np.concatenate([q, tails]))
        out.append((q[1:] + q[:-1]) / 2)
    return out


def _grow(bins: list[np.ndarray], cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray,
          rows: np.ndarray, path: tuple[Condition, ...], found: list, step: np.ndarray) -> None:
    """One regression tree on gradients; collects the path to every node and adds
    the leaf values to ``step``."""
    best = None
    if len(path) < DEPTH and len(rows) >= 2 * MIN_LEAF:
        g_all, h_all = grad[rows].sum(), hess[rows].sum()
        for f, cut in enumerate(cuts):
            if not len(cut):
                continue
            b = bins[f][rows]
            g = np.bincount(b, grad[rows], len(cut) + 1).cumsum()[:-1]
            h = np.bincount(b, hess[rows], len(cut) + 1).cumsum()[:-1]
            n = np.bincount(b, minlength=len(cut) + 1).cumsum()[:-1]
            gain = g**2 / (h + 1) + (g_all - g)**2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
            gain[(n < MIN_LEAF) | (len(rows) - n < MIN_LEAF)] = -1
            k = int(gain.argmax())
            if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                best = (gain[k], f, k)
    if best is None:
        step[rows] += 0.3 * -grad[rows].sum() / (hess[rows].sum() + 1)
        return
    _, f, k = best
    low = bins[f][rows] <= k
    for below, part in ((True, rows[low]), (False, rows[~low])):
        p = (*path, Condition(f, float(cuts[f][k]), below))
        found.append(p)
        _grow(bins, cuts, grad, hess, part, p, found, step)


def _lasso(m: np.ndarray, y: np.ndarray, lam: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """L1 logistic regression by accelerated proximal gradient; the bias is free."""
    n = len(y)
    a = np.hstack([np.ones((n, 1)), m])
    size = 0.25 * np.linalg.norm(a.T @ a / n, 2)
    w = z = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(rounds):
        g = a.T @ (1 / (1 + np.exp(-(a @ z))) - y) / n
        new = z - g / size
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - lam / size, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t2 * (new - w)
        w, t = new, t2
    return float(w[0]), w[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, lam: float = 0.0008) -> RuleModel:
    """Rule ensemble of a feature matrix and 0/1 labels."""
    n, ones = len(y), float(y.sum())
    share = (ones + 1) / (n + 2)
    if not n or ones in (0, n) or n < 4 * MIN_LEAF:
        return RuleModel(float(np.log(share / (1 - share))))
    cuts = _cuts(x)
    bins = [np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)]
    z = np.full(n, np.log(share / (1 - share)))
    found: list[tuple[Condition, ...]] = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        step = np.zeros(n)
        _grow(bins, cuts, p - y, p * (1 - p), np.arange(n), (), found, step)
        z += step
    rules = list(dict.fromkeys(tuple(sorted(r, key=lambda c: (c.feature, c.cut, c.below))) for r in found))
    m = np.array([np.logical_and.reduce([c.holds(x) for c in r]) for r in rules], float).T
    # rules that fire on the same rows say the same: keep the shortest of them
    order = sorted(range(len(rules)), key=lambda k: len(rules[k]))
    seen: dict[bytes, int] = {}
    for k in order:
        seen.setdefault(np.packbits(m[:, k].astype(bool)).tobytes(), k)
    keep = sorted(seen.values())
    bias, w = _lasso(m[:, keep], y, lam)
    on = [k for k in range(len(keep)) if abs(w[k]) > 1e-4]
    return RuleModel(bias, tuple(rules[keep[k]] for k in on), tuple(float(w[k]) for k in on))


def training_labels(labels: DataFrame, label: str, id_col: str) -> DataFrame:
    """One 0/1 label per id; ids with contradicting labels are left out."""
    y = F.col(label).cast("int")
    return (labels.where(F.col(id_col).isNotNull() & y.isin(0, 1))
            .groupBy(F.col(id_col).alias("id")).agg(F.min(y).alias("y"), F.max(y).alias("hi"))
            .where("y = hi").select("id", "y"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text",
        id_col: str = "doc_id", learn_from: Column | None = None,
        sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Fit on about ``sample_rows`` distinct labelled rows; ``learn_from`` is a
    condition on the label table's id column (``id``)."""
    known = training_labels(labels, label, id_col)
    if learn_from is not None:
        known = known.where(learn_from)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"), F.xxhash64(text).alias("digest"))
    total = known.join(rows.select("id", "digest"), "id").agg(about_distinct("id", "digest").alias("n")).first()["n"]
    # a hash threshold, not a limit: no sort, and the same rows in any run
    picked = rows.where(hash_below(MARGIN * sample_rows / max(total, 1), "id", "digest", F.lit(9)))
    rows = picked.join(known, "id").dropDuplicates(["id", "digest"])
    got = with_stats(rows, "t", "s").select("y", *features(F.col("s"))).toPandas()
    x = got[list(RATIOS)].to_numpy(float).reshape(len(got), len(RATIOS))
    order = np.lexsort([*x.T, got["y"].to_numpy()])  # the same order in any run
    return fit_rules(x[order], got["y"].to_numpy(float)[order])


def score(df: DataFrame, model: RuleModel, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with column ``out``: probability of label 1 (0 to 1)."""
    stats = fresh(df, "_stats")
    feats = fresh(df, "_features")
    scored = (with_stats(df, text, stats)
              .withColumn(feats, F.struct(*features(F.col(stats)))))
    cols = [F.col(feats)[name] for name in RATIOS]
    return scored.withColumn(out, model.score(cols)).drop(stats, feats)
