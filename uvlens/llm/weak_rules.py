"""Quality rules by weak supervision (operator 3).

Each rule looks at the statistics of one text and votes good (+1), bad (-1) or
abstains (0). Nothing says how reliable a rule is; expectation-maximisation
estimates, from the votes of all documents, how often each rule votes bad on
good documents and on each kind of junk (abstentions carry no evidence). The
posterior probability of "good" then replaces the all-must-pass filter.

Only the distinct vote patterns matter to EM. There are at most 3^rules of them
(``MAX_RULES`` bounds that), so the corpus is reduced to pattern counts by one
aggregate with map-side combine, EM runs on those counts, and the posterior is a
closed-form Spark expression over the votes: no text or id leaves the executors.

Cases. Null or empty text: no words, every count 0, base rules fail, not kept.
Null ids and repeated rows: each row is judged by its own text. Empty table: no
patterns, the starting accuracies stay. Extra columns are passed through; helper
columns get names that are free.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uvlens.llm.common import fresh
from uvlens.llm.textstats import with_stats

MAX_RULES = 9  # at most 3^9 = 19,683 vote patterns reach the driver
MIN_WORDS = 50


@dataclass(frozen=True)
class Rule:
    """Votes bad from ``bad`` on (in the direction away from ``good``), good up
    to ``good``, and abstains between; abstains below ``min_base`` of ``base``,
    where a ratio means little."""

    name: str
    top: str
    base: str
    good: float
    bad: float
    min_base: int = 20

    def vote(self, stats: Column) -> Column:
        base = stats[self.base]
        ratio = stats[self.top] / F.greatest(base, F.lit(1)).cast("double")
        high = self.bad > self.good
        is_bad = ratio >= self.bad if high else ratio <= self.bad
        is_good = ratio <= self.good if high else ratio >= self.good
        return (F.when(base < self.min_base, 0).when(is_bad, -1).when(is_good, 1)
                .otherwise(0).cast("int"))


# Thresholds of the voting rules (ratio of two statistics).
RULES = (
    Rule("symbols", "n_symbols", "n_words", 0.02, 0.10),
    Rule("dup_lines", "n_dup_lines", "n_lines", 0.15, 0.30, 4),
    Rule("repeat_words", "n_repeat_words", "n_words", 0.25, 0.50),
    Rule("capitals", "n_upper", "word_chars", 0.15, 0.40),
    Rule("digits", "n_digits", "word_chars", 0.10, 0.30),
    Rule("marks", "n_marks", "n_words", 0.40, 0.80),
    Rule("bangs", "n_bangs", "n_words", 0.05, 0.30),
    Rule("long_words", "word_chars", "n_words", 9.0, 14.0),
    Rule("variety", "n_distinct_words", "n_words", 0.15, 0.05, 100),
)


@dataclass(frozen=True)
class LabelModel:
    """Latent kinds of document: kind 0 is good, kind 1 + k is junk of the sort
    that rule k is meant to find. ``share[c]`` is P(kind c) and ``bad[c][j]`` is
    P(rule j votes bad | kind c, it votes)."""

    share: tuple[float, ...]
    bad: tuple[tuple[float, ...], ...]

    def accuracies(self) -> list[tuple[float, float]]:
        """Per rule: P(votes good | good), P(votes bad | junk of any kind)."""
        junk = np.array(self.share[1:])
        on_junk = junk @ np.array(self.bad[1:]) / junk.sum()
        return [(1 - g, float(b)) for g, b in zip(self.bad[0], on_junk)]

    def posterior(self, votes: Column) -> Column:
        """P(good | votes) as a Spark expression; ``votes`` is array<int>.

        P(good) = 1 / (1 + sum over junk kinds of P(kind, votes) / P(good, votes))."""
        arr = lambda xs: F.array(*[F.lit(float(x)) for x in xs])
        good = np.array(self.bad[0])
        kinds = F.array(*[F.struct(
            F.lit(float(np.log(self.share[c] / self.share[0]))).alias("base"),
            arr(np.log1p(-np.array(self.bad[c])) - np.log1p(-good)).alias("passed"),
            arr(np.log(self.bad[c]) - np.log(good)).alias("failed"))
            for c in range(1, len(self.share))])

        def log_odds(kind: Column) -> Column:
            evidence = F.transform(votes, lambda v, j: F.when(v == -1, F.get(kind["failed"], j))
                                   .when(v == 1, F.get(kind["passed"], j)).otherwise(F.lit(0.0)))
            return F.aggregate(evidence, kind["base"], lambda x, e: x + e)

        return 1 / (1 + F.aggregate(kinds, F.lit(0.0), lambda x, k: x + F.exp(log_odds(k))))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500,
                    tol: float = 1e-9) -> LabelModel:
    """EM over vote patterns (rows of -1/0/1) weighted by their counts.

    Junk comes in kinds that different rules find (symbols, repeats, capitals...),
    and a document of one kind passes most other rules; with a single "bad" class
    EM would spend it on the most frequent kind and call the others good. So each
    rule opens one junk kind, and EM estimates the shares and how every rule votes
    on every kind. Beta pseudo-counts stand in where a rule votes too rarely to
    tell: 0.5 % bad votes on good documents, 90 % on the rule's own kind of junk,
    5 % on the other kinds. Bad votes on good documents stay under 5 %: a rule
    that fires more often describes a kind of its own."""
    n = patterns.shape[1]
    bad, voted = patterns == -1, patterns != 0
    start = np.full((n + 1, n), 0.05)
    start[0] = 0.005
    start[np.arange(1, n + 1), np.arange(n)] = 0.90
    strength = np.full((n + 1, 1), 20.0)
    strength[0] = 200.0
    first_share = np.array([0.9] + [0.1 / n] * n)
    share, theta, last = first_share, start, None
    total = counts.sum()
    for _ in range(rounds if total else 0):
        log_p = (np.log(share) + bad @ np.log(theta).T + (voted & ~bad) @ np.log1p(-theta).T)
        log_p -= log_p.max(1, keepdims=True)
        p = np.exp(log_p)
        p *= (counts / p.sum(1))[:, None]
        share = (p.sum(0) + 10 * first_share) / (total + 10)
        theta = (p.T @ bad + start * strength) / (p.T @ voted + strength)
        theta = np.clip(theta, 1e-5, 1 - 1e-5)
        theta[0] = np.minimum(theta[0], 0.05)
        now = np.concatenate([share, theta.ravel()])
        if last is not None and np.abs(now - last).max() < tol:
            break
        last = now
    return LabelModel(tuple(map(float, share)), tuple(tuple(map(float, t)) for t in theta))


def votes_of(stats: Column, rules=RULES) -> Column:
    return F.array(*[r.vote(stats) for r in rules])


def fit(voted: DataFrame, votes: str, n_rules: int) -> LabelModel:
    """Label model of a DataFrame with a votes column: one aggregate to the
    pattern counts, then EM on at most 3^n_rules rows."""
    if n_rules > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules, got {n_rules}")
    code = F.lit(0)
    for k in range(n_rules):
        code = code * 3 + (F.col(votes)[k] + 1)
    rows = voted.groupBy(code.alias("code")).count().collect()
    patterns = np.array([[r["code"] // 3 ** (n_rules - 1 - k) % 3 - 1 for k in range(n_rules)]
                         for r in rows], int).reshape(len(rows), n_rules)
    return fit_label_model(patterns, np.array([r["count"] for r in rows], float))


def vote(df: DataFrame, text: str = "text", rules=RULES, prefix: str = "rule_") -> DataFrame:
    """``df`` with ``<prefix>stats`` (struct) and ``<prefix>votes`` (array<int>), the one
    pass over the texts."""
    stats = fresh(df, prefix + "stats")
    return with_stats(df, text, stats).withColumn(fresh(df, prefix + "votes"), votes_of(F.col(stats), rules))


def decide(voted: DataFrame, stats: str = "rule_stats", votes: str = "rule_votes", n_rules: int = len(RULES),
           threshold: float = 0.5, prefix: str = "rule_", model: LabelModel | None = None) -> DataFrame:
    """``voted`` with ``<prefix>base_failed``, ``<prefix>p_good`` (posterior) and
    ``<prefix>kept``. The model is fitted on the votes of all rows unless given; a table
    of ``vote`` that was written first is then read twice instead of judged twice."""
    if model is None:
        model = fit(voted, votes, n_rules)
    s = F.col(stats)
    failed, p_good = fresh(voted, prefix + "base_failed"), fresh(voted, prefix + "p_good")
    return (voted.withColumn(failed, (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > 50 * s["n_words"]))
            .withColumn(p_good, model.posterior(F.col(votes)))
            .withColumn(fresh(voted, prefix + "kept"), ~F.col(failed) & (F.col(p_good) >= threshold)))


def judge(df: DataFrame, text: str = "text", rules=RULES, threshold: float = 0.5,
          prefix: str = "rule_", model: LabelModel | None = None) -> DataFrame:
    """``df`` with the columns of ``vote`` and ``decide``.

    Base rules are hard: fewer than 50 words, or more than half of the words in
    repeated 3-word windows. ``kept`` is false for these, else the posterior's
    verdict."""
    return decide(vote(df, text, rules, prefix), fresh(df, prefix + "stats"), fresh(df, prefix + "votes"),
                  len(rules), threshold, prefix, model)
