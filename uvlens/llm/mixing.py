"""Mixing sources to target weights by Poisson replication (operator 7, native).

Every source has a mean repetition rate; every document draws its number of
copies from a Poisson distribution with that mean, by inverting the distribution
at a uniform number seeded by a hash of its id and text. The document is exploded by its
count and the copies are dealt out by a hash of (id, text, copy): a global shuffle.

The draw depends on nothing but id, text and seed, so a lost task redraws the same
counts, and rows without an id, or with one and the same id, draw apart. Rates come from one aggregate by source, reduced to the sources that the
weights name plus one row for all others (a bounded collect). No join and no
window: a source that holds a third of all rows is handled like any other, and
the only exchange is that of the final shuffle.

A rate above ``STEP`` is split into equal parts that are drawn apart (a sum of
Poisson variables is Poisson), so the distribution tables stay short and exp(-rate)
never underflows.

Cases. Null or unnamed sources share the weight ``other``. A source with weight 0
gets no copies. Null ids draw by their text; rows that repeat both id and text are one
document to the draw: they get equal counts and equal keys. Empty texts are mixed like others.
A table without a text column is drawn by id alone. Empty table: empty result. Extra columns are kept; ``copy`` and ``shuffle_key`` get free names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uvlens.llm.common import fresh

STEP = 8.0  # largest rate drawn from one distribution table
OTHER = "other"


def rates(counts: dict[str, float], weights: dict[str, float], total: float) -> dict[str, float]:
    """Mean repetitions per document: the target share of ``total`` output
    documents over the source's own documents. Sources without rows take no
    share; the weights of the others are scaled to 1."""
    live = {s: w for s, w in weights.items() if counts.get(s, 0) > 0 and w > 0}
    whole = sum(live.values())
    return {s: (total * live[s] / whole / counts[s] if s in live else 0.0) for s in weights}


def poisson_table(rate: float) -> list[float]:
    """P(N <= k) for k = 0, 1, ... until it no longer grows."""
    p = math.exp(-rate)
    table, k, total = [p], 0, p
    while True:
        k += 1
        p = p * rate / k
        if k > rate and total + p <= total:
            return table
        total += p
        table.append(total)


def identity(df: DataFrame, id_col: str, text: str) -> Column:
    """What a row is drawn by: its id and the md5 of its text."""
    own = [F.coalesce(F.col(id_col).cast("string"), F.lit(""))]
    if text in df.columns:
        own.append(F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return F.concat_ws("#", *own)


def uniform(who: Column, seed: int, part: int) -> Column:
    """A number in [0, 1) from the first 52 bits of md5(identity, seed, part)."""
    key = F.concat_ws("#", who, F.lit(str(seed)), F.lit(str(part)))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(2**52)


def draw(who: Column, rate: float, seed: int) -> Column:
    """Poisson count with mean ``rate``: for each part the number of table
    entries at or below the uniform number."""
    parts = max(1, math.ceil(rate / STEP))
    if rate <= 0:
        return F.lit(0)
    table = F.array(*[F.lit(x) for x in poisson_table(rate / parts)])
    count = F.lit(0)
    for k in range(parts):
        u = F.array(uniform(who, seed, k))  # one-element array: hashed once, not once per table entry
        count = count + F.aggregate(u, F.lit(0), lambda n, x: n + F.size(F.filter(table, lambda c: c <= x)))
    return count


def mix(df: DataFrame, weights: dict[str, float], total: float | None = None, seed: int = 17,
        id_col: str = "doc_id", source: str = "source", text: str = "text", shuffle: bool = True,
        copy: str = "copy", shuffle_key: str = "shuffle_key") -> DataFrame:
    """Copies of the rows of ``df`` by target weights (source -> share of the
    output; ``other`` for all sources not named). ``total``: expected number of
    output documents (default: as many as there are rows with a positive weight).
    Adds ``copy`` (from 1) and ``shuffle_key`` (hash by which copies are dealt
    out and ordered within their partition)."""
    named = [s for s in weights if s != OTHER]
    bucket = F.when(F.col(source).isin(named), F.col(source)).otherwise(F.lit(OTHER)) if named else F.lit(OTHER)
    counts = {r["s"]: r["n"] for r in df.groupBy(bucket.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if total is None:
        total = sum(n for s, n in counts.items() if weights.get(s, 0) > 0)
    rate = rates(counts, weights, total)
    copy, key = fresh(df, copy), fresh(df, shuffle_key)
    n_col, who_col = fresh(df, "_repetitions"), fresh(df, "_identity")
    who, n = F.col(who_col), F.lit(0)
    for s in weights:
        if s != OTHER:
            n = F.when(F.col(source) == s, draw(who, rate[s], seed)).otherwise(n)
    if OTHER in weights:
        other = draw(who, rate[OTHER], seed)
        n = F.when(F.coalesce(F.col(source).isin(named), F.lit(False)), n).otherwise(other) if named else other
    out = (df.withColumn(who_col, identity(df, id_col, text)).withColumn(n_col, n).where(F.col(n_col) > 0)
           .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n_col)))).drop(n_col)
           .withColumn(key, F.md5(F.concat_ws("#", who, F.col(copy).cast("string"), F.lit(f"s{seed}")))).drop(who_col))
    if shuffle:
        out = out.repartition(F.col(key)).sortWithinPartitions(key)
    return out
