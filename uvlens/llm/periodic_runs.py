"""Periodic run detection (operator 12): multi-scale minimizers.

A text is its words (``[^\\x20\\x09-\\x0D]+``), numbered from 0. A run is a stretch of
consecutive words with smallest period q (words q apart are identical), at least
``max(least, times * q)`` words long, that no neighbouring word extends keeping q.

Method. Periods up to ``SHORT`` are found by direct scans: words are compared with the
words one lag later, and long stretches of equal ones are runs. Longer periods are
treated by scales; a scale covers the periods in (lo, Q] with Q = 4/3 lo. Every stretch
of Q words is hashed, and the minima of all windows of w such hashes are kept. Inside a
run of period q the windows at i and i + q hold the same hashes, so a minimum at p comes
back at p + q; as Q >= q, the Q-word stretches of one period all differ, so no equal
hash lies between them. With w = (times - 1) * (lo + 1) - Q + 1, a run of the smallest
allowed length holds two such windows. So every run of the scale shows up as two
neighbours among the equal minima, q apart. These seeds are extended word by word in
both directions; only exact extension decides, hashes merely propose. Stretches with
the same ends under several periods are one run, that of the smallest period (by Fine
and Wilf, the smallest period of a stretch of three periods divides all the others).

Texts are handled in slices of some megabytes: the words of many texts lie in one
array, parted by values that occur once. A text is never cut; memory is bounded by one
Arrow batch plus the longest single text. Rows are independent: there is no shuffle,
no key and nothing to skew, and a lost executor costs its own rows only.

Cases. Null or empty text, or no word: no runs, collapsed text ''. Texts shorter than
``least`` words have none either. Repeated rows give equal results; ids are not read, so null or
repeated ids do not matter. Extra columns are kept; ``out`` replaces a column of that
name (callers pick a free one with ``common.fresh``). Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from uvlens.llm.common import as_strings, byte_slices, utf8

SHORT, LEAST, TIMES = 16, 24, 3
RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])
RESULT = StructType([StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())])
Run = tuple[int, int, int]  # start, length, period

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hashes of two neighbouring (or overlapping) stretches as one hash."""
    h = x * _C1
    h ^= y
    h ^= h >> np.uint64(29)
    h *= _C2
    h ^= h >> np.uint64(32)
    return h


def _sliding(x: np.ndarray, w: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) of all windows of ``w`` values, by doubling."""
    have = 1
    while 2 * have <= w:
        x = pick(x[:-have], x[have:])
        have *= 2
    rest = w - have
    return pick(x[:-rest], x[rest:]) if rest else x


def _equal_stretches(a: np.ndarray, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal stretches of ``a`` with period ``q`` that
    are ``least`` long or longer."""
    t = np.flatnonzero(a[q:] == a[:-q])
    m = least - q
    if len(t) < m or not (t[m - 1:] - t[:len(t) - m + 1] == m - 1).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero(np.diff(t) != 1)
    first, last = t[np.r_[0, cut + 1]], t[np.r_[cut, len(t) - 1]]
    long = last - first + 1 >= m
    return first[long], last[long] - first[long] + 1 + q


def _extended(a: np.ndarray, p: int, q: int) -> tuple[int, int]:
    """Start and length of the maximal stretch with period ``q`` around ``p``."""
    lo, step = p, 64
    while lo > 0:
        i = max(lo - step, 0)
        bad = np.flatnonzero(a[i:lo] != a[i + q:lo + q])
        if len(bad):
            lo = i + int(bad[-1]) + 1
            break
        lo, step = i, step * 2
    hi, step, end = p, 64, len(a) - q
    while hi < end:
        j = min(hi + step, end)
        bad = np.flatnonzero(a[hi:j] != a[hi + q:j + q])
        if len(bad):
            hi += int(bad[0])
            break
        hi, step = j, step * 2
    return lo, hi - lo + q


def seeds(grams: np.ndarray, w: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances (lo < distance <= hi) of neighbours among the equal
    window minima of ``grams``, windows of ``w`` values."""
    if len(grams) < w:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = _sliding(grams, w, np.minimum)
    edge = np.zeros(w - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate([edge, low, edge]), w, np.maximum) == grams)
    at = at[np.argsort(grams[at], kind="stable")]
    far = at[1:] - at[:-1]
    on = np.flatnonzero((grams[at[1:]] == grams[at[:-1]]) & (far > lo) & (far <= hi))
    return at[on], far[on]


def runs_of(words: np.ndarray, sizes: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[list[Run]]:
    """Runs of every text, by start and period. ``words`` holds the word numbers
    (0 or more) of all texts one after the other, ``sizes`` the texts' lengths."""
    if times < 3:
        raise ValueError("runs hold three periods or more")
    found: list[dict[tuple[int, int], int]] = [{} for _ in sizes]

    def add(starts: np.ndarray, p: int, length: int, q: int) -> None:
        if length >= max(least, times * q):
            k = int(np.searchsorted(starts, p, side="right")) - 1
            span = (p - int(starts[k]), length)
            kept = found[texts[k]]
            kept[span] = min(q, kept.get(span, q))

    # texts that can hold a run, each followed by a value of its own
    texts = np.flatnonzero(sizes >= max(least, times))
    n = sizes[texts]
    begin = np.concatenate([[0], np.cumsum(sizes)])[texts]
    starts = np.concatenate([[0], np.cumsum(n + 1)])[:-1].astype(np.int64)
    a = np.empty(int((n + 1).sum()), np.int64)
    a[starts + n] = -1 - np.arange(len(texts))
    for k in range(len(texts)):
        a[starts[k]:starts[k] + n[k]] = words[begin[k]:begin[k] + n[k]]

    # short periods: direct scans
    for q in range(1, min(SHORT, int(n.max(initial=0)) // times) + 1):
        for p, length in zip(*_equal_stretches(a, q, max(least, times * q))):
            add(starts, int(p), int(length), q)

    # longer periods: scales of minimizers
    lo, level = SHORT, 1
    h = _joined(a.astype(np.uint64), np.full(len(a), _C2))
    while True:
        stay = n >= times * (lo + 1)
        if not stay.any():
            break
        if not stay.all():
            mask = np.repeat(stay, n + 1)
            h = h[mask[:len(h)]]  # stretches that reach past a text hold its mark, as before
            a, texts, n = a[mask], texts[stay], n[stay]
            starts = np.concatenate([[0], np.cumsum(n + 1)])[:-1].astype(np.int64)
        hi = lo * 4 // 3
        while 2 * level <= hi:
            h, level = _joined(h[:-level], h[level:]), 2 * level
        rest = hi - level
        p, far = seeds(_joined(h[:-rest], h[rest:]) if rest else h, (times - 1) * (lo + 1) - hi + 1, lo, hi)
        seen = (0, -1)  # distance and end of the last stretch
        for k in np.lexsort([p, far]):
            i, q = int(p[k]), int(far[k])
            if (q, i) < seen:
                continue
            start, length = _extended(a, i, q)
            add(starts, start, length, q)
            seen = (q, start + length - q)
        lo = hi
    return [sorted((s, length, q) for (s, length), q in kept.items()) for kept in found]


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that a run holds after its first period, joined by blanks."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        drop[start + q] += 1
        drop[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(drop)[:-1] == 0)])


def _detector(least: int, times: int):
    @F.arrow_udf(RESULT)
    def detect(texts: pa.Array) -> pa.Array:
        texts = as_strings(texts)
        counts: list[int] = []
        flat: list[Run] = []
        clean: list[str] = []
        for i, j in byte_slices(texts, 1 << 21):
            data, at = utf8(texts, i, j)
            raw = data.tobytes()
            split = [raw[at[k]:at[k + 1]].split() for k in range(j - i)]
            number: dict[bytes, int] = {}
            ids = np.fromiter((number.setdefault(w, len(number)) for ws in split for w in ws), np.int64)
            got = runs_of(ids, np.array([len(ws) for ws in split], np.int64), least, times)
            for ws, runs in zip(split, got):
                counts.append(len(runs))
                flat.extend(runs)
                clean.append(collapse(ws, runs).decode("utf-8", "replace"))
        cols = np.array(flat, np.int64).reshape(-1, 3)
        runs = pa.StructArray.from_arrays([pa.array(cols[:, c]) for c in range(3)], RUN.names)
        off = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(off, runs), pa.array(clean, pa.string())],
                                          RESULT.names)
    return detect


def with_runs(df: DataFrame, text: str | Column = "text", out: str = "periodic", least: int = LEAST,
              times: int = TIMES) -> DataFrame:
    """``df`` with struct column ``out``: ``runs`` (array of start, length, period, by
    start and period) and ``collapsed`` (the text's words without repeated periods)."""
    return df.withColumn(out, _detector(least, times)(F.col(text) if isinstance(text, str) else text))


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period (ties: smallest start, then
    period); null without runs."""
    def better(best: Column, r: Column) -> Column:
        more = r["length"] * best["period"] - best["length"] * r["period"]
        return F.when(best.isNull() | (more > 0), r).otherwise(best)
    nothing = F.lit(None).cast(RUN)
    return F.aggregate(runs, nothing, better)  # runs come by start and period: the first of equals stays
