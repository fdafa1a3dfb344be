"""Key derivations for dedup and partitioning (Q4)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uvlens.operators.strategies import hash63  # noqa: F401  (63-bit user hash)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_hex(c) -> Column:
    return F.md5(_c(c).cast("string"))


def md5_16(c) -> Column:
    """Middle 16 hex digits of the md5 (chars 9-24)."""
    return F.substring(md5_hex(c), 9, 16)


def base36(n) -> Column:
    """Signed base-36 text in lower case; ``conv`` works on unsigned values
    and returns upper case."""
    n = _c(n)
    return (F.when(n < 0, F.concat(F.lit("-"), F.lower(F.conv((-n).cast("string"), 10, 36))))
            .otherwise(F.lower(F.conv(n.cast("string"), 10, 36))))


_POW31 = np.ones(1, dtype=np.uint32)


def _pow31(n: int) -> np.ndarray:
    """31**k mod 2**32 for k < n (uint32 arithmetic wraps)."""
    global _POW31
    if len(_POW31) < n:
        p = np.full(max(n, 2 * len(_POW31)), 31, dtype=np.uint32)
        p[0] = 1
        _POW31 = np.cumprod(p, dtype=np.uint32)
    return _POW31[:n]


def hash_texts(texts: list[str]) -> np.ndarray:
    """Hashes of texts (uint32) from one buffer of all their UTF-16 units: each unit
    times the power of 31 of its distance from its text's end, summed per text."""
    units = np.frombuffer("".join(texts).encode("utf-16-le", "surrogatepass"), dtype="<u2").astype(np.uint32)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    if size.sum() != len(units):  # characters of two units
        size = np.fromiter((len(t.encode("utf-16-le", "surrogatepass")) // 2 for t in texts), np.int64, len(texts))
    out = np.zeros(len(texts), np.uint32)
    full = np.flatnonzero(size)
    if len(full):
        ends = np.cumsum(size[full])
        left = np.repeat(ends, size[full]) - 1 - np.arange(len(units))
        out[full] = np.add.reduceat(units * _pow31(int(size.max()))[left], ends - size[full], dtype=np.uint32)
    return out


@F.pandas_udf(T.LongType())
def _java_hashcode_udf(texts: pd.Series) -> pd.Series:
    known = texts.notna()
    out = pd.Series(pd.array([pd.NA] * len(texts), dtype="Int64"), index=texts.index)
    out[known] = hash_texts(texts[known].tolist()).view(np.int32).astype(np.int64)
    return out


def java_hashcode(c) -> Column:
    """32-bit polynomial string hash (31 * h + unit over UTF-16 units), as a
    signed int in a bigint column.

    Arrow-batched: one numpy pass over the UTF-16 units of the whole batch.
    """
    return _java_hashcode_udf(_c(c))


def java_abs_hashcode(c) -> Column:
    """abs of the hash; the minimum int stays negative, as in Java."""
    h = java_hashcode(c)
    return F.when(h == -2147483648, h).otherwise(F.abs(h))


def hashcode_abs(c) -> Column:
    """The reference's ``hashcode``: -1 for null or empty text, else the
    absolute hash (the minimum int stays negative)."""
    c = _c(c)
    return F.when(c.isNull() | (F.length(c) == 0), F.lit(-1).cast("bigint")) \
        .otherwise(java_abs_hashcode(c))


def hash_bucket(c, n: int) -> Column:
    return F.pmod(java_hashcode(c), F.lit(int(n)))
