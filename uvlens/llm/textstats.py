"""Word, line and character statistics of whole texts, one Arrow batch at a time.

A word is a run of ``[^\\x20\\x09-\\x0D]``. ``with_stats(df, text, out)`` adds a
struct column ``out`` with the fields of ``FIELDS`` (all long):

``n_chars`` code points; ``n_words``; ``word_chars`` code points in words;
``n_symbols`` characters of ``#*$%&|<>``; ``n_lines`` lines (split at ``\\n``)
that hold a word; ``n_dup_lines`` such lines equal to an earlier line;
``n_repeat_words`` words inside 3-word windows that occur twice or more;
``n_distinct_words``; ``n_upper`` ASCII and Latin-1 capitals; ``n_digits``; ``n_ends``
characters ``.!?``; ``n_marks`` other ASCII punctuation; ``n_bangs`` ``!``;
``n_longest`` bytes of the longest word.

Null and empty texts give 0 everywhere. A text is never cut; memory is bounded by
one Arrow batch plus the flags of ``SLICE_BYTES`` of text (a dozen arrays of a byte each),
or of the longest single text and its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from uvlens.llm.common import as_strings, byte_slices, give_back, per_row, utf8

FIELDS = ("n_chars", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
          "n_repeat_words", "n_distinct_words", "n_upper", "n_digits", "n_ends",
          "n_marks", "n_bangs", "n_longest")
SCHEMA = StructType([StructField(f, LongType()) for f in FIELDS])
BLANKS = b" \t\n\x0b\x0c\r"
SLICE_BYTES = 1 << 18  # the arrays of a slice fit a core's cache


def _lut(chars: bytes) -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[list(chars)] = 1
    return t


_BLANK = _lut(BLANKS)
_LEAD = np.ones(256, np.uint8)
_LEAD[0x80:0xC0] = 0
_WORD_CP = _LEAD * (1 - _BLANK)
_SYMBOL = _lut(b"#*$%&|<>")
_UPPER = _lut(bytes(range(65, 91)))
_DIGIT = _lut(b"0123456789")
_END = _lut(b".!?")
_MARK = _lut(b"\"'(),-/:;=@[\\]^_`{}~+")
_BANG = _lut(b"!")


def repeat_words(words: list[bytes]) -> tuple[int, int]:
    """Words covered by 3-word windows occurring at least twice, and the
    number of distinct words."""
    n = len(words)
    ids: dict[bytes, int] = {}
    a = np.fromiter([ids.setdefault(w, len(ids)) for w in words], np.int64, n)
    if n < 4:  # a repeated window needs two starts
        return 0, len(ids)
    v = len(ids)
    pair = a[:-1] * v + a[1:]
    if v >= 2_000_000:  # three ids no longer fit 63 bits: rank the pairs first
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair[:-1] * v + a[2:]
    s = np.sort(key)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0, v
    dup = np.isin(key, twice)
    cover = np.zeros(n, bool)
    for k in range(3):
        cover[k:n - 2 + k] |= dup
    return int(cover.sum()), v


def batch_stats(texts: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of a string array, as one int64 array per field."""
    texts = as_strings(texts)
    out = {f: np.zeros(len(texts), np.int64) for f in FIELDS}
    for i, j in byte_slices(texts, SLICE_BYTES):
        data, start = utf8(texts, i, j)
        word = 1 - _BLANK[data]
        first = word.copy()
        first[1:] &= 1 - word[:-1]
        heads = start[:-1][start[1:] > start[:-1]]
        first[heads] = word[heads]
        for f, flags in (("n_chars", _LEAD[data]), ("n_words", first), ("word_chars", _WORD_CP[data]),
                         ("n_symbols", _SYMBOL[data]), ("n_digits", _DIGIT[data]),
                         ("n_ends", _END[data]), ("n_marks", _MARK[data]), ("n_bangs", _BANG[data])):
            out[f][i:j] = per_row(flags, start)
        upper = _UPPER[data]
        if len(data) > 1:  # U+00C0..U+00DE but the multiplication sign
            upper[1:] |= ((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
                          & (data[1:] != 0x97)).astype(np.uint8)
        out["n_upper"][i:j] = per_row(upper, start)
        raw = data.tobytes()
        for k in range(i, j):
            text = raw[start[k - i]:start[k - i + 1]]
            words = text.split()
            if not words:
                continue
            out["n_repeat_words"][k], out["n_distinct_words"][k] = repeat_words(words)
            out["n_longest"][k] = max(map(len, words))
            lines = [x for x in text.split(b"\n") if x.strip(BLANKS)]
            out["n_lines"][k] = len(lines)
            out["n_dup_lines"][k] = len(lines) - len(set(lines))
    return out


@F.arrow_udf(SCHEMA)
def _stats(texts: pa.Array) -> pa.Array:
    got = batch_stats(texts)
    give_back()
    return pa.StructArray.from_arrays([pa.array(got[f]) for f in FIELDS], list(FIELDS))


def with_stats(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the statistics of ``text`` as struct column ``out``. Only the
    text goes to Python; all other columns stay where they are."""
    return df.withColumn(out, _stats(F.col(text)))
