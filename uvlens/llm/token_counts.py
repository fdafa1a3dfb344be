"""Edit-aware token counts (operator 1).

Byte-level BPE splits a text into pre-tokens by a pattern and encodes each alone, so
a document's token count is the sum over its pre-tokens. ``TokenTree`` keeps a
segment tree per document: leaves hold ``LEAF`` pre-tokens (text, characters, token
count), inner nodes the sums of their subtrees. An edit re-encodes only the leaves it
touches, with ``CONTEXT`` characters before it (the pattern looks at most two
characters past a pre-token's end) and behind it up to the first old leaf boundary
that the new split meets again (the pattern has no look-behind, so from there on the
split is the old one), then updates the sums on the paths to the root.

``with_trees`` stores the leaves of every document (characters and tokens per leaf);
``with_edits`` rebuilds the tree from these without encoding, applies the document's
edits and returns counts and new leaves.

Cases. Null text: null counts. Empty text: 0 tokens. Edits are (start, end,
replacement) in code points of the old text; they are applied in order of start,
clipped to the text; null edits or positions and edits that begin before the end of
an earlier one are skipped and counted. Null replacement: deletion. Repeated rows are
counted alike. Whole texts are counted, whatever their length.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

LEAF, CONTEXT = 64, 3
CACHE_TOKENS, CACHE_CHARS = 400_000, 40


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Counter:
    """Token counts of pre-tokens, with a bounded cache."""

    def __init__(self, ranks: bytes, pattern: str):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        # tiktoken's \s is Unicode white space; the regex module's has four more characters
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}")
                                     .replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.cache: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def count(self, pre_token: str) -> int:
        n = self.cache.get(pre_token)
        if n is None:
            n = len(self.encoding.encode_ordinary(pre_token))
            if len(pre_token) <= CACHE_CHARS:
                if len(self.cache) >= CACHE_TOKENS:
                    self.cache.clear()
                self.cache[pre_token] = n
        return n

    def counts(self, pre_tokens: list[str]) -> list[int]:
        get, count = self.cache.get, self.count
        return [get(p) or count(p) for p in pre_tokens]


class TokenTree:
    """Segment tree over the leaves of one document."""

    def __init__(self, texts: list[str], tokens: list[int], counter: Counter):
        self.counter, self.texts = counter, texts
        self.encoded = 0  # pre-tokens encoded since the tree was made
        self.size = 1
        while self.size < len(texts):
            self.size *= 2
        self.chars = np.zeros(2 * self.size, np.int64)
        self.tokens = np.zeros(2 * self.size, np.int64)
        n = len(texts)
        self.chars[self.size:self.size + n] = [len(t) for t in texts]
        self.tokens[self.size:self.size + n] = tokens
        width = self.size
        while width > 1:
            for a in (self.chars, self.tokens):
                a[width // 2:width] = a[width:2 * width:2] + a[width + 1:2 * width:2]
            width //= 2

    @classmethod
    def build(cls, text: str, counter: Counter) -> TokenTree:
        pre = counter.split(text)
        n = counter.counts(pre)
        at = range(0, len(pre), LEAF)
        return cls(["".join(pre[i:i + LEAF]) for i in at], [sum(n[i:i + LEAF]) for i in at], counter)

    @classmethod
    def restore(cls, text: str, leaf_chars, leaf_tokens, counter: Counter) -> TokenTree:
        """The tree of stored leaves; nothing is encoded."""
        ends = np.cumsum(leaf_chars).tolist() if len(leaf_chars) else []
        return cls([text[a:b] for a, b in zip([0, *ends], ends)], list(leaf_tokens), counter)

    def total(self) -> int:
        return int(self.tokens[1])

    def find(self, char: int) -> tuple[int, int]:
        """Leaf that holds a character position, and the leaf's first position."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if char >= start + self.chars[node] and self.chars[node + 1]:
                start += int(self.chars[node])
                node += 1
        return node - self.size, start

    def put(self, leaf: int, text: str, tokens: int) -> None:
        self.texts[leaf] = text
        node = leaf + self.size
        self.chars[node], self.tokens[node] = len(text), tokens
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace characters start..end-1 and update the sums."""
        if not self.texts:
            self.__init__([""], [0], self.counter)
        first, base = self.find(max(0, start - CONTEXT))
        last = first
        old = self.texts[first]
        while base + len(old) < end and last + 1 < len(self.texts):
            last += 1
            old += self.texts[last]
        head, tail = old[:start - base], old[end - base:]
        while True:
            new = head + replacement + tail
            # look past the region, so that its last pre-token sees what follows it
            ahead, k = "", last + 1
            while len(ahead) < CONTEXT and k < len(self.texts):
                ahead += self.texts[k]
                k += 1
            pre, at, fits = [], 0, not ahead
            for p in self.counter.split(new + ahead[:CONTEXT]) if ahead else self.counter.split(new):
                if at >= len(new):
                    break
                pre.append(p)
                at += len(p)
            fits = fits or at == len(new)
            if fits:
                break
            last += 1  # the new split runs over the old boundary: take in the next leaf
            tail += self.texts[last]
        self.encoded += len(pre)
        self.put(first, new, sum(self.counter.counts(pre)))
        for leaf in range(first + 1, last + 1):
            self.put(leaf, "", 0)

    def leaves(self) -> tuple[list[int], list[int]]:
        full = [k for k, t in enumerate(self.texts) if t]
        return [len(self.texts[k]) for k in full], [int(self.tokens[self.size + k]) for k in full]


def clean_edits(edits, length: int) -> tuple[list[tuple[int, int, str]], int]:
    """Edits in order, clipped to the text, without overlaps; and the number skipped."""
    known = [e for e in edits if e and e["start"] is not None and e["end"] is not None]
    out, at, skipped = [], 0, len(edits) - len(known)
    for e in sorted(known, key=lambda e: (e["start"], e["end"], e["replacement"] or "")):
        a, b = max(0, min(e["start"], length)), max(0, min(e["end"], length))
        if a < at or b < a:
            skipped += 1
            continue
        out.append((a, b, e["replacement"] or ""))
        at = b
    return out, skipped


_COUNTERS: dict[str, Counter] = {}


def counter_of(ranks: bytes, pattern: str, key: str) -> Counter:
    """One counter (and cache) per worker process."""
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(ranks, pattern)
    return _COUNTERS[key]


def _model(ranks: str | None, pattern: str | None) -> tuple[bytes, str, str]:
    with open(ranks or default_ranks(), "rb") as f:  # a tokenizer's file, not an input table
        data = f.read()
    pattern = pattern or default_pattern()
    return data, pattern, hashlib.md5(data + pattern.encode()).hexdigest()


_INTS = pa.list_(pa.int32())
EDITS = "array<struct<start:int,end:int,replacement:string>>"


def with_trees(df: DataFrame, text: str = "text", out: str = "tree", ranks: str | None = None,
               pattern: str | None = None) -> DataFrame:
    """``df`` with struct column ``out``: n_tokens, n_pre_tokens, leaf_chars, leaf_tokens."""
    data, pat, key = _model(ranks, pattern)
    kind = StructType([StructField("n_tokens", LongType()), StructField("n_pre_tokens", LongType()),
                       StructField("leaf_chars", ArrayType(IntegerType())),
                       StructField("leaf_tokens", ArrayType(IntegerType()))])

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        counter = counter_of(data, pat, key)
        rows = []
        for t in texts:
            t = t.as_py()
            if t is None:
                rows.append((None, None, None, None))
                continue
            pre = counter.split(t)
            n = counter.counts(pre)
            at = range(0, len(pre), LEAF)
            size = [len(p) for p in pre]
            rows.append((sum(n), len(pre), [sum(size[i:i + LEAF]) for i in at], [sum(n[i:i + LEAF]) for i in at]))
        a, b, c, d = zip(*rows) if rows else ((), (), (), ())
        return pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, _INTS),
                                           pa.array(d, _INTS)], ["n_tokens", "n_pre_tokens", "leaf_chars", "leaf_tokens"])

    return df.withColumn(out, run(F.col(text)))


def with_edits(df: DataFrame, edits: str, text: str = "text", tree: str = "tree", out: str = "edited",
               ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` with struct column ``out``: n_tokens after the edits, n_edits, n_skipped,
    n_encoded (pre-tokens encoded for them), leaf_chars, leaf_tokens.
    ``edits`` has type ``EDITS`` (null: none); ``tree`` is a column of ``with_trees``."""
    data, pat, key = _model(ranks, pattern)
    kind = StructType([StructField(c, LongType()) for c in ("n_tokens", "n_edits", "n_skipped", "n_encoded")]
                      + [StructField(c, ArrayType(IntegerType())) for c in ("leaf_chars", "leaf_tokens")])

    @F.arrow_udf(kind)
    def run(texts: pa.Array, chars: pa.Array, tokens: pa.Array, changes: pa.Array) -> pa.Array:
        counter = counter_of(data, pat, key)
        rows = []
        for t, c, k, e in zip(texts, chars, tokens, changes):
            t, e = t.as_py(), e.as_py() or []
            if t is None:
                rows.append((None,) * 6)
                continue
            c, k = c.values.to_numpy(), k.values.to_numpy()
            todo, skipped = clean_edits(e, len(t))
            if not todo:
                rows.append((int(k.sum()), 0, skipped, 0, c, k))
                continue
            tree = TokenTree.restore(t, c, k, counter)
            for a, b, new in reversed(todo):  # from the end: earlier positions stay
                tree.edit(a, b, new)
            rows.append((tree.total(), len(todo), skipped, tree.encoded, *tree.leaves()))
        cols = list(zip(*rows)) or [()] * 6
        return pa.StructArray.from_arrays(
            [pa.array(x, pa.int64()) for x in cols[:4]] + [pa.array(x, _INTS) for x in cols[4:]],
            ["n_tokens", "n_edits", "n_skipped", "n_encoded", "leaf_chars", "leaf_tokens"])

    return df.withColumn(out, run(F.col(text), F.col(tree)["leaf_chars"], F.col(tree)["leaf_tokens"], F.col(edits)))


# What the masking edits look for and put in its place. Whole runs are matched,
# however long; possessive repeats, and mail addresses that begin where a run does (or where
# the last one ended), keep this linear. Letters and digits are those of re's \w.
MASKS = ((regex.compile(r"(?:(?<![\p{L}\p{N}_.+-])|\G)[\p{L}\p{N}_.+-]++@[\p{L}\p{N}_-]++(?:\.[\p{L}\p{N}_-]++)++"),
          "<EMAIL>"),
         (re.compile(r"https?://[^\s<>\"]++"), "<URL>"),
         (re.compile(r"(?<!\d)\d(?:[ -]?\d){6,}+"), "<NUMBER>"))


def masks(text: str) -> list[tuple[int, int, str]]:
    """What is masked, in order. Masks that overlap become one over all of their
    characters, with the replacement of the longest."""
    out, longest = [], 0
    for a, b, new in sorted((m.start(), m.end(), new) for rule, new in MASKS for m in rule.finditer(text)):
        if not out or a >= out[-1][1]:
            out.append((a, b, new))
            longest = b - a
            continue
        start, end, was = out[-1]
        out[-1] = (start, max(end, b), new if b - a > longest else was)
        longest = max(longest, b - a)
    return out


def mask_edits(df: DataFrame, text: str = "text", out: str = "edits") -> DataFrame:
    """``df`` with the edits that mask e-mail addresses, links and long numbers."""
    kind = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()),
                                 StructField("replacement", StringType())]))

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else [{"start": a, "end": b, "replacement": new} for a, b, new in masks(t)]
                         for t in texts.to_pylist()],
                        pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("replacement", pa.string())])))

    return df.withColumn(out, run(F.col(text)))
