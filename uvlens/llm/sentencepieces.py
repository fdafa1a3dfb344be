"""SentencePiece encoding and decoding (operator 2): N-best segmentation by A*.

Pieces and scores come from a model file (a parameter). The text is the lattice of
all pieces at all positions; characters that no piece covers are written as byte
pieces. The forward Viterbi score of a position is the best score of any path from
the start to it: as a heuristic for a backward search from the end it is exact, so A*
pops the paths in order of their score and never expands a path that is not part of
one of the N best.

No piece runs from a non-blank into a blank, nor over a line break, so the lattice
falls apart into units (blanks and the word behind them, or a line break), which are
segmented apart. A forward and a backward pass give each unit's best path and the loss
of its second best; only the N - 1 units with the smallest losses can differ from the
best within the N best of the whole text, and only these are searched by A*.

Columns are encoded in slices of about ``SLICE_CHARS`` characters: the distinct units
of a slice that the worker's bounded store lacks are grouped by length, and both passes run
over a whole group's pieces at once in numpy (units with characters beyond the pieces, and
very long ones, one by one). A text's N best differ from its best in at most N - 1 units,
so their ids are the best's with other pieces there.

Scores are integers (millionths of a nat), so sums and ties are exact. A unigram
model's scores are used as they are. A BPE model has merge ranks instead: a piece of
rank r gets the log-probability of 1 / (r + 10), normalised (Zipf's law).

Decoding joins the bytes of the pieces and drops the blank that encoding put in
front; decode(encode(text)) == text for every text, ``▁`` included (it is written
as bytes).

Cases. Null text: null ids. Empty text: no pieces, score 0. Repeated rows are encoded
alike. Texts of any length are encoded whole; time is linear in the text but for the
length of the longest piece.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from uvlens.llm.common import as_strings, byte_slices, give_back

NBEST = 3
CACHE_UNITS, CACHE_CHARS = 20_000, 40
SLICE_CHARS, LANE_CHARS, LANE_CELLS = 500_000, 24, 1_000_000
STORE_UNITS, STORE_IDS = 400_000, 4_000_000  # from which on the store of solved units is begun anew
MICRO = 1_000_000
_NEVER, _ALONE = -(2**60), 2**62  # score of no piece; loss where there is no second path
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


@dataclass(frozen=True)
class Vocabulary:
    """What a task needs of a model; a few hundred KB, shipped with the task."""

    pieces: tuple[str, ...]  # by id; blanks as spaces; "" for control and byte pieces
    scores: tuple[int, ...]
    byte_ids: tuple[int, ...]  # of bytes 0..255
    unknown: int  # score of a character that no piece covers

    @property
    def digest(self) -> str:
        return hashlib.md5(repr((self.pieces[-2000:], len(self.pieces), sum(self.scores))).encode()).hexdigest()


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_vocabulary(model: str | None = None) -> Vocabulary:
    """Vocabulary of a SentencePiece model file with byte fallback."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model or default_model())
    size = sp.get_piece_size()
    byte_ids = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
    if len(byte_ids) != 256:
        raise ValueError("the model has no byte pieces; texts could not be read back")
    normal = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    pieces = [""] * size
    for i in normal:
        pieces[i] = sp.id_to_piece(i).replace("▁", " ")
    raw = [sp.get_score(i) for i in normal]
    if all(x == int(x) for x in raw):  # merge ranks
        z = math.log(sum(1 / (r + 10) for r in range(len(normal))))
        raw = [-(math.log(r + 10) + z) for r in range(len(normal))]
    scores = [0] * size
    for i, x in zip(normal, raw):
        scores[i] = round(x * MICRO)
    return Vocabulary(tuple(pieces), tuple(scores), tuple(byte_ids[b] for b in range(256)),
                      min(scores[i] for i in normal) - 10 * MICRO)


class _Store(dict):
    """Solved units: a unit's number (given at its first look-up), and by number the best
    score, the loss and the end of its ids in ``flat``."""

    def __init__(self) -> None:
        super().__init__()
        self.units: list[str] = []
        self.best, self.loss, self.ends = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.int32)

    def __missing__(self, unit: str) -> int:
        self[unit] = k = len(self)
        self.units.append(unit)
        return k


class Segmenter:
    def __init__(self, v: Vocabulary):
        self.v = v
        self.store: _Store | None = None
        self.known = {p: (i, v.scores[i]) for i, p in enumerate(v.pieces) if p}
        self.longest = max(map(len, self.known), default=1)
        if any(re.search(r"[^ ] ", p) for p in self.known):
            raise ValueError("a piece runs from a word into a blank: units are not independent")
        line = "" if any("\n" in p for p in self.known) else "\\n"
        self.units = re.compile(rf" +[^ {line}]*|[^ {line}]+" + ("|\n" if line else ""))
        self.cache: dict[str, tuple[int, tuple[int, ...], int | None]] = {}
        self.way_cache: dict[tuple[str, int], list] = {}
        self.bytes = [p.encode() for p in v.pieces]
        for b, i in enumerate(v.byte_ids):
            self.bytes[i] = bytes([b])
        size = np.array([len(x) for x in self.bytes], np.int64)
        self.byte_at = np.concatenate([[0], np.cumsum(size)])
        self.byte_data = np.frombuffer(b"".join(self.bytes), np.uint8)

    def edges(self, unit: str) -> list[list[tuple[int, tuple[int, ...], int]]]:
        """For each end position the pieces that end there: (start, ids, score)."""
        n, known, longest = len(unit), self.known, self.longest
        ends: list[list] = [[] for _ in range(n + 1)]
        for i in range(n):
            for j in range(i + 1, min(i + longest, n) + 1):
                hit = known.get(unit[i:j])
                if hit is not None:
                    ends[j].append((i, (hit[0],), hit[1]))
            if unit[i] not in known:
                ids = tuple(self.v.byte_ids[b] for b in unit[i].encode("utf-8", "surrogatepass"))
                ends[i + 1].append((i, ids, self.v.unknown))
        return ends

    @staticmethod
    def forward(ends: list) -> tuple[list[int], list]:
        """Best score of a path to every position, and its last edge."""
        best, last = [0] * len(ends), [None] * len(ends)
        for j in range(1, len(ends)):
            top = None
            for e in ends[j]:
                s = best[e[0]] + e[2]
                if top is None or s > top:
                    top, last[j] = s, e
            best[j] = top
        return best, last

    def entry(self, unit: str) -> tuple[int, tuple[int, ...], int | None]:
        """(best score, its ids, loss of the second best path or None)."""
        hit = self.known.get(unit)
        if hit is not None and len(unit) == 1:
            return hit[1], (hit[0],), None
        ends = self.edges(unit)
        best, last = self.forward(ends)
        n = len(unit)
        path, ids, j = set(), [], n
        while j:
            e = last[j]
            path.add((e[0], j))
            ids.append(e[1])
            j = e[0]
        behind: list[int | None] = [None] * n + [0]  # best score of a path to the end
        second = None
        for j in range(n, 0, -1):
            after = behind[j]
            if after is None:
                continue
            for i, _, s in ends[j]:
                if behind[i] is None or s + after > behind[i]:
                    behind[i] = s + after
                if (i, j) not in path and (second is None or best[i] + s + after > second):
                    second = best[i] + s + after
        return best[n], tuple(chain.from_iterable(reversed(ids))), None if second is None else best[n] - second

    def look_up(self, unit: str) -> tuple[int, tuple[int, ...], int | None]:
        got = self.cache.get(unit)
        if got is None:
            got = self.entry(unit)
            if len(unit) <= CACHE_CHARS:
                if len(self.cache) >= CACHE_UNITS:
                    self.cache.clear()
                self.cache[unit] = got
        return got

    def nbest_unit(self, unit: str, n: int) -> list[tuple[int, tuple[int, ...]]]:
        """The n best paths of one unit by A* from its end."""
        ends = self.edges(unit)
        best, _ = self.forward(ends)
        out, count = [], 0
        # (-(best to here + behind), position, counter, score behind, pieces behind);
        # of equal scores the one closest to the start goes first
        heap: list = [(-best[-1], len(unit), 0, 0, None)]
        while heap and len(out) < n:
            f, pos, _, behind, tail = heapq.heappop(heap)
            if not pos:
                ids, t = [], tail
                while t:
                    ids.append(t[0])
                    t = t[1]
                out.append((-f, tuple(chain.from_iterable(ids))))
                continue
            for i, piece, s in ends[pos]:
                count += 1
                heapq.heappush(heap, (-(best[i] + s + behind), i, count, s + behind, (piece, tail)))
        return out

    def split(self, text: str) -> list[str]:
        return self.units.findall(" " + text) if text else []

    def encode(self, text: str, n: int = 1) -> list[tuple[int, np.ndarray]]:
        """The n best segmentations: (score, ids), best first."""
        units = self.split(text)
        get, look = self.cache.get, self.look_up
        got = [get(u) or look(u) for u in units]
        ids = np.fromiter(chain.from_iterable(g[1] for g in got), np.int32)
        top = sum(g[0] for g in got)
        out = [(top, ids)]
        if n <= 1 or not units:
            return out
        free = heapq.nsmallest(n - 1, ((g[2], k) for k, g in enumerate(got) if g[2] is not None))
        ways = [(k, self.nbest_unit(units[k], n)) for _, k in sorted(free, key=lambda x: x[1])]
        # sums of one alternative per unit, best first
        sums: list[tuple[int, tuple[int, ...]]] = [(top, ())]
        for k, alternatives in ways:
            sums = heapq.nsmallest(n, ((-(s + a[0] - got[k][0]), (*c, w)) for s, c in sums
                                       for w, a in enumerate(alternatives)))
            sums = [(-s, c) for s, c in sums]
        for s, choice in sums[1:]:
            parts = [g[1] for g in got]
            for (k, alternatives), w in zip(ways, choice):
                parts[k] = alternatives[w][1]
            out.append((s, np.fromiter(chain.from_iterable(parts), np.int32)))
        return out

    # --- many texts at once -----------------------------------------------------

    def _tables(self) -> None:
        """Arrays of the pieces: codes, hashes (sorted), filters by hash bits of the pieces
        and of their beginnings, and the ids of single characters."""
        pieces = [(p, i) for i, p in enumerate(self.v.pieces) if p]
        self.codes = np.zeros((len(self.v.pieces), self.longest), np.uint32)
        for p, i in pieces:
            self.codes[i, :len(p)] = np.frombuffer(p.encode("utf-32-le"), np.uint32)
        at = np.array([i for _, i in pieces], np.int64)
        length = np.array([len(p) for p, _ in pieces], np.int64)
        keys, h = np.zeros(len(pieces), np.uint64), np.zeros(len(pieces), np.uint64)
        self.begins = np.zeros(1 << 22, bool)
        for size in range(1, self.longest + 1):
            h = h * _MULT + (self.codes[at, size - 1].astype(np.uint64) + np.uint64(1))
            key = _mix(h)
            self.begins[(key[length >= size] >> np.uint64(42)).astype(np.int64)] = True
            keys[length == size] = key[length == size]
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_ids = at[order].astype(np.int32)
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces have one hash")
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        self.piece_scores = np.array(self.v.scores, np.int64)
        self.single = {p for p in self.known if len(p) == 1}
        self.single_ids = np.zeros(0x110000, np.int32)
        for p in self.single:
            self.single_ids[ord(p)] = self.known[p][0]

    def _edges_of(self, codes: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
        """For each start the pieces in m units of n characters, each a single piece: (length,
        units that have such a piece there, its ids and scores). Only units where a longer
        piece may begin are looked at further."""
        n, m = codes.shape
        every, out = np.arange(m), []
        for i in range(n):
            ids = self.single_ids[codes[i]]
            here = [(1, every, ids, self.piece_scores[ids])]
            rows, h = every, codes[i].astype(np.uint64) + np.uint64(1)
            for size in range(2, min(self.longest, n - i) + 1):
                h = h * _MULT + (codes[i + size - 1, rows].astype(np.uint64) + np.uint64(1))
                key = _mix(h)
                go = self.begins[(key >> np.uint64(42)).astype(np.int64)]
                rows, h, key = rows[go], h[go], key[go]
                if not len(rows):
                    break
                some = np.flatnonzero(self.filter[(key >> np.uint64(44)).astype(np.int64)])
                at = np.minimum(np.searchsorted(self.keys, key[some]), len(self.keys) - 1)
                hit = self.keys[at] == key[some]
                on, ids = rows[some[hit]], self.key_ids[at[hit]]
                same = (self.codes[ids, :size] == codes[i:i + size, on].T).all(1)  # hashes may lie
                if size < self.longest:
                    same &= self.codes[ids, size] == 0
                on, ids = on[same], ids[same]
                if len(on):
                    here.append((size, on, ids, self.piece_scores[ids]))
            out.append(here)
        return out

    def _lattice(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward passes over m units of n characters (codes is n x m):
        best scores, losses, piece counts, and ids (m x most pieces, in order)."""
        n, m = codes.shape
        edges = self._edges_of(codes)
        ending: list[list] = [[] for _ in range(n + 1)]
        for i, here in enumerate(edges):  # longest first, as starts come in order
            for size, rows, ids, score in here:
                ending[i + size].append((size, rows, ids, score))
        best = np.full((n + 1, m), 2 * _NEVER, np.int64)
        best[0] = 0
        last = np.zeros((n + 1, m), np.int32)
        last_id = np.zeros((n + 1, m), np.int32)
        for j in range(1, n + 1):
            for size, rows, ids, score in ending[j]:
                c = best[j - size, rows] + score
                better = c > best[j, rows]
                on = rows[better]
                best[j, on], last[j, on], last_id[j, on] = c[better], size, ids[better]
        behind = np.full((n + 1, m), 2 * _NEVER, np.int64)
        behind[n] = 0
        for i in range(n - 1, -1, -1):
            for size, rows, _, score in edges[i]:
                behind[i, rows] = np.maximum(behind[i, rows], behind[i + size, rows] + score)
        path, used, count = [], np.zeros((n + 1, m), np.int32), np.zeros(m, np.int64)
        rows, pos = np.arange(m), np.full(m, n)
        while len(rows):
            size = last[pos, rows]
            used[pos, rows] = size  # length of the path's piece that ends here
            ids = np.zeros(m, np.int32)
            ids[rows] = last_id[pos, rows]
            path.append(ids)
            count[rows] += 1
            pos = pos - size
            rows, pos = rows[pos > 0], pos[pos > 0]
        second = np.full(m, _NEVER, np.int64)
        for i, here in enumerate(edges):
            for size, rows, _, score in here:
                c = best[i, rows] + score + behind[i + size, rows]
                c[used[i + size, rows] == size] = _NEVER
                second[rows] = np.maximum(second[rows], c)
        loss = np.where(second > _NEVER // 2, best[n] - second, _ALONE)
        back = np.array(path)  # last piece first
        k = np.arange(len(path))
        ids = back[np.maximum(count[:, None] - 1 - k, 0), np.arange(m)[:, None]]
        return best[n], loss, count, ids

    def _solve(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct units: best scores, losses, ends of their ids, and all ids."""
        if not hasattr(self, "keys"):
            self._tables()
        total = len(units)
        best, loss = np.zeros(total, np.int64), np.zeros(total, np.int64)
        ids: list = [None] * total
        size = np.fromiter(map(len, units), np.int64, total)
        single = self.single
        plain = np.fromiter((len(u) <= LANE_CHARS and single.issuperset(u) for u in units), bool, total)
        for k in np.flatnonzero(~plain):
            best[k], ids[k], x = self.look_up(units[k])
            loss[k] = _ALONE if x is None else x
        lanes = []
        for n in np.unique(size[plain]):
            rows = np.flatnonzero(plain & (size == n))
            step = max(1, LANE_CELLS // int(n * min(n, self.longest)))
            for a in range(0, len(rows), step):
                part = rows[a:a + step]
                codes = np.frombuffer("".join([units[k] for k in part]).encode("utf-32-le"), np.uint32)
                best[part], loss[part], count, got = self._lattice(np.ascontiguousarray(codes.reshape(-1, n).T))
                lanes.append((part, count, got))
        count = np.zeros(total, np.int64)
        for k in np.flatnonzero(~plain):
            count[k] = len(ids[k])
        for part, c, _ in lanes:
            count[part] = c
        ends = np.cumsum(count)
        flat = np.zeros(int(ends[-1]) if total else 0, np.int32)
        for k in np.flatnonzero(~plain):
            flat[ends[k] - count[k]:ends[k]] = ids[k]
        for part, c, got in lanes:
            on = np.arange(got.shape[1]) < c[:, None]
            flat[((ends[part] - c)[:, None] + np.arange(got.shape[1]))[on]] = got[on]
        return best, loss, ends, flat

    def _place(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the texts' units in the store (joined) and each text's number of units;
        units that the store lacks are solved."""
        store = self.store
        if store is None or len(store) >= STORE_UNITS or len(store.flat) >= STORE_IDS or len(store) != len(store.best):
            store = self.store = _Store()
        place: list[int] = []
        per_text, number, known = [], store.__getitem__, len(store)
        for t in texts:
            units = self.split(t)
            per_text.append(len(units))
            place += map(number, units)
        if len(store) > known:
            best, loss, ends, flat = self._solve(store.units[known:])
            store.ends = np.concatenate([store.ends, ends + len(store.flat)])
            store.flat = np.concatenate([store.flat, flat])
            store.best, store.loss = np.concatenate([store.best, best]), np.concatenate([store.loss, loss])
        return np.array(place, np.int64), np.array(per_text, np.int64)

    def segment_many(self, texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, list[list[int]], list[list[np.ndarray]]]:
        """The n best segmentations of all texts: ids of the best (joined, with the number
        of ids of each text), scores of all n, ids of the second to the n-th."""
        at, per_text = self._place(texts)
        if not len(at):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64), [[0] for _ in texts], [[] for _ in texts]
        store = self.store
        best, loss, units = store.best, store.loss, store.units
        size = np.diff(store.ends)[at]
        stop = np.cumsum(size)
        ids = store.flat[np.repeat(store.ends[1:][at] - stop, size) + np.arange(int(stop[-1]))]
        edge = np.concatenate([[0], np.cumsum(per_text)])
        total = np.concatenate([[0], np.cumsum(best[at])])
        count = np.concatenate([[0], stop])  # start of each unit's ids
        scores, others = [], []
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            sums: list[tuple[int, tuple[int, ...]]] = [(-int(total[b] - total[a]), ())]
            free: list[tuple[int, list]] = []
            if n > 1 and b > a:
                x = loss[at[a:b]]
                near = np.flatnonzero(x <= np.partition(x, n - 2)[n - 2]) if len(x) >= n else np.arange(len(x))
                near = np.sort(near[np.argsort(x[near], kind="stable")[:n - 1]])
                free = [(a + int(k), self.ways(units[at[a + k]], n)) for k in near if x[k] != _ALONE]
                for k, ways in free:
                    own = int(best[at[k]])
                    sums = heapq.nsmallest(n, ((s - w[0] + own, (*c, i)) for s, c in sums for i, w in enumerate(ways)))
            scores.append([-s for s, _ in sums])
            more = []
            for _, choice in sums[1:]:
                parts, done = [], int(count[a])
                for (k, ways), i in zip(free, choice):
                    if i:
                        parts += [ids[done:count[k]], np.array(ways[i][1], np.int32)]
                        done = int(count[k + 1])
                more.append(np.concatenate([*parts, ids[done:count[b]]]))
            others.append(more)
        return ids, count[edge[1:]] - count[edge[:-1]], scores, others

    def encode_many(self, texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """``segment_many`` without the ids of the second to the n-th."""
        return self.segment_many(texts, n)[:3]

    def ways(self, unit: str, n: int) -> list[tuple[int, tuple[int, ...]]]:
        """The n best paths of a unit, kept in a bounded cache."""
        got = self.way_cache.get((unit, n))
        if got is None:
            got = self.nbest_unit(unit, n)
            if len(unit) <= CACHE_CHARS:
                if len(self.way_cache) >= CACHE_UNITS:
                    self.way_cache.clear()
                self.way_cache[unit, n] = got
        return got

    def decode_many(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of joined ids; ``ends`` are the ends of each text's ids."""
        size = (self.byte_at[1:] - self.byte_at[:-1])[ids]
        stop = np.cumsum(size)
        data = self.byte_data[np.repeat(self.byte_at[1:][ids] - stop, size) + np.arange(int(stop[-1]) if len(stop) else 0)]
        stop = np.concatenate([[0], stop])[np.concatenate([[0], ends])]
        raw = data.tobytes()
        return pa.array([raw[a + 1:b].decode("utf-8", "replace") for a, b in zip(stop[:-1].tolist(), stop[1:].tolist())],
                        pa.string())

    def decode(self, ids) -> str:
        """The text of ids; the first character (the added blank) is dropped."""
        table = self.bytes
        return b"".join([table[i] for i in ids]).decode("utf-8", "surrogatepass")[1:]


_SEGMENTERS: dict[str, Segmenter] = {}


def segmenter(v: Vocabulary, key: str) -> Segmenter:
    """One segmenter (and cache) per worker process."""
    if key not in _SEGMENTERS:
        _SEGMENTERS.clear()
        _SEGMENTERS[key] = Segmenter(v)
    return _SEGMENTERS[key]


def encode(df: DataFrame, text: str = "text", out: str = "pieces", n: int = NBEST,
           model: str | None = None) -> DataFrame:
    """``df`` with struct column ``out``: ids of the best segmentation, nbest_scores, the
    scores of the n best, best first (in millionths of a nat), other_ids, the ids of the
    second to the n-th, and others_read_back, whether these all decode to the text."""
    v = load_vocabulary(model)
    key = v.digest
    kind = StructType([StructField("ids", ArrayType(IntegerType())), StructField("nbest_scores", ArrayType(LongType())),
                       StructField("other_ids", ArrayType(ArrayType(IntegerType()))),
                       StructField("others_read_back", BooleanType())])

    def ends(sizes) -> pa.Array:
        return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seg = segmenter(v, key)
        for texts in batches:
            for i, j in byte_slices(as_strings(texts), SLICE_CHARS):
                part = texts[i:j]  # given back slice by slice: ids take more memory than texts
                null = part.is_null()
                part = as_strings(part)
                ids, sizes, scores, others = seg.segment_many(part.to_pylist(), n)
                row = np.repeat(np.arange(j - i), [len(x) for x in others])
                lists = [x for xs in others for x in xs]
                flat = np.concatenate([np.zeros(0, np.int32), *lists])
                each = np.array([len(x) for x in lists], np.int64)
                differ = pc.not_equal(seg.decode_many(flat, np.cumsum(each)), part.take(pa.array(row)))
                wrong = np.bincount(row[differ.to_numpy(zero_copy_only=False)], minlength=j - i)
                gone = null.to_pylist()
                yield pa.StructArray.from_arrays(
                    [pa.ListArray.from_arrays(ends(sizes), pa.array(ids), mask=null),
                     pa.array([None if x else s for x, s in zip(gone, scores)], pa.list_(pa.int64())),
                     pa.ListArray.from_arrays(ends([len(x) for x in others]),
                                              pa.ListArray.from_arrays(ends(each), pa.array(flat)), mask=null),
                     pa.array(wrong == 0)], ["ids", "nbest_scores", "other_ids", "others_read_back"])
            give_back()

    return df.withColumn(out, run(F.col(text)))


def encode_nbest(df: DataFrame, text: str = "text", out: str = "segmentations", n: int = NBEST,
                 model: str | None = None) -> DataFrame:
    """``df`` with array column ``out``: the n best segmentations (score, ids)."""
    v = load_vocabulary(model)
    key = v.digest
    kind = ArrayType(StructType([StructField("score", LongType()), StructField("ids", ArrayType(IntegerType()))]))

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        seg = segmenter(v, key)
        return pa.array([None if t is None else [{"score": s, "ids": i} for s, i in seg.encode(t, n)]
                         for t in texts.to_pylist()],
                        pa.list_(pa.struct([("score", pa.int64()), ("ids", pa.list_(pa.int32()))])))

    return df.withColumn(out, run(F.col(text)))


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", model: str | None = None) -> DataFrame:
    """``df`` with the text of the ids (null for null)."""
    v = load_vocabulary(model)
    key = v.digest

    @F.arrow_udf(StringType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seg = segmenter(v, key)
        for column in batches:
            for i in range(0, len(column), 500):
                part = column[i:i + 500]
                size = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                got = seg.decode_many(part.flatten().to_numpy(zero_copy_only=False), np.cumsum(size))
                yield pc.if_else(part.is_valid(), got, None)
            give_back()

    return df.withColumn(out, run(F.col(ids)))
