"""Exact top-k search by inner product with KD-trees per shard (operator 6).

Vectors are split into *cells* by the median splits of a KD-tree over a bounded sample
(``SAMPLE_ROWS``; it only sets the splits, every vector is routed through them), and
cells into shards of about ``SHARD_VALUES`` components, dealt out by position, so that
equal vectors do not concentrate rows. One aggregate over all rows gives each cell its
tight bounding box: the largest inner product any point of a box can have is a bound for
all of its vectors. There are at most ``SAMPLE_ROWS / 16`` cells and one per length.

Queries go to blocks of about ``BLOCK_ROWS``, next to those with the same most promising
cell; each (shard, block) pair is one group of bounded size. Within a group a KD-tree is
built: median splits on the widest side, down to ``LEAF_ROWS``, with a tight box per node.
Each query walks the tree best-first and ends when no open node can beat the k-th score.

The k-th score is propagated: a first pass searches one shard of each query's most
promising cell. The k-th scores found there are lower bounds; in the second pass a query
is sent only to cells whose box reaches its bound, and a shard only to blocks that hold
such queries. Every group returns at most k rows per query; the final rank is taken per
query over these, cut per task before the shuffle.

Scores are exact integers: floor(256 x) per component, products in float64 while
they stay below 2^53 and in Python integers beyond (clipped to the range of a long;
256 x is clipped to the range of a double). Box bounds have slack for rounding.

Cases. Vectors that are null, or hold null or non-finite components, take no part;
nor do rows with null ids. Only vectors of one length are compared; lengths that the
sample lacks share a cell without a box, which is always searched. Ties go to the
smaller id. Rows that repeat a query (id and vector) are one query; a query is never
compared with rows of its own id; repeated candidate rows each take a rank. Fewer
than k candidates: all of them. Empty tables: empty result. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uvlens.llm.common import hash63, hash_below, materialize

SAMPLE_ROWS, CELL_ROWS = 16_384, 32  # rows of the sample, and of it in a cell at most
SHARD_VALUES, BLOCK_ROWS, LEAF_ROWS = 1 << 20, 16_384, 256
FOUND = "query_id BIGINT, vec_id BIGINT, score BIGINT"
_LONG = 2**63 - 1


class KDTree:
    """Median-split tree over integer vectors; node arrays in depth-first order."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order = np.arange(len(points))
        self.lo, self.hi, self.span, self.kids, self.cut = [], [], [], [], []
        stack = [(0, len(points), -1, 0)]
        while stack:
            a, b, parent, side = stack.pop()
            part = points[order[a:b]]
            lo, hi = part.min(0), part.max(0)
            node = len(self.lo)
            self.lo.append(lo)
            self.hi.append(hi)
            self.span.append((a, b))
            self.kids.append([-1, -1])
            self.cut.append((0, 0))
            if parent >= 0:
                self.kids[parent][side] = node
            if b - a <= leaf_rows or not part.shape[1]:
                continue
            axis = int((hi - lo).argmax())
            if hi[axis] == lo[axis]:  # all points equal: the box is exact already
                continue
            mid = (b - a) // 2
            at = np.argpartition(part[:, axis], mid, kind="introselect")
            order[a:b] = order[a:b][at]
            self.cut[node] = (axis, part[at[mid], axis])
            stack += [(a + mid, b, node, 1), (a, a + mid, node, 0)]
        self.points, self.ids = points[order], ids[order]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def route(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point belongs to by the splits."""
        axis, cut = np.array([c[0] for c in self.cut]), np.array([c[1] for c in self.cut])
        kids, node = np.array(self.kids), np.zeros(len(points), np.int64)
        on = np.flatnonzero(kids[node, 0] >= 0)
        while len(on):
            at = node[on]
            node[on] = kids[at, (points[on, axis[at]] >= cut[at]).astype(int)]
            on = on[kids[node[on], 0] >= 0]
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """queries x nodes: the largest inner product in each node's box."""
        zero = queries.dtype.type(0) if queries.dtype != object else 0
        return np.maximum(queries, zero) @ self.hi.T + np.minimum(queries, zero) @ self.lo.T

    def search(self, query: np.ndarray, own: int, bounds: np.ndarray, k: int, floor) -> list[tuple]:
        """Up to k (score, id), best first; scores below ``floor`` are not wanted."""
        best: list[tuple] = []  # heap of (score, -id): its least element goes first
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            least = best[0][0] if len(best) == k else floor
            if -bound < least:
                break
            left, right = self.kids[node]
            if left >= 0:
                heapq.heappush(heap, (-bounds[left], left))
                heapq.heappush(heap, (-bounds[right], right))
                continue
            a, b = self.span[node]
            scores, ids = self.points[a:b] @ query, self.ids[a:b]
            on = np.flatnonzero((scores >= least) & (ids != own))
            if len(on) > k:  # all that can still be among the k best, ties included
                cut = np.partition(scores[on], len(on) - k)[len(on) - k]
                on = on[scores[on] >= cut]
                on = on[np.lexsort((ids[on], -scores[on]))][:k]
            for s, i in zip(scores[on], ids[on]):
                item = (int(s), -int(i))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _matrix(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vectors by length: (row numbers, float64 matrix)."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(arr):
        return {}
    off = arr.offsets.to_numpy()
    flat = arr.values.to_numpy(zero_copy_only=False)
    size = np.diff(off)
    return {int(d): (rows, flat[off[rows][:, None] + np.arange(d)]) for d in np.unique(size)
            for rows in [np.flatnonzero(size == d)]}


def search_group(vectors: pa.Table, queries: pa.Table, k: int) -> list[tuple[int, int, int]]:
    """(query, id, score) of one shard and one query block."""
    out: list[tuple[int, int, int]] = []
    by_dim = _matrix(vectors["v"])
    for dim, (q_rows, q) in _matrix(queries["v"]).items():
        if dim not in by_dim:
            continue
        v_rows, v = by_dim[dim]
        if dim and np.abs(v).max() * np.abs(q).max() * dim * 2 >= 2**53:
            to_int = np.vectorize(int, otypes=[object])
            v, q = to_int(v), to_int(q)
        tree = KDTree(v, vectors["vec_id"].to_numpy()[v_rows])
        ids = queries["query_id"].to_numpy()[q_rows]
        floors = queries["floor"].take(pa.array(q_rows)).to_pylist()  # exact beyond 2^53, too
        for at in range(0, len(q), 256):
            bounds = tree.bounds(q[at:at + 256]) if dim else np.zeros((len(q[at:at + 256]), len(tree.lo)))
            for r in range(len(bounds)):
                f = floors[at + r]
                got = tree.search(q[at + r], ids[at + r], bounds[r], k, -math.inf if f is None else f)
                out += [(int(ids[at + r]), i, max(-_LONG - 1, min(_LONG, s))) for s, i in got]
    return out


class Cells:
    """Cells by length and median splits of a sample; cell 0 takes the lengths that the
    sample lacks. ``boxes`` are added once known: cell -> (lo, hi)."""

    def __init__(self, sample: dict[int, np.ndarray], cells: int):
        rows = sum(map(len, sample.values()))
        leaf = max(CELL_ROWS, math.ceil(rows / cells))
        self.trees, self.number, self.count, self.boxes = {}, {}, 1, {}
        for dim, points in sorted(sample.items()):
            if not dim:
                continue
            tree = self.trees[dim] = KDTree(points, np.arange(len(points)), leaf)
            is_leaf = np.array([k[0] < 0 for k in tree.kids])
            self.number[dim] = np.where(is_leaf, np.cumsum(is_leaf) - 1 + self.count, -1)
            self.count += int(is_leaf.sum())
            tree.points = tree.ids = None  # only the splits are shipped

    def of(self, vectors: pa.Array) -> np.ndarray:
        out = np.zeros(len(vectors), np.int32)
        for dim, (rows, v) in _matrix(vectors).items():
            if dim in self.trees:
                out[rows] = self.number[dim][self.trees[dim].route(v)]
        return out

    def bounds(self, vectors: pa.Array):
        """Per length: row numbers, cells, and the largest inner product of each row with
        each cell's box, with slack for rounding (NaN where it overflows)."""
        for dim, (rows, q) in _matrix(vectors).items():
            cells = [int(c) for c in self.number.get(dim, ()) if c in self.boxes]
            if not cells:
                yield rows, np.zeros(1, np.int32), np.full((len(rows), 1), np.inf)
                continue
            lo, hi = (np.array([self.boxes[c][i] for c in cells]) for i in (0, 1))
            for a in range(0, len(rows), 1024):
                part = q[a:a + 1024]
                with np.errstate(over="ignore", invalid="ignore"):
                    got = np.maximum(part, 0) @ hi.T + np.minimum(part, 0) @ lo.T
                    got += 1e-12 * (np.abs(part) @ np.maximum(np.abs(lo), np.abs(hi)).T)
                yield rows[a:a + 1024], np.array(cells, np.int32), got

    def home(self, vectors: pa.Array) -> np.ndarray:
        out = np.zeros(len(vectors), np.int32)
        for rows, cells, bound in self.bounds(vectors):
            out[rows] = cells[np.nan_to_num(bound, nan=np.inf, posinf=np.inf).argmax(1)]
        return out

    def reached(self, vectors: pa.Array, floors: np.ndarray) -> list[np.ndarray]:
        """Cells whose bound is not below a row's floor (NaN: none)."""
        out: list = [None] * len(vectors)
        for rows, cells, bound in self.bounds(vectors):
            on = ~(bound < floors[rows][:, None])
            for r, flags in zip(rows, on):
                out[r] = cells[flags]
        return out


def quantize(embedding: Column) -> Column:
    """floor(256 x) per component; null unless every component is a finite number."""
    x = F.transform(embedding, lambda e: e.cast("double"))
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    big = 1.7976931348623157e308

    def cell(e: Column) -> Column:
        y = e * 256.0  # a whole number from 2^52 on; floor() gives a long, which holds less
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(F.greatest(F.least(y, F.lit(big)), F.lit(-big)))

    return F.when(finite, F.transform(x, cell))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _boxes(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Tight boxes of the cells over all rows: one per task and cell, then one per cell."""
    schema = "cell INT, lo ARRAY<DOUBLE>, hi ARRAY<DOUBLE>"

    def merge(parts) -> pa.Table:
        boxes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for cell, lo, hi in parts:
            was = boxes.get(cell, (lo, hi))
            boxes[cell] = (np.minimum(was[0], lo), np.maximum(was[1], hi))
        return pa.table({"cell": pa.array(boxes, pa.int32()),
                         "lo": pa.array([b[0] for b in boxes.values()], pa.list_(pa.float64())),
                         "hi": pa.array([b[1] for b in boxes.values()], pa.list_(pa.float64()))})

    def local(batches):
        def parts():
            for batch in batches:
                cell = batch.column("cell").to_numpy(zero_copy_only=False)
                for _, (at, v) in _matrix(batch.column("v")).items():
                    order = np.argsort(cell[at], kind="stable")
                    c, edge = np.unique(cell[at][order], return_index=True)
                    yield from zip(c.tolist(), np.minimum.reduceat(v[order], edge), np.maximum.reduceat(v[order], edge))
        yield from merge(parts()).to_batches()

    def whole(table: pa.Table) -> pa.Table:
        return merge(zip(table["cell"].to_pylist(), map(np.array, table["lo"].to_pylist()), map(np.array, table["hi"].to_pylist())))

    got = (rows.where("cell > 0").select("cell", "v").mapInArrow(local, schema)
           .groupBy("cell").applyInArrow(whole, schema).collect())
    return {r["cell"]: (np.array(r["lo"]), np.array(r["hi"])) for r in got}


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          embedding: str = "embedding", shard_rows: int | None = None,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best other rows.
    ``is_query`` is a condition on the id, as column ``vec_id``."""
    raw = (vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), quantize(F.col(embedding)).alias("v"))
           .where("vec_id is not null and v is not null").withColumn("at", F.monotonically_increasing_id()))
    n, dim = raw.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    per_shard = shard_rows or max(1_024, SHARD_VALUES // max(1, dim or 1))
    sample = pa.array([], pa.list_(pa.float64()))
    if n > per_shard:
        sample = raw.where(hash_below(min(1.0, SAMPLE_ROWS / n), "at")).select("v").toArrow()["v"]
    cells = Cells({d: v for d, (_, v) in _matrix(sample).items()}, max(1, math.ceil(n / per_shard)))

    @F.arrow_udf("int")
    def cell_of(v: pa.Array) -> pa.Array:
        return pa.array(cells.of(v), pa.int32())

    # written: both passes see the same cells and positions
    rows = materialize(raw.withColumn("cell", cell_of("v")), "vectors")
    size = dict(rows.groupBy("cell").count().collect())
    shards = [math.ceil(size.get(c, 0) / per_shard) for c in range(cells.count)]
    first = [sum(shards[:c]) for c in range(cells.count)]
    cells.boxes = _boxes(rows) if sum(shards) > 1 else {}

    def shard(cell: Column, part: Column) -> Column:
        return (F.get(F.lit(first), cell) + F.pmod(part, F.greatest(F.get(F.lit(shards), cell), F.lit(1)))).cast("int")

    rows = rows.select("vec_id", "v", shard(F.col("cell"), F.col("at")).alias("shard"))

    @F.arrow_udf("int")
    def home_of(v: pa.Array) -> pa.Array:
        return pa.array(cells.home(v), pa.int32())

    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "v").distinct()
    queries = materialize(queries.withColumn("home", home_of("v")), "queries")
    asked = dict(queries.groupBy("home").count().collect())
    asked = [asked.get(c, 0) for c in range(cells.count)]
    before = [sum(asked[:c]) for c in range(cells.count)]
    place = F.get(F.lit(before), F.col("home")) + F.get(F.lit(asked), F.col("home")) * (hash63("query_id", "v") / 2.0**63)
    queries = queries.withColumn("block", F.floor(place / block_rows).cast("int"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        got = search_group(left, right, k) if len(left) and len(right) else []
        cols = list(zip(*got)) or [[], [], []]
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("query_id", "vec_id", "score"), cols)})

    def search_all(q: DataFrame) -> DataFrame:
        """``q`` has query_id, v, floor, block and shard; a shard goes to the blocks that ask for it."""
        wanted = q.groupBy("shard").agg(F.collect_set("block").alias("blocks"))
        left = (rows.select(*[F.col(c).alias(c) for c in rows.columns]).join(wanted, "shard")
                .select("vec_id", "v", "shard", F.explode("blocks").alias("block")))
        return (left.groupBy("shard", "block").cogroup(q.groupBy("shard", "block")).applyInArrow(search, FOUND))

    q = queries.withColumn("floor", F.lit(None).cast("bigint"))
    if sum(shards) > 1:
        home = q.withColumn("shard", shard(F.col("home"), hash63("query_id")))
        # at least k rows, or it bounds nothing; nor does a clipped score
        kth = F.when((F.count(F.lit(1)) == k) & (F.min("score") > -_LONG), F.min("score"))
        floors = _ranked(search_all(home), k).groupBy("query_id").agg(kth.alias("floor"))
        q = materialize(queries.join(materialize(floors, "floors"), "query_id", "left"), "bounded")

    @F.arrow_udf("array<int>")
    def reached(v: pa.Array, floor: pa.Array) -> pa.Array:
        floors = floor.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
        return pa.array(cells.reached(v, floors), pa.list_(pa.int32()))

    q = q.withColumn("cell", F.explode(reached("v", "floor")))
    start, parts = F.get(F.lit(first), F.col("cell")), F.get(F.lit(shards), F.col("cell"))
    q = q.where(parts > 0).withColumn("shard", F.explode(F.sequence(start, start + parts - 1)))
    return (_ranked(search_all(q.select("query_id", "v", "floor", "block", "shard")), k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
