"""Keyed result store filled from micro-batches.

The reference writes sets / HLLs into a remote key-value store under keys
like ``<prefix>_<page>_<bucket>`` with an expiry. Here the store is a Parquet
folder partitioned by ``day`` (UTC day of the bucket) and ``batch_id``:

* ``kind='set'``  rows ``(page, window_time, user_id)``, distinct per batch;
* ``kind='hll'``  rows ``(page, window_time, sketch)``, one sketch per key and batch.

Writing a batch replaces only its own partitions (dynamic partition overwrite),
so a replayed micro-batch after a failure changes nothing. Reading merges all
batches with an aggregate (count_distinct or ``hll_union_agg``), partially
aggregated per task. Only the folders of the asked days are listed and opened: a
lookup reads the days of its keys, a read with an ``as_of`` time the days that have
not expired, however old the store is.

``write_new`` (sets only) stores what no earlier batch has stored: sources that
deliver again after a failure of their own come with a new batch id, which the
replay rule does not know. ``seen`` filters tell most rows to be new for sure; the
others are held against the stored rows, so the result is exact.

``compact`` folds all batches into a snapshot, stored in a partition with a
negative ``batch_id`` (batches must not use these), and then adds a line to the
table ``<root>.snapshots``: (snapshot id, last batch folded in). Readers, in any
process, take the newest snapshot and the batches after it; other partitions are
pruned. Expired days are left out, so a compaction reads the live days only. A crash between the two writes leaves a snapshot that nobody reads. A batch
that is replayed after it was folded in is ignored.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uvlens.operators.seen import BLOCKS, seen_filters, unseen_for_sure
from uvlens.operators.strategies import DEFAULT_LGK, hll_sketch
from uvlens.session import subfolders, written

SET_SCHEMA = "page STRING, window_time BIGINT, user_id STRING, day BIGINT, batch_id BIGINT"
SNAPSHOT_SCHEMA = "snapshot_id BIGINT, last_batch BIGINT"
HLL_SCHEMA = "page STRING, window_time BIGINT, sketch BINARY, day BIGINT, batch_id BIGINT"
SEEN_SCHEMA = "page STRING, window_time BIGINT, block INT, bits BINARY, day BIGINT, batch_id BIGINT"

DAY_MS = 86_400_000

# Default expiries of the reference's store (sets 5 min, HLL 1 day).
SET_TTL_MS = 5 * 60 * 1000
HLL_TTL_MS = 24 * 60 * 60 * 1000


class UVStore:
    def __init__(self, spark: SparkSession, root: str, kind: str = "set",
                 ttl_ms: int | None = None, lgk: int = DEFAULT_LGK, seen_blocks: int = BLOCKS):
        """``seen_blocks``: size of the filters of ``write_new``, fixed for a store's life."""
        if kind not in ("set", "hll"):
            raise ValueError("kind must be 'set' or 'hll'")
        self.spark, self.root, self.kind, self.lgk = spark, root.rstrip("/"), kind, lgk
        self.seen_blocks = seen_blocks
        self.ttl_ms = ttl_ms if ttl_ms is not None else (SET_TTL_MS if kind == "set" else HLL_TTL_MS)

    # -- write ----------------------------------------------------------------
    def batch_rows(self, batch: DataFrame) -> DataFrame:
        """(page, window_time, user_id) rows -> rows to store for this batch."""
        if self.kind == "set":
            return batch.select("page", "window_time", "user_id").dropDuplicates()
        return (batch.groupBy("page", "window_time")
                .agg(hll_sketch("user_id", self.lgk).alias("sketch")))

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        self._write(self.batch_rows(batch), self._batch_id(batch_id))

    def write_new(self, batch: DataFrame, batch_id: int) -> None:
        """Store the (page, window_time, user_id) rows that no earlier batch holds.

        Filters of the batch's days are read first; stored rows only if some row may
        have been seen. Filters are written after the rows, and only those of earlier
        batches are asked, so a replay after a crash between the two writes is safe."""
        if self.kind != "set":
            raise ValueError("a store of sketches merges repeats by itself: use write_batch")
        batch_id, keys = self._batch_id(batch_id), ["page", "window_time", "user_id"]
        rows = written(self.batch_rows(batch), "store-batch")
        first, last = rows.agg(F.min("window_time"), F.max("window_time")).first()
        if first is None:
            return
        days = (first // DAY_MS, last // DAY_MS)
        seen = self._days(f"{self.root}.seen", SEEN_SCHEMA, days).where(F.col("batch_id") < batch_id)
        told = written(unseen_for_sure(rows, seen, self.seen_blocks), "store-told")
        new = told.where("new").select(*keys)
        doubt = told.where("not new").select(*keys)
        if not doubt.isEmpty():
            stored = self.rows(days).where(F.col("batch_id") < batch_id)
            new = new.unionByName(doubt.join(stored, keys, "left_anti"))
        self._write(new, batch_id)
        mine = self._days(self.root, SET_SCHEMA, days).where(F.col("batch_id") == batch_id)
        self._write(seen_filters(mine, self.seen_blocks), batch_id, f"{self.root}.seen")

    @staticmethod
    def _batch_id(batch_id: int) -> int:
        if int(batch_id) < 0:
            raise ValueError("negative batch ids are reserved for snapshots")
        return int(batch_id)

    def _write(self, rows: DataFrame, batch_id: int, path: str | None = None) -> None:
        # One file a day where it fits one, several where it does not: tasks that each
        # hold all days of a long batch would write tasks x days files.
        (rows.withColumn("day", F.expr(f"cast(floor(window_time / {DAY_MS}) as bigint)"))
         .hint("rebalance", "day").withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "batch_id").parquet(path or self.root))

    # -- read -----------------------------------------------------------------
    def _read(self, path: str, schema: str) -> DataFrame:
        """A table of the store; empty before it is first written."""
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _days(self, path: str, schema: str, days: tuple[int | None, int | None]) -> DataFrame:
        """Rows of the days from the first to the last one given (None: no bound). Names
        of day folders are listed; only those in the range are opened."""
        first, last = days
        if first is None and last is None:
            return self._read(path, schema)
        names = [n for n in subfolders(self.spark, path) if n[4:].lstrip("-").isdigit()
                 and (first is None or int(n[4:]) >= first) and (last is None or int(n[4:]) <= last)]
        if not names:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.option("basePath", path).schema(schema)
                .parquet(*(f"{path}/{n}" for n in sorted(names))))

    def snapshot(self) -> tuple[int, int] | None:
        """(number, last batch folded in) of the newest snapshot."""
        got = (self._read(f"{self.root}.snapshots", SNAPSHOT_SCHEMA)
               .orderBy(F.desc("snapshot_id")).first())
        return (got["snapshot_id"], got["last_batch"]) if got else None

    def rows(self, days: tuple[int | None, int | None] = (None, None)) -> DataFrame:
        """All stored rows, or those of a range of days (both ends included); empty
        before the first batch is written."""
        rows = self._days(self.root, SET_SCHEMA if self.kind == "set" else HLL_SCHEMA, days)
        newest = self.snapshot()
        if newest is None:
            return rows.where("batch_id >= 0")
        return rows.where((F.col("batch_id") == -newest[0]) | (F.col("batch_id") > newest[1]))

    def live_rows(self, as_of_ms: int | None = None, first_ms: int | None = None,
                  last_ms: int | None = None) -> DataFrame:
        """Rows not expired at ``as_of_ms``, of buckets from ``first_ms`` to ``last_ms``."""
        alive = None if as_of_ms is None else int(as_of_ms) - self.ttl_ms
        bounds = [ms for ms in (alive, first_ms) if ms is not None]
        rows = self.rows((max(bounds) // DAY_MS if bounds else None,
                          None if last_ms is None else last_ms // DAY_MS))
        return rows if alive is None else rows.where(F.col("window_time") > F.lit(alive))

    def uv(self, as_of_ms: int | None = None) -> DataFrame:
        """(page, window_time, uv) over all stored batches (scard / pfcount)."""
        return self._count(self.live_rows(as_of_ms))

    def _count(self, rows: DataFrame) -> DataFrame:
        if self.kind == "set":
            return (rows.groupBy("page", "window_time")
                    .agg(F.count_distinct("user_id").cast("bigint").alias("uv")))
        return (rows.groupBy("page", "window_time")
                .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast("bigint").alias("uv")))

    def lookup(self, keys: DataFrame, as_of_ms: int | None = None) -> DataFrame:
        """Point / batch lookup by (page, window_time); absent and expired keys give
        0. Only the days of the keys are read, only rows of the asked buckets aggregated."""
        keys = written(keys.select("page", "window_time").distinct(), "lookup-keys")
        first, last = keys.agg(F.min("window_time"), F.max("window_time")).first()
        if first is None:
            return keys.withColumn("uv", F.lit(0).cast("bigint"))
        asked = self.live_rows(as_of_ms, first, last).join(keys, ["page", "window_time"], "left_semi")
        return (keys.join(self._count(asked), ["page", "window_time"], "left")
                .select("page", "window_time", F.coalesce("uv", F.lit(0)).cast("bigint").alias("uv")))

    def compact(self, snapshot_id: int | None = None, as_of_ms: int | None = None) -> int:
        """Fold all live rows into a new snapshot; returns its number (from 1, larger
        than any before). Expired rows are left out."""
        newest = self.snapshot()
        number = max((newest[0] if newest else 0) + 1, int(snapshot_id or 0))
        last = self.live_rows(as_of_ms).agg(F.max("batch_id")).first()[0]
        if last is None:
            return newest[0] if newest else 0
        rows = self.live_rows(as_of_ms).drop("day", "batch_id")
        if self.kind == "set":
            merged = rows.dropDuplicates()
        else:
            merged = rows.groupBy("page", "window_time").agg(F.hll_union_agg("sketch").alias("sketch"))
        self._write(merged, -number)
        last = max(last, newest[1] if newest else -1)
        (self.spark.range(1).select(F.lit(number).cast("bigint").alias("snapshot_id"),
                                    F.lit(last).cast("bigint").alias("last_batch"))
         .write.mode("append").parquet(f"{self.root}.snapshots"))
        return number
