"""Streaming UV jobs.

Each job reads a behaviour stream (file stream here, Kafka in production),
keeps its state in the checkpoint under ``spark.checkpoint.dir`` and writes
either an append-only result (closed windows) or, in update mode, a change
log through ``foreachBatch`` whose last value per key is the current result.
Every write is keyed by the micro-batch id and overwrites only that batch's
partition, so a replayed batch is idempotent.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from uvlens.functions.time import batch_time, window_end_ms
from uvlens.operators.store import UVStore
from uvlens.operators.strategies import DEFAULT_LGK, hll_sketch
from uvlens.session import scratch_path, subfolders

CHANGELOG_SCHEMA_EXTRA = "batch_id BIGINT"


def _window_end(col: str = "window") -> F.Column:
    return F.expr(f"unix_millis({col}.end)")


# --- windowed UV streams (A1, A3 / T1, T3, T4) -----------------------------------

def exact_uv_stream(behaviors: DataFrame, width: str = "1 minute",
                    delay: str = "10 minutes") -> DataFrame:
    """Exact streaming UV: dedup (page, user, window) then count. State is one
    small row per visitor and window, evicted by the watermark."""
    return (behaviors.withWatermark("behavior_time", delay)
            .withColumn("window", F.window("behavior_time", width))
            .dropDuplicates(["page", "user_id", "window"])
            .groupBy("page", "window").agg(F.count(F.lit(1)).alias("uv"))
            .select("page", _window_end().alias("window_time"), F.col("uv").cast("bigint")))


def hll_uv_stream(behaviors: DataFrame, width: str = "1 minute", delay: str = "10 minutes",
                  lgk: int = DEFAULT_LGK) -> DataFrame:
    """Approximate streaming UV: one constant-size sketch per (page, window)."""
    return (behaviors.withWatermark("behavior_time", delay)
            .groupBy("page", F.window("behavior_time", width))
            .agg(F.hll_sketch_estimate(hll_sketch("user_id", lgk)).cast("bigint").alias("uv"))
            .select("page", _window_end().alias("window_time"), "uv"))


def active_windows_stream(behaviors: DataFrame, width: str,
                          delay: str = "10 minutes") -> DataFrame:
    """Windows holding events, with their first and last event time; window
    state is evicted by the watermark."""
    return (behaviors.withWatermark("behavior_time", delay)
            .groupBy("page", F.window("behavior_time", width))
            .agg(F.min("behavior_ms").alias("first_ms"), F.max("behavior_ms").alias("last_ms"))
            .select("page", _window_end().alias("window_time"), "first_ms", "last_ms"))


ACTIVE_LOG = "page STRING, window_time BIGINT, first_ms BIGINT, last_ms BIGINT, batch_id BIGINT"


def active_windows_log(spark: SparkSession, behaviors: DataFrame, width_ms: int, name: str):
    """The same windows without streaming state and without a watermark: every
    micro-batch is aggregated by itself and logged, ``read_active_windows`` merges the
    log. No event is too late for it, in whatever order the files come."""
    out = scratch_path(spark, f"changelog-{name}")
    log = _changelog_writer(out)

    def write(batch: DataFrame, batch_id: int) -> None:
        log(batch.groupBy("page", window_end_ms("behavior_ms", width_ms).alias("window_time"))
            .agg(F.min("behavior_ms").alias("first_ms"), F.max("behavior_ms").alias("last_ms")), batch_id)
    q = (behaviors.writeStream.foreachBatch(write).queryName(f"{name}-{uuid.uuid4().hex[:8]}")
         .option("checkpointLocation", scratch_path(spark, f"ckpt-{name}"))
         .trigger(availableNow=True).start())
    return q, out, name


def read_active_windows(spark: SparkSession, log: str) -> DataFrame:
    """(page, window_time, first_ms, last_ms) over all micro-batches of a log."""
    return (spark.read.schema(ACTIVE_LOG).parquet(log).groupBy("page", "window_time")
            .agg(F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms")))


FIRST_SCHEMA = "page STRING, user_id STRING, first_ms BIGINT"


def first_visits_stream(behaviors: DataFrame) -> DataFrame:
    """First visit of each (page, user) ever, in update mode: the state keeps the
    smallest event time, so neither the order of rows within a micro-batch nor
    the order of the batches matters. The state is the set of users seen so far,
    which is what counting without expiry needs; for bounded state use the TTL
    forms."""
    return (behaviors.groupBy("page", "user_id").agg(F.min("behavior_ms").alias("first_ms")))


def read_first_visits(spark: SparkSession, log: str) -> DataFrame:
    """(page, user_id, first_ms) after all micro-batches of a change log."""
    rows = spark.read.schema(f"{FIRST_SCHEMA}, {CHANGELOG_SCHEMA_EXTRA}").parquet(log)
    return rows.groupBy("page", "user_id").agg(F.min("first_ms").alias("first_ms"))


def new_users_per_window(first_visits: DataFrame, width_ms: int) -> DataFrame:
    """(page, window_time, new_users) of first visits."""
    return (first_visits.groupBy("page", window_end_ms("first_ms", width_ms).alias("window_time"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("new_users")))


def first_seen_stream(behaviors: DataFrame, width: str,
                      delay: str = "10 minutes") -> DataFrame:
    """New users per window, counted inside the stream. It keeps whichever event
    of a (page, user) reaches the state first, so it needs input in time order
    (one file after the other); ``first_visits_stream`` does not."""
    return (behaviors.withWatermark("behavior_time", delay)
            .dropDuplicates(["page", "user_id"])
            .groupBy("page", F.window("behavior_time", width))
            .agg(F.count(F.lit(1)).cast("bigint").alias("new_users"))
            .select("page", _window_end().alias("window_time"), "new_users"))


# --- exact TTL admissions as arbitrary state (T7) ---------------------------------

ADMIT_SCHEMA = "page STRING, user_id STRING, admit_ms BIGINT"
ADMIT_STATE = "last_admit BIGINT"


def _admit_fn(ttl_ms: int):
    def fn(key, pdfs, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        out = []
        for pdf in pdfs:
            t = np.sort(pdf["behavior_ms"].to_numpy(dtype=np.int64))
            pos = 0 if last is None else int(np.searchsorted(t, last + ttl_ms, side="left"))
            while pos < len(t):
                last = int(t[pos])
                out.append(last)
                pos = int(np.searchsorted(t, last + ttl_ms, side="left"))
        if last is not None:
            state.update((last,))
            # Once the watermark passes last + ttl the entry has expired and
            # an absent state means the same: drop it.
            state.setTimeoutTimestamp(last + ttl_ms)
        if out:
            yield pd.DataFrame({"page": [key[0]] * len(out), "user_id": [key[1]] * len(out),
                                "admit_ms": out})
    return fn


def admissions_stream(behaviors: DataFrame, ttl_ms: int, delay: str = "10 minutes") -> DataFrame:
    """Admissions keyed by (page, user): exact entry TTL in event time.

    Events of one key inside a micro-batch are folded in time order; an event
    older than the key's last admission is not admitted again.
    """
    return (behaviors.withWatermark("behavior_time", delay)
            .groupBy("page", "user_id")
            .applyInPandasWithState(_admit_fn(int(ttl_ms)), ADMIT_SCHEMA, ADMIT_STATE,
                                    "append", GroupStateTimeout.EventTimeTimeout))


ADMIT_TABLE = f"{ADMIT_SCHEMA}, day BIGINT, batch_id BIGINT"
DAY_MS = 86_400_000


def read_days(session: SparkSession, path: str, schema: str, first_ms: int | None,
              last_ms: int | None) -> DataFrame:
    """Rows of a table partitioned by ``day``, of the days from ``first_ms`` to ``last_ms``
    (None: no bound): only the folders of these days are opened, however long the stream
    has run. Empty where the table is missing."""
    lo = None if first_ms is None else first_ms // DAY_MS
    hi = None if last_ms is None else last_ms // DAY_MS
    days = [int(n[4:]) for n in subfolders(session, path) if n[4:].lstrip("-").isdigit()]
    paths = [f"{path}/day={d}" for d in sorted(days) if (lo is None or d >= lo) and (hi is None or d <= hi)]
    if not paths:
        return session.createDataFrame([], schema)
    return session.read.option("basePath", path).schema(schema).parquet(*paths)


def seeded_admissions_writer(ttl_ms: int, out: str,
                             then: Callable[[DataFrame, int], None] | None = None):
    """foreachBatch body: fold the micro-batch seeded by stored admissions,
    store the new admissions by day and ``batch_id`` and pass them on."""
    from uvlens.operators.admissions import continue_admissions
    ttl_ms = int(ttl_ms)

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        b = batch.select("page", "user_id", "behavior_ms").persist()  # bounds, then the fold
        try:
            lo, hi = b.agg(F.min("behavior_ms"), F.max("behavior_ms")).first()
            if lo is None:
                return
            prev = (read_days(session, out, ADMIT_TABLE, lo - ttl_ms, hi)
                    .where((F.col("batch_id") < batch_id) & (F.col("admit_ms") > F.lit(int(lo) - ttl_ms))))
            adm = continue_admissions(b, prev.select("page", "user_id", "admit_ms"), ttl_ms)
            (adm.withColumn("day", F.expr(f"cast(floor(admit_ms / {DAY_MS}) as bigint)"))
             .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("day", "batch_id").parquet(out))
        finally:
            b.unpersist()
        if then is not None:
            stored = (read_days(session, out, ADMIT_TABLE, lo, hi)
                      .where(F.col("batch_id") == batch_id).drop("batch_id", "day"))
            then(stored, batch_id)
    return write


def admissions_store_stream(spark: SparkSession, behaviors: DataFrame, ttl_ms: int,
                            out: str, name: str = "adm-store"):
    """Exact TTL admissions of a stream without per-key Python calls.

    Each micro-batch is folded as a batch job (sorted partitions through
    ``mapInPandas``), seeded by the admissions of earlier batches that are
    younger than the TTL relative to the batch; its admissions are written
    to the ``day`` and ``batch_id`` partitions of ``out``. Replaying a batch overwrites
    its own partitions and ignores them as seeds, so the result is unchanged.
    """
    q = (behaviors.writeStream.foreachBatch(seeded_admissions_writer(ttl_ms, out))
         .option("checkpointLocation", scratch_path(spark, f"ckpt-{name}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out


# --- running a stream to completion ------------------------------------------------

# name -> state rows / bytes of the last run, from the streaming progress report
STATE_METRICS: dict[str, dict[str, int]] = {}


def _record_state(name: str, q) -> None:
    rows = mem = 0
    for p in q.recentProgress or []:
        ops = p.get("stateOperators", []) if isinstance(p, dict) else []
        if ops:  # peak over the micro-batches
            rows = max(rows, sum(int(o.get("numRowsTotal", 0)) for o in ops))
            mem = max(mem, sum(int(o.get("memoryUsedBytes", 0)) for o in ops))
    STATE_METRICS[name] = {"peak_state_rows": rows, "peak_state_bytes": mem}

def _changelog_writer(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))
    return write


def start_update(spark: SparkSession, result: DataFrame, name: str):
    """Start an update-mode stream over the available input; returns
    (query, change-log folder with one partition per micro-batch)."""
    out = scratch_path(spark, f"changelog-{name}")
    q = (result.writeStream.outputMode("update").queryName(f"{name}-{uuid.uuid4().hex[:8]}")
         .option("checkpointLocation", scratch_path(spark, f"ckpt-{name}"))
         .foreachBatch(_changelog_writer(out))
         .trigger(availableNow=True).start())
    return q, out, name


def start_append(spark: SparkSession, result: DataFrame, name: str):
    out = scratch_path(spark, f"append-{name}")
    q = (result.writeStream.outputMode("append").format("parquet")
         .queryName(f"{name}-{uuid.uuid4().hex[:8]}")
         .option("path", out)
         .option("checkpointLocation", scratch_path(spark, f"ckpt-{name}"))
         .trigger(availableNow=True).start())
    return q, out, name


def await_all(*handles) -> list[str]:
    """Wait for streams started together (their fixed costs overlap)."""
    outs = []
    for q, out, name in handles:
        q.awaitTermination()
        _record_state(name, q)
        outs.append(out)
    return outs


def run_update(spark: SparkSession, result: DataFrame, name: str) -> str:
    return await_all(start_update(spark, result, name))[0]


def run_append(spark: SparkSession, result: DataFrame, name: str) -> str:
    return await_all(start_append(spark, result, name))[0]


def read_changelog(spark: SparkSession, path: str, schema: str, keys: list[str],
                   value_cols: list[str]) -> DataFrame:
    """Last value per key across micro-batches."""
    log = spark.read.schema(f"{schema}, {CHANGELOG_SCHEMA_EXTRA}").parquet(path)
    return log.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in value_cols])


def cumulative_from(active: DataFrame, new_users: DataFrame) -> DataFrame:
    w = Window.partitionBy("page").orderBy("window_time").rowsBetween(Window.unboundedPreceding, 0)
    return (active.join(new_users, ["page", "window_time"], "left")
            .select("page", "window_time",
                    F.sum(F.coalesce("new_users", F.lit(0))).over(w).cast("bigint").alias("uv")))


def cumulative_ttl_from(active: DataFrame, new_users: DataFrame, ttl_ms: int) -> DataFrame:
    """Running admitted users per page that restarts after a page silence
    >= ttl. ``active`` has (page, window_time, first_ms, last_ms) for every
    window with events; a silence is the gap from one active window's last
    event to the next one's first (windows must be shorter than the TTL).
    The windows over pages hold one row per active window."""
    w = Window.partitionBy("page").orderBy("window_time")
    prev_last = F.lag("last_ms").over(w)
    brk = F.when(prev_last.isNull() | (F.col("first_ms") - prev_last >= int(ttl_ms)), 1).otherwise(0)
    epochs = (active.withColumn("brk", brk)
              .withColumn("epoch", F.sum("brk").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    we = (Window.partitionBy("page", "epoch").orderBy("window_time")
          .rowsBetween(Window.unboundedPreceding, 0))
    return (epochs.join(new_users, ["page", "window_time"], "left")
            .select("page", "window_time",
                    F.sum(F.coalesce("new_users", F.lit(0))).over(we).cast("bigint").alias("uv")))


def store_stream(spark: SparkSession, behaviors: DataFrame, store: UVStore, n: int = 1,
                 unit: str = "minutes", zone: str = "UTC", name: str = "store") -> UVStore:
    """Each micro-batch merges its (page, bucket, user) rows into the
    keyed store; the bucket is year-anchored and labelled by its start."""
    def write(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.select("page", "user_id",
                             batch_time("behavior_ms", n, unit, zone).alias("window_time"))
        store.write_batch(keyed, batch_id)

    q = (behaviors.writeStream.foreachBatch(write)
         .option("checkpointLocation", scratch_path(spark, f"ckpt-{name}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return store
