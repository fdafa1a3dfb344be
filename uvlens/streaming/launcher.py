"""Run a UV strategy as a long-running streaming job.

    python -m uvlens.streaming.launcher --strategy exact \\
        --source kafka --servers host:9092 --topic behaviors \\
        --sink console --trigger-seconds 5

Sources: ``kafka`` (JSON messages), ``json`` (folder of JSON-lines files) or
``parquet`` (folder of files with the ``events`` schema). Sinks: ``console``
(report lines ``key:...,window time:...,uv:...``, the first ``--console-rows`` of
each micro-batch) or ``parquet`` (change log partitioned by micro-batch id; the last
value per page and window is the result). A long-running job needs ``--checkpoint``;
the folders of its admissions and active windows lie next to it, so that a restart
goes on where the job stopped. With ``--once`` a fresh folder is used.

Strategies (one per reference plan):

==================  =====================================================
exact               distinct users per window: dedup state + count (A1)
cumulative          users admitted under the entry TTL, summed per page up to each
                    window; the sum restarts after a silent TTL (A2)
hll                 HLL sketch per window (A3)
hll-store           per-batch sketches merged in a keyed store (A4, A10)
new-visitors        users new to the page within the TTL, per window; 0 for windows
                    with events but no new user (A5)
slots               occupied hash slots per window (A6)
hash                distinct 63-bit hashes per window (A7)
set-store           per-batch distinct users merged in a keyed store (A8, A9)
==================  =====================================================
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uvlens.functions.time import batch_time, format_ms, window_end_ms
from uvlens.operators.reports import store_lines
from uvlens.operators.store import UVStore
from uvlens.operators.strategies import DEFAULT_SLOTS, hash63, md5_slot
from uvlens.session import build_session, scratch_path
from uvlens.sources.streams import (
    json_line_messages, kafka_messages, stream_behaviors, stream_behaviors_from_messages,
)
from uvlens.streaming import jobs as J

STRATEGIES = ("exact", "cumulative", "hll", "hll-store", "new-visitors", "slots", "hash",
              "set-store")


def source(spark: SparkSession, args) -> DataFrame:
    if args.source == "kafka":
        extra = {"maxOffsetsPerTrigger": str(args.max_offsets)} if args.max_offsets else {}
        return stream_behaviors_from_messages(kafka_messages(spark, args.servers, args.topic,
                                                             args.starting_offsets, **extra))
    if args.source == "json":
        return stream_behaviors_from_messages(json_line_messages(spark, args.path, args.max_files))
    return stream_behaviors(spark, args.path, glob=args.glob, max_files=args.max_files)


def _distinct_keyed(b: DataFrame, key, width: str, delay: str) -> DataFrame:
    """Exact distinct count of ``key`` per (page, window) on a stream."""
    return (b.withWatermark("behavior_time", delay)
            .withColumn("window", F.window("behavior_time", width))
            .withColumn("_k", key)
            .dropDuplicates(["page", "_k", "window"])
            .groupBy("page", "window").agg(F.count(F.lit(1)).cast("bigint").alias("uv"))
            .select("page", F.expr("unix_millis(window.end)").alias("window_time"), "uv"))


def windowed_result(b: DataFrame, args) -> DataFrame:
    if args.strategy == "exact":
        return J.exact_uv_stream(b, args.window, args.delay)
    if args.strategy == "hll":
        return J.hll_uv_stream(b, args.window, args.delay)
    if args.strategy == "slots":
        return _distinct_keyed(b, md5_slot("user_id", args.slots), args.window, args.delay)
    if args.strategy == "hash":
        return _distinct_keyed(b, hash63("user_id"), args.window, args.delay)
    raise ValueError(args.strategy)


def _print(lines: DataFrame, limit: int) -> None:
    """Console sink: the first ``limit`` lines of a micro-batch (one more is read to
    tell whether there are others)."""
    got = lines.limit(limit + 1).collect()
    for r in got[:limit]:
        print(r.line)
    if len(got) > limit:
        print(f"... more than {limit} lines; use --sink parquet for all")


def _sink_batch(args, out: str | None):
    def write(batch: DataFrame, batch_id: int) -> None:
        if args.sink == "console":
            _print(batch.select(F.concat(
                F.lit("key:"), F.col("page"), F.lit(",window time:"),
                format_ms("window_time", "yyyy-MM-dd HH:mm:ss", args.zone),
                F.lit(",uv:"), F.col("uv").cast("string")).alias("line")), args.console_rows)
        else:
            _write_batch(batch, batch_id, out)
    return write


def _write_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    (rows.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


ACTIVE_SCHEMA = "page STRING, window_time BIGINT, first_ms BIGINT, last_ms BIGINT, day BIGINT, batch_id BIGINT"
TOTALS_SCHEMA = "page STRING, window_time BIGINT, uv BIGINT, day BIGINT, batch_id BIGINT"


def _write_days(rows: DataFrame, batch_id: int, path: str) -> None:
    """Rows with a ``window_time``, by its day and the micro-batch."""
    (rows.withColumn("day", F.expr(f"cast(floor(window_time / {J.DAY_MS}) as bigint)"))
     .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day", "batch_id").parquet(path))


def new_users(admitted: DataFrame, width_ms: int) -> DataFrame:
    return (admitted.select("page", "user_id", window_end_ms("admit_ms", width_ms).alias("window_time"))
            .groupBy("page", "window_time").agg(F.count_distinct("user_id").alias("new_users")))


def admission_totals(admitted: DataFrame, touched: DataFrame, width_ms: int) -> DataFrame:
    """(page, window_time, uv) of the windows of a micro-batch: new visitors, 0 if none."""
    return (touched.join(new_users(admitted, width_ms), ["page", "window_time"], "left")
            .select("page", "window_time", F.coalesce("new_users", F.lit(0)).cast("bigint").alias("uv")))


def running_totals(admitted: DataFrame, active: DataFrame, totals: DataFrame, touched: DataFrame,
                   width_ms: int, ttl_ms: int) -> DataFrame:
    """(page, window_time, uv) of the windows whose running total a micro-batch may
    change: those of a page from its first touched window on.

    ``totals`` holds the totals that earlier batches stored. A page goes on from the last
    window before its first touched one: that window enters with its stored total in place
    of its new users, and whether the sum restarts after it is judged by its last event as
    for any other. A window a TTL or more back does not matter, as the sum restarts, so
    the three inputs need to reach back by a TTL and a window only."""
    since = touched.groupBy("page").agg(F.min("window_time").alias("since"))
    seen = (active.join(since, "page").groupBy("page", "window_time", "since")
            .agg(F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms")))
    before = seen.where("window_time < since").groupBy("page").agg(F.max("window_time").alias("window_time"))
    carried = (totals.join(before, ["page", "window_time"]).groupBy("page", "window_time")
               .agg(F.max_by("uv", "batch_id").alias("new_users")))
    kept = (seen.join(before.withColumnRenamed("window_time", "last_before"), "page", "left")
            .where("window_time >= since OR window_time = last_before")
            .select("page", "window_time", "first_ms", "last_ms"))
    new = (new_users(admitted, width_ms).join(since, "page").where("window_time >= since").drop("since")
           .unionByName(carried))
    return J.cumulative_ttl_from(kept, new, ttl_ms).join(since, "page").where("window_time >= since").drop("since")


def _admissions_batch(args, state: str, ttl_ms: int, out: str | None):
    """foreachBatch body of the strategies with entry TTL: folds the micro-batch into
    the stored admissions and active windows, then reports the changed totals. Every
    write replaces only the batch's own partitions, and later partitions are not read,
    so a replay gives the same rows.

    What is read reaches from the batch's first window (for running totals a TTL earlier)
    to the newest one: it depends on how late events are, not on the age of the job."""
    width_ms = _width_ms(args.window)
    admissions, windows, running = f"{state}/admissions", f"{state}/active", f"{state}/totals"
    fold = J.seeded_admissions_writer(ttl_ms, admissions)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = (batch.groupBy("page", window_end_ms("behavior_ms", width_ms).alias("window_time"))
                   .agg(F.min("behavior_ms").alias("first_ms"), F.max("behavior_ms").alias("last_ms"))).persist()
        try:
            first, last = touched.agg(F.min("window_time"), F.max("window_time")).first()
            if first is None:
                return
            _write_days(touched, batch_id, windows)
        finally:
            touched.unpersist()
        upto = F.col("batch_id") <= batch_id
        mine = (J.read_days(spark, windows, ACTIVE_SCHEMA, first, last)
                .where(F.col("batch_id") == batch_id).select("page", "window_time"))
        fold(batch, batch_id)
        if args.strategy == "new-visitors":
            admitted = J.read_days(spark, admissions, J.ADMIT_TABLE, first - width_ms, last).where(upto)
            _sink_batch(args, out)(admission_totals(admitted, mine, width_ms), batch_id)
            return
        back = first - ttl_ms - width_ms
        admitted = J.read_days(spark, admissions, J.ADMIT_TABLE, first - width_ms, None).where(upto)
        active = J.read_days(spark, windows, ACTIVE_SCHEMA, back, None).where(upto)
        totals = J.read_days(spark, running, TOTALS_SCHEMA, back, None).where(F.col("batch_id") < batch_id)
        _write_days(running_totals(admitted, active, totals, mine, width_ms, ttl_ms), batch_id, running)
        changed = J.read_days(spark, running, TOTALS_SCHEMA, first, None).where(F.col("batch_id") == batch_id)
        _sink_batch(args, out)(changed.drop("day", "batch_id"), batch_id)
    return write


def _keyed_admissions_batch(args, state: str, ttl_ms: int, out: str | None):
    """The same totals where a keyed-state stream has already made the admissions
    (new visitors only: its output says nothing of windows without admissions)."""
    width_ms = _width_ms(args.window)
    folder = f"{state}/admissions"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("page", "user_id", "admit_ms",
                            window_end_ms("admit_ms", width_ms).alias("window_time")).persist()
        try:
            first, last = rows.agg(F.min("window_time"), F.max("window_time")).first()
            if first is None:
                return
            _write_days(rows, batch_id, folder)
        finally:
            rows.unpersist()
        schema = f"{J.ADMIT_SCHEMA}, window_time BIGINT, day BIGINT, batch_id BIGINT"
        admitted = (J.read_days(spark, folder, schema, first, last).where(F.col("batch_id") <= batch_id)
                    .drop("window_time"))
        mine = (admitted.where(F.col("batch_id") == batch_id)
                .select("page", window_end_ms("admit_ms", width_ms).alias("window_time")).distinct())
        _sink_batch(args, out)(admission_totals(admitted, mine, width_ms), batch_id)
    return write


def _width_ms(text: str) -> int:
    n, unit = text.split()
    mult = {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
    return int(n) * mult[unit.rstrip("s")]


def start(spark: SparkSession, args):
    if not args.checkpoint and not args.once:
        raise ValueError("a long-running job needs --checkpoint: a restart would forget its state")
    b = source(spark, args)
    ckpt = args.checkpoint or scratch_path(spark, f"ckpt-{args.strategy}")
    state = args.admissions or f"{ckpt.rstrip('/')}-state"
    out = args.out if args.sink == "parquet" else None
    trigger = ({"availableNow": True} if args.once
               else {"processingTime": f"{args.trigger_seconds} seconds"})
    if args.strategy in ("set-store", "hll-store"):
        kind = "set" if args.strategy == "set-store" else "hll"
        store = UVStore(spark, args.out or f"{state}/store", kind)

        def write(batch: DataFrame, batch_id: int) -> None:
            keyed = batch.select("page", "user_id", "behavior_ms",
                                 batch_time("behavior_ms", args.bucket_n, args.bucket_unit,
                                            args.zone).alias("window_time"))
            if args.only_new and kind == "set":
                store.write_new(keyed.select("page", "window_time", "user_id"), batch_id)
            else:
                store.write_batch(keyed, batch_id)
            if args.compact_every and batch_id % args.compact_every == args.compact_every - 1:
                # The earliest event decides: one clock that runs ahead expires nothing.
                store.compact(as_of_ms=keyed.agg(F.min("behavior_ms")).first()[0])
            if args.sink == "console":
                now = keyed.agg(F.max("behavior_ms")).first()[0]
                if now is not None:
                    _print(store_lines(store, keyed, now), args.console_rows)
        w = b.writeStream.foreachBatch(write)
    elif args.strategy in ("new-visitors", "cumulative"):
        ttl = int(args.ttl_hours * 3_600_000)
        if args.state == "keyed":
            if args.strategy == "cumulative":
                raise ValueError("cumulative needs --state seeded")
            w = (J.admissions_stream(b, ttl, args.delay).writeStream.outputMode("append")
                 .foreachBatch(_keyed_admissions_batch(args, state, ttl, out)))
        else:
            w = b.writeStream.foreachBatch(_admissions_batch(args, state, ttl, out))
    else:
        res = windowed_result(b, args)
        w = res.writeStream.outputMode(args.mode).foreachBatch(_sink_batch(args, out))
    return w.option("checkpointLocation", ckpt).trigger(**trigger).start()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    p.add_argument("--strategy", choices=STRATEGIES, default="exact")
    p.add_argument("--source", choices=("kafka", "json", "parquet"), default="kafka")
    p.add_argument("--servers")
    p.add_argument("--topic")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--path")
    p.add_argument("--glob")
    p.add_argument("--max-files", type=int, help="files per micro-batch (file sources)")
    p.add_argument("--max-offsets", type=int, help="records per micro-batch (Kafka)")
    p.add_argument("--sink", choices=("console", "parquet"), default="console")
    p.add_argument("--out")
    p.add_argument("--checkpoint")
    p.add_argument("--mode", choices=("update", "append"), default="update")
    p.add_argument("--window", default="1 minute")
    p.add_argument("--delay", default="10 minutes")
    p.add_argument("--ttl-hours", type=float, default=3.0)
    p.add_argument("--state", choices=("seeded", "keyed"), default="seeded",
                   help="TTL admissions: batch fold seeded from stored admissions, or "
                        "applyInPandasWithState keyed by (page, user)")
    p.add_argument("--admissions", help="folder of stored admissions, active windows and "
                                        "store (default: next to the checkpoint)")
    p.add_argument("--console-rows", type=int, default=1000, help="lines printed per micro-batch")
    p.add_argument("--slots", type=int, default=DEFAULT_SLOTS)
    p.add_argument("--bucket-n", type=int, default=1)
    p.add_argument("--bucket-unit", default="minutes")
    p.add_argument("--zone", default="UTC")
    p.add_argument("--only-new", action="store_true",
                   help="set-store: store no visitor of a bucket twice, also if the source delivers again")
    p.add_argument("--compact-every", type=int, default=0,
                   help="set-store, hll-store: fold the live buckets into a snapshot every so many "
                        "micro-batches (0: never); buckets expired by then are left out")
    p.add_argument("--trigger-seconds", type=int, default=5)
    p.add_argument("--once", action="store_true", help="process what is available, then stop")
    p.add_argument("--master")
    p.add_argument("--cluster", action="store_true", help="apply the large-cluster settings")
    p.add_argument("--state-partitions", type=int,
                   help="state partitions of a new query (fixed in its checkpoint); "
                        "about 2-3x the total cores")
    return p


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    extra = ({"spark.sql.shuffle.partitions": str(args.state_partitions)}
             if args.state_partitions else None)
    spark = build_session(args.master, app=f"uvlens-{args.strategy}", cluster=args.cluster,
                          extra=extra)
    q = start(spark, args)
    q.awaitTermination()


if __name__ == "__main__":
    main()
