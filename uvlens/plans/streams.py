"""Streaming and store queries, checked with the SQL of their batch forms.

Each stream reads the ``events`` table (a file or a folder of part files) as a
file stream (``availableNow``), so it processes the whole table; the final rows
are read back from the sink.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from uvlens.functions import time as TM
from uvlens.operators.reports import store_lines
from uvlens.operators.store import UVStore
from uvlens.operators.windows import DAY, HOUR, MINUTE
from uvlens.plans import uv as U
from uvlens.plans.registry import B_SQL, ORACLE, register
from uvlens.session import scratch_path
from uvlens.sources.behaviors import load_behaviors
from uvlens.sources.streams import stream_table_behaviors
from uvlens.sources.tables import read_table
from uvlens.streaming import jobs as J
from uvlens.streaming import late as L


def _stream(spark, sf_dir):
    return stream_table_behaviors(spark, sf_dir)


ROWS_PER_FILE = 1_000_000
ROWS_PER_BATCH = 100_000_000


def _stream_in_batches(spark, sf_dir):
    """The events dealt out to files that overlap in time, of up to a million rows each,
    streamed in at least four micro-batches of up to a hundred million rows: tasks and
    batches grow in number with the table, not in size."""
    events = read_table(spark, sf_dir, "events")
    files = max(4, -(-events.count() // ROWS_PER_FILE))
    folder = scratch_path(spark, "stream-in")
    events.repartition(files, F.xxhash64("event_id")).write.parquet(f"{folder}/events.parquet")
    return stream_table_behaviors(spark, folder, max_files=min(files // 4, ROWS_PER_BATCH // ROWS_PER_FILE))


def _batch(spark, sf_dir):
    return load_behaviors(spark, sf_dir)


@register("stream_uv_exact", ORACLE["uv_exact"])
def stream_uv_exact(spark, sf_dir):
    """Exact UV per minute in update mode; last value per key."""
    log = J.run_update(spark, J.exact_uv_stream(_stream(spark, sf_dir), "1 minute"), "exact")
    return J.read_changelog(spark, log, "page STRING, window_time BIGINT, uv BIGINT",
                            ["page", "window_time"], ["uv"])


@register("stream_uv_hll", ORACLE["uv_exact"])
def stream_uv_hll(spark, sf_dir):
    """A3 as a stream (update mode): the sketch's UV per page and minute."""
    log = J.run_update(spark, J.hll_uv_stream(_stream(spark, sf_dir), "1 minute"), "hll")
    return J.read_changelog(spark, log, "page STRING, window_time BIGINT, uv BIGINT",
                            ["page", "window_time"], ["uv"])


APPEND_DELAY_MS = 3_600_000


@register("stream_uv_append", f"""
WITH {B_SQL}
SELECT page, (behavior_ms // 86400000 + 1) * 86400000 AS window_time,
       count(DISTINCT user_id)::BIGINT AS uv
FROM b GROUP BY 1, 2
HAVING (behavior_ms // 86400000 + 1) * 86400000 <= (SELECT max(behavior_ms) FROM b) - {APPEND_DELAY_MS}""")
def stream_uv_append(spark, sf_dir):
    """T4/T5: append mode, 1-day windows, 1-hour delay: one final row per
    window closed by the watermark."""
    res = J.exact_uv_stream(_stream(spark, sf_dir), "1 day", "1 hour")
    out = J.run_append(spark, res, "append")
    return spark.read.schema("page STRING, window_time BIGINT, uv BIGINT").parquet(out)


ACTIVE_SCHEMA = "page STRING, window_time BIGINT, first_ms BIGINT"


def _first_seen_and_active(spark, stream, width_ms: int, width: str, name: str):
    """(new users per window, active windows) of a stream without expiry: the
    first visit of every (page, user) as streaming state, and active windows."""
    seen_log, act_log = J.await_all(
        J.start_update(spark, J.first_visits_stream(stream()), f"{name}-new"),
        J.start_update(spark, J.active_windows_stream(stream(), width), f"{name}-active"))
    new = J.new_users_per_window(J.read_first_visits(spark, seen_log), width_ms)
    act = J.read_changelog(spark, act_log, ACTIVE_SCHEMA, ["page", "window_time"], ["first_ms"])
    return new, act.drop("first_ms")


def _with_zeros(act, new):
    return (act.join(new, ["page", "window_time"], "left")
            .select("page", "window_time", F.coalesce("new_users", F.lit(0)).cast("bigint").alias("uv")))


@register("stream_uv_cumulative", ORACLE["uv_cumulative"])
def stream_uv_cumulative(spark, sf_dir):
    """A2 as streams: first visits and active 30-s windows, both in update
    mode; running sum over the final change logs."""
    new, act = _first_seen_and_active(spark, lambda: _stream(spark, sf_dir), 30_000, "30 seconds", "cum")
    return J.cumulative_from(act, new)


@register("stream_uv_cumulative_ttl", ORACLE["uv_cumulative_ttl"])
def stream_uv_cumulative_ttl(spark, sf_dir):
    """A2 with a 1-hour entry TTL and page reset on a stream: admissions from
    the seeded-fold stream, active 30-s windows with their first and last
    event from an update stream; running sums per page epoch on read."""
    active = J.start_update(spark, J.active_windows_stream(_stream(spark, sf_dir), "30 seconds"),
                            "cumt-active")
    out = J.admissions_store_stream(spark, _stream(spark, sf_dir), U.TTL_TEST_MS,
                                    scratch_path(spark, "adm-store"), "cumt-adm")
    (act_log,) = J.await_all(active)
    admitted = spark.read.schema(f"{J.ADMIT_SCHEMA}, batch_id BIGINT").parquet(out)
    new = (admitted.select("page", "user_id",
                           TM.window_end_ms("admit_ms", 30_000).alias("window_time"))
           .groupBy("page", "window_time")
           .agg(F.count_distinct("user_id").alias("new_users")))
    act = J.read_changelog(spark, act_log,
                           "page STRING, window_time BIGINT, first_ms BIGINT, last_ms BIGINT",
                           ["page", "window_time"], ["first_ms", "last_ms"])
    return J.cumulative_ttl_from(act, new, U.TTL_TEST_MS)


@register("stream_uv_new_visitors", ORACLE["uv_new_visitors"])
def stream_uv_new_visitors(spark, sf_dir):
    """A5 without expiry as streams: first visits per minute, 0 for windows
    with events but no new user."""
    new, act = _first_seen_and_active(spark, lambda: _stream(spark, sf_dir), MINUTE, "1 minute", "nv")
    return _with_zeros(act, new)


@register("stream_uv_new_visitors_wm", ORACLE["uv_new_visitors"])
def stream_uv_new_visitors_wm(spark, sf_dir):
    """A5 without expiry over micro-batches that overlap in time by their whole length.
    Neither the first visits nor the logged active windows need a watermark, so no event
    is too late and no window stays in the state."""
    stream = _stream_in_batches(spark, sf_dir)
    seen_log, act_log = J.await_all(
        J.start_update(spark, J.first_visits_stream(stream), "nv-wm"),
        J.active_windows_log(spark, stream, MINUTE, "nv-wm-active"))
    new = J.new_users_per_window(J.read_first_visits(spark, seen_log), MINUTE)
    return _with_zeros(J.read_active_windows(spark, act_log).select("page", "window_time"), new)


@register("stream_uv_new_visitors_ttl", ORACLE["uv_new_visitors_ttl"])
def stream_uv_new_visitors_ttl(spark, sf_dir):
    """A5 with a 1-hour entry TTL on a stream: every micro-batch is folded as
    a batch job seeded by earlier admissions younger than the TTL; admitted
    users are counted per minute. (``jobs.admissions_stream`` is the same
    rule as arbitrary keyed state.)"""
    active = J.start_update(spark, J.active_windows_stream(_stream(spark, sf_dir), "1 minute"),
                            "nvt-active")
    out = J.admissions_store_stream(spark, _stream(spark, sf_dir), U.TTL_TEST_MS,
                                    scratch_path(spark, "adm-store"), "nv-ttl")
    (act_log,) = J.await_all(active)
    admitted = spark.read.schema(f"{J.ADMIT_SCHEMA}, batch_id BIGINT").parquet(out)
    per_window = (admitted.select("page", "user_id",
                                  TM.window_end_ms("admit_ms", MINUTE).alias("window_time"))
                  .groupBy("page", "window_time")
                  .agg(F.count_distinct("user_id").alias("new_users")))
    act = J.read_changelog(spark, act_log, "page STRING, window_time BIGINT, first_ms BIGINT",
                           ["page", "window_time"], ["first_ms"])
    return (act.join(per_window, ["page", "window_time"], "left")
            .select("page", "window_time", F.coalesce("new_users", F.lit(0)).cast("bigint").alias("uv")))


@register("uv_microbatch_set", ORACLE["uv_dedup_bucket"])
def uv_microbatch_set(spark, sf_dir):
    """Micro-batches merged into the keyed set store (year-anchored
    minutes, label = start); UV read back from the store."""
    store = UVStore(spark, scratch_path(spark, "store-set"), "set")
    J.store_stream(spark, _stream_in_batches(spark, sf_dir), store, 1, "minutes", name="mb-set")
    return store.uv()


@register("uv_microbatch_hll", ORACLE["uv_dedup_bucket"])
def uv_microbatch_hll(spark, sf_dir):
    """A10: micro-batches merged into the keyed sketch store; UV of the
    merged sketches."""
    store = UVStore(spark, scratch_path(spark, "store-hll"), "hll")
    J.store_stream(spark, _stream_in_batches(spark, sf_dir), store, 1, "minutes", name="mb-hll")
    return store.uv()


@register("stream_uv_store", f"""
WITH {B_SQL},
y AS (SELECT *, epoch_us(date_trunc('year', ts)) // 1000 AS ys FROM b),
u AS (SELECT page, ys + ((behavior_ms - ys) // 3600000) * 3600000 AS window_time,
             count(DISTINCT user_id)::BIGINT AS uv FROM y GROUP BY 1, 2)
SELECT * FROM u WHERE window_time + 86400000 > (SELECT max(behavior_ms) FROM b)""")
def stream_uv_store(spark, sf_dir):
    """K4 with expiry: hourly sets kept for one day; read as of the latest
    event time, so only buckets younger than a day remain."""
    store = UVStore(spark, scratch_path(spark, "store-exp"), "set", ttl_ms=DAY)
    J.store_stream(spark, _stream(spark, sf_dir), store, 1, "hours", name="st-exp")
    as_of = _batch(spark, sf_dir).agg(F.max("behavior_ms")).first()[0]
    return store.uv(as_of_ms=as_of)


_HOUR_START_SQL = f"""
WITH {B_SQL}
SELECT page, behavior_ms - behavior_ms % 3600000 AS window_time, count(DISTINCT user_id)::BIGINT AS uv
FROM b GROUP BY 1, 2"""


def _two_batches_store(spark, sf_dir) -> UVStore:
    """Store filled by two batches (before / after the median time) and a
    replay of the second batch, which must change nothing."""
    b = _batch(spark, sf_dir).select("page", "user_id",
                                     TM.hour_start("behavior_ms").alias("window_time"), "behavior_ms")
    cut = b.agg(F.percentile_approx("behavior_ms", 0.5)).first()[0]
    store = UVStore(spark, scratch_path(spark, "store-upsert"), "set")
    store.write_batch(b.where(F.col("behavior_ms") < cut), 0)
    store.write_batch(b.where(F.col("behavior_ms") >= cut), 1)
    store.write_batch(b.where(F.col("behavior_ms") >= cut), 1)
    return store


@register("uv_store_upsert", _HOUR_START_SQL)
def uv_store_upsert(spark, sf_dir):
    """K4: batches merged by key into the store, replay-safe."""
    return _two_batches_store(spark, sf_dir).uv()


@register("uv_lookup", f"""
WITH {B_SQL},
u AS (SELECT page, behavior_ms - behavior_ms % 3600000 AS window_time,
             count(DISTINCT user_id)::BIGINT AS uv FROM b GROUP BY 1, 2),
k AS (SELECT page, window_time FROM u UNION SELECT page, window_time + 3600000 FROM u)
SELECT k.page, k.window_time, coalesce(u.uv, 0)::BIGINT AS uv
FROM k LEFT JOIN u ON u.page = k.page AND u.window_time = k.window_time""")
def uv_lookup(spark, sf_dir):
    """K5: lookups by (page, hour) for every stored hour and the hour after
    it; hours never written give 0."""
    store = _two_batches_store(spark, sf_dir)
    stored = store.uv().select("page", "window_time")
    keys = stored.unionByName(stored.select("page", (F.col("window_time") + HOUR).alias("window_time"))
                              ).distinct()
    return store.lookup(keys)


@register("store_report_lines", f"""
WITH {B_SQL},
u AS (SELECT page, behavior_ms - behavior_ms % 3600000 AS window_time,
             count(DISTINCT user_id)::BIGINT AS n FROM b GROUP BY 1, 2),
l AS (SELECT page, window_time,
             (CASE WHEN window_time + {DAY} > (SELECT max(behavior_ms) FROM b) THEN n ELSE 0 END)::BIGINT AS uv
      FROM u)
SELECT *, 'page:' || page || ',batch time:' || window_time || ',uv:' || uv AS line FROM l""")
def store_report_lines(spark, sf_dir):
    """K2: the printed line of every bucket that the micro-batches wrote, read back
    from the store as of the latest event; buckets older than a day have expired."""
    store = UVStore(spark, scratch_path(spark, "store-lines"), "hll", ttl_ms=DAY)
    J.store_stream(spark, _stream_in_batches(spark, sf_dir), store, 1, "hours", name="st-lines")
    as_of = _batch(spark, sf_dir).agg(F.max("behavior_ms")).first()[0]
    return store_lines(store, store.rows().select("page", "window_time"), as_of)


@register("uv_store_redelivery", f"""
WITH {B_SQL}
SELECT page, behavior_ms - behavior_ms % 3600000 AS window_time,
       count(DISTINCT user_id)::BIGINT AS uv, count(DISTINCT user_id)::BIGINT AS stored_rows
FROM b GROUP BY 1, 2""")
def uv_store_redelivery(spark, sf_dir):
    """The duplicate filter between micro-batches. The events before the median time
    come as batch 0, then a source delivers everything again as batch 1 and once more as
    batch 2; each visitor of a bucket is stored once."""
    b = _batch(spark, sf_dir).select("page", "user_id", "behavior_ms",
                                     TM.hour_start("behavior_ms").alias("window_time"))
    cut = b.agg(F.percentile_approx("behavior_ms", 0.5)).first()[0]
    store = UVStore(spark, scratch_path(spark, "store-new"), "set")
    store.write_new(b.where(F.col("behavior_ms") < cut), 0)
    store.write_new(b, 1)
    store.write_new(b, 2)
    return (store.rows().groupBy("page", "window_time")
            .agg(F.count_distinct("user_id").cast("bigint").alias("uv"),
                 F.count(F.lit(1)).cast("bigint").alias("stored_rows")))


LATE_DELAY_MS = 2 * DAY
# Arrival of an event: its week, or the week after for the users whose devices send a
# week's events at once (one in seven).
_ARRIVAL = ("(behavior_ms - (SELECT min(behavior_ms) FROM b)) // 604800000 "
            "+ CASE WHEN user_num % 7 = 0 THEN 1 ELSE 0 END")


@register("uv_late_report", f"""
WITH {B_SQL},
a AS (SELECT page, user_id, behavior_ms, {_ARRIVAL} AS arrival,
             (behavior_ms // 3600000 + 1) * 3600000 AS window_time FROM b),
m AS (SELECT DISTINCT arrival FROM a),
w AS (SELECT m.arrival, (SELECT max(behavior_ms) FROM a x WHERE x.arrival < m.arrival) - {LATE_DELAY_MS} AS mark
      FROM m),
l AS (SELECT a.*, coalesce(a.window_time <= w.mark, false) AS late FROM a JOIN w USING (arrival)),
u AS (SELECT page, window_time, user_id, bool_and(late) AS only_late,
             count(*) FILTER (WHERE late) AS late_n FROM l GROUP BY 1, 2, 3)
SELECT page, window_time, count(*) FILTER (WHERE NOT only_late)::BIGINT AS closed_uv,
       sum(late_n)::BIGINT AS late_events, count(*) FILTER (WHERE only_late)::BIGINT AS late_users,
       count(*)::BIGINT AS restated_uv
FROM u GROUP BY 1, 2""")
def uv_late_report(spark, sf_dir):
    """Events by weekly arrival, one user in seven a week late, windows of an hour and
    a watermark delay of two days: what closed, what came late, what it adds up to."""
    b = load_behaviors(spark, sf_dir)
    start = b.agg(F.min("behavior_ms")).first()[0] or 0
    arrival = F.expr(f"(behavior_ms - {start}) div 604800000 + IF(cast(user_id as bigint) % 7 = 0, 1, 0)")
    weeks = scratch_path(spark, "arrivals")
    (b.select("page", "user_id", "behavior_ms", arrival.alias("arrival"))
     .write.partitionBy("arrival").parquet(weeks))
    arrived = spark.read.schema("page STRING, user_id STRING, behavior_ms BIGINT, arrival BIGINT").parquet(weeks)
    root = scratch_path(spark, "late")
    write = L.late_writer(root, HOUR, LATE_DELAY_MS)
    last = arrived.agg(F.max("arrival")).first()[0]
    for k in range(0 if last is None else last + 1):  # one micro-batch a week of the table
        write(arrived.where(F.col("arrival") == k), k)
    return L.late_report(spark, root)
