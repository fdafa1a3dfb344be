"""Calendar roll-up jobs (B1-B14): exact UV per page and calendar bucket.

All buckets are computed from ``behavior_ms`` in an explicit zone (UTC for the
registered queries); results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uvlens.functions import time as TM
from uvlens.operators.strategies import uv_exact
from uvlens.plans.registry import B_SQL, register
from uvlens.sources.behaviors import MANY_PAGES, load_behaviors, orders_as_behaviors

ZONE = "UTC"

O_SQL = ("o AS (SELECT cast(o_custkey AS VARCHAR) AS user_id, o_orderpriority AS page, "
         "epoch_us(o_orderdate) // 1000 AS behavior_ms, o_orderdate AS ts FROM orders)")


def _ms(x: str) -> str:
    return f"(epoch_us({x}) // 1000)"


def uv_by(df: DataFrame, bucket, label: str = "window_time", end=None) -> DataFrame:
    keyed = df.select("page", "user_id", bucket.alias(label),
                      *([end.alias("window_end")] if end is not None else []))
    keys = ["page", label] + (["window_end"] if end is not None else [])
    return uv_exact(keyed, keys)


@register("uv_by_minute", f"""
WITH {B_SQL}
SELECT page, behavior_ms - behavior_ms % 60000 AS window_time, count(DISTINCT user_id)::BIGINT AS uv
FROM b GROUP BY 1, 2""")
def uv_by_minute(spark, sf_dir):
    """B2: minute start."""
    return uv_by(load_behaviors(spark, sf_dir), TM.minute_start("behavior_ms"))


@register("uv_by_hour", f"""
WITH {B_SQL}
SELECT page, behavior_ms - behavior_ms % 3600000 AS window_time,
       behavior_ms - behavior_ms % 3600000 + 3599999 AS window_end,
       count(DISTINCT user_id)::BIGINT AS uv
FROM b GROUP BY 1, 2, 3""")
def uv_by_hour(spark, sf_dir):
    """UTC hour start and last millisecond of the hour."""
    b = load_behaviors(spark, sf_dir)
    return uv_by(b, TM.hour_start("behavior_ms"), end=TM.hour_end("behavior_ms"))


@register("uv_by_day", f"""
WITH {B_SQL}
SELECT page, {_ms("date_trunc('day', ts)")} AS window_time,
       {_ms("date_trunc('day', ts) + INTERVAL 1 DAY")} - 1 AS window_end,
       count(DISTINCT user_id)::BIGINT AS uv
FROM b GROUP BY 1, 2, 3""")
def uv_by_day(spark, sf_dir):
    """Local midnight and 23:59:59.999."""
    b = load_behaviors(spark, sf_dir)
    return uv_by(b, TM.calendar_start("behavior_ms", "DAY", ZONE),
                 end=TM.calendar_end("behavior_ms", "DAY", ZONE))


@register("uv_by_week", f"""
WITH {B_SQL}
SELECT page, {_ms("date_trunc('week', ts)")} AS window_time,
       {_ms("date_trunc('week', ts) + INTERVAL 7 DAY")} - 1 AS window_end,
       count(DISTINCT user_id)::BIGINT AS uv
FROM b GROUP BY 1, 2, 3""")
def uv_by_week(spark, sf_dir):
    """ISO weeks (Monday 00:00 to Sunday 23:59:59.999)."""
    b = load_behaviors(spark, sf_dir)
    return uv_by(b, TM.calendar_start("behavior_ms", "WEEK", ZONE),
                 end=TM.calendar_end("behavior_ms", "WEEK", ZONE))


@register("uv_by_month", f"""
WITH {O_SQL}
SELECT page, {_ms("date_trunc('month', ts)")} AS window_time,
       {_ms("date_trunc('month', ts) + INTERVAL 1 MONTH")} - 1 AS window_end,
       count(DISTINCT user_id)::BIGINT AS uv
FROM o GROUP BY 1, 2, 3""")
def uv_by_month(spark, sf_dir):
    """Customers per order priority and month (orders span years)."""
    o = orders_as_behaviors(spark, sf_dir)
    return uv_by(o, TM.calendar_start("behavior_ms", "MONTH", ZONE),
                 end=TM.calendar_end("behavior_ms", "MONTH", ZONE))


@register("uv_by_year", f"""
WITH {O_SQL}
SELECT page, year(ts)::BIGINT AS year, {_ms("date_trunc('year', ts)")} AS window_time,
       count(DISTINCT user_id)::BIGINT AS uv
FROM o GROUP BY 1, 2, 3""")
def uv_by_year(spark, sf_dir):
    """Year start and year number in the zone."""
    o = orders_as_behaviors(spark, sf_dir)
    keyed = o.select("page", "user_id",
                     TM.year_of("behavior_ms", ZONE).cast("bigint").alias("year"),
                     TM.calendar_start("behavior_ms", "YEAR", ZONE).alias("window_time"))
    return uv_exact(keyed, ["page", "year", "window_time"])


@register("uv_calendar_index", f"""
WITH {O_SQL}
SELECT page, year(ts)::BIGINT AS year, month(ts)::BIGINT AS month_index,
       dayofyear(ts)::BIGINT AS day_index,
       {_ms("make_date(year(ts), 1, 1)::TIMESTAMP + (dayofyear(ts) - 1) * INTERVAL 1 DAY")} AS day_time,
       count(DISTINCT user_id)::BIGINT AS uv
FROM o GROUP BY 1, 2, 3, 4, 5""")
def uv_calendar_index(spark, sf_dir):
    """Day and month index of the year, and the inverse (year, day) -> ms."""
    o = orders_as_behaviors(spark, sf_dir)
    keyed = (o.select("page", "user_id",
                      TM.year_of("behavior_ms", ZONE).cast("bigint").alias("year"),
                      TM.month_of_year("behavior_ms", ZONE).cast("bigint").alias("month_index"),
                      TM.day_of_year("behavior_ms", ZONE).cast("bigint").alias("day_index"))
             .withColumn("day_time", TM.day_time("year", "day_index", ZONE)))
    return uv_exact(keyed, ["page", "year", "month_index", "day_index", "day_time"])


@register("uv_month_days", f"""
WITH {O_SQL},
m AS (SELECT page, date_trunc('month', ts)::DATE AS d, count(DISTINCT user_id)::BIGINT AS uv FROM o GROUP BY 1, 2)
SELECT page, {_ms("d::TIMESTAMP")} AS month_start, {_ms("(d + INTERVAL 1 MONTH)::TIMESTAMP")} - 1 AS month_end,
       day(last_day(d))::INTEGER AS n_days, strftime(d, '%Y-%m-%d') AS first_day,
       strftime(last_day(d), '%Y-%m-%d') AS last_day, uv
FROM m""")
def uv_month_days(spark, sf_dir):
    """Months given as (year, month), their bounds, and their list of days."""
    o = orders_as_behaviors(spark, sf_dir)
    uv = uv_exact(o.select("page", "user_id", TM.year_of("behavior_ms", ZONE).alias("y"),
                           TM.month_of_year("behavior_ms", ZONE).alias("m")), ["page", "y", "m"])
    bounds = uv.select("page", "uv", TM.month_start_of("y", "m", ZONE).alias("month_start"),
                       TM.month_end_of("y", "m", ZONE).alias("month_end"))
    days = bounds.withColumn("days", TM.day_list("month_start", "month_end", ZONE))
    return days.select("page", "month_start", "month_end", F.size("days").alias("n_days"),
                       F.element_at("days", 1).alias("first_day"), F.element_at("days", -1).alias("last_day"), "uv")


def _batch_sql(n: int, unit: str) -> str:
    if unit == "days":
        return _ms(f"date_trunc('year', ts) + ((dayofyear(ts) - 1) // {n} * {n}) * INTERVAL 1 DAY")
    d = n * {"minutes": 60_000, "hours": 3_600_000}[unit]
    ys = _ms("date_trunc('year', ts)")
    return f"({ys} + ((behavior_ms - {ys}) // {d}) * {d})"


BATCHES = (("7m", 7, "minutes"), ("5h", 5, "hours"), ("7d", 7, "days"))


@register("uv_by_batch_time", "\nUNION ALL\n".join(f"""
SELECT * FROM (WITH {B_SQL}
  SELECT '{tag}' AS bucket, page, {_batch_sql(n, unit)} AS window_time,
         count(DISTINCT user_id)::BIGINT AS uv FROM b GROUP BY 1, 2, 3)""" for tag, n, unit in BATCHES))
def uv_by_batch_time(spark, sf_dir):
    """Year-anchored buckets of 7 minutes, 5 hours and 7 days.

    One scan: each event is expanded into its three bucket labels
    (``inline``), then one distinct count per (bucket kind, page, bucket).
    """
    b = load_behaviors(spark, sf_dir)
    kinds = F.array(*[F.struct(F.lit(tag).alias("bucket"),
                               TM.batch_time("behavior_ms", n, unit, ZONE).alias("window_time"))
                      for tag, n, unit in BATCHES])
    keyed = b.select("page", "user_id", F.inline(kinds))
    return uv_exact(keyed, ["bucket", "page", "window_time"])


PREVIOUS = (("1h", 1, "hours"), ("7m", 7, "minutes"), ("5h", 5, "hours"))


def _previous_sql(tag: str, n: int, unit: str) -> str:
    d = n * {"minutes": 60_000, "hours": 3_600_000}[unit]
    back = f"(window_time - {d})"
    ys = f"(epoch_us(date_trunc('year', epoch_ms{back}::TIMESTAMP)) // 1000)"
    return f"""
SELECT * FROM (WITH {B_SQL},
  u AS (SELECT page, {_batch_sql(n, unit)} AS window_time, count(DISTINCT user_id)::BIGINT AS uv
        FROM b GROUP BY 1, 2),
  p AS (SELECT *, {ys} + (({back} - {ys}) // {d}) * {d} AS prev_time FROM u)
  SELECT '{tag}' AS bucket, p.page, p.window_time, p.uv, coalesce(u.uv, 0)::BIGINT AS prev_uv
  FROM p LEFT JOIN u ON u.page = p.page AND u.window_time = p.prev_time)"""


@register("uv_vs_previous", "\nUNION ALL\n".join(_previous_sql(*x) for x in PREVIOUS))
def uv_vs_previous(spark, sf_dir):
    """UV of each year-anchored bucket (1 hour, 7 minutes, 5 hours) next to the
    UV of the previous bucket, i.e. the bucket of the time one width earlier. One
    scan: the previous bucket is one of the two active buckets before (a year's last
    bucket may be shorter), so lags over the aggregated buckets find it."""
    b = load_behaviors(spark, sf_dir)
    kinds = F.array(*[F.struct(F.lit(tag).alias("bucket"),
                               TM.batch_time("behavior_ms", n, unit, ZONE).alias("window_time"))
                      for tag, n, unit in PREVIOUS])
    cur = uv_exact(b.select("page", "user_id", F.inline(kinds)), ["bucket", "page", "window_time"])
    before = F.coalesce(*[F.when(F.col("bucket") == tag, TM.previous_batch_time("window_time", n, unit, ZONE))
                          for tag, n, unit in PREVIOUS])
    w = Window.partitionBy("bucket", "page").orderBy("window_time")
    found = F.coalesce(*[F.when(F.lag("window_time", k).over(w) == F.col("prev_time"), F.lag("uv", k).over(w))
                         for k in (1, 2)], F.lit(0))
    return (cur.withColumn("prev_time", before)
            .select("bucket", "page", "window_time", "uv", found.cast("bigint").alias("prev_uv")))


SHIFTS = ("SECOND", "MINUTE", "HOUR", "DAY", "WEEK")


def shift_compare(uv: DataFrame, units, zone: str = ZONE) -> DataFrame:
    """(page, window_time, uv, uv_<unit>_before ...): UV of each bucket against the
    buckets one local unit earlier. Each aggregated row counts for its own label and,
    per unit, for the label one unit later; one aggregate by label brings them
    together, without a second scan or a join."""
    roles = F.array(F.struct(F.lit("").alias("role"), F.col("window_time").alias("label")),
                    *[F.struct(F.lit(u).alias("role"), TM.shift_ms("window_time", 1, u, zone).alias("label"))
                      for u in units])
    rows = uv.select("page", "uv", F.inline(roles))
    return (rows.groupBy("page", F.col("label").alias("window_time"))
            .agg(F.max(F.when(F.col("role") == "", F.col("uv"))).alias("uv"),
                 *[F.coalesce(F.sum(F.when(F.col("role") == u, F.col("uv"))), F.lit(0)).cast("bigint")
                   .alias(f"uv_{u.lower()}_before") for u in units])
            .where("uv is not null"))


@register("uv_shift_compare", f"""
WITH {B_SQL},
u AS (SELECT page, behavior_ms - behavior_ms % 3600000 AS window_time,
             count(DISTINCT user_id)::BIGINT AS uv FROM b GROUP BY 1, 2)
SELECT u.page, u.window_time, u.uv, coalesce(p.uv, 0)::BIGINT AS uv_day_before
FROM u LEFT JOIN u p ON p.page = u.page
  AND p.window_time = {_ms("to_timestamp(u.window_time / 1000)::TIMESTAMP - INTERVAL 1 DAY")}""")
def uv_shift_compare(spark, sf_dir):
    """UV per hour against the same hour one local day earlier."""
    b = load_behaviors(spark, sf_dir)
    return shift_compare(uv_by(b, TM.hour_start("behavior_ms")), ["DAY"])


@register("uv_shift_units", f"""
WITH {B_SQL},
u AS (SELECT page, behavior_ms - behavior_ms % 1000 AS window_time,
             count(DISTINCT user_id)::BIGINT AS uv FROM b GROUP BY 1, 2)
SELECT u.page, u.window_time, u.uv,
  {', '.join(f"coalesce(p{k}.uv, 0)::BIGINT AS uv_{x.lower()}_before" for k, x in enumerate(SHIFTS))}
FROM u {' '.join(f"LEFT JOIN u p{k} ON p{k}.page = u.page AND p{k}.window_time = "
                 + f"(epoch_us(make_timestamp(u.window_time * 1000) - INTERVAL 1 {x}) // 1000)"
                 for k, x in enumerate(SHIFTS))}""")
def uv_shift_units(spark, sf_dir):
    """UV per second against the second one second, minute, hour, day and week
    earlier."""
    b = load_behaviors(spark, sf_dir)
    return shift_compare(uv_by(b, TM.floor_ms("behavior_ms", 1_000)), SHIFTS)


ZONES = ("America/New_York", "Asia/Shanghai")


@register("uv_by_day_zones", "\nUNION ALL\n".join(f"""
SELECT * FROM (WITH {O_SQL},
  l AS (SELECT page, user_id, date_trunc('day', (ts AT TIME ZONE 'UTC') AT TIME ZONE '{z}') AS d FROM o)
  SELECT '{z}' AS zone, page, (epoch_us(d AT TIME ZONE '{z}') // 1000) AS window_time,
         (epoch_us((d + INTERVAL 1 DAY) AT TIME ZONE '{z}') // 1000) - 1 AS window_end,
         strftime(d, '%Y-%m-%d') AS day, count(DISTINCT user_id)::BIGINT AS uv
  FROM l GROUP BY ALL)""" for z in ZONES))
def uv_by_day_zones(spark, sf_dir):
    """B5 / B14 in local time: customers per order priority and local day, in a zone
    with clock changes and in UTC+8 (orders span years)."""
    o = orders_as_behaviors(spark, sf_dir)
    kinds = F.array(*[F.struct(F.lit(z).alias("zone"), TM.calendar_start("behavior_ms", "DAY", z).alias("window_time"),
                               TM.calendar_end("behavior_ms", "DAY", z).alias("window_end"),
                               TM.format_ms("behavior_ms", "yyyy-MM-dd", z).alias("day")) for z in ZONES])
    return uv_exact(o.select("page", "user_id", F.inline(kinds)), ["zone", "page", "window_time", "window_end", "day"])


@register("return_gap_days", f"""
WITH {B_SQL},
d AS (SELECT DISTINCT page, user_id, ts::DATE AS day FROM b),
g AS (SELECT page, day - lag(day) OVER (PARTITION BY page, user_id ORDER BY day) AS gap FROM d)
SELECT page, gap::BIGINT AS gap_days, count(*)::BIGINT AS n_returns
FROM g WHERE gap IS NOT NULL GROUP BY 1, 2""")
def return_gap_days(spark, sf_dir):
    """Histogram of days between a user's consecutive active days on a page.

    The window runs over one row per (page, user, active day), so its
    partitions are bounded by the number of days, not by the events.
    """
    b = load_behaviors(spark, sf_dir)
    days = b.select("page", "user_id",
                    TM.calendar_start("behavior_ms", "DAY", ZONE).alias("day_ms")).distinct()
    w = Window.partitionBy("page", "user_id").orderBy("day_ms")
    gaps = days.withColumn("prev_ms", F.lag("day_ms").over(w))
    gaps = gaps.where("prev_ms is not null").withColumn(
        "gap_days", TM.days_between("prev_ms", "day_ms", ZONE).cast("bigint"))
    return gaps.groupBy("page", "gap_days").agg(F.count(F.lit(1)).cast("bigint").alias("n_returns"))


@register("uv_gap_filled", f"""
WITH {B_SQL},
m AS (SELECT concat('page_', json_extract_string(e.props, '$.k')) AS page, b.user_id, b.ts
      FROM b JOIN events e USING (event_id)),
u AS (SELECT page, ts::DATE AS day, count(DISTINCT user_id) AS uv FROM m GROUP BY 1, 2),
r AS (SELECT page, min(day) AS d1, max(day) AS d2 FROM u GROUP BY 1),
s AS (SELECT page, unnest(generate_series(d1, d2, INTERVAL 1 DAY))::DATE AS day FROM r)
SELECT s.page, {_ms("s.day::TIMESTAMP")} AS window_time, coalesce(u.uv, 0)::BIGINT AS uv
FROM s LEFT JOIN u ON u.page = s.page AND u.day = s.day""")
def uv_gap_filled(spark, sf_dir):
    """Daily UV per page on every day between its first and last active
    day, 0 on days without events (many-pages mapping, so gaps occur)."""
    b = load_behaviors(spark, sf_dir, page=MANY_PAGES)
    day = TM.calendar_start("behavior_ms", "DAY", ZONE)
    daily = uv_by(b, day)
    return gap_fill(daily)


def gap_fill(daily: DataFrame, zone: str = ZONE) -> DataFrame:
    """Complete a daily (page, window_time, uv) series, labelled by local midnight,
    with zero rows: one for every local date between two active days. Steps are
    dates, not 24 hours, so clock changes lose no day. One pass: each active day
    brings the days up to the next one."""
    day = F.expr(f"cast({TM.local_ts_sql('window_time', zone)} as date)")
    w = Window.partitionBy("page").orderBy("day")
    rows = daily.withColumn("day", day).withColumn("last", F.coalesce(F.date_sub(F.lead("day").over(w), 1), "day"))
    days = rows.select("page", "window_time", "uv", F.col("day").alias("first"),
                       F.explode(F.sequence("day", "last")).alias("day"))
    midnight = F.expr(TM.local_to_ms_sql("cast(day as timestamp_ntz)", zone))
    here = F.col("day") == F.col("first")
    return days.select("page", F.when(here, F.col("window_time")).otherwise(midnight).alias("window_time"),
                       F.when(here, F.col("uv")).otherwise(0).cast("bigint").alias("uv"))


# The eight preset date formats of the reference, in its order,
# each with the strftime equivalent used by the DuckDB oracle.
FORMAT_PAIRS = (
    ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
    ("yyyyMMddHHmmss", "%Y%m%d%H%M%S"),
    ("yyyyMMddHHmm", "%Y%m%d%H%M"),
    ("yyyyMMddHH", "%Y%m%d%H"),
    ("yyyy-MM-dd", "%Y-%m-%d"),
    ("yyyyMMdd", "%Y%m%d"),
    ("HH:mm:ss", "%H:%M:%S"),
    ("HH:mm", "%H:%M"),
)


def parse_text_time(text: str, pattern: str) -> "F.Column":
    """Parse text with a pattern as UTC wall-clock; null when it does not fit."""
    return TM.parse_ms(text, pattern, ZONE)


def _formats_sql() -> str:
    parts = []
    for jp, sp in FORMAT_PAIRS:
        date_part = "HH" not in jp[:2]
        day = (_ms(f"date_trunc('day', try_strptime(x.text, '{sp}'))") if date_part
               else "NULL::BIGINT")
        parts.append(f"""
SELECT event_id, '{jp}' AS pattern, text, {day} AS day_ms,
  (((({_ms(f"try_strptime(text, '{sp}')")}) % 86400000) + 86400000) % 86400000) AS tod_ms,
  try_strptime(text, '{sp}') IS NOT NULL AS valid
FROM (SELECT event_id, strftime(ts, '{sp}') AS text FROM events) x""")
    parts.append(f"""
SELECT event_id, 'yyyy-MM-dd' AS pattern, props AS text, NULL::BIGINT AS day_ms,
       NULL::BIGINT AS tod_ms, false AS valid FROM events""")
    return "\nUNION ALL\n".join(parts)


@register("report_formats", _formats_sql())
def report_formats(spark, sf_dir):
    """Event times rendered in the preset formats and parsed back into a
    day bucket and a time of day; text that does not parse is rejected
    (``valid`` false), here the JSON ``props`` column. One scan: every event
    is expanded into its nine (pattern, text) variants."""
    from uvlens.sources.tables import read_table
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "props", F.expr(TM.epoch_ms_sql("ts")).alias("ms"))
    variants = [F.struct(F.lit(jp).alias("pattern"),
                         TM.format_ms("ms", jp, ZONE).alias("text"),
                         F.lit("HH" not in jp[:2]).alias("has_date"))
                for jp, _ in FORMAT_PAIRS]
    variants.append(F.struct(F.lit("yyyy-MM-dd").alias("pattern"), F.col("props").alias("text"),
                             F.lit(True).alias("has_date")))
    rows = ev.select("event_id", F.inline(F.array(*variants)))
    # the pattern varies per row, so the parse goes through one CASE per pattern
    parsed = F.coalesce(*[F.when(F.col("pattern") == jp, parse_text_time("text", jp))
                          for jp, _ in FORMAT_PAIRS])
    rows = rows.withColumn("_p", parsed)
    return rows.select(
        "event_id", "pattern", "text",
        F.when(F.col("has_date"), F.expr("_p - pmod(_p, 86400000)")).alias("day_ms"),
        F.expr("pmod(_p, 86400000)").alias("tod_ms"),
        F.col("_p").isNotNull().alias("valid"))
