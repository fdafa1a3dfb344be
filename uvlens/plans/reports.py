"""Reports (R1-R3, K1), message parsing (S3) and publishing payloads (K3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from uvlens.functions import time as TM
from uvlens.operators.reports import asc, bottom_by_score, positions, report_lines, top_by_score
from uvlens.operators.strategies import uv_exact
from uvlens.operators.windows import MINUTE, uv_per_window
from uvlens.plans.registry import B_SQL, register
from uvlens.sources.behaviors import (
    MANY_PAGES, events_as_messages, load_behaviors, parse_messages, split_messages,
)
from uvlens.sources.sinks import as_messages
from uvlens.sources.tables import read_table

M_SQL = (f"{B_SQL}, m AS (SELECT b.*, concat('page_', json_extract_string(e.props, '$.k')) AS mpage "
         "FROM b JOIN events e USING (event_id))")


def _daily_many_pages(spark, sf_dir):
    b = load_behaviors(spark, sf_dir, page=MANY_PAGES)
    keyed = b.select("page", "user_id",
                     TM.calendar_start("behavior_ms", "DAY", "UTC").alias("window_time"))
    return uv_exact(keyed, ["window_time", "page"])


_DAILY_SQL = f"""
WITH {M_SQL},
u AS (SELECT mpage AS page, epoch_us(date_trunc('day', ts)) // 1000 AS window_time,
             count(DISTINCT user_id)::BIGINT AS uv FROM m GROUP BY 1, 2)"""


@register("top_pages", _DAILY_SQL + """
SELECT window_time, page, uv, rank FROM (
  SELECT *, (row_number() OVER (PARTITION BY window_time ORDER BY uv DESC, page DESC) - 1)::BIGINT
         AS rank FROM u) WHERE rank BETWEEN 0 AND 2""")
def top_pages(spark, sf_dir):
    """Three pages with most visitors per day (zrevrange 0..2)."""
    return top_by_score(_daily_many_pages(spark, sf_dir), ["window_time"], "page", "uv", 0, 2)


@register("bottom_pages", _DAILY_SQL + """
SELECT window_time, page, uv, rank FROM (
  SELECT *, (row_number() OVER (PARTITION BY window_time ORDER BY uv ASC, page ASC) - 1)::BIGINT
         AS rank FROM u) WHERE rank BETWEEN 0 AND 2""")
def bottom_pages(spark, sf_dir):
    """R2: three pages with fewest visitors per day (zrange 0..2)."""
    return bottom_by_score(_daily_many_pages(spark, sf_dir), ["window_time"], "page", "uv", 0, 2)


@register("event_slice", f"""
WITH {B_SQL},
r AS (SELECT page, event_id, user_id, behavior_ms,
        (row_number() OVER (PARTITION BY page ORDER BY behavior_ms, event_id) - 1)::BIGINT AS pos,
        count(*) OVER (PARTITION BY page) AS n FROM b)
SELECT 'head' AS part, page, event_id, user_id, behavior_ms, pos FROM r WHERE pos BETWEEN 0 AND 9
UNION ALL
SELECT 'tail' AS part, page, event_id, user_id, behavior_ms, pos FROM r WHERE pos BETWEEN n - 5 AND n - 1
UNION ALL
SELECT 'mid' AS part, page, event_id, user_id, behavior_ms, pos FROM r WHERE pos BETWEEN 2 AND n - 3""")
def event_slice(spark, sf_dir):
    """Events of each page by position (lrange): 0..9, -5..-1, 2..-3."""
    b = load_behaviors(spark, sf_dir, keep=("event_id",))
    order = [asc("behavior_ms"), asc("event_id")]
    ranked = positions(b, ["page"], order, size="n")
    at, n = F.col("pos"), F.col("n")
    tags = F.array(F.when(at <= 9, "head"), F.when(at >= n - 5, "tail"), F.when((at >= 2) & (at <= n - 3), "mid"))
    return (ranked.withColumn("part", F.explode(F.array_compact(tags)))
            .select("part", "page", "event_id", "user_id", "behavior_ms", "pos"))


@register("uv_report_lines", f"""
WITH {B_SQL},
u AS (SELECT page, (behavior_ms // 60000 + 1) * 60000 AS window_time,
             count(DISTINCT user_id)::BIGINT AS uv FROM b GROUP BY 1, 2)
SELECT page, window_time, uv,
       'key:' || page || ',window time:' || strftime(epoch_ms(window_time), '%Y-%m-%d %H:%M:%S')
       || ',uv:' || uv::VARCHAR AS line
FROM u""")
def uv_report_lines(spark, sf_dir):
    """K1: the printed report line of Plans 1-7 per (page, minute window)."""
    return report_lines(uv_per_window(load_behaviors(spark, sf_dir), MINUTE, "exact"))


@register("publish_json", """
SELECT event_id, to_json({'userId': user_id::VARCHAR, 'page': event_type,
                          'behaviorTime': epoch_us(ts) // 1000}) AS value,
       15::INTEGER AS key_len
FROM events""")
def publish_json(spark, sf_dir):
    """K3: the records a producer publishes: random 15-char key, JSON value.
    The key is random, so only its length is compared."""
    ev = read_table(spark, sf_dir, "events")
    b = ev.select("event_id", F.col("user_id").cast("string").alias("userId"),
                  F.col("event_type").alias("page"),
                  F.expr(TM.epoch_ms_sql("ts")).alias("behaviorTime"))
    # The event id rides along outside the JSON value for the comparison.
    records = as_messages(b.select(F.struct("userId", "page", "behaviorTime").alias("r"),
                                   "event_id"), key_len=15, value_of="r")
    return records.select("event_id", "value", F.length("key").alias("key_len"))


@register("parse_behaviors", f"""
WITH {B_SQL}
SELECT event_id, 'json' AS source, user_id, page, behavior_ms, true AS valid FROM b
UNION ALL
SELECT event_id, 'lenient' AS source, user_id, page, behavior_ms, true AS valid FROM b
UNION ALL
SELECT event_id, 'props' AS source, NULL AS user_id, NULL AS page, NULL::BIGINT AS behavior_ms,
       false AS valid FROM events""")
def parse_behaviors(spark, sf_dir):
    """S3: parse raw messages. Three renderings of every event: strict JSON,
    lenient JSON (unquoted names, single quotes) and the props text, which
    lacks the fields and must be rejected."""
    ev = read_table(spark, sf_dir, "events")
    ms = F.expr(TM.epoch_ms_sql("ts"))
    strict = F.to_json(F.struct(F.col("user_id").cast("string").alias("userId"),
                                F.col("event_type").alias("page"), ms.alias("behaviorTime")))
    lenient = F.concat(F.lit("{userId:'"), F.col("user_id").cast("string"), F.lit("',page:'"),
                       F.col("event_type"), F.lit("',behaviorTime:"), ms.cast("string"), F.lit("}"))
    # one scan: every event expands into its three message renderings
    raw = ev.select("event_id", F.inline(F.array(
        F.struct(F.lit("json").alias("source"), strict.alias("value")),
        F.struct(F.lit("lenient").alias("source"), lenient.alias("value")),
        F.struct(F.lit("props").alias("source"), F.col("props").alias("value")))))
    return parse_messages(raw).select("event_id", "source", "user_id", "page", "behavior_ms",
                                      "valid")


@register("split_behaviors", f"""
WITH {B_SQL}
SELECT event_id, user_id, page, behavior_ms, NULL AS rejected FROM b
UNION ALL
SELECT event_id, NULL, NULL, NULL::BIGINT, props AS rejected FROM events""")
def split_behaviors(spark, sf_dir):
    """S3: a message stream with rubbish in it, split into behaviours and the raw text
    of rejected messages (here the props text)."""
    ev = read_table(spark, sf_dir, "events")
    raw = (events_as_messages(ev)
           .unionByName(ev.select("event_id", F.col("props").alias("value"))))
    good, bad = split_messages(raw)
    return (good.withColumn("rejected", F.lit(None).cast("string"))
            .unionByName(bad.withColumnRenamed("value", "rejected"), allowMissingColumns=True))
