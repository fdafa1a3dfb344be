"""The canonical input: user behaviours ``(user_id, page, behavior_ms)``.

Two sources feed it: the Parquet ``events`` table (batch and file streams)
and raw JSON messages as they come from a message bus (S1-S3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uvlens.functions.time import epoch_ms_sql, event_time
from uvlens.sources.tables import read_table

# The field names of a raw behaviour message.
MESSAGE_SCHEMA = "userId STRING, page STRING, behaviorTime BIGINT"

# Lenient JSON as accepted by the reference's mapper: unquoted names and
# single quotes. Extra fields are ignored by Spark.
JSON_OPTIONS = {
    "allowUnquotedFieldNames": "true",
    "allowSingleQuotes": "true",
    "mode": "PERMISSIVE",
}

BEHAVIOR_COLUMNS = ("user_id", "page", "behavior_ms")


def _page_expr(page: str | Column) -> Column:
    return F.expr(page) if isinstance(page, str) else page


def behaviors_from_events(events: DataFrame, page: str | Column = "event_type",
                          keep: tuple[str, ...] = ()) -> DataFrame:
    """events -> behaviours. Rows missing a user, page or time are dropped
    (the one rule for rejected records)."""
    return (events
            .select(*keep,
                    F.col("user_id").cast("string").alias("user_id"),
                    _page_expr(page).alias("page"),
                    F.expr(epoch_ms_sql("ts")).alias("behavior_ms"))
            .where(F.col("user_id").isNotNull() & F.col("page").isNotNull()
                   & F.col("behavior_ms").isNotNull()))


# A second page mapping with many pages (one per props key value).
MANY_PAGES = "concat('page_', get_json_object(props, '$.k'))"


def load_behaviors(spark: SparkSession, sf_dir: str, page: str | Column = "event_type",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    return behaviors_from_events(read_table(spark, sf_dir, "events"), page, keep)


def orders_as_behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as behaviours: user = customer, page = order priority. Spans
    several years, so month and year buckets carry meaning."""
    return (read_table(spark, sf_dir, "orders")
            .select(F.col("o_custkey").cast("string").alias("user_id"),
                    F.col("o_orderpriority").alias("page"),
                    F.expr(epoch_ms_sql("o_orderdate")).alias("behavior_ms"))
            .where("user_id is not null and page is not null and behavior_ms is not null"))


def with_event_time(df: DataFrame) -> DataFrame:
    """Adds ``behavior_time`` (TIMESTAMP) for windows and watermarks;
    ``withWatermark`` refuses TIMESTAMP_NTZ."""
    return df.withColumn("behavior_time", event_time("behavior_ms"))


# --- raw messages (S3) ---------------------------------------------------------

def events_as_messages(events: DataFrame) -> DataFrame:
    """Render events as the raw JSON messages a producer sends (K3 payload)."""
    return events.select(
        "event_id",
        F.to_json(F.struct(
            F.col("user_id").cast("string").alias("userId"),
            F.col("event_type").alias("page"),
            F.expr(epoch_ms_sql("ts")).alias("behaviorTime"))).alias("value"))


def parse_messages(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse JSON text into behaviour columns plus a ``valid`` flag.

    Malformed, blank and incomplete messages parse to nulls and are marked
    invalid instead of failing the job.
    """
    parsed = F.from_json(F.col(value_col), MESSAGE_SCHEMA, JSON_OPTIONS)
    out = raw.withColumn("_m", parsed).select(
        *[c for c in raw.columns if c != value_col],
        F.col("_m.userId").alias("user_id"),
        F.col("_m.page").alias("page"),
        F.col("_m.behaviorTime").alias("behavior_ms"),
    )
    valid = (F.col("user_id").isNotNull() & F.col("page").isNotNull()
             & F.col("behavior_ms").isNotNull())
    return out.withColumn("valid", F.coalesce(valid, F.lit(False)))


def split_messages(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(valid behaviours, rejected raw rows); each message is parsed once per frame."""
    parsed = parse_messages(raw.withColumn("_raw", F.col(value_col)), value_col)
    good = parsed.where("valid").drop("valid", "_raw")
    bad = parsed.where("not valid").withColumnRenamed("_raw", value_col).select(*raw.columns)
    return good, bad
