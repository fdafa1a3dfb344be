"""Late events kept in a side table, and totals restated with them.

A window is closed once the watermark, the largest event time of the micro-batches
before the present one less the delay, reaches its end. Events of closed windows are
dropped by Spark's stateful operators without a trace; here they are written aside
with the batch that brought them, so that a report can state what was closed, what came
late and what the total is with it.

Folders below ``root``: ``rows`` (page, window_time, user_id, n), partitioned by
``late``, ``day`` of the window and ``batch_id``; ``marks``, the largest event time up
to each batch. A batch reads the mark of the batch before it only, and replaces its own
partitions, so a replay changes nothing and the work does not grow with the job's age.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uvlens.functions.time import window_end_ms
from uvlens.session import path_exists

ROWS = ("page STRING, window_time BIGINT, user_id STRING, n BIGINT, late BOOLEAN, day BIGINT, "
        "batch_id BIGINT")
DAY_MS = 86_400_000


def _write(rows: DataFrame, batch_id: int, path: str, *parts: str) -> None:
    (rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts, "batch_id").parquet(path))


def _mark_before(spark: SparkSession, root: str, batch_id: int) -> int | None:
    """Largest event time of all earlier batches. Batch ids have no gaps."""
    path = f"{root}/marks/batch_id={batch_id - 1}"
    if batch_id == 0 or not path_exists(spark, path):
        return None
    return spark.read.schema("max_ms BIGINT").parquet(path).first()["max_ms"]


def late_writer(root: str, width_ms: int, delay_ms: int) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: visits of open windows and late ones, told apart."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = _mark_before(spark, root, batch_id)
        end = window_end_ms("behavior_ms", width_ms)
        late = F.lit(False) if mark is None else end <= F.lit(mark - delay_ms)
        rows = (batch.groupBy("page", end.alias("window_time"), "user_id")
                .agg(F.count(F.lit(1)).alias("n"), F.max("behavior_ms").alias("max_ms"), F.first(late).alias("late"))
                .withColumn("day", F.expr(f"cast(floor(window_time / {DAY_MS}) as bigint)"))).persist()
        try:
            _write(rows.drop("max_ms"), batch_id, f"{root}/rows", "late", "day")
            _write(rows.agg(F.greatest(F.max("max_ms"), F.lit(mark)).cast("bigint").alias("max_ms")),
                   batch_id, f"{root}/marks")
        finally:
            rows.unpersist()
    return write


def late_report(spark: SparkSession, root: str) -> DataFrame:
    """(page, window_time, closed_uv, late_events, late_users, restated_uv): users counted
    when the window closed; events and users that came too late, the latter only if they
    were not counted; distinct users with the late ones."""
    path = f"{root}/rows"
    rows = spark.read.schema(ROWS).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], ROWS)
    users = (rows.groupBy("page", "window_time", "user_id")
             .agg(F.sum(F.expr("IF(late, n, 0)")).alias("late_n"), F.bool_and("late").alias("only_late")))
    return (users.groupBy("page", "window_time")
            .agg(F.count(F.lit(1)).alias("restated_uv"), F.sum("late_n").alias("late_events"),
                 F.count_if("only_late").alias("late_users"))
            .select("page", "window_time", (F.col("restated_uv") - F.col("late_users")).alias("closed_uv"),
                    "late_events", "late_users", "restated_uv"))
