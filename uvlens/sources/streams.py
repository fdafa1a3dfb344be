"""Streaming sources for behaviours.

The message bus reader is built from options, so a file stream of JSON lines
or a Parquet folder stands in where the Kafka connector is absent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uvlens.sources.behaviors import behaviors_from_events, parse_messages, with_event_time
from uvlens.sources.tables import table_path

EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")


def kafka_messages(spark: SparkSession, servers: str, topic: str,
                   starting: str = "latest", **options: str) -> DataFrame:
    """Raw message values from a topic; offsets live in the query checkpoint."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"))


def json_line_messages(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(folder)


def stream_behaviors_from_messages(messages: DataFrame) -> DataFrame:
    """Valid parsed messages with ``behavior_time`` for watermarks."""
    parsed = parse_messages(messages).where("valid").drop("valid")
    return with_event_time(parsed)


def stream_events(spark: SparkSession, folder: str, glob: str | None = None,
                  max_files: int | None = None) -> DataFrame:
    """A file stream over Parquet files with the ``events`` schema."""
    r = spark.readStream.schema(EVENTS_SCHEMA).format("parquet")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(folder)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path is a folder, in any file system that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def stream_table(spark: SparkSession, sf_dir: str, name: str = "events",
                 max_files: int | None = None) -> DataFrame:
    """A file stream over the ``events`` table ``<sf_dir>/<name>.parquet``: a
    folder of part files is streamed itself; a single file is streamed from its
    parent folder by its name (Spark streams folders only). A missing table
    raises, as in a batch read."""
    path = table_path(sf_dir, name)
    if is_folder(spark, path):
        return stream_events(spark, path, None, max_files)
    parent, _, file = path.rpartition("/")
    return stream_events(spark, parent, file, max_files)


def stream_table_behaviors(spark: SparkSession, sf_dir: str, name: str = "events",
                           max_files: int | None = None) -> DataFrame:
    return with_event_time(behaviors_from_events(stream_table(spark, sf_dir, name, max_files)))


def stream_behaviors(spark: SparkSession, folder: str, glob: str | None = "events*.parquet",
                     max_files: int | None = None) -> DataFrame:
    return with_event_time(behaviors_from_events(stream_events(spark, folder, glob, max_files)))
