"""Queries over a table that is a folder of part files, in any row order."""

import os

import pytest
from pyspark.sql import functions as F

from uvlens.plans import QUERIES
from uvlens.sources.streams import stream_table

SF = "/root/testdata/sf0.001"
STREAMS = sorted(q for q in QUERIES if q.startswith("stream_") or q.startswith("uv_microbatch") or q == "store_report_lines")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The events as four files in reversed and shuffled order."""
    out = tmp_path_factory.mktemp("folder")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    (ev.repartition(4, F.xxhash64("event_id")).sortWithinPartitions(F.col("ts").desc())
     .write.parquet(str(out / "events.parquet")))
    assert len([f for f in os.listdir(out / "events.parquet") if f.startswith("part-")]) == 4
    return str(out)


def rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("name", STREAMS)
def test_stream_queries_read_folders(spark, folder, name):
    got = rows(QUERIES[name](spark, folder))
    assert got and got == rows(QUERIES[name](spark, SF))


def test_missing_table_raises(spark, tmp_path):
    with pytest.raises(Exception, match="No such file|FileNotFound|does not exist"):
        stream_table(spark, str(tmp_path))
