"""Publishing (K3) and streaming strategies on the load-generator fixture."""

import json

from pyspark.sql import functions as F

from conftest import BASE_MS, MINUTE
from uvlens.session import scratch_path
from uvlens.sources.sinks import as_messages, publish
from uvlens.sources.streams import stream_behaviors
from uvlens.streaming import jobs as J

SCHEMA = "page STRING, window_time BIGINT, uv BIGINT"


def test_publish_json_round_trip(spark):
    df = spark.createDataFrame([("a", "p", 5), ("", "q", 6)], "userId string, page string, behaviorTime bigint")
    msgs = as_messages(df)
    out = scratch_path(spark, "published")
    publish(msgs, fmt="json", path=out)
    back = spark.read.json(out).collect()
    assert len(back) == 2 and all(len(r.key) == 15 for r in back)
    assert sorted(json.loads(r.value)["page"] for r in back) == ["p", "q"]


def _stage_generator2(spark):
    rows, uid = [], 0
    for _ in range(10):
        for p in range(3):
            for _ in range(100):
                rows.append((uid, uid, f"page_{p}", BASE_MS + 7))
                uid += 1
    folder = scratch_path(spark, "gen2")
    (spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, ms bigint")
     .select("event_id", F.expr("timestampadd(MILLISECOND, ms, TIMESTAMP_NTZ'1970-01-01 00:00:00')").alias("ts"),
             "user_id", "event_type", F.lit(1.0).alias("value"), F.lit("{}").alias("props"))
     .coalesce(1).write.parquet(f"{folder}/events-gen2"))
    return f"{folder}/events-gen2"


def test_generator2_streams(spark):
    folder = _stage_generator2(spark)
    want = [(f"page_{p}", BASE_MS + MINUTE, 1000) for p in range(3)]
    exact = J.run_update(spark, J.exact_uv_stream(stream_behaviors(spark, folder, glob=None)), "g2-exact")
    got = J.read_changelog(spark, exact, SCHEMA, ["page", "window_time"], ["uv"]).collect()
    assert sorted(tuple(r) for r in got) == want
    hll = J.run_update(spark, J.hll_uv_stream(stream_behaviors(spark, folder, glob=None)), "g2-hll")
    for r in J.read_changelog(spark, hll, SCHEMA, ["page", "window_time"], ["uv"]).collect():
        assert abs(r.uv - 1000) <= 30
