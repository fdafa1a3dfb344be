"""Calendar edges: year end, zones with half-hour offsets, ISO weeks, DST."""

from datetime import datetime, timezone

import pytest

from uvlens.functions import time as TM
from uvlens.plans.calendar import gap_fill


def ms(s, tz=timezone.utc):
    return int(datetime.strptime(s, "%Y-%m-%d %H:%M:%S.%f").replace(tzinfo=tz).timestamp() * 1000)


def one(spark, expr_col, t):
    return spark.createDataFrame([(t,)], "m bigint").select(expr_col.alias("x")).first().x


@pytest.mark.parametrize("zone,expected_day_start", [
    ("UTC", "2023-12-31 00:00:00.000"),
    ("Asia/Shanghai", "2024-01-01 00:00:00.000"),   # 07:59 local on Jan 1
    ("Asia/Kolkata", "2024-01-01 00:00:00.000"),    # 05:29 local on Jan 1
])
def test_day_start_in_zones(spark, zone, expected_day_start):
    from zoneinfo import ZoneInfo
    t = ms("2023-12-31 23:59:59.999")
    got = one(spark, TM.calendar_start("m", "DAY", zone), t)
    assert got == ms(expected_day_start, ZoneInfo(zone))
    end = one(spark, TM.calendar_end("m", "DAY", zone), t)
    assert end == got + 86_400_000 - 1


def test_year_edge(spark):
    t0, t1 = ms("2023-12-31 23:59:59.999"), ms("2024-01-01 00:00:00.000")
    assert one(spark, TM.year_of("m"), t0) == 2023
    assert one(spark, TM.year_of("m"), t1) == 2024
    assert one(spark, TM.year_of("m", "Asia/Shanghai"), t0) == 2024


def test_year_anchored_vs_epoch_aligned(spark):
    t = ms("2024-03-05 10:07:31.000")
    assert one(spark, TM.batch_time("m", 7, "minutes"), t) == ms("2024-03-05 10:04:00.000")
    assert one(spark, TM.floor_ms("m", 7 * 60_000), t) == ms("2024-03-05 10:05:00.000")
    assert one(spark, TM.batch_time("m", 7, "days"), t) == ms("2024-03-04 00:00:00.000")
    assert one(spark, TM.previous_batch_time("m", 7, "minutes"), t) == ms("2024-03-05 09:57:00.000")


def test_iso_week_and_dst_sunday(spark):
    from zoneinfo import ZoneInfo
    ny = ZoneInfo("America/New_York")
    t = ms("2024-03-10 12:00:00.000", ny)  # Sunday, clocks moved forward at 02:00
    assert one(spark, TM.calendar_start("m", "WEEK", "America/New_York"), t) == \
        ms("2024-03-04 00:00:00.000", ny)
    day_start = one(spark, TM.calendar_start("m", "DAY", "America/New_York"), t)
    day_end = one(spark, TM.calendar_end("m", "DAY", "America/New_York"), t)
    assert day_end - day_start + 1 == 23 * 3_600_000   # a 23-hour day
    # shift by one local day keeps the wall-clock time across the change
    back = one(spark, TM.shift_ms("m", -1, "DAY", "America/New_York"), t)
    assert back == ms("2024-03-09 12:00:00.000", ny)


def test_days_between(spark):
    a, b = ms("2024-01-01 23:00:00.000"), ms("2024-01-03 01:00:00.000")
    got = spark.createDataFrame([(a, b)], "a bigint, b bigint").select(
        TM.days_between("a", "b").alias("d")).first().d
    assert got == 2


def test_gap_fill_ranges(spark):
    day = 86_400_000
    one_day = spark.createDataFrame([("p", 10 * day, 3)], "page string, window_time bigint, uv bigint")
    assert gap_fill(one_day).count() == 1
    two = spark.createDataFrame([("p", 10 * day, 3), ("p", 13 * day, 1)],
                                "page string, window_time bigint, uv bigint")
    assert [r.uv for r in gap_fill(two).orderBy("window_time").collect()] == [3, 0, 0, 1]


def test_month_and_year_start_by_numbers(spark):
    from zoneinfo import ZoneInfo
    df = spark.createDataFrame([(2024, 2)], "y int, m int")
    r = df.select(TM.month_start_of("y", "m", "Asia/Kolkata").alias("s"),
                  TM.month_end_of("y", "m", "Asia/Kolkata").alias("e"),
                  TM.year_start_of("y", "Asia/Kolkata").alias("ys")).first()
    kol = ZoneInfo("Asia/Kolkata")
    assert r.s == ms("2024-02-01 00:00:00.000", kol)
    assert r.e == ms("2024-03-01 00:00:00.000", kol) - 1
    assert r.ys == ms("2024-01-01 00:00:00.000", kol)


def test_day_list_and_hour_in_half_hour_zone(spark):
    a, b = ms("2024-01-30 10:00:00.000"), ms("2024-02-02 01:00:00.000")
    df = spark.createDataFrame([(a, b)], "a bigint, b bigint")
    r = df.select(TM.day_list("a", "b").alias("l"), TM.day_list("b", "a").alias("rev"),
                  TM.day_list("a", "a").alias("one"),
                  TM.calendar_start("a", "HOUR", "Asia/Kolkata").alias("h")).first()
    assert r.l == ["2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02"]
    assert r.rev == [] and r.one == ["2024-01-30"]
    assert r.h == ms("2024-01-30 09:30:00.000")   # 15:30 local is the hour start


def test_parse_in_zone(spark):
    from zoneinfo import ZoneInfo
    df = spark.createDataFrame([("2024-03-10 12:00:00",), ("nonsense",)], "t string")
    got = [r.m for r in df.select(TM.parse_ms("t", "yyyy-MM-dd HH:mm:ss", "America/New_York")
                                  .alias("m")).collect()]
    assert got == [ms("2024-03-10 12:00:00.000", ZoneInfo("America/New_York")), None]
