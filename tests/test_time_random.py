"""Bucket functions against a plain-Python oracle on random instants and zones."""

import random
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from uvlens.functions import time as TM

ZONES = ["UTC", "Asia/Shanghai", "Asia/Kolkata", "America/New_York", "Europe/Berlin",
         "Australia/Adelaide"]


def _local(ms, z):
    return datetime.fromtimestamp(ms / 1000, tz=timezone.utc).astimezone(ZoneInfo(z))


def _to_ms(local_naive, z):
    return int(local_naive.replace(tzinfo=ZoneInfo(z)).timestamp() * 1000)


def py_batch_time(ms, n, unit, z):
    loc = _local(ms, z)
    ys = _to_ms(datetime(loc.year, 1, 1), z)
    if unit == "days":
        day = (loc.timetuple().tm_yday - 1) // n * n
        return _to_ms(datetime(loc.year, 1, 1) + timedelta(days=day), z)
    d = n * {"seconds": 1000, "minutes": 60_000, "hours": 3_600_000}[unit]
    return ys + (ms - ys) // d * d


def py_start(ms, unit, z):
    loc = _local(ms, z).replace(tzinfo=None)
    if unit == "DAY":
        s = loc.replace(hour=0, minute=0, second=0, microsecond=0)
    elif unit == "WEEK":
        s = (loc - timedelta(days=loc.weekday())).replace(hour=0, minute=0, second=0, microsecond=0)
    elif unit == "MONTH":
        s = loc.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    else:
        s = loc.replace(month=1, day=1, hour=0, minute=0, second=0, microsecond=0)
    return _to_ms(s, z)


@pytest.mark.parametrize("zone", ZONES)
def test_random_instants(spark, zone):
    rnd = random.Random(zone)
    lo, hi = 946_684_800_000, 4_102_444_800_000  # 2000 .. 2100
    ms = [rnd.randrange(lo, hi) for _ in range(300)]
    df = spark.createDataFrame([(m,) for m in ms], "m bigint")
    cols = [TM.calendar_start("m", u, zone).alias(f"s_{u}") for u in ("DAY", "WEEK", "MONTH", "YEAR")]
    specs = [(7, "minutes"), (5, "hours"), (7, "days"), (13, "seconds")]
    cols += [TM.batch_time("m", n, u, zone).alias(f"b_{n}_{u}") for n, u in specs]
    rows = df.select("m", *cols).collect()
    for r in rows:
        for u in ("DAY", "WEEK", "MONTH", "YEAR"):
            assert r[f"s_{u}"] == py_start(r.m, u, zone), (r.m, u)
        for n, u in specs:
            assert r[f"b_{n}_{u}"] == py_batch_time(r.m, n, u, zone), (r.m, n, u)
