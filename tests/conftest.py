import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from uvlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="uvlens-tests", shuffle_partitions=4)
    yield s


BASE_MS = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC
HOUR = 3_600_000
MINUTE = 60_000


@pytest.fixture
def mk(spark):
    """Behaviours from (user, page, ms) tuples."""
    def make(rows):
        return spark.createDataFrame(
            [(str(u), p, int(t), int(u) if str(u).isdigit() else None) for u, p, t in rows],
            "user_id string, page string, behavior_ms bigint, user_num bigint")
    return make
