from uvlens.operators.strategies import STRATEGIES, distinct_users
from uvlens.operators.windows import uv_per_window, uv_per_batch_time, page_views
from uvlens.operators.admissions import (
    admission_times, first_seen, ttl_admissions, uv_cumulative, uv_new_visitors,
)

__all__ = [
    "STRATEGIES", "distinct_users", "uv_per_window", "uv_per_batch_time", "page_views",
    "admission_times", "first_seen", "ttl_admissions", "uv_cumulative", "uv_new_visitors",
]
