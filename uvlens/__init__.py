"""uvlens — unique-visitor analytics on Spark.

Distinct users per page and time bucket, on tables and on streams, with
several interchangeable distinct strategies (exact, HLL sketch, hash slots,
bitmaps), three meanings of the metric (per window, cumulative, new
visitors), stored sketches with roll-ups, calendar buckets, reports and
table jobs. Everything is expressed with DataFrame / SQL operators so that
Catalyst plans partial aggregation, pruning and pushdown.
"""

from uvlens.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
