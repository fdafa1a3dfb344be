"""Admissions: when does a user count (again) for a page?

The reference keeps a page-scoped "seen" map whose entries expire a TTL after
they were written. A user is *admitted* at its first event, and again at the
first event at least ``ttl`` after its previous admission. From admissions:

* cumulative UV (A2): running count of admissions per page, sampled at each
  window with events; without TTL, first-seen users only. With TTL, a page
  that stays silent for ``ttl`` or longer starts again from 0 (its counter
  expired as well).
* new visitors (A5): admitted users per window; windows with events but no
  admission report 0.

Scaling. Without TTL everything is a group-by (min per (page, user)) with
partial aggregation. With TTL the admission chain is sequential per
(page, user). It is computed exactly as follows:

1. Distinct event times per (page, user) are summarised per TTL-wide time
   bucket (min, max). Consecutive events inside one bucket are closer than
   ``ttl``, so every gap >= ttl lies between two neighbouring non-empty
   buckets; a window over these summaries (at most span/ttl rows per key,
   independent of the event count) cuts each key into *sessions* at such
   gaps. The event after such a gap is always an admission, so sessions are
   independent and a hot (page, user) is split into many of them.
2. Sessions shorter than ``ttl`` have exactly one admission, their first
   event: pure aggregation.
3. Only longer sessions go through an ordered fold. Their distinct times
   are packed into sorted arrays per 1,024-ms piece (partial aggregation, so
   a hot key's duplicates collapse map-side); the pieces are hash-partitioned
   by session, sorted, and scanned by ``mapInPandas`` with O(1) carried
   state (binary search for the next admission). A session is streamed in
   Arrow batches and never held whole in memory.
4. Sessions of more than ``dense_times`` distinct times (a bot that never
   pauses) are not folded by one task but split over all tasks by *pointer
   doubling*: every time gets its successor, the first time at least ``ttl``
   later, and joins of the successor table with itself give the successors 2,
   4, 8, ... steps on; the times reached from a session's start are its
   admissions. The cost is one join of the session's times per doubling of
   its number of admissions, whatever pattern the times follow.

The pieces are written once, below the shared checkpoint folder. Everything
that a report needs (admissions, active windows, page epochs) is computed
from them, so the raw events are scanned and shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uvlens.functions.time import window_end_ms
from uvlens.session import written

KEYS = ("page", "user_id")


def first_seen(behaviors: DataFrame, keys: Sequence[str] = KEYS,
               ms: str = "behavior_ms") -> DataFrame:
    return behaviors.groupBy(*keys).agg(F.min(ms).alias("admit_ms"))


def _sessions_from_summary(per_bucket: DataFrame, keys: list[str], ttl_ms: int) -> DataFrame:
    """``per_bucket`` (keys..., tb, mn, mx, ...) with column ``session``: a new session starts after every gap >= ttl between neighbouring
    buckets. The window holds at most span/ttl rows per key."""
    w = Window.partitionBy(*keys).orderBy("tb")
    prev = F.lag("mx").over(w)
    brk = F.when(prev.isNull() | (F.col("mn") - prev >= ttl_ms), 1).otherwise(0)
    return (per_bucket.withColumn("brk", brk)
            .withColumn("session", F.sum("brk").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("brk"))


def _sessions(times: DataFrame, keys: list[str], ttl_ms: int, ms: str) -> DataFrame:
    """(keys..., tb, session, mn, mx) per non-empty TTL bucket of events."""
    per_bucket = (times.groupBy(*keys, F.expr(f"{ms} div {ttl_ms}").alias("tb"))
                  .agg(F.min(ms).alias("mn"), F.max(ms).alias("mx")))
    return _sessions_from_summary(per_bucket, keys, ttl_ms)


PIECE_MS = 1024  # width of the time pieces whose distinct times travel as one array


def _fold_pieces(keys: list[str], ttl_ms: int):
    """mapInPandas body: rows (keys..., session, piece, times) arrive sorted
    by (keys, session, piece); ``times`` is the sorted array of distinct
    event times of the piece. The chain state (key, last admission) is
    carried across rows and Arrow batches."""
    group_cols = keys + ["session"]

    def fold(batches):
        carry_key = None
        carry_last = None
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                continue
            cols = [pdf[c].to_numpy() for c in group_cols]
            pieces = pdf["times"].to_numpy()
            change = np.zeros(n, dtype=bool)
            change[0] = True
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(change)
            ends = np.append(starts[1:], n)
            rows, admits = [], []
            for s, e in zip(starts, ends):
                key = tuple(c[s] for c in cols)
                if key != carry_key:
                    carry_last = None
                seg = np.concatenate([np.asarray(p, dtype=np.int64) for p in pieces[s:e]])
                pos = 0 if carry_last is None else int(np.searchsorted(seg, carry_last + ttl_ms))
                while pos < len(seg):
                    carry_last = int(seg[pos])
                    rows.append(s)
                    admits.append(carry_last)
                    pos = int(np.searchsorted(seg, carry_last + ttl_ms, side="left"))
                carry_key = key
            if rows:
                idx = np.asarray(rows)
                out = pd.DataFrame({k: pdf[k].to_numpy()[idx] for k in keys})
                out["admit_ms"] = np.asarray(admits, dtype=np.int64)
                yield out
    return fold


def ttl_pieces(behaviors: DataFrame, ttl_ms: int, keys: Sequence[str] = KEYS,
               ms: str = "behavior_ms") -> DataFrame:
    """Written table (keys..., piece, times, pmin, pmax): the sorted distinct times of
    every key and piece, a partial aggregate over one scan. A piece is not wider than
    the TTL."""
    if int(ttl_ms) <= 0:
        raise ValueError("ttl_ms must be positive")
    return written(behaviors.groupBy(*keys, F.expr(f"{ms} div {min(PIECE_MS, int(ttl_ms))}").alias("piece"))
                   .agg(F.array_sort(F.collect_set(ms)).alias("times"),
                        F.min(ms).alias("pmin"), F.max(ms).alias("pmax")), "ttl-pieces")


def piece_times(pieces: DataFrame, *cols: str, ms: str = "behavior_ms") -> DataFrame:
    """The distinct times of the pieces again, one row each."""
    return pieces.select(*cols, F.explode("times").alias(ms))


DENSE_TIMES = 1_000_000  # distinct times of one session that a single task folds


def ttl_admissions(behaviors: DataFrame, ttl_ms: int, keys: Sequence[str] = KEYS,
                   ms: str = "behavior_ms", dense_times: int = DENSE_TIMES) -> DataFrame:
    """Admission times (keys..., admit_ms) under an entry TTL (exact, see module doc)."""
    return admissions_of_pieces(ttl_pieces(behaviors, ttl_ms, keys, ms), ttl_ms, keys, dense_times)


def admissions_of_pieces(pieces: DataFrame, ttl_ms: int, keys: Sequence[str] = KEYS,
                         dense_times: int = DENSE_TIMES) -> DataFrame:
    """Admission times per key, from the table of ``ttl_pieces``.

    A piece is assigned to the TTL bucket of its first event; a
    bucket assigned this way still has no inner gap >= ttl (its pieces start
    inside one TTL span and are no wider than the TTL), so sessions follow
    from per-bucket (min, max) over pieces exactly as over events. Short
    sessions yield their first time; pieces of long sessions are joined to
    their session and folded in order, or, if the session is dense, split.
    """
    keys, ttl_ms = list(keys), int(ttl_ms)
    pieces = pieces.withColumn("tb", F.expr(f"pmin div {ttl_ms}"))
    summary = (pieces.groupBy(*keys, "tb")
               .agg(F.min("pmin").alias("mn"), F.max("pmax").alias("mx"),
                    F.sum(F.size("times")).alias("n_times")))
    sessions = _sessions_from_summary(summary, keys, ttl_ms)
    ws = Window.partitionBy(*keys, "session")
    bounds = written(sessions
                     .withColumn("s_min", F.min("mn").over(ws))
                     .withColumn("long", F.max("mx").over(ws) - F.col("s_min") >= ttl_ms)
                     .withColumn("dense", F.col("long") & (F.sum("n_times").over(ws) > dense_times)), "ttl-sessions")
    short = (bounds.where(~F.col("long") & (F.col("mn") == F.col("s_min")))
             .select(*keys, F.col("s_min").alias("admit_ms")))
    tagged = pieces.join(bounds.where("long").select(*keys, "tb", "session", "dense"), [*keys, "tb"])
    out_schema = T.StructType([pieces.schema[k] for k in keys] + [T.StructField("admit_ms", T.LongType())])
    folded = (tagged.where(~F.col("dense")).select(*keys, "session", "piece", "times")
              .repartition(*keys, "session").sortWithinPartitions(*keys, "session", "piece")
              .mapInPandas(_fold_pieces(keys, ttl_ms), out_schema))
    out = short.unionByName(folded)
    if not bounds.where("dense").isEmpty():
        times = piece_times(tagged.where("dense"), *keys, "session", ms="t")
        out = out.unionByName(dense_admissions(times, ttl_ms, [*keys, "session"])
                              .select(*keys, F.col("t").alias("admit_ms")))
    return out


def successors(times: DataFrame, ttl_ms: int, group: Sequence[str]) -> DataFrame:
    """(group..., t, to): for every distinct time the first time of its session at least
    ``ttl_ms`` later. Within a session it lies less than ``2 * ttl_ms`` on, so in the TTL
    bucket of t + ttl or in the next one: windows hold one bucket each, not the session."""
    g = list(group)
    bucket = F.expr(f"v div {ttl_ms}").alias("b")
    both = (times.select(*g, F.col("t").alias("v"), "t", F.lit(None).cast("bigint").alias("since"))
            .unionByName(times.select(*g, (F.col("t") + ttl_ms).alias("v"), F.lit(None).cast("bigint").alias("t"),
                                      F.col("t").alias("since"))).select("*", bucket))
    later = Window.partitionBy(*g, "b").orderBy(F.desc("v"), F.asc_nulls_first("since")).rowsBetween(
        Window.unboundedPreceding, 0)
    here = both.withColumn("to", F.min("t").over(later)).where("since IS NOT NULL").select(
        *g, F.col("since").alias("t"), "b", "to")
    first = (times.groupBy(*g, F.expr(f"t div {ttl_ms}").alias("b")).agg(F.min("t").alias("first"))
             .select(*g, (F.col("b") - 1).alias("b"), "first"))
    return (here.join(first, [*g, "b"], "left").select(*g, "t", F.coalesce("to", "first").alias("to"))
            .where("to IS NOT NULL"))


def dense_admissions(times: DataFrame, ttl_ms: int, group: Sequence[str]) -> DataFrame:
    """(group..., t): the admissions of sessions (no gap of ``ttl_ms`` or more) given by
    their distinct times, by pointer doubling. All joins are on (group, time), which is
    unique on one side: they neither multiply rows nor gather a session."""
    g = list(group)
    times = written(times, "dense-times")
    reached = written(times.groupBy(*g).agg(F.min("t").alias("t")), "dense-reached")
    jump = written(successors(times, ttl_ms, g), "dense-jump")
    while not jump.isEmpty():
        # ``reached`` holds the first 2^k admissions of every session, ``jump`` 2^k steps
        reached = written(reached.unionByName(
            reached.join(jump, [*g, "t"]).select(*g, F.col("to").alias("t"))), "dense-reached")
        on = jump.select(*g, F.col("t").alias("to"), F.col("to").alias("further"))
        jump = written(jump.join(on, [*g, "to"]).select(*g, "t", F.col("further").alias("to")), "dense-jump")
    return reached


def admission_times(behaviors: DataFrame, ttl_ms: int | None = None,
                    keys: Sequence[str] = KEYS) -> DataFrame:
    if ttl_ms is None:
        return first_seen(behaviors, keys)
    return ttl_admissions(behaviors, ttl_ms, keys)


def active_windows(behaviors: DataFrame, width_ms: int) -> DataFrame:
    """(page, window_time, first_ms) for every window holding events."""
    return (behaviors.select("page", window_end_ms("behavior_ms", width_ms).alias("window_time"),
                             "behavior_ms")
            .groupBy("page", "window_time").agg(F.min("behavior_ms").alias("first_ms")))


def _admitted_per_window(adm: DataFrame, width_ms: int) -> DataFrame:
    return (adm.select("page", "user_id", window_end_ms("admit_ms", width_ms).alias("window_time"))
            .groupBy("page", "window_time")
            .agg(F.count_distinct("user_id").cast("bigint").alias("new_users")))


def first_visits_per_window(behaviors: DataFrame, width_ms: int) -> DataFrame:
    """(page, window_time, new_users) of every window with events, without expiry: one
    scan and no join. Events collapse to one row per (page, user, window) before the
    first shuffle; the window below holds one row per active window of one user."""
    rows = (behaviors.select("page", "user_id", window_end_ms("behavior_ms", width_ms).alias("window_time"))
            .distinct())
    first = F.min("window_time").over(Window.partitionBy("page", "user_id"))
    return (rows.withColumn("is_new", (F.col("window_time") == first).cast("bigint"))
            .groupBy("page", "window_time").agg(F.sum("is_new").alias("new_users")))


def uv_new_visitors(behaviors: DataFrame, width_ms: int = 60_000,
                    ttl_ms: int | None = None) -> DataFrame:
    """A5: users admitted in each window with events; 0 when none."""
    if ttl_ms is None:
        return first_visits_per_window(behaviors, width_ms).withColumnRenamed("new_users", "uv")
    pieces = ttl_pieces(behaviors, ttl_ms)
    adm = admissions_of_pieces(pieces, ttl_ms)
    active = active_windows(piece_times(pieces, "page"), width_ms).select("page", "window_time")
    return (active.join(_admitted_per_window(adm, width_ms), ["page", "window_time"], "left")
            .select("page", "window_time",
                    F.coalesce("new_users", F.lit(0)).cast("bigint").alias("uv")))


def page_epochs(behaviors: DataFrame, ttl_ms: int) -> DataFrame:
    """(page, tb, epoch): epoch increases after every page silence >= ttl."""
    s = _sessions(behaviors.select("page", "behavior_ms"), ["page"], ttl_ms, "behavior_ms")
    return s.select("page", "tb", F.col("session").alias("epoch"))


def uv_cumulative(behaviors: DataFrame, width_ms: int = 30_000,
                  ttl_ms: int | None = None) -> DataFrame:
    """A2: running distinct users per page, sampled at each window with events."""
    if ttl_ms is None:
        w = (Window.partitionBy("page").orderBy("window_time")
             .rowsBetween(Window.unboundedPreceding, 0))
        return (first_visits_per_window(behaviors, width_ms)
                .select("page", "window_time", F.sum("new_users").over(w).alias("uv")))
    if width_ms > ttl_ms:
        raise ValueError("window width must not exceed the TTL")
    pieces = ttl_pieces(behaviors, ttl_ms)
    adm = admissions_of_pieces(pieces, ttl_ms)
    active = active_windows(piece_times(pieces, "page"), width_ms)
    per_window = (active.join(_admitted_per_window(adm, width_ms), ["page", "window_time"], "left")
                  .withColumn("tb", F.expr(f"first_ms div {int(ttl_ms)}"))
                  .join(page_epochs(piece_times(pieces, "page"), ttl_ms), ["page", "tb"]))
    w = (Window.partitionBy("page", "epoch").orderBy("window_time")
         .rowsBetween(Window.unboundedPreceding, 0))
    return per_window.select(
        "page", "window_time",
        F.sum(F.coalesce("new_users", F.lit(0))).over(w).cast("bigint").alias("uv"))


def _fold_seeded(keys: list[str], ms: str, ttl_ms: int, carry: str):
    """mapInPandas body: rows sorted by (keys, ms), each carrying the key's
    previous admission (or null); emits new admissions."""
    def fold(batches):
        carry_key = None
        carry_last = None
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                continue
            cols = [pdf[c].to_numpy() for c in keys]
            t = pdf[ms].to_numpy(dtype=np.int64)
            seed = pdf[carry].to_numpy(dtype="float64")
            change = np.zeros(n, dtype=bool)
            change[0] = True
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(change)
            ends = np.append(starts[1:], n)
            rows, admits = [], []
            for s, e in zip(starts, ends):
                key = tuple(c[s] for c in cols)
                if key != carry_key:
                    carry_last = None if np.isnan(seed[s]) else int(seed[s])
                seg = t[s:e]
                pos = 0 if carry_last is None else int(np.searchsorted(seg, carry_last + ttl_ms))
                while pos < len(seg):
                    carry_last = int(seg[pos])
                    rows.append(s)
                    admits.append(carry_last)
                    pos = int(np.searchsorted(seg, carry_last + ttl_ms, side="left"))
                carry_key = key
            if rows:
                idx = np.asarray(rows)
                out = pd.DataFrame({k: pdf[k].to_numpy()[idx] for k in keys})
                out["admit_ms"] = np.asarray(admits, dtype=np.int64)
                yield out
    return fold


def continue_admissions(events: DataFrame, previous: DataFrame, ttl_ms: int,
                        keys: Sequence[str] = KEYS, ms: str = "behavior_ms") -> DataFrame:
    """Admissions of a new slice of events, given earlier admissions.

    ``previous`` holds (keys..., admit_ms) from earlier slices; only its
    latest admission per key within ``ttl`` of the slice matters, found by a
    partial aggregate. Events older than a key's last admission are not
    admitted again (arrival order wins, as with keyed state).
    """
    keys = list(keys)
    ttl_ms = int(ttl_ms)
    carry = previous.groupBy(*keys).agg(F.max("admit_ms").alias("_carry"))
    seeded = events.select(*keys, ms).join(carry, keys, "left")
    out_schema = T.StructType([events.schema[k] for k in keys]
                              + [T.StructField("admit_ms", T.LongType())])
    return (seeded.repartition(*keys).sortWithinPartitions(*keys, ms)
            .mapInPandas(_fold_seeded(keys, ms, ttl_ms, "_carry"), out_schema))
