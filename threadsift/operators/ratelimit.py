"""Accepted-only rate limiting per key.

An event is accepted iff fewer than ``cap`` *accepted* events of its key lie in
the ``window`` before it. Whether an event counts depends on all earlier
decisions of its key, so no window function gives this answer. The decisions
are taken by a walk over (key, time, id) only, in order, holding ``cap`` times
per key; payload columns never enter Python.

Events are thinned first, in parallel and without changing the result: time is
cut into slots, events are counted per (key, slot) with map-side combine, and
bounds on the number of accepted events up to each slot show which slots cannot
hold one. Only events of the other slots are walked.

A key's time is cut where a whole window has no event: nothing before such a gap
counts for what comes after it. So each stretch between two gaps, a segment, is
decided on its own, and a key's segments are walked in as many tasks as there are.
Gaps are found among cells of several slots, a row for each cell that has events,
in a running maximum that Spark takes; only gapless stretches are sequential. What a
task walks of one grows with its time and not with the number of its events, and it
is walked as a stream of batches, so that memory does not grow with the key. All
keys and sizes take this one path. ``accepted_keys`` reads its events three times, so
``rate_limit`` writes (key, time, id) to the shared folder first, and what the key costs
is paid once.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, GroupedData, Window, functions as F

from ..session import written

#: Slots that a window is cut into, and cells among which gaps are looked for: a gap of
#: a window and two cells is always found.
SLOTS, CELLS = 4096, 16


def _by_bucket(df: DataFrame, *order: str) -> GroupedData:
    """Rows grouped into buckets of whole segments, sorted by segment and ``order``.

    The grouping states that segments must stay together, so no later change of the
    plan splits them (a bare ``repartition`` is dropped where the input already
    has that partitioning, and then nothing protects it). Groups reach Python
    as a stream of batches, never whole.
    """
    spark = df.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.withColumn("_b", F.pmod(F.xxhash64("_k", "_seg"), F.lit(buckets)))
        .repartition("_b")
        .sortWithinPartitions("_b", "_k", "_seg", *order)
        .groupBy("_b")
    )


def _accept(held: list[int], times: np.ndarray, cap: int, window_us: int):
    """Which of the sorted ``times`` of one key are accepted after ``held``, its
    last accepted times; and the last accepted times afterwards."""
    joined = np.concatenate([np.asarray(held, dtype=times.dtype), times])
    if len(joined) <= cap or (joined[cap:] - joined[:-cap] >= window_us).all():
        return True, joined[-cap:].tolist()
    recent, given = deque(held, maxlen=cap), times.tolist()
    keep = np.zeros(len(given), dtype=bool)
    i = 0
    while i < len(given):
        if len(recent) < cap or recent[0] <= given[i] - window_us:
            recent.append(given[i])
            keep[i] = True
            i += 1
        else:  # nothing is accepted until the oldest of them leaves the window
            i = bisect_left(given, recent[0] + window_us, i + 1)
    return keep, list(recent)


def _walk(cap: int, window_us: int):
    """Decides rows that come sorted by (key, segment, time, id), batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            keys, times, segment = batch.column("_k"), batch.column("_t").to_numpy(), batch.column("_seg").to_numpy()
            if not len(keys):
                continue
            changes = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False) | (segment[1:] != segment[:-1])
            starts = np.flatnonzero(np.concatenate([[True], changes])).tolist()
            keep = np.ones(len(keys), dtype=bool)
            for a, b in zip(starts, [*starts[1:], len(keys)]):
                if a or (keys[0].as_py(), segment[0]) != key:
                    held = []
                if len(held) + b - a <= cap:
                    held = held + times[a:b].tolist()
                else:
                    keep[a:b], held = _accept(held, times[a:b], cap, window_us)
            key = (keys[-1].as_py(), segment[-1])
            yield batch.select(["_k", "_t", "_id"]).filter(pa.array(keep))

    return run


def _live_slots(cap: int, whole: int, ceiling: int):
    """Slots that may hold an accepted event, from sorted (key, segment, slot, count).

    ``hi`` and ``lo`` bound the number A(i) of accepted events up to slot i:
    any ``whole`` consecutive slots fit into one window, so
    A(i) <= min(A(i-1) + count, A(i-whole) + cap); and either all events of slot
    i are accepted or one is refused because ``cap`` lie in the window before
    it, so A(i) >= min(A(i-1) + count, A(i-ceiling-1) + cap).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, past, lagging = None, deque(), deque()
        hi = lo = old_hi = old_lo = 0
        for batch in batches:
            live = []
            rows = zip(
                zip(batch["_k"].to_numpy(), batch["_seg"].to_numpy().tolist()),
                batch["_slot"].to_numpy().tolist(),
                batch["n"].to_numpy().tolist(),
            )
            for k, slot, n in rows:
                if k != key:
                    key, hi, lo, old_hi, old_lo = k, 0, 0, 0, 0
                    past, lagging = deque(), deque()
                # Values of A at slot-whole and at slot-ceiling-1.
                while past and past[0][0] <= slot - whole:
                    old_hi = past.popleft()[1]
                while lagging and lagging[0][0] <= slot - ceiling - 1:
                    old_lo = lagging.popleft()[1]
                before = lo
                hi = min(hi + n, old_hi + cap)
                lo = min(lo + n, old_lo + cap)
                past.append((slot, hi))
                lagging.append((slot, lo))
                live.append(hi > before)
            yield batch.loc[live, ["_k", "_slot", "_seg"]]

    return run


def segments(counts: DataFrame, window_us: int, width: int, cells: int = CELLS) -> DataFrame:
    """``counts`` (``_k``, ``_slot``, ...) with ``_seg``, the first cell of the row's segment.
    Two segments of a key have a gap of ``window_us`` at least between them. Each cell
    with events is one row, which meets its slots again by an equi-join."""
    per = max(window_us // width // cells, 1)
    need = -(-window_us // (per * width))
    celled = counts.withColumn("_cell", F.floor(F.col("_slot") / per).cast("long"))
    by_time = Window.partitionBy("_k").orderBy("_cell")
    before = F.lag("_cell").over(by_time)
    opens = F.when(before.isNull() | (F.col("_cell") - before > need), F.col("_cell"))
    since = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = celled.select("_k", "_cell").distinct().withColumn("_opens", opens)
    placed = starts.select("_k", "_cell", F.max("_opens").over(since).alias("_seg"))
    return celled.join(placed, ["_k", "_cell"]).drop("_cell")


def thin(events: DataFrame, cap: int, window_us: int, slots: int = SLOTS) -> DataFrame:
    """``events`` (``_k``, ``_t``, ``_id``) with their segment ``_seg``, without those that
    are certainly refused: those of slots that cannot hold an accepted one."""
    width = max(window_us // slots, 1)
    slotted = events.withColumn("_slot", F.floor(F.col("_t") / width).cast("long"))
    counts = slotted.groupBy("_k", "_slot").agg(F.count("*").alias("n"))
    live = _by_bucket(segments(counts, window_us, width), "_slot").applyInPandas(
        _live_slots(cap, window_us // width, -(-window_us // width)),
        "_k string, _slot long, _seg long",
    )
    return slotted.join(live, ["_k", "_slot"]).drop("_slot")


def accepted_keys(
    events: DataFrame, cap: int, window_seconds: float, slots: int = SLOTS
) -> DataFrame:
    """The accepted rows of ``events`` (``_k`` string, ``_t`` epoch
    microseconds, ``_id`` long, unique)."""
    window_us = int(window_seconds * 1_000_000)
    return _by_bucket(thin(events, cap, window_us, slots), "_t", "_id").applyInArrow(
        _walk(cap, window_us), "_k string, _t long, _id long"
    )


def keyed(df: DataFrame, keys: list[str], at: str, order: str) -> DataFrame:
    """The three columns the decision needs. The key is text that tells NULL from
    '' and keeps its parts apart."""
    return df.select(
        F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("_k"),
        F.unix_micros(F.col(at).cast("timestamp")).alias("_t"),
        F.col(order).cast("long").alias("_id"),
    )


def rate_limit(
    df: DataFrame,
    keys: list[str],
    at: str,
    order: str,
    cap: int,
    window_seconds: float,
    *,
    reused: bool = False,
    **options,
) -> DataFrame:
    """Rows of ``df`` that are accepted: at most ``cap`` accepted rows per key in
    any ``window_seconds``. ``order`` is a unique number that orders rows of the
    same instant. Payload rows meet the decisions in a semi-join on ``order``,
    which no key can skew. With ``reused`` the decisions are written to the shared
    folder, so that further steps do not take them again."""
    events = written(keyed(df, keys, at, order), "keyed")
    accepted = accepted_keys(events, cap, window_seconds, **options)
    ids = accepted.select(F.col("_id").alias(order))
    return df.join(written(ids, "accepted") if reused else ids, order, "left_semi")


def drop_repeats(
    df: DataFrame, keys: list[str], at: str, order: str, ttl_seconds: float, **options
) -> DataFrame:
    """Drops a row while the last *kept* row of its key is younger than the TTL:
    a rate limit of one per TTL."""
    return rate_limit(df, keys, at, order, 1, ttl_seconds, **options)
