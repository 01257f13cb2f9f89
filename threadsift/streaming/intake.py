"""Error reports as a stream: repeats, hourly rate, digests.

The rate limit is a stateful operator of Spark's: it is fed with (key, time, id) only and
keeps the last ``cap`` accepted times of each key in Spark's own state store, which belongs
to the checkpoint. A micro-batch that is repeated after a failure finds the state it
began with. The ids it accepts are appended to a table; payload meets them by id
when that table is read, and never enters Python.

Bounds: a task holds the times and ids (16 bytes a row) of one key's rows in one
micro-batch. A micro-batch has ``landed.BATCH_BYTES`` of files at most unless its reader
is told otherwise, so that bounds them. State has ``cap`` times a key; keys unseen for
``keep_seconds`` leave it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import errors, ratelimit
from ..plans import jobs
from ..session import finished, written
from ..sources.daytable import DayTable


def limiter(cap: int, window_us: int, keep_ms: int | None = None) -> Callable:
    """The rule for one key: its new rows (``_k``, ``_t``, ``_id``), in chunks of any size
    and order, after the accepted times in its state.

    Arrival counts: a row older than the key's last accepted one is judged as if it
    came at that time.
    """

    def run(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = list(state.get[0]) if state.exists else []
        parts = [(c["_t"].to_numpy(np.int64), c["_id"].to_numpy(np.int64)) for c in chunks]
        times, ids = (np.concatenate(a) for a in zip(*parts))
        if held:
            times = np.maximum(times, held[-1])
        order = np.lexsort((ids, times))
        times, ids = times[order], ids[order]
        keep, held = ratelimit._accept(held, times, cap, window_us)
        state.update((held,))
        if keep_ms is not None:
            state.setTimeoutDuration(keep_ms)
        if keep is not True:
            times, ids = times[keep], ids[keep]
        yield pd.DataFrame({"_k": key[0], "_t": times, "_id": ids})

    return run


def limited_stream(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    *,
    keys: list[str],
    at: str,
    order: str,
    cap: int,
    window_seconds: float,
    keep_seconds: float | None = None,
) -> StreamingQuery:
    """Appends the ids of the accepted rows of a stream to the table ``out`` until the
    landed files are used up; ``accepted_rows`` reads them. ``order`` is a unique number.
    ``keep_seconds`` drops a key's state when no row of it came for so long on the
    clock; rows that come later find no earlier one. Without it all keys are kept.

    Spark's file sink writes each micro-batch once, also when it is repeated."""
    keep_ms = None if keep_seconds is None else int(keep_seconds * 1000)
    expiry = GroupStateTimeout.NoTimeout if keep_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    accepted = ratelimit.keyed(stream, keys, at, order).groupBy("_k").applyInPandasWithState(
        limiter(cap, int(window_seconds * 1_000_000), keep_ms),
        "_k string, _t long, _id long", "times array<long>", "append", expiry,
    )
    writer = (
        accepted.select("_id").writeStream.format("parquet").outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    # A clock timeout alone would keep such a run going for ever on empty micro-batches;
    # keys leave with the next one that has rows. A query takes the setting as it starts.
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return writer.start()
    finally:
        conf.set(name, before)


def accepted_rows(landed: DataFrame, out: str, order: str) -> DataFrame:
    """The landed rows that a limited stream accepted: a semi-join by id, which no key
    can skew."""
    ids = landed.sparkSession.read.schema("_id long").parquet(out)
    return landed.join(ids.select(F.col("_id").alias(order)), order, "left_semi")


def digest_stream(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    every: str | None = None,
    *,
    table: DayTable | None = None,
    deliver: Callable[[DataFrame], DataFrame] | None = None,
    as_of=None,
) -> StreamingQuery:
    """One row per fingerprint and micro-batch, written to ``out/batch=N``. With
    ``every`` (such as ``15 minutes``) it keeps running at that pace, else it
    stops when the landed files are used up.

    ``deliver`` gets the groups, with ``batch``, and returns those it could deliver;
    ``out`` then is the log of what was delivered. With ``table``, the kept table of
    the errors, their rows are marked with ``as_of`` as the batch job does it. The log is
    written before anything is marked: a micro-batch that is repeated with its log
    there delivers nothing again, and marks what is not yet marked. One that failed
    before its log was whole delivers again, under the same (batch, fingerprint), by
    which a receiver can tell."""

    def take(batch: DataFrame, number: int) -> None:
        spark, log = batch.sparkSession, f"{out}/batch={number}"
        waiting = errors.unalerted(batch)
        if not finished(spark, log):
            groups = errors.digest(waiting)
            told = groups if deliver is None else deliver(groups.withColumn("batch", F.lit(number))).drop("batch")
            told.write.mode("overwrite").parquet(log)
        if table is not None:
            delivered = spark.read.parquet(log).select("fingerprint")
            jobs.mark(table, written(waiting.select("id", "fingerprint", "occurred_at"), "waiting"), delivered, as_of)

    pace = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**pace)
        .start()
    )
