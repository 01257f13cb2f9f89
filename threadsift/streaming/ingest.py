"""Incremental ingest of landed candidates into the post store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans import jobs
from ..sources import landed
from ..sources.daytable import DayTable


def ingest(
    posts: DayTable,
    landing: str,
    checkpoint: str,
    as_of,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Takes in every file that landed since the last run and stops. A micro-batch
    that is repeated after a failure finds its URLs stored and adds nothing, so
    each post enters once. Copies with later tags still bring their tags in."""
    stream = landed.candidate_stream(posts.spark, landing, files_per_batch)

    def take(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            jobs.discover(posts, batch, as_of)

    return (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_now(posts: DayTable, landing: str, checkpoint: str, as_of, **options) -> None:
    ingest(posts, landing, checkpoint, as_of, **options).awaitTermination()
