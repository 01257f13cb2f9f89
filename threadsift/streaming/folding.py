"""Results that grow with what lands: a small state per micro-batch instead of history.

Both forms write one folder per micro-batch below ``folder`` and overwrite it when the
batch is repeated after a failure, so each batch counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

Step = Callable[[DataFrame], DataFrame]


def _run(stream: DataFrame, checkpoint: str, take: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def state_stream(stream: DataFrame, state: Step, folder: str, checkpoint: str) -> StreamingQuery:
    """Leaves the ``state`` of each micro-batch's events in its own folder, for states
    that merge in any order (``runs.step_states``). Events are read once; readers merge
    the states, a row per key and batch."""

    def take(batch: DataFrame, number: int) -> None:
        state(batch).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return _run(stream, checkpoint, take)


def winner_stream(stream: DataFrame, winners: Step, folder: str, checkpoint: str) -> StreamingQuery:
    """Keeps the winners (``harvest.story_winners``) of all that landed so far: those of
    the micro-batch before together with the new items. A state is bounded by the
    queries' limits, whatever landed."""

    def take(batch: DataFrame, number: int) -> None:
        if number:
            held = batch.sparkSession.read.schema(batch.schema).parquet(f"{folder}/batch={number - 1}")
            batch = held.unionByName(batch)
        winners(batch).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return _run(stream, checkpoint, take)


def latest(spark, folder: str, schema) -> DataFrame:
    """The winners after the last micro-batch; other batches' folders are not opened."""
    kept = spark.read.schema(schema).parquet(folder)
    last = kept.select("batch").agg(F.max("batch")).first()[0]
    return spark.read.schema(schema).parquet(f"{folder}/batch={last}")
