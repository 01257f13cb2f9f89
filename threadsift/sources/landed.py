"""Readers of landed files: search pages, model responses, candidates, logs.

Schemas are fixed, so reading never infers them. Lines that do not parse give
rows of NULLs, which the operators drop as incomplete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas

#: Bytes of landed files that a micro-batch takes at most (one file at least).
BATCH_BYTES = 256 << 20


def _page_items(spark: SparkSession, path: str, member: str, item: str) -> DataFrame:
    """Items of pages such as {"hits": [...]}, one page per line."""
    return _items(spark.read, path, member, item)


def _items(reader, path: str, member: str, item: str) -> DataFrame:
    fields = ", ".join(f"{f.strip().replace(' ', ':', 1)}" for f in _split(item))
    pages = reader.schema(f"{member} array<struct<{fields}>>").json(path)
    return pages.select(F.explode(member).alias("item")).select("item.*")


def _split(fields: str) -> list[str]:
    """Top-level fields of a schema string."""
    out, depth, last = [], 0, 0
    for i, ch in enumerate(fields):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            out.append(fields[last:i])
            last = i + 1
    return [*out, fields[last:]]


def story_hits(spark: SparkSession, path: str) -> DataFrame:
    return _page_items(spark, path, "hits", schemas.STORY_HIT)


def questions(spark: SparkSession, path: str) -> DataFrame:
    return _page_items(spark, path, "items", schemas.QUESTION)


def micro_posts(spark: SparkSession, path: str) -> DataFrame:
    return _page_items(spark, path, "posts", schemas.MICRO_POST)


def model_responses(spark: SparkSession, path: str) -> DataFrame:
    """One response per line, named by its content."""
    return spark.read.text(path).select(
        F.sha2("value", 256).alias("response_id"), F.col("value").alias("payload")
    )


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their ``place``: file, start of the split in it, and a number that
    rises inside a split, since a split is read from its start to its end by one task.
    Places order the lines as the files have them, however the files are cut."""
    return spark.read.text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("place"),
    )


def page_stream(spark: SparkSession, path: str, member: str, item: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Items of landed pages as a stream."""
    return _items(spark.readStream.option("maxBytesPerTrigger", batch_bytes), path, member, item)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CANDIDATE).json(path)


def candidate_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schemas.CANDIDATE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def report_stream(spark: SparkSession, path: str, schema: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(path)


def evolved(spark: SparkSession, path: str, defaults: dict[str, Column]) -> DataFrame:
    """A table whose older files lack columns that newer ones have: all columns of all
    files, NULLs of the given ones filled with their default."""
    merged = spark.read.option("mergeSchema", "true").parquet(path)
    missing = {c: v for c, v in defaults.items() if c not in merged.columns}
    held = {c: F.coalesce(F.col(c), v) for c, v in defaults.items() if c in merged.columns}
    return merged.withColumns({**held, **missing})
