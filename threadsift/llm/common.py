"""What the operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: ASCII white space, the separator of words in every operator that counts words.
SPACE = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text of a table, a null text as an empty one."""
    return df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def range_bounds(df: DataFrame, key: str, parts: int) -> list[int]:
    """At most ``parts - 1`` increasing values that cut ``key`` into runs of about
    equal row counts. Only these values reach the driver."""
    steps = [i / parts for i in range(1, parts)]
    if not steps:
        return []
    found = df.agg(F.percentile_approx(key, steps, 20 * parts).alias("b")).first()["b"]
    return sorted(set(found or []))


def range_bucket(key: str, bounds: list[int]) -> Column:
    """Number of the run that a key belongs to, null keys in the first one."""
    if not bounds:
        return F.lit(0)
    listed = ",".join(f"{b}L" for b in bounds)
    return F.expr(f"size(filter(array({listed}), b -> b < `{key}`))")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch, columns: list[int], limit: int):
    """A batch in slices of about ``limit`` bytes of text in the given columns, of one
    row at least."""
    sizes = sum(np.asarray(pc.fill_null(pc.binary_length(batch.column(c)), 0), np.int64) for c in columns)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)
