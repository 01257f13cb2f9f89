"""What the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def usable(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows whose vector can be used, and its length: not null, not empty, all
    components finite, and as long as most such vectors are (the longer of equally
    frequent lengths). Counts by length reach the driver as one row. Without such rows
    the length is 0."""
    fine = df.where(
        f"`{vector}` IS NOT NULL AND size(`{vector}`) > 0 AND forall(`{vector}`, "
        "x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )
    lengths = fine.groupBy(F.size(F.col(f"`{vector}`")).alias("n")).count()
    usual = lengths.agg(F.max(F.struct("count", "n")).alias("most")).first()["most"]
    length = usual["n"] if usual else 0
    return fine.where(F.size(F.col(f"`{vector}`")) == length), length


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """A column of lists of equal length as rows of numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)
