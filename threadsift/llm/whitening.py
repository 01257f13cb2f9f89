"""Embedding whitening by weighted multiplicity covariance.

Components become integers, so equal vectors are exactly equal and are grouped: each
distinct vector has its multiplicity as weight, and all that follows works on distinct
vectors. The covariance is a weighted centred product: each task subtracts the centre
from its distinct vectors, multiplies the matrix with its weighted self, and returns the
upper triangle, which Spark adds up. The centre is the integer nearest to each mean, so
the products stay whole numbers, and the rest of the mean is taken off exactly on the
driver. Eigenvectors are taken from this one matrix. Every distinct vector is whitened
once and joined back to its rows.

A vector with more than a ``HOT``-th of all rows (there are fewer than ``HOT`` such) meets
its rows by a broadcast of that bounded table, all others by a shuffle, so that no task
gets the rows of a hot vector.

``weights="one"`` fits on distinct vectors, each counted once, instead.

Vectors that are null, empty, of another length than most, or hold null or non-finite
components are dropped. Repeated rows and rows with a null key are rows like others.
Components whose eigenvalue is 0 to double precision cannot be whitened and are left out:
without rows, or with one distinct vector, there are none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from .vectors import matrix, usable

#: A component c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Components returned at most, and the share of rows that makes a vector hot.
COMPONENTS, HOT = 32, 1000
_ROWS = 4096


@dataclass(frozen=True)
class Fit:
    """n rows with sums S; ``basis`` holds the components as rows, ``values`` their
    eigenvalues, both by falling eigenvalue; ``trace`` is that of the covariance."""

    n: int
    sums: list[int]
    basis: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        return np.array([nearest(s, self.n) for s in self.sums], np.int64)


def nearest(s: int, n: int) -> int:
    """The integer nearest to s / n."""
    return (2 * s + n) // (2 * n)


def scatter(df: DataFrame, vector: str, weight: str, centre: np.ndarray) -> np.ndarray:
    """The sum of weight * (x - centre)(x - centre)' over all rows: one product for each
    batch, one upper triangle for each task, added up by Spark."""
    d = len(centre)
    at = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((d, d)), False
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS):
                part = batch.slice(i, _ROWS)
                y = (matrix(part.column(0), d) - centre).astype(np.float64)
                total += (y * part.column(1).to_numpy()[:, None]).T @ y
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)), pa.array(total[at])], names=["i", "j", "v"]
            )

    each = df.select(vector, F.col(weight).cast("double")).mapInArrow(run, "i int, j int, v double")
    out = np.zeros((d, d))
    for r in each.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # d * (d + 1) / 2 rows
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def _integers(vector: str) -> Column:
    return F.expr(f"transform(`{vector}`, c -> floor({SCALE} * cast(c AS double)) + {SHIFT}L)")


def distinct(rows: DataFrame) -> DataFrame:
    """rows: x; each distinct x once with its count, written. Copies are counted before
    the shuffle."""
    return written(rows.groupBy("x").agg(F.count("*").alias("count")), "distinct-vectors")


def fit(vectors: DataFrame, length: int, weights: str = "count") -> Fit | None:
    """The fit on distinct vectors (x, count); None without any."""
    if weights not in ("count", "one"):
        raise ValueError("weights are 'count' or 'one'")
    weighted = vectors.select("x", (F.col("count") if weights == "count" else F.lit(1).cast("long")).alias("weight"))
    exact = "decimal(38,0)"
    total = weighted.agg(
        F.sum("weight").alias("n"),
        *(F.sum(F.col("x")[k].cast(exact) * F.col("weight")).cast(exact).alias(f"s{k}") for k in range(length)),
    ).first()
    if not total["n"]:
        return None
    n, sums = int(total["n"]), [int(total[f"s{k}"]) for k in range(length)]
    centre = [nearest(s, n) for s in sums]
    around = scatter(weighted, "x", "weight", np.array(centre, np.int64))
    rest = [s - n * c for s, c in zip(sums, centre)]
    covariance = np.array([
        [float(Fraction(n * int(around[i, j]) - rest[i] * rest[j], n * n)) for j in range(length)] for i in range(length)
    ])
    values, vectors_ = np.linalg.eigh(covariance)
    values, basis, trace = values[::-1], vectors_[:, ::-1].T, float(np.trace(covariance))
    real = int((values > length * np.finfo(float).eps * max(values[0], 0)).sum()) if trace > 0 else 0
    return Fit(n, sums, basis[:real], values[:real], trace)


def _whitener(own: Fit, components: int):
    """x -> deviation and whitened components, for batches of distinct vectors."""
    n, centre, d = own.n, own.centre, len(own.sums)
    rest = [s - n * int(c) for s, c in zip(own.sums, centre)]
    offset = np.array([r / n for r in rest])
    scaled = (own.basis[:components] / np.sqrt(own.values[:components])[:, None]).T
    square = sum(r * r for r in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS):
                part = batch.slice(i, _ROWS)
                y = matrix(part.column(0), d) - centre
                exact = y  # whole numbers of any size where 64 bits may not do
                if int(np.abs(y).max(initial=0)) * max(map(abs, rest), default=0) * d >= 1 << 62 or np.abs(y).max(initial=0) >= 1 << 26:
                    exact = y.astype(object)
                squares, cross = (exact * exact).sum(axis=1), (exact * np.array(rest, exact.dtype)).sum(axis=1)
                # sum of (n y - rest)^2
                deviation = [n * n * int(q) - 2 * n * int(c) + square for q, c in zip(squares, cross)]
                deviation = [Decimal(v) if v < 10**38 else None for v in deviation]
                z = (y.astype(np.float64) - offset) @ scaled
                flat = pa.ListArray.from_arrays(np.arange(0, z.size + 1, max(1, z.shape[1]), dtype=np.int32), pa.array(z.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(deviation, pa.decimal128(38, 0)), flat],
                    names=["x", "count", "deviation", "whitened"],
                )

    return run


def _joined(rows: DataFrame, vectors: DataFrame, n: int) -> DataFrame:
    """rows (key, x) with what the distinct vectors (x, count ...) have: those with more
    than n / HOT rows by a broadcast, fewer than HOT of them, the others by a shuffle."""
    hot = vectors.where(F.col("count") * HOT > n)
    cold = vectors.where(F.col("count") * HOT <= n)
    common = F.broadcast(hot.select("x"))
    of_hot = rows.join(common, "x", "left_semi").join(F.broadcast(hot), "x")
    of_cold = rows.join(common, "x", "left_anti").join(cold, "x")
    return of_hot.unionByName(of_cold)


def whiten(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, weights: str = "count",
) -> DataFrame:
    """A row for each usable row and component up to ``components``: n, deviation (sum
    over dimensions of (n x - S)^2, exact, null beyond 38 digits), whitened, explained (the eigenvalue
    by the trace) and identity_error (the largest absolute entry of the covariance of
    what was returned, minus the identity; measured over all rows)."""
    rows, length = usable(df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("vector")), "vector")
    rows = written(rows.select("key", _integers("vector").alias("x")), "integer-vectors")
    vectors = distinct(rows)
    own = fit(vectors, length, weights)
    many = 0 if own is None else min(components, len(own.values))
    if not many:
        return rows.where("false").selectExpr(
            f"key AS `{key}`", "1 AS component", "0L AS n", "cast(0 AS decimal(38,0)) AS deviation",
            "0d AS whitened", "0d AS explained", "0d AS identity_error",
        )
    white = written(vectors.mapInArrow(
        _whitener(own, many), "x array<long>, count long, deviation decimal(38,0), whitened array<double>"
    ), "whitened-vectors")
    weight = "count" if weights == "count" else "one"
    counted = white.withColumn("one", F.lit(1).cast("long"))
    mean = counted.agg(*(F.sum(F.col("whitened")[k] * F.col(weight)).alias(f"m{k}") for k in range(many))).first()
    centre = np.array([mean[f"m{k}"] / own.n for k in range(many)])
    error = float(np.abs(scatter(counted, "whitened", weight, centre) / own.n - np.eye(many)).max())
    explained = ", ".join(f"{float(v / own.trace)!r}d" for v in own.values[:many])
    return _joined(rows, white, own.n).selectExpr(
        "key", "deviation", "posexplode(whitened) AS (at, whitened)",
    ).selectExpr(
        f"key AS `{key}`", "at + 1 AS component", f"{own.n}L AS n", "deviation", "whitened",
        f"array({explained})[at] AS explained", f"{error!r}d AS identity_error",
    )
