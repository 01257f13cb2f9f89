"""Evaluate an expression once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds or replaces columns that no later operator computes again.

    A filter on a computed column is pushed below the projection that computes
    it, which then runs the expression for the filter and again for the output.
    A generated column stops that: one explode of a one-element array, inside
    the same stage and without a shuffle.
    """
    held = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, held.alias("_once")).select(
        *kept, *[f"_once.{name}" for name in columns]
    )
