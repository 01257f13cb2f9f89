"""Copies of a post within a batch, and a batch against the store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import refdata


def first_seen(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """The first row of every key. Spark limits each group before the shuffle, so
    a key with very many copies costs one row per input partition."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def merge_copies(
    posts: DataFrame,
    seq: str = "seq",
    names: list[str] = refdata.COMPETITORS,
    priority: str = refdata.PRIORITY_PLATFORM,
) -> DataFrame:
    """One row per ``post_url``: the first copy, its competitors extended by those
    of later copies in order of appearance, its platform raised to ``priority``
    if any copy has it. Categories are not merged.

    One shuffle with map-side combine. Cleaned competitors come from a short
    list, so each name keeps only its first position and no group collects its
    copies.
    """
    other = [c for c in posts.columns if c != "post_url"]
    first_at = [
        F.min(
            F.when(
                F.array_contains("competitors", name),
                F.struct(
                    F.col(seq).alias("seq"),
                    F.array_position("competitors", name).alias("pos"),
                    F.lit(name).alias("name"),
                ),
            )
        ).alias(f"_c{i}")
        for i, name in enumerate(names)
    ]
    grouped = posts.groupBy("post_url").agg(
        F.min_by(F.struct(*other), F.col(seq)).alias("_first"),
        F.bool_or(F.col("platform") == priority).alias("_raised"),
        *first_at,
    )
    in_order = F.array_sort(F.array_compact(F.array(*[f"_c{i}" for i in range(len(names))])))
    rebuilt = {
        "platform": F.when(F.col("_raised"), F.lit(priority)).otherwise(
            F.col("_first.platform")
        ),
        "competitors": F.transform(in_order, lambda c: c["name"]),
    }
    return grouped.select(
        *[
            F.col("post_url")
            if c == "post_url"
            else rebuilt.get(c, F.col(f"_first.{c}")).alias(c)
            for c in posts.columns
        ]
    )


def stored_urls(batch: DataFrame, store: DataFrame) -> DataFrame:
    """URLs of the batch that the store holds. The store is the side that is
    filtered: against a small batch it is read without being shuffled."""
    return store.select("post_url").join(batch.select("post_url"), "post_url", "left_semi")


def already_stored(batch: DataFrame, store: DataFrame) -> DataFrame:
    return batch.join(stored_urls(batch, store), "post_url", "left_semi")


def not_stored(batch: DataFrame, store: DataFrame) -> DataFrame:
    return batch.join(stored_urls(batch, store), "post_url", "left_anti")


def within(output: DataFrame, given: DataFrame) -> DataFrame:
    """Rows whose URL, taken literally, is one of the given ones."""
    return output.join(given.select("post_url").distinct(), "post_url", "left_semi")


def with_snippets(
    posts: DataFrame, snippets: DataFrame, order: str = "seq", body: str = "body"
) -> DataFrame:
    """Adds the latest snippet of each URL; NULL where there is none."""
    latest = (
        snippets.filter(F.col(body).isNotNull())
        .groupBy("post_url")
        .agg(F.max_by(body, order).alias("body"))
    )
    return posts.join(latest, "post_url", "left")
