"""Records out of model responses, and the hook that calls a model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import json_text as J
from ..functions.stage import once
from .dedup import with_snippets

ASKED = ["platform", "post_url", "post_title", "author_handle", "posted_at", "body"]
ANSWERED = ["post_url", "summary", "opportunity", "categories"]


def parse_batches(responses: DataFrame, payload: str, batch_id: str) -> DataFrame:
    """Every response with its parsed batch ``_batch`` and ``fault``: ``no_text``,
    ``no_json``, ``no_object``, or NULL for a readable batch."""
    read = J.with_response_text(responses.select(batch_id, payload), payload, "_text")
    parsed = J.with_json(read, "_text", "_json").select(batch_id, "_text", "_json")
    fault = (
        F.when(F.col("_text").isNull(), "no_text")
        .when(F.col("_json").isNull(), "no_json")
        .when(J.kind(F.col("_json")) != "OBJECT", "no_object")
    )
    return once(parsed, {"_batch": F.col("_json"), "fault": fault}).select(
        batch_id, "_batch", "fault"
    )


def batch_faults(parsed: DataFrame, batch_id: str) -> DataFrame:
    return parsed.filter(F.col("fault").isNotNull()).select(batch_id, "fault")


def batch_summaries(parsed: DataFrame, batch_id: str) -> DataFrame:
    summary = F.coalesce(F.try_variant_get("_batch", "$.summary", "string"), F.lit(""))
    return parsed.filter(F.col("fault").isNull()).select(batch_id, summary.alias("summary"))


def batch_records(parsed: DataFrame, batch_id: str) -> DataFrame:
    """Every record of the readable batches with ``pos`` and ``fault``, the name
    of the field that breaks it. ``posts`` that is no list counts as empty."""
    listed = F.try_variant_get("_batch", "$.posts", "array<variant>")
    each = parsed.filter(F.col("fault").isNull()).select(
        batch_id, F.posexplode(listed).alias("pos", "_record")
    )
    kinds = each.withColumn("_kinds", J.record_kinds(F.col("_record")))
    faulted = once(kinds, {"fault": J.record_fault(F.col("_kinds"))})
    text = {
        c: F.try_variant_get("_record", f"$.{c}", "string").alias(c)
        for c in [*J.REQUIRED_TEXT, *J.OPTIONAL_TEXT]
    }
    lists = [
        F.coalesce(
            F.try_variant_get("_record", f"$.{c}", "array<string>"),
            F.array().cast("array<string>"),
        ).alias(c)
        for c in J.TEXT_LISTS
    ]
    opportunity = F.coalesce(
        F.try_variant_get("_record", "$.opportunity", "string"), F.lit("")
    ).alias("opportunity")
    return faulted.select(batch_id, "pos", "fault", *text.values(), opportunity, *lists)


def valid_records(records: DataFrame) -> DataFrame:
    return records.filter(F.col("fault").isNull()).drop("fault")


def classify(
    candidates: DataFrame,
    snippets: DataFrame | None,
    predict: Callable[[pd.DataFrame], pd.DataFrame],
    order: str = "seq",
) -> DataFrame:
    """Candidates with summary, opportunity and categories set by ``predict``.

    ``predict`` gets a batch (platform, post_url, post_title, author_handle,
    posted_at, body) and returns rows (post_url, summary, opportunity,
    categories) for the posts it keeps, each under the index of the row it is
    for. So copies of one URL keep their own payload, however the rows are cut
    into batches. Answers under another index or URL than those given are
    dropped. Batches are Spark's Arrow batches and empty ones never reach it; no
    row leaves its partition.
    """
    columns = candidates.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield _answered(batch, predict)[columns]

    return _with_bodies(candidates, snippets, order).mapInPandas(run, candidates.schema)


def _with_bodies(candidates: DataFrame, snippets: DataFrame | None, order: str) -> DataFrame:
    if snippets is None:
        return candidates.withColumn("body", F.lit(None).cast("string"))
    return with_snippets(candidates, snippets, order)


def _answered(batch: pd.DataFrame, predict: Callable[[pd.DataFrame], pd.DataFrame]) -> pd.DataFrame:
    """The rows of a batch that ``predict`` keeps, with its answers."""
    answer = predict(batch[ASKED])[ANSWERED]
    answer = answer[answer.index.isin(batch.index)]
    asked = batch["post_url"].loc[answer.index].to_numpy()
    answer = answer[answer["post_url"].to_numpy() == asked]
    answer = answer[~answer.index.duplicated()].drop(columns="post_url").astype(object)  # empty ones have no type
    return batch.drop(columns=ANSWERED[1:]).join(answer, how="inner")


def classify_or_fault(
    candidates: DataFrame,
    snippets: DataFrame | None,
    predict: Callable[[pd.DataFrame], pd.DataFrame],
    order: str = "seq",
) -> DataFrame:
    """``classify`` with failures as data: the kept candidates with ``fault`` NULL, and the
    candidates for which ``predict`` fails, as they came, with what it raised.

    A batch that fails is halved and asked again, down to single rows. So one bad row
    costs a few more calls and takes no other row with it, and how Spark cuts rows into
    batches changes nothing, as long as it is rows that make ``predict`` fail. A
    ``predict`` that always fails gives a fault for every row, not the end of the job.
    """
    columns = candidates.columns

    def answers(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        try:
            kept = _answered(batch, predict)[columns]
        except Exception as failure:  # any failure of the caller's model is data here
            if len(batch) == 1:
                yield batch[columns].assign(fault=f"{type(failure).__name__}: {failure}")
                return
            half = len(batch) // 2
            yield from answers(batch.iloc[:half])
            yield from answers(batch.iloc[half:])
        else:
            yield kept.assign(fault=None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield from answers(batch)

    schema = StructType([*candidates.schema.fields, StructField("fault", StringType())])
    return _with_bodies(candidates, snippets, order).mapInPandas(run, schema)


def keyword_rules(rules: dict[str, list[str]]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A stand-in for a model: a category applies when one of its words occurs in
    the title or snippet; posts without any category are dropped."""

    def predict(batch: pd.DataFrame) -> pd.DataFrame:
        text = (batch["post_title"].fillna("") + "\n" + batch["body"].fillna("")).str.lower()
        categories = [
            [name for name, words in rules.items() if any(w in t for w in words)]
            for t in text
        ]
        out = pd.DataFrame(
            {
                "post_url": batch["post_url"],
                "summary": "Matched " + pd.Series(categories, index=batch.index).str.join(", "),
                "opportunity": "",
                "categories": categories,
            }
        )
        return out[[bool(c) for c in categories]]

    return predict
