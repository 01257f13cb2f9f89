"""Client error reports: fingerprint, intake, digest and alert marks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import refdata
from ..functions import text, times
from ..functions.stage import once
from . import ratelimit

DIGEST_COLUMNS = [
    "id", "occurred_at", "message", "stack", "page_url", "user_agent", "fingerprint",
]
PLACEHOLDERS = {
    "message": "(no message)", "stack": "(no stack)",
    "page_url": "(no url)", "user_agent": "(no user agent)",
}


def with_fingerprint(reports: DataFrame) -> DataFrame:
    """Later filters, keys and cuts use the fingerprint without computing it again."""
    return once(reports, {"fingerprint": text.fingerprint(F.col("message"), F.col("stack"))})


def suppress_repeats(
    reports: DataFrame,
    *,
    session: str = "session",
    at: str = "occurred_at",
    order: str = "seq",
    ttl_seconds: float = refdata.REPEAT_TTL_S,
    **options,
) -> DataFrame:
    """What one page still sends: a fingerprint again only after the TTL."""
    return ratelimit.drop_repeats(
        reports, [session, "fingerprint"], at, order, ttl_seconds, **options
    )


def valid_reports(reports: DataFrame) -> DataFrame:
    """Reports with a message and a fingerprint, cut to the stored widths. The
    fingerprint is cut before anything counts it."""
    present = (F.length("message") > 0) & (F.length("fingerprint") > 0)
    widths = {**refdata.ERROR_WIDTHS, "fingerprint": refdata.FINGERPRINT_CHARS}
    return reports.filter(F.coalesce(present, F.lit(False))).withColumns(
        {c: F.left(c, F.lit(n)) for c, n in widths.items() if c in reports.columns}
    )


def admit(
    reports: DataFrame,
    *,
    at: str = "occurred_at",
    order: str = "seq",
    cap: int = refdata.ACCEPTED_PER_HOUR,
    window_seconds: float = refdata.RATE_WINDOW_S,
    **options,
) -> DataFrame:
    """Reports that enter the table: valid, cut, and within the hourly rate of
    their fingerprint. The rest is dropped without a trace."""
    return ratelimit.rate_limit(
        valid_reports(reports), ["fingerprint"], at, order, cap, window_seconds, **options
    )


def unalerted(errors: DataFrame, cap: int | None = None) -> DataFrame:
    """The reports nobody was told about; with ``cap`` the oldest of them."""
    waiting = errors.filter(F.col("alerted_at").isNull()).select(*DIGEST_COLUMNS)
    return waiting if cap is None else waiting.orderBy("occurred_at", "id").limit(cap)


def digest(batch: DataFrame) -> DataFrame:
    """One row per fingerprint: number of occurrences and the first one's details,
    with ``position`` in order of first occurrence."""
    first = F.min(F.struct("occurred_at", "id", *PLACEHOLDERS)).alias("_first")
    grouped = batch.groupBy("fingerprint").agg(F.count("*").alias("occurrences"), first)
    shown = [
        F.coalesce(text.empty_to_null(F.col(f"_first.{c}")), F.lit(empty)).alias(c)
        for c, empty in PLACEHOLDERS.items()
    ]
    return grouped.select(
        "fingerprint",
        "occurrences",
        F.col("_first.occurred_at").alias("first_seen"),
        F.col("_first.id").alias("first_id"),
        *shown,
    )


def in_digest_order(groups: DataFrame, shown: int | None = None) -> DataFrame:
    """All groups, or with ``shown`` the first ones, in order of first occurrence."""
    ordered = groups.orderBy("first_seen", "first_id")
    return ordered if shown is None else ordered.limit(shown)


def mark_alerted(
    errors: DataFrame, batch: DataFrame, delivered: DataFrame, as_of
) -> DataFrame:
    """Sets ``alerted_at`` on the batch's rows whose fingerprint was delivered.
    Rows outside the batch wait for the next digest; one already marked keeps its time.
    An id that the batch holds several times is marked once."""
    told = (
        batch.join(delivered.select("fingerprint").distinct(), "fingerprint", "left_semi")
        .select("id").distinct().withColumn("_told", F.lit(True))
    )
    return errors.join(told, "id", "left").select(
        *[
            F.when(F.col("_told") & F.col("alerted_at").isNull(), times.as_timestamp(as_of))
            .otherwise(F.col("alerted_at"))
            .alias("alerted_at")
            if c == "alerted_at"
            else F.col(c)
            for c in errors.columns
        ]
    )
