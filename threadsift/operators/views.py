"""Queue, archive and report views, run and error lists, drill-in filters.

Parameters left at ``None`` filter nothing, so no predicate for them reaches
the plan. Ties in time are broken by id, so limits give the same rows each time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import refdata
from ..functions import tags, times

POST_WINDOW_COLUMNS = [
    "id", "platform", "post_url", "post_title", "summary", "opportunity",
    "categories", "status", "posted_at", "discovered_at",
]


def _top(df: DataFrame, cap: int | None, *order: Column) -> DataFrame:
    return df if cap is None else df.orderBy(*order).limit(cap)


def ago(as_of, amount: int, unit: str) -> Column:
    return times.as_timestamp(as_of) - F.expr(f"INTERVAL {int(amount)} {unit}")


def row_count(posts: DataFrame) -> DataFrame:
    """Exact number of rows; the scan reads no column."""
    return posts.agg(F.count(F.lit(1)).alias("n"))


def posts_window(posts: DataFrame, as_of, hours: int) -> DataFrame:
    """Posts discovered in the last hours, newest first, without unused columns."""
    return (
        posts.filter(F.col("discovered_at") >= ago(as_of, hours, "HOURS"))
        .select(*POST_WINDOW_COLUMNS)
        .orderBy(F.desc("discovered_at"), "id")
    )


def active_queue(posts: DataFrame, cap: int | None = refdata.QUEUE_CAP) -> DataFrame:
    return _top(posts.filter(F.col("status") == "new"), cap, F.desc("discovered_at"), F.asc("id"))


def archive_view(
    posts: DataFrame, cutoff=None, cap: int | None = refdata.QUEUE_CAP
) -> DataFrame:
    """Handled posts by time of their last change; rows without one come last, and
    fall away only when a cutoff is given."""
    shown = posts.filter(F.col("status").isin(refdata.ARCHIVE_STATUSES))
    if cutoff is not None:
        shown = shown.filter(F.col("status_changed_at") >= times.as_timestamp(cutoff))
    return _top(shown, cap, F.desc_nulls_last("status_changed_at"), F.asc("id"))


def report_window(
    posts: DataFrame, cutoff=None, cap: int | None = refdata.REPORT_CAP
) -> DataFrame:
    """Posts of all statuses since the cutoff. The cap cuts counts made on the
    result; pass ``cap=None`` to report on everything."""
    shown = posts
    if cutoff is not None:
        shown = shown.filter(F.col("discovered_at") >= times.as_timestamp(cutoff))
    return _top(shown, cap, F.desc("discovered_at"), F.asc("id"))


def _list_cap(limit: int | None, ceiling: int | None = refdata.LIST_LIMIT_MAX) -> int:
    """Rows a list shows: what the caller asks for, up to the ceiling, if any."""
    wanted = refdata.LIST_LIMIT if limit is None else limit
    return wanted if ceiling is None else min(wanted, ceiling)


def runs_list(
    runs: DataFrame,
    as_of,
    *,
    product: str | None = None,
    status: str | None = None,
    limit: int | None = None,
    ceiling: int | None = refdata.LIST_LIMIT_MAX,
    since_days: int | None = None,
) -> DataFrame:
    days = refdata.RUNS_DAYS if since_days is None else since_days
    shown = runs.filter(F.col("started_at") > ago(as_of, days, "DAYS"))
    if product is not None:
        shown = shown.filter(F.col("product") == product)
    if status is not None:
        shown = shown.filter(F.col("status") == status)
    return _top(
        shown.select(
            "id", "product", "script", "mode", "started_at", "ended_at", "status",
            "steps", "stats", "error_id",
        ),
        _list_cap(limit, ceiling), F.desc("started_at"), F.asc("id"),
    )


def errors_list(
    errors: DataFrame,
    as_of,
    *,
    product: str | None = None,
    unresolved_only: bool = False,
    limit: int | None = None,
    ceiling: int | None = refdata.LIST_LIMIT_MAX,
    since_days: int | None = None,
) -> DataFrame:
    days = refdata.ERRORS_DAYS if since_days is None else since_days
    shown = errors.filter(F.col("occurred_at") > ago(as_of, days, "DAYS"))
    if product is not None:
        shown = shown.filter(F.col("product") == product)
    if unresolved_only:
        shown = shown.filter(~F.col("resolved"))
    return _top(
        shown.select(
            "id", "occurred_at", "product", "script", "mode", "message", "traceback",
            "resolved", "resolved_at", "run_id",
        ),
        _list_cap(limit, ceiling), F.desc("occurred_at"), F.asc("id"),
    )


def drill_filter(key: str) -> Column:
    """The predicate behind a figure of the report: ``total``, a status card,
    ``competitors``, ``platform:x``, ``status:x`` or ``category:x``. Any other key
    shows everything."""
    if key in ("completed", "replied", "archived", "deleted"):
        return F.col("status") == key
    if key == "competitors":
        return tags.has_competitor(F.col("competitors"))
    field, _, value = key.partition(":")
    if value or key.endswith(":"):
        if field in ("platform", "status"):
            return F.col(field) == value
        if field == "category":
            return F.array_contains(tags.or_empty(F.col("categories")), value)
    return F.lit(True)


def drill_in(posts: DataFrame, key: str) -> DataFrame:
    return posts.filter(drill_filter(key))


def drill_in_all(posts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of several drill-ins in one pass, each row once per key it answers."""
    answered = F.array_compact(
        F.array(*[F.when(drill_filter(key), F.lit(key)) for key in keys])
    )
    return posts.withColumn("drill_key", F.explode(answered))
