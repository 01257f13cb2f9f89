"""Canonical posts out of raw candidates, with a reason for every rejected one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import refdata, schemas
from ..functions import tags, text, times, urls
from ..functions.sqltext import quote, stripped
from ..functions.stage import once


def vendor_too_old(platform: Column, posted: Column, as_of, days: int) -> Column:
    """Posts of the vendor forums age by their own date; no date is never late."""
    cutoff = times.as_timestamp(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    return F.coalesce(
        (platform == refdata.VENDOR_PLATFORM) & (posted < cutoff), F.lit(False)
    )


def judge(
    raw: DataFrame,
    as_of,
    *,
    vendor_days: int = refdata.VENDOR_MAX_AGE_DAYS,
    categories: list[str] = refdata.CATEGORIES,
    competitors: list[str] = refdata.COMPETITORS,
    tracking: list[str] = refdata.TRACKING_PARAMS,
) -> DataFrame:
    """Every candidate in canonical form plus ``reject_reason`` (NULL = keep).

    One narrow pass without a shuffle. The first broken rule names the reason.
    """
    staged = raw.selectExpr(
        "*",
        *urls.normal_url_steps("post_url", "_url", tracking),
        *times.instant_steps("posted_at", "_instant"),
        f"{stripped("coalesce(post_title, '')")} AS _title",
    )
    given = [c for c in raw.columns if c not in schemas.POST_FIELDS]
    canonical = staged.select(
        *given,
        tags.canonical_platform("platform").alias("platform"),
        F.col("_url").alias("post_url"),
        F.col("_title").alias("post_title"),
        text.blank_to_null(F.col("author_handle")).alias("author_handle"),
        F.expr(f"CASE WHEN _instant IS NOT NULL THEN {stripped('posted_at')} END").alias("posted_at"),
        F.expr(stripped("coalesce(summary, '')")).alias("summary"),
        F.expr(stripped("coalesce(opportunity, '')")).alias("opportunity"),
        tags.known_categories("categories", categories).alias("categories"),
        tags.canonical_competitors("competitors", competitors).alias("competitors"),
        "_instant",
    )
    late = vendor_too_old(F.col("platform"), F.col("_instant"), as_of, vendor_days)
    reason = (
        F.when(
            F.expr("NOT coalesce(post_url LIKE 'https://%' OR post_url LIKE 'http://%', false)"),
            "bad_url",
        )
        .when(
            F.expr(
                "size(categories) = 0 AND size(competitors) = 0 "
                f"AND platform <> {quote(refdata.PRIORITY_PLATFORM)}"
            ),
            "untagged",
        )
        .when(F.col("post_title") == "", "no_title")
        .when(~text.is_latin(F.col("post_title")), "not_latin")
        .when(F.col("summary") == "", "no_summary")
        .when(late, "stale_vendor")
    )
    out = [*given, *schemas.POST_FIELDS]
    cut = {"post_title": F.left("post_title", F.lit(refdata.TITLE_CHARS))}
    return once(
        canonical.withColumn("reject_reason", reason).drop("_instant"),
        {**{c: cut.get(c, F.col(c)) for c in out}, "reject_reason": F.col("reject_reason")},
    )


def kept(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reject_reason").isNotNull())


def clean(raw: DataFrame, as_of, **rules) -> DataFrame:
    return kept(judge(raw, as_of, **rules))
