"""Weekly health findings and their verdict."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from .. import refdata
from ..functions import text, times
from ..session import written
from . import reports, views

ATTENTION = "NEEDS_ATTENTION"


def zero_volume_days(per_day: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Of the days before ``as_of``, those without a post. Sundays are free."""
    today = F.to_date(times.as_timestamp(as_of))
    spine = (
        per_day.sparkSession.range(1)
        .select(F.explode(F.sequence(F.date_sub(today, days), F.date_sub(today, 1))).alias("day"))
        .filter(F.weekday("day") != 6)
    )
    return spine.join(per_day.filter("n > 0"), "day", "left_anti")


def zero_volume_days_by(per_day: DataFrame, key: str, as_of, days: int = 7) -> DataFrame:
    """The same for each value of ``key`` that ever had a post, from (key, day, n): each
    one's days are made from its own row and meet its counts by an equi-join."""
    today = F.to_date(times.as_timestamp(as_of))
    spine = per_day.select(key).distinct().select(
        key, F.explode(F.sequence(F.date_sub(today, days), F.date_sub(today, 1))).alias("day")
    ).filter(F.weekday("day") != 6)
    return spine.join(per_day.filter("n > 0").select(F.col(key).alias("_key"), F.col("day").alias("_day")),
                      F.col(key).eqNullSafe(F.col("_key")) & (F.col("day") == F.col("_day")), "left_anti")


def runaway_days(per_day: DataFrame, limit: int = refdata.RUNAWAY_PER_DAY) -> DataFrame:
    return per_day.filter(F.col("n") > limit)


def silent_platforms(
    posts: DataFrame, expected: list[str] = refdata.EXPECTED_PLATFORMS
) -> DataFrame:
    names = F.explode(F.array(*map(F.lit, expected))).alias("platform")
    return (
        posts.sparkSession.range(1)
        .select(names)
        .join(posts.select("platform").distinct(), "platform", "left_anti")
    )


def row_count(df: DataFrame, cap: int | None = None) -> DataFrame:
    """Number of rows; with ``cap`` at most that."""
    n = F.count("*")
    return df.agg((n if cap is None else F.least(n, F.lit(cap))).alias("n"))


def scan_log(
    lines: DataFrame, as_of, column: str = "value", days: int = 7, slack_days: int = 1
) -> DataFrame:
    """Lines with ERROR or BROKEN whose first date is recent. Lines without a date,
    or with an impossible one, stay."""
    line = F.col(column)
    dated = F.regexp_extract(line, r"(\d{4}-\d{2}-\d{2})", 1)
    day = text.empty_to_null(dated).try_cast("date").cast("timestamp")
    oldest = views.ago(as_of, days + slack_days, "DAYS")
    return lines.filter(line.contains("ERROR") | line.contains("BROKEN")).filter(
        day.isNull() | (day >= oldest)
    )


def latest_lines(hits: DataFrame, column: str = "value", k: int = 15) -> DataFrame:
    """The last lines by date and text, for tables without another order."""
    dated = F.regexp_extract(F.col(column), r"(\d{4}-\d{2}-\d{2})", 1)
    return hits.orderBy(F.desc(dated), F.desc(column)).limit(k)


def tail_lines(hits: DataFrame, place: str = "place", k: int = 15) -> DataFrame:
    """The last lines in the order of the files, from lines with their ``place``
    (see ``landed.placed_lines``); every task keeps k lines only."""
    return hits.orderBy(F.desc(place)).limit(k)


def _finding(df: DataFrame, check: str, detail: Column) -> DataFrame:
    """At most one finding: a row only where ``detail`` is not NULL."""
    return df.agg(detail.alias("detail")).filter(F.col("detail").isNotNull()).select(
        F.lit(check).alias("check"), F.lit(ATTENTION).alias("severity"), "detail"
    )


def _listed(value: Column) -> Column:
    return text.empty_to_null(F.array_join(F.array_sort(F.collect_list(value)), ", "))


def health_findings(
    posts: DataFrame,
    errors: DataFrame,
    log_lines: DataFrame,
    as_of: str | dt.datetime,
    *,
    runaway_per_day: int = refdata.RUNAWAY_PER_DAY,
    errors_limit: int = refdata.ERRORS_PER_WEEK,
    expected: list[str] = refdata.EXPECTED_PLATFORMS,
) -> DataFrame:
    """One row per failed check (check, severity, detail). Each source is scanned once; the
    checks of posts read one roll-up."""
    start = views.ago(as_of, 7, "DAYS")
    week = posts.filter(F.col("discovered_at") >= start).select(
        "id", "discovered_at", "platform", "status", "categories", "competitors"
    )
    rollup = written(reports.roll_up(week), "rollup")
    per_day = reports.rolled_days(rollup)
    own = rollup.filter("of_post")
    mentions = F.coalesce(F.sum(F.when(F.col("competitor"), F.col("n"))), F.lit(0))
    count = F.count("*")
    found = [
        _finding(zero_volume_days(per_day, as_of), "zero_volume_days", _listed(F.col("day").cast("string"))),
        _finding(
            runaway_days(per_day, runaway_per_day), "runaway_days",
            _listed(F.concat_ws(":", F.col("day").cast("string"), F.col("n").cast("string"))),
        ),
        _finding(silent_platforms(own, expected), "silent_platforms", _listed(F.col("platform"))),
        _finding(own, "competitor_mentions", F.when(mentions == 0, F.lit("none in 7 days"))),
        _finding(
            errors.filter(F.col("occurred_at") >= start), "error_volume",
            F.when(count > errors_limit, count.cast("string")),
        ),
        _finding(
            scan_log(log_lines, as_of), "log_lines",
            F.when(F.count("*") > 0, F.count("*").cast("string")),
        ),
    ]
    out = found[0]
    for one in found[1:]:
        out = out.unionByName(one)
    return out


def verdict(findings: DataFrame) -> DataFrame:
    """The worst severity found, HEALTHY without findings."""
    order = F.array(*map(F.lit, refdata.SEVERITIES))
    worst = F.coalesce(F.max(F.array_position(order, F.col("severity"))), F.lit(1))
    return findings.agg(
        F.element_at(order, worst.cast("int")).alias("verdict"),
        F.count("*").alias("findings"),
    )
