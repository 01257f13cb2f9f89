"""Counts, shares, timelines and summaries over posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import refdata
from ..functions import tags, text, times
from ..session import written
from . import views

TIMELINE_STATUSES = ["replied", "deleted", "archived", "completed"]


def count_by(df: DataFrame, key: Column, name: str) -> DataFrame:
    """Count per key. ``newest`` is the latest discovery within the key: rows are
    shown newest first, so it orders keys of equal count."""
    return df.groupBy(key.alias(name)).agg(
        F.count("*").alias("n"), F.max("discovered_at").alias("newest")
    )


def ranked(counts: DataFrame, name: str) -> DataFrame:
    """Adds ``rank``: by count, then by ``newest``, then by name. The counts are
    one row per key."""
    w = Window.orderBy(F.desc("n"), F.desc("newest"), F.asc(name))
    return counts.withColumn("rank", F.row_number().over(w))


def with_share(counts: DataFrame, labels: dict[str, str], name: str) -> DataFrame:
    """Adds the label and the share of the total in whole percent, half up."""
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumns(
        {
            "label": text.label(F.col(name), labels),
            "share": F.floor(100 * F.col("n") / total + 0.5).cast("long"),
        }
    )


def platform_counts(posts: DataFrame, labels=refdata.PLATFORM_LABELS) -> DataFrame:
    counts = count_by(posts, F.col("platform"), "platform")
    return ranked(with_share(counts, labels, "platform"), "platform")


def status_counts(posts: DataFrame, labels=refdata.STATUS_LABELS) -> DataFrame:
    counts = count_by(posts, F.col("status"), "status")
    return ranked(with_share(counts, labels, "status"), "status")


ROLLUP_KEYS = ["of_post", "day", "platform", "status", "competitor", "category"]


def roll_up(posts: DataFrame) -> DataFrame:
    """Partial counts of posts in one pass, of which every report of counts is made: by
    day, platform, status and whether a competitor is named, once for the posts
    (``of_post``) and once more by category, for each time that a post names it. Few rows
    whatever the posts: ``n``, ``newest``, and ``seen``, where newest-first rows show the
    group first. Roll-ups of disjoint posts merge."""
    named = F.transform(
        F.coalesce("categories", F.array().cast("array<string>")),
        lambda c, i: F.struct(F.lit(False).alias("of_post"), i.alias("pos"), c.alias("category")),
    )
    itself = F.struct(F.lit(True).alias("of_post"), F.lit(0).alias("pos"), F.lit(None).cast("string").alias("category"))
    facts = posts.select(
        times.day_of(F.col("discovered_at")).alias("day"), "platform", "status",
        tags.has_competitor(F.col("competitors")).alias("competitor"), "discovered_at", "id",
        F.explode(F.concat(F.array(itself), named)).alias("fact"),
    ).select("*", "fact.*")
    return facts.groupBy(*ROLLUP_KEYS).agg(
        F.count("*").alias("n"), F.max("discovered_at").alias("newest"),
        F.min(F.struct((-F.unix_micros("discovered_at")).alias("age"), "id", "pos")).alias("seen"),
    )


def merge_rollups(*rollups: DataFrame) -> DataFrame:
    """The roll-up of the posts of several ones."""
    every = rollups[0]
    for other in rollups[1:]:
        every = every.unionByName(other)
    return every.groupBy(*ROLLUP_KEYS).agg(
        F.sum("n").alias("n"), F.max("newest").alias("newest"), F.min("seen").alias("seen")
    )


def rolled_counts(rollup: DataFrame, key: Column, name: str) -> DataFrame:
    """``count_by`` from a roll-up."""
    return rollup.filter("of_post").groupBy(key.alias(name)).agg(
        F.sum("n").alias("n"), F.max("newest").alias("newest")
    )


def rolled_topics(rollup: DataFrame) -> DataFrame:
    """``topic_counts`` from a roll-up."""
    return rollup.filter("NOT of_post").groupBy("category").agg(F.sum("n").alias("n"), F.min("seen").alias("seen"))


def rolled_days(rollup: DataFrame) -> DataFrame:
    """``posts_per_day`` from a roll-up."""
    return rollup.filter("of_post AND day IS NOT NULL").groupBy("day").agg(F.sum("n").alias("n"))


def topic_counts(posts: DataFrame) -> DataFrame:
    """Count per category; a category a post names twice counts twice. ``seen`` is
    where newest-first rows, those of one instant by id, show it first."""
    each = posts.select(
        (-F.unix_micros("discovered_at")).alias("age"), "id",
        F.posexplode("categories").alias("pos", "category"),
    )
    return each.groupBy("category").agg(
        F.count("*").alias("n"), F.min(F.struct("age", "id", "pos")).alias("seen")
    )


def top_topics(posts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent categories. Equal counts keep the order in which
    the newest-first rows show them."""
    return first_topics(topic_counts(posts), k)


def first_topics(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` topics with the highest counts; the counts are one row per topic."""
    w = Window.orderBy(F.desc("n"), F.asc("seen"), F.asc("category"))
    return (
        counts.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("rank", "category", "n")
    )


def stat_cards(posts: DataFrame) -> DataFrame:
    """The report's six figures in one pass."""
    status = F.col("status")
    return posts.agg(
        F.count("*").alias("total"),
        *[F.count_if(status == s).alias(s) for s in ("completed", "replied", "archived", "deleted")],
        F.count_if(tags.has_competitor(F.col("competitors"))).alias("competitors"),
    )


def action_timeline(posts: DataFrame) -> DataFrame:
    """Handled posts per day of their last change. A day with other statuses only
    still gives a row of zeros."""
    handled = posts.filter(
        (F.col("status") != "new") & F.col("status_changed_at").isNotNull()
    )
    return handled.groupBy(times.day_of(F.col("status_changed_at")).alias("day")).agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in TIMELINE_STATUSES]
    )


def posts_per_day(posts: DataFrame) -> DataFrame:
    return (
        posts.filter(F.col("discovered_at").isNotNull())
        .groupBy(times.day_of(F.col("discovered_at")).alias("day"))
        .agg(F.count("*").alias("n"))
    )


def platform_breakdown(posts: DataFrame) -> DataFrame:
    """One line such as ``3 reddit, 1 x``; ``none`` without posts. Platforms of
    equal count keep the order of their first ``seq``."""
    counts = posts.groupBy("platform").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    line = F.array_join(
        F.transform(
            F.array_sort(
                F.collect_list(
                    F.struct((-F.col("n")).alias("less"), "first", "platform")
                )
            ),
            lambda s: F.concat_ws(" ", (-s["less"]).cast("string"), s["platform"]),
        ),
        ", ",
    )
    return counts.agg(F.coalesce(text.empty_to_null(line), F.lit("none")).alias("by_platform"))


def daily_summary(
    posts: DataFrame,
    as_of,
    hours: int = 24,
    labels: dict[str, str] = refdata.SUMMARY_LABELS,
    topics: int = 5,
    picks: int = 5,
) -> DataFrame:
    """The day in rows (section, rank, key, value): total, count per platform, top
    topics, newest posts. No rows at all when the window holds no post. The posts are
    scanned once: the window, a day's narrow rows, is written and rolled up."""
    shown = ["id", "discovered_at", "platform", "status", "categories", "competitors", "post_title", "post_url"]
    recent = posts.filter(F.col("discovered_at") >= views.ago(as_of, hours, "HOURS")).select(*shown)
    window = written(recent, "window")
    rollup = written(roll_up(window), "rollup")
    shape = ["section", "rank", "key", "value"]

    total = (
        rollup.filter("of_post").agg(F.sum("n").alias("n"))
        .filter("n > 0")
        .select(
            F.lit("total").alias("section"), F.lit(1).alias("rank"),
            F.lit("posts").alias("key"), F.col("n").cast("string").alias("value"),
        )
    )
    platform = F.coalesce(text.empty_to_null(F.col("platform")), F.lit("other"))
    by_platform = ranked(rolled_counts(rollup, platform, "p"), "p").select(
        F.lit("platform").alias("section"), "rank",
        text.label(F.col("p"), labels).alias("key"), F.col("n").cast("string").alias("value"),
    )
    top = first_topics(rolled_topics(rollup), topics).select(
        F.lit("topic").alias("section"), "rank",
        F.col("category").alias("key"), F.col("n").cast("string").alias("value"),
    )
    newest = window.orderBy(F.desc("discovered_at"), "id").limit(picks)
    w = Window.orderBy(F.desc("discovered_at"), "id")
    pick = newest.select(
        F.lit("pick").alias("section"),
        F.row_number().over(w).alias("rank"),
        F.coalesce(text.empty_to_null(text.strip(F.col("post_title"))), F.lit("(untitled)")).alias("key"),
        F.concat_ws(" ", text.label(platform, labels), F.col("post_url")).alias("value"),
    )
    parts = [total, by_platform, top, pick]
    out = parts[0].select(*shape)
    for part in parts[1:]:
        out = out.unionByName(part.select(*shape))
    return out
