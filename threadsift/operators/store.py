"""Changes to the post store, each a transform from one state to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import refdata, schemas
from ..functions import tags, text, times
from .clean import vendor_too_old
from .dedup import not_stored

ARCHIVED_BY_AGE = "age"
ARCHIVED_STALE = "stale_vendor"


def stable_id(url: Column) -> Column:
    """An id in UUID form that a recomputed task gives again."""
    h = F.sha2(url, 256)
    return F.concat_ws(
        "-",
        *[F.substring(h, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))],
    )


def new_rows(batch: DataFrame, store: DataFrame, as_of) -> DataFrame:
    """Rows of the batch the store lacks, with the table's defaults. The batch
    holds each URL once (see ``merge_copies``)."""
    null = F.lit(None)
    fresh = times.with_instant(not_stored(batch, store), "posted_at", "_posted")
    return fresh.select(
        stable_id(F.col("post_url")).alias("id"),
        "platform",
        "post_url",
        "post_title",
        "author_handle",
        F.col("_posted").alias("posted_at"),
        "summary",
        text.empty_to_null(F.col("opportunity")).alias("opportunity"),
        tags.or_empty(F.col("categories")).alias("categories"),
        tags.or_empty(F.col("competitors")).alias("competitors"),
        F.lit("new").alias("status"),
        times.as_timestamp(as_of).alias("discovered_at"),
        null.cast("timestamp").alias("status_changed_at"),
        null.cast("string").alias("actioned_by"),
        null.cast("timestamp").alias("actioned_at"),
    )


def incoming_competitors(batch: DataFrame) -> DataFrame:
    """Distinct competitors per URL. Pairs are made distinct first, so a URL with
    very many copies never gathers them."""
    return (
        batch.select("post_url", F.explode("competitors").alias("name"))
        .distinct()
        .groupBy("post_url")
        .agg(F.collect_list("name").alias("_incoming"))
    )


def merge_competitors(store: DataFrame, batch: DataFrame) -> DataFrame:
    """The whole store with incoming competitors merged in and a ``changed`` flag.
    A row that gains nothing keeps its list as it is, even if unsorted."""
    joined = store.join(incoming_competitors(batch), "post_url", "left")
    stored = tags.or_empty(F.col("competitors"))
    fresh = tags.or_empty(F.array_except(F.col("_incoming"), stored))
    changed = F.size(fresh) > 0
    return joined.withColumn("changed", changed).select(
        *[
            F.when(F.col("changed"), F.array_sort(F.array_union(stored, fresh)))
            .otherwise(F.col("competitors"))
            .alias(c)
            if c == "competitors"
            else F.col(c)
            for c in store.columns
        ],
        "changed",
    )


def met_by(store: DataFrame, batch: DataFrame) -> DataFrame:
    """What a batch can meet in the store, from one narrow scan of it: URL, competitors
    and day of the rows with a URL of the batch. The store is the side that is filtered."""
    narrow = store.select("post_url", "competitors", "discovered_at")
    return narrow.join(batch.select("post_url"), "post_url", "left_semi")


def upsert(store: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    """The store after a batch: stored rows with merged competitors, then new rows."""
    merged = merge_competitors(store, batch).drop("changed")
    return merged.select(*schemas.POST_COLUMNS).unionByName(new_rows(batch, store, as_of))


def archive_sweep(
    store: DataFrame,
    as_of,
    days: int = refdata.ARCHIVE_DAYS,
    vendor_days: int = refdata.VENDOR_MAX_AGE_DAYS,
) -> DataFrame:
    """Both sweeps over rows still ``new``: by age in the queue, then by the age
    of a vendor-forum post. ``archived_for`` tells which one took the row."""
    now = times.as_timestamp(as_of)
    aged = F.col("discovered_at") < now - F.expr(f"INTERVAL {int(days)} DAYS")
    stale = vendor_too_old(F.col("platform"), F.col("posted_at"), as_of, vendor_days)
    is_new = F.col("status") == "new"
    swept = store.withColumn(
        "archived_for",
        F.when(is_new & aged, ARCHIVED_BY_AGE).when(is_new & stale, ARCHIVED_STALE),
    )
    taken = F.col("archived_for").isNotNull()
    return swept.withColumns(
        {
            "status": F.when(taken, "archived").otherwise(F.col("status")),
            "status_changed_at": F.when(taken, now).otherwise(F.col("status_changed_at")),
        }
    )


def sweep_counts(swept: DataFrame) -> DataFrame:
    return swept.agg(
        F.count_if(F.col("archived_for") == ARCHIVED_BY_AGE).alias("by_age"),
        F.count_if(F.col("archived_for") == ARCHIVED_STALE).alias("by_post_date"),
        F.count("archived_for").alias("archived"),
    )


def valid_actions(actions: DataFrame) -> DataFrame:
    return actions.filter(F.col("status").isin(refdata.STATUSES))


def invalid_actions(actions: DataFrame) -> DataFrame:
    return actions.filter(~F.coalesce(F.col("status").isin(refdata.STATUSES), F.lit(False)))


def apply_actions(store: DataFrame, actions: DataFrame) -> DataFrame:
    """Status changes by id. The last valid action of an id wins; unknown ids do
    nothing; any status may follow any other."""
    last = (
        valid_actions(actions)
        .groupBy("id")
        .agg(F.max_by(F.struct("status", "user", "at"), F.struct("at", "seq")).alias("_a"))
    )
    acted = F.col("_a").isNotNull()
    change = {
        "status": "_a.status",
        "status_changed_at": "_a.at",
        "actioned_by": "_a.user",
        "actioned_at": "_a.at",
    }
    joined = store.join(last, "id", "left")
    return joined.select(
        *[
            F.when(acted, F.col(change[c])).otherwise(F.col(c)).alias(c)
            if c in change
            else F.col(c)
            for c in store.columns
        ]
    )


def duplicate_urls(store: DataFrame) -> DataFrame:
    """Violations of the one-row-per-URL rule; empty for a sound store."""
    return store.groupBy("post_url").agg(F.count("*").alias("n")).filter("n > 1")

