"""The scheduled jobs over the kept tables: discover, archive, actions, digest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F

from .. import refdata, schemas
from ..operators import clean, dedup, errors, harvest, health, records, reports, store
from ..session import written
from ..sources.daytable import DayTable


def post_table(spark, root: str) -> DayTable:
    return DayTable(spark, root, schemas.POSTS, "discovered_at")


def error_table(spark, root: str) -> DayTable:
    return DayTable(spark, root, schemas.CLIENT_ERRORS, "occurred_at")


def combine(*pools: DataFrame) -> DataFrame:
    """Pools of candidates in order of precedence. Each pool is ordered by its own
    ``seq``; the pool's place goes before it, as text that sorts alike."""
    numbered = [
        pool.withColumn("seq", F.concat(F.lit(f"{i:03d}:"), F.lpad(F.col("seq").cast("string"), 75, "0")))
        for i, pool in enumerate(pools)
    ]
    return harvest.in_source_order(*numbered)


FAULTS = "source string, item string, message string"


def gather(spark, sources: dict[str, Callable[[], DataFrame]]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The pools of all sources that can be read, each written once, and a row (source,
    item, message) for each that failed: it drops only itself."""
    pools, failed = {}, []
    for name, read in sources.items():
        try:
            pools[name] = written(read(), name)
        except Exception as failure:  # whatever a source fails with ends that source only
            failed.append((name, None, f"{type(failure).__name__}: {str(failure).splitlines()[0] if str(failure) else ''}"))
    return pools, spark.createDataFrame(failed, FAULTS)


def native_pools(
    stories: DataFrame,
    questions: DataFrame,
    micro: DataFrame,
    predict: Callable,
    as_of,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Candidates of the three searched sources, in source order, classified by
    ``predict`` with their snippets at hand; and what failed (source, item, message):
    whole sources, and posts for which ``predict`` fails. The others go on."""
    spark = stories.sparkSession
    harvests = {
        "stories": lambda: harvest.harvest_stories(stories, as_of, **options),
        "questions": lambda: harvest.harvest_questions(questions, as_of, **options),
        "micro": lambda: harvest.harvest_micro_posts(micro, as_of, **options),
    }
    pools, failed = gather(spark, harvests)
    numbered = [harvest.sequence(pools[n], i) for i, n in enumerate(harvests) if n in pools]
    if not numbered:
        return spark.createDataFrame([], schemas.CANDIDATE), failed
    found = written(harvest.in_source_order(*numbered), "pool")
    answered = written(records.classify_or_fault(
        found.select("seq", *schemas.POST_FIELDS), found.select("seq", "post_url", "body"), predict
    ), "classified")
    refused = answered.filter(F.col("fault").isNotNull()).select(
        F.lit("classify").alias("source"), F.col("post_url").alias("item"), F.col("fault").alias("message")
    )
    return answered.filter(F.col("fault").isNull()).drop("fault"), failed.unionByName(refused)


def native_pool(stories: DataFrame, questions: DataFrame, micro: DataFrame, predict: Callable, as_of, **options) -> DataFrame:
    """The candidates of ``native_pools`` alone."""
    return native_pools(stories, questions, micro, predict, as_of, **options)[0]


def model_pool(responses: DataFrame) -> DataFrame:
    """Valid records of landed model responses (response_id, payload), ordered by
    response and place. ``seq`` is text of a fixed width that sorts so; names of
    responses have 64 characters at most."""
    parsed = records.parse_batches(responses, "payload", "response_id")
    valid = records.valid_records(records.batch_records(parsed, "response_id"))
    place = F.lpad(F.col("pos").cast("string"), 10, "0")
    order = F.concat(F.lpad(F.col("response_id").cast("string"), 64, "0"), F.lit(":"), place)
    return valid.select(order.alias("seq"), *schemas.POST_FIELDS)


def priority(pool: DataFrame) -> DataFrame:
    """A pool whose posts all bear the priority platform, whatever they say."""
    return pool.withColumn("platform", F.lit(refdata.PRIORITY_PLATFORM))


def discover(posts: DayTable, raw: DataFrame, as_of) -> dict[str, int]:
    """Cleans a batch, merges its copies and brings the store up to date. Running
    it twice on the same batch changes nothing the second time.

    The merged batch is written to the shared folder once and read from there,
    so it is neither cached nor computed again. The store is probed once: what the
    batch meets there decides which rows are new and which gain competitors. Only
    days that change are rewritten. Returns the counts of each stage.
    """
    seen, good = Observation(), Observation()
    judged = clean.judge(raw, as_of).observe(
        seen,
        F.count(F.lit(1)).alias("pool"),
        F.count("reject_reason").alias("dropped"),
    )
    merged = dedup.merge_copies(clean.kept(judged)).observe(good, F.count(F.lit(1)).alias("n"))
    batch = written(merged, "batch")

    # one narrow scan of the store: of its rows with a URL of the batch, a batch at most
    met = written(store.met_by(posts.read(), batch), "met")
    touched = store.merge_competitors(met, batch).filter("changed")
    new = store.new_rows(batch, met, as_of)

    changed = Observation()
    days = set(posts.days_of(touched))
    fresh_days = set(posts.days_of(new.limit(1)))  # all new rows are of one day
    counts = {**seen.get, "distinct": good.get["n"], "inserted": 0, "merged": 0}
    if not (days or fresh_days):
        return counts
    old = store.merge_competitors(posts.read(days | fresh_days), batch).withColumn(
        "_new", F.lit(False)
    )
    after = old.unionByName(
        new.withColumns({"changed": F.lit(False), "_new": F.lit(True)})
    ).observe(
        changed,
        F.count_if("_new").alias("inserted"),
        F.count_if("changed").alias("merged"),
    )
    posts.write(after)
    return {**counts, **changed.get}


def _rewrite(
    table: DayTable, change: Callable[[DataFrame], DataFrame], affected: DataFrame
) -> int:
    """Rewrites the days of the affected rows; returns how many rows are."""
    n = Observation()
    days = table.days_of(affected.observe(n, F.count(F.lit(1)).alias("n")))
    if not days:
        return 0
    table.write(change(table.read(days)))
    return n.get["n"]


def archive(posts: DayTable, as_of) -> int:
    """Both archive sweeps; only days with a swept row are read and written."""
    narrow = posts.read().filter(F.col("status") == "new").select(
        "platform", "status", "posted_at", "discovered_at", "status_changed_at"
    )
    swept = store.archive_sweep(narrow, as_of).filter(F.col("archived_for").isNotNull())
    return _rewrite(posts, lambda df: store.archive_sweep(df, as_of).drop("archived_for"), swept)


def act(posts: DayTable, actions: DataFrame) -> int:
    """Applies status actions; returns how many posts they hit."""
    hit = posts.read().select("id", "discovered_at").join(
        store.valid_actions(actions).select("id").distinct(), "id", "left_semi"
    )
    return _rewrite(posts, lambda df: store.apply_actions(df, actions), hit)


def digest(
    table: DayTable, deliver: Callable[[DataFrame], DataFrame], as_of, shown: int | None = None
) -> int:
    """Groups all unalerted errors, hands the groups (with ``shown`` the first ones)
    to ``deliver`` and marks those it returns. Errors of other groups wait for the
    next run."""
    batch = written(errors.unalerted(table.read()), "digest")
    groups = errors.in_digest_order(errors.digest(batch), shown)
    # Written at once, so that delivering happens once.
    delivered = written(deliver(groups).select("fingerprint"), "delivered")
    return mark(table, batch, delivered, as_of)


def mark(table: DayTable, batch: DataFrame, delivered: DataFrame, as_of) -> int:
    """Marks the rows of a digest's batch (id, fingerprint, occurred_at) whose group was
    delivered; returns how many they are."""
    told = batch.join(delivered.select("fingerprint").distinct(), "fingerprint", "left_semi")
    return _rewrite(
        table, lambda df: errors.mark_alerted(df, batch, delivered, as_of), told
    )


def _day_before(as_of: str | dt.datetime, **span: int) -> str:
    """The day, in UTC, that lies the given span before ``as_of``."""
    at = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(as_of)
    return (at - dt.timedelta(**span)).date().isoformat()


def daily_summary(posts: DayTable, as_of, hours: int = 24, **options) -> DataFrame:
    """The day's summary; only the days that the window touches are opened."""
    return reports.daily_summary(posts.since(_day_before(as_of, hours=hours)), as_of, hours, **options)


def health_check(
    posts: DayTable, client_errors: DayTable, log_lines: DataFrame, as_of, **options
) -> DataFrame:
    """The week's findings; only the week's days of both tables are opened."""
    first = _day_before(as_of, days=7)
    return health.health_findings(
        posts.since(first), client_errors.since(first), log_lines, as_of, **options
    )
