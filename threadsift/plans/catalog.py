"""The registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import refdata, schemas
from ..functions import tags, text, times, urls
from ..operators import (
    clean, dedup, errors, harvest, health, ratelimit, records, reports, runs, store, views,
)
from ..functions.stage import once
from ..session import work_dir, written
from ..sources import landed
from ..streaming import folding, ingest, intake
from . import fixtures as fx, jobs

AS_OF = fx.AS_OF
MONTH_AGO = "2024-01-01 00:00:00"
WEEK_AGO = "2024-01-24 00:00:00"
ALL_HOURS = 1_000_000
MONTH_HOURS = 24 * 31

STORY_WORDS = [*refdata.KEYWORDS, "tion", "und ", "Entre", "les ", "the "]
QUESTION_TAGS = ["click", "error", "k1", "k42", "purchase"]
QUESTION_PHRASES = ["does click", "SIGNUP work", "question 1", "view", "PDF"]
MICRO_WORDS = ["click", "Purchase", '"k": 7', "error with", "OCR"]
COMMON_WORDS = [
    "the", "of", "and", "is", "in", "on", "with", "der", "die", "das", "und", "zu", "ist", "de", "la", "les", "par",
    "sur", "el", "los", "que", "a", "y", "é",
]
SYLLABLES = ["tion", "ement", "keit", "sch", "ción", "er", "an", "re", "th", "ou", "ai", "ent", "in", "on", "o", "ß"]
MANY_PHRASES = [
    *(f"{a} {b}" for a in COMMON_WORDS for b in COMMON_WORDS), *(a + b for a in SYLLABLES for b in SYLLABLES),
    *(f"{a}. {b}" for a in SYLLABLES for b in COMMON_WORDS), *(f" {a}{b} " for a in SYLLABLES for b in SYLLABLES),
]
CLASS_RULES = {"OCR": ["story 1", "the "], "IDP": ["und "], "NLP": ["tion"]}
DRILL_KEYS = [
    "total", "completed", "replied", "archived", "deleted", "competitors",
    "platform:x", "platform:ade", "status:new", "category:OCR", "category:ADE",
]

# Days, and flags that may be NULL, are compared as text.
TEXTED = ["day", "resolved"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def plain(df: DataFrame) -> DataFrame:
    """Values that compare across engines: instants without a zone, lists joined,
    whole numbers as bigint."""
    columns = []
    for field in df.schema:
        c = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, (T.DateType, T.BooleanType)) and field.name in TEXTED:
            c = c.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        elif isinstance(field.dataType, T.IntegerType):
            c = c.cast("bigint")
        columns.append(c.alias(field.name))
    return df.select(*columns)


# Scalar rules ---------------------------------------------------------------


@query
def strip_html_snippet(spark, sf):
    pages = fx.table(spark, sf, "pages")
    given = F.when(F.col("page_id") % 4 == 0, "").otherwise(
        F.concat(F.lit("  Page "), F.col("page_id").cast("string"), F.lit(" "))
    )
    return pages.select(
        "page_id",
        text.html_snippet(F.col("html")).alias("snippet"),
        text.title(text.first_nonempty(given, F.col("url"))).alias("title"),
    )


@query
def url_canonical(spark, sf):
    pages = urls.with_normal_url(fx.table(spark, sf, "pages").select("page_id", "url"), "url")
    return pages.withColumn("is_web", urls.is_web_url(F.col("url")))


@query
def url_dedup(spark, sf):
    return dedup.first_seen(url_canonical(spark, sf), "url", "page_id").select("url", "page_id")


@query
def platform_canonical(spark, sf):
    return fx.posts_raw(spark, sf).select(
        "seq", tags.canonical_platform("platform").alias("platform")
    )


@query
def language_guard(spark, sf):
    """Every third document with some letters turned Cyrillic."""
    shown = F.when(
        F.col("doc_id") % 3 == 0, F.translate("text", "aeos", "аеоѕ")
    ).otherwise(F.translate("text", "z", "ж"))
    given = fx.table(spark, sf, "documents").select("doc_id", "text")
    shown_once = once(given.select("doc_id", shown.alias("shown")), {"shown": F.col("shown")})
    return shown_once.select("doc_id", text.is_latin(F.col("shown")).alias("is_latin"))


@query
def posted_at_valid(spark, sf):
    dated = times.with_instant(
        fx.posts_raw(spark, sf).select("seq", "posted_at"), "posted_at", "instant"
    )
    valid = F.when(F.col("instant").isNotNull(), text.strip(F.col("posted_at")))
    return plain(dated.withColumn("posted_at", valid))


@query
def epoch_times(spark, sf):
    """Epoch seconds kept as text, some of them no number."""
    given = F.when(F.col("event_id") % 5 == 0, "soon").otherwise(
        F.unix_seconds("ts").cast("string")
    )
    return plain(
        fx.events(spark, sf).select("event_id", times.epoch_to_timestamp(given).alias("at"))
    )


@query
def taxonomy_and_competitors(spark, sf):
    return plain(
        fx.posts_raw(spark, sf).select(
            "seq",
            tags.known_categories("categories").alias("categories"),
            tags.canonical_competitors("competitors").alias("competitors"),
        )
    )


# Cleaning, copies and the store ------------------------------------------------


@query
def clean_posts(spark, sf):
    return plain(clean.clean(fx.posts_raw(spark, sf), AS_OF))


@query
def clean_rejects(spark, sf):
    judged = clean.judge(fx.posts_raw(spark, sf), AS_OF)
    return clean.rejected(judged).select("seq", "reject_reason")


@query
def dedup_merge(spark, sf):
    return plain(fx.batch(spark, sf))


def _store_and_batch(spark, sf):
    """A store and the batch that meets it. The batch is written first, as the
    discovery job does, because several steps use it."""
    batch = written(fx.batch(spark, sf), "batch")
    return fx.stored_before(spark, sf, batch), batch


@query
def new_vs_existing(spark, sf):
    stored, batch = _store_and_batch(spark, sf)
    old = dedup.already_stored(batch, stored).select("post_url", F.lit("stored").alias("found"))
    new = dedup.not_stored(batch, stored).select("post_url", F.lit("new").alias("found"))
    return old.unionByName(new)


@query
def competitor_merge(spark, sf):
    merged = store.merge_competitors(*_store_and_batch(spark, sf))
    return plain(merged.select("post_url", "competitors", "changed"))


@query
def upsert_snapshot(spark, sf):
    after = store.upsert(*_store_and_batch(spark, sf), AS_OF)
    return plain(after.drop("id", "actioned_at", "actioned_by", "status_changed_at"))


@query
def upsert_ids(spark, sf):
    """Ids of inserted rows depend on their URL only, and no URL is stored twice."""
    after = store.upsert(*_store_and_batch(spark, sf), AS_OF)
    return after.groupBy("post_url").agg(
        F.count("*").alias("n"), F.max("id").alias("id")
    )


@query
def archive_sweep(spark, sf):
    swept = store.archive_sweep(fx.posts(spark, sf), AS_OF)
    return plain(swept.select("id", "status", "status_changed_at", "archived_for"))


@query
def archive_counts(spark, sf):
    return store.sweep_counts(store.archive_sweep(fx.posts(spark, sf), AS_OF))


@query
def apply_status_actions(spark, sf):
    done = store.apply_actions(fx.posts(spark, sf), fx.status_actions(spark, sf))
    return plain(done.select("id", "status", "status_changed_at", "actioned_by", "actioned_at"))


@query
def refused_actions(spark, sf):
    return store.invalid_actions(fx.status_actions(spark, sf)).select("seq", "id", "status")


# Views and reports ---------------------------------------------------------------


@query
def row_count(spark, sf):
    return views.row_count(fx.posts(spark, sf))


@query
def active_queue(spark, sf):
    return plain(views.active_queue(fx.posts(spark, sf)).select("id", "platform", "post_url", "discovered_at"))


@query
def archive_view(spark, sf):
    return plain(views.archive_view(fx.posts(spark, sf)).select("id", "status", "status_changed_at"))


@query
def archive_view_since(spark, sf):
    shown = views.archive_view(fx.posts(spark, sf), cutoff=WEEK_AGO)
    return plain(shown.select("id", "status", "status_changed_at"))


@query
def report_window(spark, sf):
    shown = views.report_window(fx.posts(spark, sf), cutoff=MONTH_AGO)
    return plain(shown.select("id", "platform", "status", "categories", "competitors", "discovered_at"))


@query
def posts_window(spark, sf):
    return plain(views.posts_window(fx.posts(spark, sf), AS_OF, 168))


@query
def top_topics(spark, sf):
    window = views.report_window(fx.posts(spark, sf), cutoff=MONTH_AGO, cap=None)
    return plain(reports.top_topics(window))


@query
def platform_counts(spark, sf):
    window = views.report_window(fx.posts(spark, sf), cutoff=MONTH_AGO, cap=None)
    return plain(reports.platform_counts(window))


@query
def status_counts(spark, sf):
    window = views.report_window(fx.posts(spark, sf), cutoff=MONTH_AGO, cap=None)
    return plain(reports.status_counts(window))


@query
def stat_cards(spark, sf):
    return reports.stat_cards(views.report_window(fx.posts(spark, sf), cutoff=MONTH_AGO, cap=None))


@query
def action_timeline(spark, sf):
    window = views.report_window(fx.posts(spark, sf), cutoff=MONTH_AGO, cap=None)
    return plain(reports.action_timeline(window))


@query
def posts_per_day(spark, sf):
    return plain(reports.posts_per_day(fx.posts(spark, sf)))


@query
def drill_in(spark, sf):
    return views.drill_in_all(fx.posts(spark, sf), DRILL_KEYS).select("drill_key", "id")


@query
def daily_summary(spark, sf):
    return plain(reports.daily_summary(fx.posts(spark, sf), AS_OF))


@query
def summary_job(spark, sf):
    """The summary of the kept table, of which only the last days are opened."""
    posts = jobs.post_table(spark, f"{work_dir(spark, 'posts')}/posts")
    posts.write(fx.posts(spark, sf))
    return plain(jobs.daily_summary(posts, AS_OF))


# Client errors -------------------------------------------------------------------


@query
def fingerprint_errors(spark, sf):
    return errors.with_fingerprint(fx.error_reports(spark, sf)).select("seq", "fingerprint")


@query
def ttl_dedup(spark, sf):
    """One page per event type: an hour of silence after each kept report."""
    kept = ratelimit.drop_repeats(
        fx.events(spark, sf), ["event_type"], "ts", "event_id", 3600
    )
    return kept.select("event_id", "event_type")


@query
def rate_limit(spark, sf):
    kept = ratelimit.rate_limit(
        fx.events(spark, sf), ["event_type"], "ts", "event_id", 2, 3600
    )
    return kept.select("event_id", "event_type")


@query
def rate_limit_hot(spark, sf):
    """The same limit for all events as one key."""
    all_events = fx.events(spark, sf).withColumn("key", F.lit("all"))
    kept = ratelimit.rate_limit(
        all_events, ["key"], "ts", "event_id", 2, 3600
    )
    return kept.select("event_id")


@query
def error_intake(spark, sf):
    """Fingerprint, repeats per page, then validity, widths and the hourly rate."""
    reports_in = errors.with_fingerprint(fx.error_reports(spark, sf))
    sent = errors.suppress_repeats(reports_in, reused=True)
    return errors.admit(sent, cap=3).select("seq", "message", "fingerprint")


@query
def error_digest(spark, sf):
    return plain(errors.digest(errors.unalerted(fx.client_errors(spark, sf))))


@query
def mark_alerted(spark, sf):
    """Only digests about the agents' first function could be delivered."""
    table = fx.client_errors(spark, sf)
    batch = errors.unalerted(table)
    delivered = errors.digest(batch).filter(F.col("message") != "Boom 3")
    marked = errors.mark_alerted(table, batch, delivered, AS_OF)
    return plain(marked.select("id", "fingerprint", "alerted_at"))


# Runs and health -----------------------------------------------------------------


def _run_tables(spark, sf):
    reported = fx.error_log(spark, sf)
    ends = fx.run_ends(spark, sf).unionByName(runs.failed_ends(reported))
    table = runs.error_rows(reported)
    folded = runs.fold_runs(fx.run_starts(spark, sf), ends, fx.step_events(spark, sf), table)
    return folded, table


def _shown_runs(folded):
    return plain(
        folded.withColumns(
            {
                "steps": F.transform("steps", lambda s: F.concat_ws(":", s["name"], s["status"])),
                "stats": F.try_element_at("stats", F.lit("inserted")),
            }
        )
    )


@query
def fold_steps(spark, sf):
    steps = runs.fold_steps(fx.step_events(spark, sf))
    return plain(steps.withColumn("count", F.col("count").cast("string")))


@query
def fold_runs(spark, sf):
    folded, _ = _run_tables(spark, sf)
    return _shown_runs(folded)


@query
def runs_list(spark, sf):
    folded, _ = _run_tables(spark, sf)
    shown = views.runs_list(folded, AS_OF, product="P2", status="failed", limit=900, since_days=20)
    return plain(shown.select("id", "script", "started_at", "ended_at", "error_id"))


@query
def errors_list(spark, sf):
    _, table = _run_tables(spark, sf)
    resolved = runs.resolve_errors(table, fx.resolutions(spark, sf))
    return plain(views.errors_list(resolved, AS_OF, unresolved_only=True))


@query
def resolve_errors(spark, sf):
    _, table = _run_tables(spark, sf)
    resolved = runs.resolve_errors(table, fx.resolutions(spark, sf))
    return plain(resolved.select("id", "message", "resolved", "resolved_at", "resolved_by"))


@query
def run_errors(spark, sf):
    folded, table = _run_tables(spark, sf)
    linked = runs.error_of_run(folded, table)
    return plain(
        linked.select("id", "error_id", F.left("message", F.lit(20)).alias("message"), "resolved")
    )


@query
def zero_volume_days(spark, sf):
    """Of each author's last days, those without a post of theirs."""
    posts = fx.posts(spark, sf).filter(F.col("discovered_at").isNotNull())
    per_day = posts.groupBy("author_handle", times.day_of(F.col("discovered_at")).alias("day")).agg(F.count("*").alias("n"))
    return plain(health.zero_volume_days_by(per_day, "author_handle", AS_OF))


@query
def health_findings(spark, sf):
    return health.health_findings(
        fx.posts(spark, sf), fx.client_errors(spark, sf), fx.log_lines(spark, sf), AS_OF,
        runaway_per_day=340, expected=[*refdata.EXPECTED_PLATFORMS, "newsgroup"],
    )


@query
def health_verdict(spark, sf):
    found = health.health_findings(
        fx.posts(spark, sf), fx.client_errors(spark, sf), fx.log_lines(spark, sf), AS_OF
    )
    return health.verdict(found)


@query
def log_scan(spark, sf):
    return health.scan_log(fx.log_lines(spark, sf), AS_OF)


@query
def log_tail(spark, sf):
    return health.latest_lines(health.scan_log(fx.log_lines(spark, sf), AS_OF))


@query
def log_tail_landed(spark, sf):
    """The last lines of landed text files, in the files' own order."""
    work = work_dir(spark, "logs")
    lines = fx.log_lines(spark, sf, "event_id")
    files = lines.repartitionByRange(5, "event_id").sortWithinPartitions("event_id")
    files.select("value").write.text(work)
    placed = landed.placed_lines(spark, work)
    return health.tail_lines(health.scan_log(placed, AS_OF)).select("value")


@query
def error_volume(spark, sf):
    recent = fx.client_errors(spark, sf).filter(F.col("occurred_at") >= views.ago(AS_OF, 7, "DAYS"))
    return health.row_count(recent)


@query
def health_job(spark, sf):
    """The health check over the kept tables."""
    work = work_dir(spark, "health")
    posts, kept = jobs.post_table(spark, f"{work}/posts"), jobs.error_table(spark, f"{work}/errors")
    posts.write(fx.posts(spark, sf))
    kept.write(fx.client_errors(spark, sf))
    return jobs.health_check(
        posts, kept, fx.log_lines(spark, sf), AS_OF,
        runaway_per_day=340, expected=[*refdata.EXPECTED_PLATFORMS, "newsgroup"],
    )


# Harvest and model output ----------------------------------------------------------


@query
def phrase_index(spark, sf):
    """How many documents contain each of more than a thousand phrases."""
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    hits = harvest.match_many_phrases(docs, "text", MANY_PHRASES)
    return plain(hits.groupBy("query").agg(F.count("*").alias("n_docs"), F.sum("doc_id").alias("ids")))


@query
def harvest_keyword_topk(spark, sf):
    found = harvest.harvest_stories(
        fx.story_hits(spark, sf), AS_OF, hours=ALL_HOURS, keywords=STORY_WORDS
    )
    return plain(found.select("query", "rank", "post_url", "post_title", "author_handle", "posted_at", "body"))


@query
def harvest_tag_topk(spark, sf):
    found = harvest.harvest_questions(
        fx.question_items(spark, sf), AS_OF, hours=MONTH_HOURS,
        tags=QUESTION_TAGS, phrases=QUESTION_PHRASES,
    )
    return plain(found.select("query", "rank", "post_url", "post_title", "author_handle", "posted_at", "body"))


@query
def harvest_nested_bot_filter(spark, sf):
    found = harvest.harvest_micro_posts(
        fx.micro_posts(spark, sf), AS_OF, hours=MONTH_HOURS, keywords=MICRO_WORDS
    )
    return plain(found.select("query", "rank", "post_url", "post_title", "author_handle", "posted_at"))


def _source_pool(story_hits, question_items, micro_posts):
    stories = harvest.harvest_stories(story_hits, AS_OF, hours=ALL_HOURS, keywords=STORY_WORDS)
    questions = harvest.harvest_questions(
        question_items, AS_OF, hours=MONTH_HOURS, tags=QUESTION_TAGS, phrases=QUESTION_PHRASES
    )
    micro = harvest.harvest_micro_posts(
        micro_posts, AS_OF, hours=MONTH_HOURS, keywords=MICRO_WORDS
    )
    pools = [harvest.sequence(p, i) for i, p in enumerate([stories, questions, micro])]
    return harvest.in_source_order(*pools).select("seq", "platform", "post_url")


@query
def harvest_pool(spark, sf):
    """All three harvests in source order, each under its own platform."""
    return _source_pool(
        fx.story_hits(spark, sf), fx.question_items(spark, sf), fx.micro_posts(spark, sf)
    )


@query
def harvest_landed(spark, sf):
    """The same from pages of JSON that were landed first, an item each."""
    work = work_dir(spark, "pages")
    for name, member, items in (
        ("stories", "hits", fx.story_hits(spark, sf)),
        ("questions", "items", fx.question_items(spark, sf)),
        ("micro", "posts", fx.micro_posts(spark, sf)),
    ):
        items.select(F.array(F.struct("*")).alias(member)).write.json(f"{work}/{name}")
    return _source_pool(
        landed.story_hits(spark, f"{work}/stories"),
        landed.questions(spark, f"{work}/questions"),
        landed.micro_posts(spark, f"{work}/micro"),
    )


def _parsed(spark, sf):
    return records.parse_batches(fx.model_responses(spark, sf), "payload", "response_id")


@query
def model_batch_parse(spark, sf):
    return plain(records.batch_records(_parsed(spark, sf), "response_id"))


@query
def model_batch_faults(spark, sf):
    return records.batch_faults(_parsed(spark, sf), "response_id")


@query
def model_batch_summaries(spark, sf):
    return records.batch_summaries(_parsed(spark, sf), "response_id")


@query
def classify_hook(spark, sf):
    found = harvest.sequence(
        harvest.harvest_stories(
            fx.story_hits(spark, sf), AS_OF, hours=ALL_HOURS, keywords=STORY_WORDS
        ),
        0,
    )
    candidates = found.select("seq", *schemas.POST_FIELDS)
    kept = records.classify(
        candidates, found.select("seq", "post_url", "body"), records.keyword_rules(CLASS_RULES)
    )
    return plain(kept.select("post_url", "summary", "categories"))


def refusing(predict, mark: str):
    """A model that fails on every batch with a text that holds ``mark``."""

    def run(batch):
        if batch["body"].str.contains(mark, regex=False, na=False).any():
            raise ValueError("refused")
        return predict(batch)

    return run


@query
def classify_faults(spark, sf):
    """All documents, classified by a model that refuses texts with an access key."""
    docs = fx.table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), "source", F.col("text").alias("body"))
    given = docs.select(
        "seq", F.concat(F.lit("https://d.example/"), F.col("seq").cast("string")).alias("post_url"), "body",
        F.lit("x").alias("platform"), F.lit("").alias("post_title"), F.col("source").alias("author_handle"),
        *(F.lit(None).cast("string").alias(c) for c in ("posted_at", "summary", "opportunity")),
        *(F.lit(None).cast("array<string>").alias(c) for c in ("categories", "competitors")),
    )
    predict = refusing(records.keyword_rules(CLASS_RULES), "AKIA")
    found = records.classify_or_fault(
        given.select("seq", *schemas.POST_FIELDS), given.select("seq", "post_url", "body"), predict
    )
    return plain(found.select("seq", "categories", "fault"))


@query
def schema_evolution(spark, sf):
    """Posts from files that were written before and after the list of competitors came."""
    path = f"{work_dir(spark, 'evolved')}/posts"
    posts = fx.posts(spark, sf).select("id", "platform", "discovered_at", "competitors")
    early = F.col("discovered_at") < times.as_timestamp(fx.STORE_CUTOFF)
    posts.filter(early).drop("competitors").write.parquet(path)
    posts.filter(~early).write.mode("append").parquet(path)
    none = F.array().cast("array<string>")
    return plain(landed.evolved(spark, path, {"competitors": none}).select("id", "platform", "competitors"))


@query
def priority_pool(spark, sf):
    """Raw candidates, then the batch as the pool of the priority platform: the copies'
    platform in the merged pools."""
    pools = jobs.combine(fx.posts_raw(spark, sf), jobs.priority(fx.batch(spark, sf)))
    return dedup.merge_copies(pools).select("post_url", "platform")


@query
def model_landed(spark, sf):
    """Valid records of model responses that were landed as lines of text."""
    path = f"{work_dir(spark, 'responses')}/responses"
    fx.model_responses(spark, sf).select("payload").write.text(path)
    return jobs.model_pool(landed.model_responses(spark, path)).select("platform", "post_url", "post_title")


@query
def subset_guard(spark, sf):
    """Raw candidates whose URL, as given, is also a canonical URL of the batch."""
    return dedup.within(fx.posts_raw(spark, sf), fx.batch(spark, sf)).select("seq", "post_url")


@query
def snippet_lookup(spark, sf):
    """The latest raw summary of each batch URL; NULL where no copy spells it so."""
    bodies = fx.posts_raw(spark, sf).select("seq", "post_url", F.col("summary").alias("body"))
    return dedup.with_snippets(fx.batch(spark, sf), bodies).select("post_url", "body")


# Counters ----------------------------------------------------------------------------


@query
def stage_counters(spark, sf):
    """What each stage of a discovery run took and left, as (stage, key, n)."""
    judged = clean.judge(fx.posts_raw(spark, sf), AS_OF)
    stored, batch = _store_and_batch(spark, sf)

    def total(df, stage):
        return df.agg(F.count("*").alias("n")).select(
            F.lit(stage).alias("stage"), F.lit("all").alias("key"), "n"
        )

    def by(df, stage, key):
        return df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).select(
            F.lit(stage).alias("stage"), "key", "n"
        )

    parts = [
        by(judged.withColumn("verdict", F.coalesce("reject_reason", F.lit("kept"))), "clean", "verdict"),
        total(batch, "distinct"),
        total(dedup.already_stored(batch, stored), "stored"),
        by(dedup.not_stored(batch, stored), "new", "platform"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def platform_breakdown(spark, sf):
    stored, batch = _store_and_batch(spark, sf)
    return reports.platform_breakdown(dedup.not_stored(batch, stored))


# Streams -------------------------------------------------------------------------------


def _land_in_two(df: DataFrame, at: DataFrame, folder: str, fmt: str):
    """Writes the rows before the cutoff, yields, then writes the others: two
    landings that two runs of a stream pick up."""
    early = F.col("_ts") < times.as_timestamp(fx.STORE_CUTOFF)
    dated = df.join(at, "seq")
    for part in (dated.filter(early), dated.filter(~early)):
        part.drop("_ts").write.mode("append").format(fmt).save(folder)
        yield


@query
def stream_ingest(spark, sf):
    """Two incremental runs over landed candidates: the store they leave."""
    work = work_dir(spark, "ingest")
    at = fx.events(spark, sf).select(F.col("event_id").alias("seq"), F.col("ts").alias("_ts"))
    posts = jobs.post_table(spark, f"{work}/posts")
    for _ in _land_in_two(fx.posts_raw(spark, sf), at, f"{work}/landing", "json"):
        ingest.ingest_now(posts, f"{work}/landing", f"{work}/checkpoint", AS_OF)
    return plain(posts.read().select("platform", "post_url", "post_title", "categories", "competitors"))


def _limited_stream(spark, sf, cap):
    """Two incremental runs over landed events, limited per hour and event type."""
    work = work_dir(spark, "intake")
    events = fx.events(spark, sf).withColumnRenamed("event_id", "seq")
    at = events.select("seq", F.col("ts").alias("_ts"))
    for _ in _land_in_two(events, at, f"{work}/landing", "parquet"):
        stream = landed.report_stream(spark, f"{work}/landing", events.schema)
        intake.limited_stream(
            stream, f"{work}/accepted", f"{work}/checkpoint",
            keys=["event_type"], at="ts", order="seq", cap=cap, window_seconds=3600,
        ).awaitTermination()
    kept = intake.accepted_rows(spark.read.parquet(f"{work}/landing"), f"{work}/accepted", "seq")
    return kept.select(F.col("seq").alias("event_id"), "event_type")


@query
def stream_rate_limit(spark, sf):
    """Twice an hour per event type, in two runs."""
    return _limited_stream(spark, sf, 2)


@query
def stream_ttl_dedup(spark, sf):
    """One page per event type: an hour of silence after each kept report, in two runs."""
    return _limited_stream(spark, sf, 1)


@query
def stream_digest(spark, sf):
    """Two digests of landed error rows, one per run."""
    work = work_dir(spark, "digest")
    table = fx.client_errors(spark, sf)
    rows = table.withColumn("seq", F.col("id").cast("long"))
    at = rows.select("seq", F.col("occurred_at").alias("_ts"))
    schema = table.schema
    for _ in _land_in_two(rows, at, f"{work}/landing", "parquet"):
        stream = landed.report_stream(spark, f"{work}/landing", schema)
        intake.digest_stream(stream, f"{work}/digests", f"{work}/checkpoint").awaitTermination()
    shown = spark.read.parquet(f"{work}/digests")
    return plain(shown.select("batch", "fingerprint", "occurrences", "first_seen", "first_id"))


@query
def stream_digest_marks(spark, sf):
    """Two digests of landed error rows, of which all groups but one's could be
    delivered: the marks that they leave in the kept table."""
    work = work_dir(spark, "digest")
    given = fx.client_errors(spark, sf)
    kept = jobs.error_table(spark, f"{work}/errors")
    kept.write(given)
    rows = given.withColumn("seq", F.col("id").cast("long"))
    at = rows.select("seq", F.col("occurred_at").alias("_ts"))
    for _ in _land_in_two(rows, at, f"{work}/landing", "parquet"):
        stream = landed.report_stream(spark, f"{work}/landing", given.schema)
        intake.digest_stream(
            stream, f"{work}/delivered", f"{work}/checkpoint", table=kept, as_of=AS_OF,
            deliver=lambda groups: groups.filter(F.col("message") != "Boom 3"),
        ).awaitTermination()
    return plain(kept.read().select("id", "fingerprint", "alerted_at"))


def _landed_halves(df: DataFrame, folder: str, fmt: str):
    """Writes half of the rows, of any time, yields, then writes the others."""
    second = F.xxhash64(F.to_json(F.struct("*"))) % 2 == 0
    for part in (df.filter(~second), df.filter(second)):
        part.write.mode("append").format(fmt).save(folder)
        yield


def _state_of(spark, events: DataFrame, state, work: str) -> DataFrame:
    """States of two landings of events, of which the second has earlier ones, too."""
    for _ in _landed_halves(events, f"{work}/landing", "parquet"):
        stream = landed.report_stream(spark, f"{work}/landing", events.schema)
        folding.state_stream(stream, state, f"{work}/states", f"{work}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{work}/states").drop("batch")


@query
def stream_fold_steps(spark, sf):
    states = _state_of(spark, fx.step_events(spark, sf), runs.step_states, work_dir(spark, "steps"))
    steps = runs.steps_of(runs.merge_steps(states))
    return plain(steps.withColumn("count", F.col("count").cast("string")))


@query
def stream_fold_runs(spark, sf):
    """The run table out of the states that two landings of steps and ends left."""
    reported = fx.error_log(spark, sf)
    ends = fx.run_ends(spark, sf).unionByName(runs.failed_ends(reported))
    folded = runs.runs_of(
        fx.run_starts(spark, sf),
        runs.merge_ends(_state_of(spark, ends, runs.end_states, work_dir(spark, "ends"))),
        runs.merge_steps(_state_of(spark, fx.step_events(spark, sf), runs.step_states, work_dir(spark, "steps"))),
        runs.error_rows(reported),
    )
    return _shown_runs(folded)


@query
def stream_harvest(spark, sf):
    """All harvests of two landings each, of which only the winners were kept."""
    pools = []
    for member, item, items, winners in (
        ("hits", schemas.STORY_HIT, fx.story_hits(spark, sf),
         lambda df: harvest.story_winners(df, AS_OF, hours=ALL_HOURS, keywords=STORY_WORDS)),
        ("items", schemas.QUESTION, fx.question_items(spark, sf),
         lambda df: harvest.question_winners(
             df, AS_OF, hours=MONTH_HOURS, tags=QUESTION_TAGS, phrases=QUESTION_PHRASES)),
        ("posts", schemas.MICRO_POST, fx.micro_posts(spark, sf),
         lambda df: harvest.micro_winners(df, AS_OF, hours=MONTH_HOURS, keywords=MICRO_WORDS)),
    ):
        work = work_dir(spark, member)
        pages = items.select(F.array(F.struct("*")).alias(member))
        for _ in _landed_halves(pages, f"{work}/landing", "json"):
            stream = landed.page_stream(spark, f"{work}/landing", member, item)
            folding.winner_stream(stream, winners, f"{work}/winners", f"{work}/checkpoint").awaitTermination()
        pools.append(folding.latest(spark, f"{work}/winners", stream.schema))
    return _source_pool(*pools)
