"""Tables of the pipeline's own shape, derived by expressions from the given
tables. Each is a projection of the whole base table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import refdata
from ..functions import text, times
from ..functions.sqltext import listed
from ..operators import clean, dedup

AS_OF = "2024-01-31 00:00:00"
STORE_CUTOFF = "2024-01-20 00:00:00"

PLATFORM_SPELLINGS = [
    "Reddit", "HN", "StackOverflow", "twitter", "bsky", "AWS", "mastodon", "ade",
    "re:Post thread", "hacker news",
]
STEP_NAMES = ["fetch", "classify", "clean", "insert"]
STEP_STATUSES = ["running", "success", "failed", "skipped"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as an instant (the files hold it without a zone)."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _str(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _picked(values: list[str], index: str) -> str:
    return f"element_at(array({listed(values)}), cast({index} AS int) + 1)"


_TOPICS = ["OCR", "IDP", "NLP", "ADE", "RPA"]
_EARLIER = "ts - make_dt_interval(cast(event_id % 30 AS int))"
_ISO = "yyyy-MM-dd\\'T\\'HH:mm:ss"
_STATUS = _picked(refdata.STATUSES, "event_id % 5")


def posts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw candidates: one per event, every fifth a copy of an earlier URL."""
    even = _picked(["", "&ref=x", "#top", "&utm_source=feed"], "event_id % 4")
    odd = _picked(["", "/", "#top", "?utm_source=feed"], "event_id % 4")
    return events(spark, sf_dir).selectExpr(
        "event_id AS seq",
        f"{_picked(PLATFORM_SPELLINGS, '(event_id * 3 + user_id) % 10')} AS platform",
        "if(event_id % 5 = 0 AND event_id >= 5, event_id - 3, event_id) AS pk",
        f"""CASE WHEN event_id % 53 = 0 THEN 'javascript:alert(1)'
            WHEN pk % 2 = 0 THEN concat('https://site', pk % 7, '.example/item?id=', pk, {even})
            ELSE concat('https://site', pk % 7, '.example/p/', pk, {odd}) END AS post_url""",
        """CASE WHEN event_id % 41 = 0 THEN '  ' WHEN event_id % 17 = 0 THEN 'Привет OCR'
            ELSE concat('Post ', event_id) END AS post_title""",
        "if(event_id % 9 = 0, NULL, concat('  u', user_id, ' ')) AS author_handle",
        f"""CASE event_id % 6 WHEN 0 THEN '3 days ago'
            WHEN 2 THEN concat(date_format({_EARLIER}, '{_ISO}'), 'Z')
            WHEN 3 THEN date_format({_EARLIER}, '{_ISO}')
            WHEN 4 THEN '2024-01'
            WHEN 5 THEN concat(date_format(ts, '{_ISO}'), '+02:00') END AS posted_at""",
        "if(event_id % 43 = 0, NULL, concat('summary ', event_id)) AS summary",
        "if(event_id % 9 = 0, NULL, concat(' idea ', user_id, ' ')) AS opportunity",
        f"""if(event_id % 3 = 0, array('bogus'),
            array('OCR', 'bogus', {_picked(_TOPICS, 'user_id % 5')})) AS categories""",
        """CASE event_id % 4 WHEN 0 THEN array(' reducto', 'UIPATH', 'Reducto')
            WHEN 1 THEN array('nobody') ELSE cast(array() AS array<string>) END AS competitors""",
    ).drop("pk")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored posts in all statuses: one per event."""
    return events(spark, sf_dir).selectExpr(
        "cast(event_id AS string) AS id",
        f"{_picked(refdata.PLATFORMS, 'user_id % 8')} AS platform",
        "concat('https://site', event_id % 7, '.example/s/', event_id) AS post_url",
        "concat('Post ', event_id) AS post_title",
        "concat('u', user_id) AS author_handle",
        f"if(event_id % 7 = 0, NULL, {_EARLIER}) AS posted_at",
        "concat('summary ', event_id) AS summary",
        "if(event_id % 9 = 0, NULL, concat('idea ', user_id)) AS opportunity",
        f"""if(event_id % 3 = 0, cast(array() AS array<string>),
            array('OCR', {_picked(_TOPICS, 'user_id % 5')})) AS categories""",
        """if(event_id % 4 = 0, array('Reducto', 'UiPath'),
            cast(array() AS array<string>)) AS competitors""",
        f"{_STATUS} AS status",
        "ts AS discovered_at",
        """if(event_id % 5 = 0 OR event_id % 11 = 0, NULL,
            ts + make_dt_interval(0, cast(event_id % 72 AS int))) AS status_changed_at""",
        "cast(NULL AS string) AS actioned_by",
        "cast(NULL AS timestamp) AS actioned_at",
    )


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned, merged batch of all raw candidates."""
    return dedup.merge_copies(clean.clean(posts_raw(spark, sf_dir), AS_OF))


def stored_before(spark: SparkSession, sf_dir: str, batch: DataFrame) -> DataFrame:
    """A store that met the batch's URLs first seen before the cutoff, with
    competitor lists of its own (some unsorted)."""
    early = events(spark, sf_dir).filter(F.col("ts") < times.as_timestamp(STORE_CUTOFF)).select(
        F.col("event_id").alias("seq"), F.col("ts").alias("_ts")
    )
    first = times.with_instant(
        batch.join(early, "seq"), "posted_at", "_posted"
    )
    return first.select(
        _str("s", F.col("seq")).alias("id"),
        "platform", "post_url", "post_title", "author_handle",
        F.col("_posted").alias("posted_at"),
        "summary",
        text.empty_to_null(F.col("opportunity")).alias("opportunity"),
        "categories",
        F.when(F.col("seq") % 3 == 0, F.array().cast("array<string>"))
        .when(F.col("seq") % 3 == 1, F.array(F.lit("UiPath"), F.lit("Reducto")))
        .otherwise(F.array(F.lit("LlamaIndex")))
        .alias("competitors"),
        F.lit("new").alias("status"),
        F.col("_ts").alias("discovered_at"),
        F.lit(None).cast("timestamp").alias("status_changed_at"),
        F.lit(None).cast("string").alias("actioned_by"),
        F.lit(None).cast("timestamp").alias("actioned_at"),
    )


def status_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two actions per post at most, some with an unknown status or post."""
    n, user = F.col("event_id"), F.col("user_id")
    return events(spark, sf_dir).select(
        F.when(n % 13 == 0, _str("no-", n)).otherwise((n - n % 3).cast("string")).alias("id"),
        pick([*refdata.STATUSES, "gone"], (n + user) % 6).alias("status"),
        F.when(n % 10 != 0, _str("user", user)).alias("user"),
        F.col("ts").alias("at"),
        n.alias("seq"),
    )


def error_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What pages send: one report per event, the user standing for the page."""
    n, user = F.col("event_id"), F.col("user_id")
    return events(spark, sf_dir).select(
        n.alias("seq"),
        n.cast("string").alias("id"),
        user.alias("session"),
        F.col("ts").alias("occurred_at"),
        F.when(n % 97 == 0, "").otherwise(_str("Boom ", F.col("event_type"))).alias("message"),
        F.when(n % 10 != 0, _str("Error\n    at f", user % 5, " (a.js:1:2)\n    at g")).alias("stack"),
        F.when(n % 8 != 0, _str("https://site.example/page/", n)).alias("page_url"),
        F.when(n % 6 != 0, _str("agent ", user)).alias("user_agent"),
    )


def client_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error table: error events, a third of them already told about."""
    e = events(spark, sf_dir).filter(F.col("event_type") == "error")
    n, user = F.col("event_id"), F.col("user_id")
    rows = e.select(
        n.cast("string").alias("id"),
        F.col("ts").alias("occurred_at"),
        _str("Boom ", user % 5).alias("message"),
        _str("Error\n    at f", user % 5, " (a.js:1:2)\n    at g").alias("stack"),
        F.when(n % 8 != 0, _str("https://site.example/page/", n)).alias("page_url"),
        F.when(n % 6 != 0, _str("agent ", user)).alias("user_agent"),
        F.when(n % 3 == 0, F.col("ts") + F.expr("INTERVAL 15 MINUTES")).alias("alerted_at"),
    )
    return rows.withColumn("fingerprint", text.fingerprint(F.col("message"), F.col("stack"))).select(
        "id", "occurred_at", "message", "stack", "page_url", "user_agent", "fingerprint", "alerted_at"
    )


def _run_id(n: Column) -> Column:
    return F.floor(n / 10)


def run_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of ten events each."""
    run = _run_id(F.col("event_id"))
    grouped = events(spark, sf_dir).groupBy(run.alias("run")).agg(F.min("ts").alias("at"))
    r = F.col("run")
    return grouped.select(
        r.cast("string").alias("run_id"),
        pick(["P1", "P2", "P3"], r % 3).alias("product"),
        _str("job_", r % 4).alias("script"),
        F.when(r % 5 != 0, pick(["discover", "archive"], r % 2)).alias("mode"),
        "at",
    )


def step_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    return events(spark, sf_dir).select(
        _run_id(n).cast("string").alias("run_id"),
        pick(STEP_NAMES, n % 4).alias("name"),
        pick([*STEP_STATUSES, "running", "success", "running"], n % 7).alias("status"),
        F.when(n % 3 != 0, (n % 100).cast("int")).alias("count"),
        F.when(n % 5 == 0, _str("note ", n)).alias("note"),
        F.when(n % 6 == 0, (n % 9).cast("int")).alias("sequence"),
        F.col("ts").alias("at"),
        n.alias("seq"),
    )


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported pipeline errors: the error events, some outside any run."""
    n = F.col("event_id")
    return events(spark, sf_dir).filter(F.col("event_type") == "error").select(
        _str("e", n).alias("id"),
        F.col("ts").alias("at"),
        pick(["P1", "P2", "P3"], _run_id(n) % 3).alias("product"),
        _str("job_", _run_id(n) % 4).alias("script"),
        F.when(n % 4 != 0, "discover").alias("mode"),
        F.when(n % 7 != 0, F.repeat(_str("failure ", n, " "), 60)).alias("message"),
        F.when(n % 2 == 0, _str("Traceback ", n)).alias("traceback"),
        F.when(n % 6 != 0, _run_id(n).cast("string")).alias("run_id"),
        n.alias("seq"),
    )


def run_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End events: purchases end their run, at times with stats or an error id
    that no error row bears."""
    n = F.col("event_id")
    return events(spark, sf_dir).filter(F.col("event_type") == "purchase").select(
        _run_id(n).cast("string").alias("run_id"),
        pick(["success", "partial"], n % 2).alias("status"),
        F.when(n % 3 == 0, F.create_map(F.lit("inserted"), n.cast("string"))).alias("stats"),
        F.when(n % 4 == 0, _str("e", n)).alias("error_id"),
        F.col("ts").alias("at"),
        n.alias("seq"),
    )


def resolutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups resolve the error of the event before them, where there is one."""
    n = F.col("event_id")
    return events(spark, sf_dir).filter(F.col("event_type") == "signup").select(
        _str("e", n - 1).alias("id"),
        F.when(n % 2 == 0, _str("user", F.col("user_id"))).alias("resolved_by"),
        F.col("ts").alias("at"),
        n.alias("seq"),
    )


def log_lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Log lines: mostly dated, some undated, some with a date that is none."""
    n = F.col("event_id")
    stamp = (
        F.when(n % 9 == 0, "")
        .when(n % 10 == 0, "2024-13-45 ")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss "))
    )
    level = pick(["INFO", "ERROR", "info error", "BROKEN"], n % 4)
    return events(spark, sf_dir).select(
        F.concat(stamp, level, _str(" line ", n)).alias("value"), *more
    )


def question_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions: the event type and the k of its props as tags."""
    n, user = F.col("event_id"), F.col("user_id")
    return events(spark, sf_dir).select(
        _str(" https://qa.example/q/", n - n % 4).alias("link"),
        F.when(n % 19 == 0, "  ")
        .when(n % 2 == 0, _str("How does ", F.col("event_type"), " work? ", n))
        .otherwise(_str("Question ", n))
        .alias("title"),
        F.unix_seconds("ts").cast("string").alias("creation_date"),
        F.struct(F.when(n % 5 != 0, _str(" u", user)).alias("display_name")).alias("owner"),
        F.array("event_type", _str("k", F.get_json_object("props", "$.k"))).alias("tags"),
    )


def micro_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, user = F.col("event_id"), F.col("user_id")
    label = F.when(user % 10 == 0, "bot").when(user % 10 == 1, "spam")
    return events(spark, sf_dir).select(
        F.when(n % 29 != 0, _str("at://did/app/post/", n)).alias("uri"),
        F.struct(
            F.when(n % 31 != 0, _str("u", user)).alias("handle"),
            F.array(F.struct(label.alias("val"))).alias("labels"),
        ).alias("author"),
        F.struct(
            F.when(n % 37 == 0, " ")
            .otherwise(_str(" a ", F.col("event_type"), " with ", F.col("props")))
            .alias("text"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("createdAt"),
        ).alias("record"),
    )


def story_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stories out of documents: the whole text, an hour between two of them."""
    n = F.col("doc_id")
    at = F.unix_seconds(times.as_timestamp(AS_OF)) - (n + 1) * 3600
    return table(spark, sf_dir, "documents").select(
        n.cast("string").alias("objectID"),
        F.when(n % 11 == 0, "").otherwise(_str(" Story ", n)).alias("title"),
        F.when(n % 22 != 0, _str("Told ", n)).alias("story_title"),
        F.when(n % 7 != 0, _str("by ", F.col("source"))).alias("author"),
        F.date_format(F.timestamp_seconds(at), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        at.alias("created_at_i"),
        F.col("text").alias("story_text"),
    )


def model_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model responses as JSON text, one per event, in every shape the parser
    meets: fenced, inside prose, broken, of the wrong type, with faulty records."""
    n, user = F.col("event_id"), F.col("user_id")
    head = _str('{"platform":"x","post_url":"https://m.example/', n, '","post_title":"T ', n, '","summary":"S"')
    faulty = pick(
        ["}", ',"categories":null}', ',"opportunity":null}', ',"categories":["OCR",1]}',
         ',"author_handle":null,"extra":1}', ',"posted_at":5}'],
        n % 6,
    )
    records = F.concat(
        F.lit("["), head, F.lit(',"categories":["OCR"],"competitors":["UiPath"]},'),
        head, faulty, _str(',{"platform":"x","n":', user, "}]"),
    )
    body = F.when(n % 13 == 0, F.lit('{"summary":"none","posts":"x"}')).when(
        n % 17 == 0, F.lit("[1,2]")
    ).when(n % 19 == 0, F.lit('{"posts":[')).otherwise(
        F.concat(_str('{"summary":"batch ', n, '","posts":'), records, F.lit("}"))
    )
    shown = (
        F.when(n % 4 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(n % 4 == 2, F.concat(F.lit("Here it is: "), body, F.lit(" Done.")))
        .otherwise(body)
    )
    quoted = F.to_json(F.struct(shown.alias("t")))
    value = F.substr(quoted, F.lit(6), F.length(quoted) - 6)
    part = F.concat(F.lit('{"type":"text","text":'), value, F.lit("}"))
    payload = (
        F.when(n % 23 == 0, F.lit('{"output":[]}'))
        .when(n % 2 == 0, F.concat(F.lit('{"output_text":'), value, F.lit("}")))
        .otherwise(
            F.concat(
                F.lit('{"output_text":7,"output":[{"content":[{"type":"note","text":"skip"},'),
                part, F.lit("]},{}]}"),
            )
        )
    )
    return events(spark, sf_dir).select(
        n.alias("response_id"), payload.alias("payload")
    )
