"""Edge cases of the DataFrame operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from threadsift import refdata, schemas
from threadsift.operators import (
    clean, dedup, errors, harvest, health, records, reports, runs, store, views,
)

AS_OF = "2024-01-31 00:00:00"


def candidates(spark, *rows):
    base = dict(
        seq=0, platform="x", post_url="https://a.example/1", post_title="T", author_handle=None,
        posted_at=None, summary="S", opportunity="", categories=["OCR"], competitors=[],
    )
    full = [{**base, "seq": i, **r} for i, r in enumerate(rows)]
    return spark.createDataFrame(
        [tuple(r[c.split()[0]] for c in schemas.CANDIDATE.split(", ")) for r in full],
        schemas.CANDIDATE,
    )


def posts(spark, *rows):
    base = dict(
        id="1", platform="x", post_url="https://a.example/1", post_title="T", author_handle=None,
        posted_at=None, summary="S", opportunity=None, categories=[], competitors=[],
        status="new", discovered_at="2024-01-30 00:00:00", status_changed_at=None,
        actioned_by=None, actioned_at=None,
    )
    stamps = ["posted_at", "discovered_at", "status_changed_at", "actioned_at"]
    full = [{**base, "id": str(i), "post_url": f"https://a.example/{i}", **r} for i, r in enumerate(rows)]
    text = schemas.POSTS.replace("timestamp", "string")
    df = spark.createDataFrame([tuple(r[c] for c in schemas.POST_COLUMNS) for r in full], text)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in stamps})


def reasons(spark, *rows):
    judged = clean.judge(candidates(spark, *rows), AS_OF)
    return [r["reject_reason"] for r in judged.orderBy("seq").collect()]


def test_reject_reasons(spark):
    assert reasons(
        spark,
        {},
        {"post_url": "javascript:alert(1)"},
        {"post_url": None},
        {"post_url": "http://[::1/"},
        {"categories": ["bogus"]},
        {"categories": [], "competitors": ["uipath "]},
        {"categories": None, "competitors": None, "platform": "ade"},
        {"post_title": "   "},
        {"post_title": None},
        {"post_title": "Привет"},
        {"summary": " "},
        {"summary": None},
        {"platform": None},
    ) == [
        None, "bad_url", "bad_url", "bad_url", "untagged", None, None, "no_title", "no_title",
        "not_latin", "no_summary", "no_summary", None,
    ]


def test_vendor_posts_age_by_their_own_date(spark):
    assert reasons(
        spark,
        {"platform": "aws", "posted_at": "2024-01-17T00:00:00"},
        {"platform": "aws", "posted_at": "2024-01-16T23:59:59"},
        {"platform": "aws", "posted_at": "2024-01-16T23:59:59-01:00"},
        {"platform": "aws", "posted_at": None},
        {"platform": "aws", "posted_at": "3 weeks ago"},
        {"platform": "x", "posted_at": "2020-01-01"},
    ) == [None, "stale_vendor", None, None, None, None]


def test_clean_form(spark):
    row = clean.clean(
        candidates(
            spark,
            {
                "post_title": " " + "t" * 600, "summary": " " + "s" * 600, "opportunity": " o ",
                "author_handle": " ", "posted_at": " 2024-01-02T03:04:05Z ",
                "categories": ["OCR", "x", "OCR"], "competitors": ["reducto", "REDUCTO"],
            },
        ),
        AS_OF,
    ).first()
    assert len(row["post_title"]) == 500 and len(row["summary"]) == 600
    assert row["opportunity"] == "o" and row["author_handle"] is None
    assert row["posted_at"] == "2024-01-02T03:04:05Z"
    assert row["categories"] == ["OCR", "OCR"] and row["competitors"] == ["Reducto"]


def test_merge_copies(spark):
    merged = dedup.merge_copies(
        candidates(
            spark,
            {"competitors": ["UiPath"], "categories": ["OCR"], "post_title": "first"},
            {"competitors": ["Reducto", "UiPath"], "categories": ["IDP"]},
            {"platform": "ade", "competitors": ["LlamaIndex"]},
            {"post_url": "https://a.example/2", "competitors": []},
        )
    )
    rows = {r["post_url"]: r for r in merged.collect()}
    one = rows["https://a.example/1"]
    assert one["post_title"] == "first" and one["categories"] == ["OCR"] and one["seq"] == 0
    assert one["platform"] == "ade"
    assert one["competitors"] == ["UiPath", "Reducto", "LlamaIndex"]
    assert rows["https://a.example/2"]["competitors"] == []


def test_many_copies_of_one_url_are_combined_before_the_shuffle(spark):
    plan = dedup.merge_copies(candidates(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_min_by" in plan


def test_first_seen_limits_groups_before_the_shuffle(spark):
    df = candidates(spark, {}, {})
    plan = dedup.first_seen(df, "post_url", "seq")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_competitor_merge_sorts_only_what_changes(spark):
    stored = posts(
        spark,
        {"competitors": ["UiPath", "Reducto"]},
        {"competitors": ["UiPath", "Reducto"]},
        {"competitors": []},
        {"competitors": []},
    )
    batch = candidates(
        spark,
        {"post_url": "https://a.example/0", "competitors": ["Reducto"]},
        {"post_url": "https://a.example/1", "competitors": ["LlamaIndex", "Reducto"]},
        {"post_url": "https://a.example/2", "competitors": ["UiPath", "Reducto"]},
        {"post_url": "https://a.example/9", "competitors": ["UiPath"]},
    )
    got = {r["id"]: (r["competitors"], r["changed"]) for r in store.merge_competitors(stored, batch).collect()}
    assert got == {
        "0": (["UiPath", "Reducto"], False),
        "1": (["LlamaIndex", "Reducto", "UiPath"], True),
        "2": (["Reducto", "UiPath"], True),
        "3": ([], False),
    }


def test_upsert_twice_inserts_nothing(spark):
    batch = dedup.merge_copies(
        clean.clean(candidates(spark, {}, {"post_url": "https://a.example/7", "opportunity": " "}), AS_OF)
    )
    empty = posts(spark, {}).limit(0)
    once = store.upsert(empty, batch, AS_OF)
    assert once.count() == 2
    assert store.new_rows(batch, once, AS_OF).isEmpty()
    twice = store.upsert(once, batch, "2024-02-01 00:00:00")
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    assert store.duplicate_urls(twice).isEmpty()
    row = once.filter("post_url like '%7'").first()
    assert row["opportunity"] is None and row["status"] == "new" and row["competitors"] == []


def test_archive_sweep(spark):
    swept = store.archive_sweep(
        posts(
            spark,
            {"discovered_at": "2024-01-26 23:59:59"},
            {"discovered_at": "2024-01-27 00:00:00"},
            {"discovered_at": "2024-01-01 00:00:00", "status": "replied"},
            {"platform": "vendor-forum", "posted_at": "2024-01-16 23:59:59"},
            {"platform": "vendor-forum", "posted_at": "2024-01-17 00:00:00"},
            {"platform": "vendor-forum"},
            {"posted_at": "2020-01-01 00:00:00"},
            {"platform": "vendor-forum", "posted_at": "2020-01-01 00:00:00", "discovered_at": "2024-01-01 00:00:00"},
        ),
        AS_OF,
    )
    got = [(r["status"], r["archived_for"]) for r in swept.orderBy("id").collect()]
    assert got == [
        ("archived", "age"), ("new", None), ("replied", None), ("archived", "stale_vendor"),
        ("new", None), ("new", None), ("new", None), ("archived", "age"),
    ]
    assert tuple(store.sweep_counts(swept).first()) == (2, 1, 3)
    assert swept.filter("archived_for is not null and actioned_at is not null").isEmpty()


def test_actions(spark):
    actions = spark.createDataFrame(
        [
            ("0", "replied", "ann", "2024-01-30 10:00:00", 1),
            ("0", "deleted", None, "2024-01-30 11:00:00", 2),
            ("0", "gone", "bob", "2024-01-30 12:00:00", 3),
            ("1", "replied", "ann", "2024-01-30 10:00:00", 5),
            ("1", "new", "ann", "2024-01-30 10:00:00", 6),
            ("zz", "new", "ann", "2024-01-30 10:00:00", 7),
            ("2", None, "ann", "2024-01-30 10:00:00", 8),
        ],
        "id string, status string, user string, at string, seq long",
    ).withColumn("at", F.col("at").cast("timestamp"))
    done = {r["id"]: r for r in store.apply_actions(posts(spark, {}, {}, {}), actions).collect()}
    assert (done["0"]["status"], done["0"]["actioned_by"]) == ("deleted", None)
    assert done["0"]["actioned_at"] == done["0"]["status_changed_at"] is not None
    assert done["1"]["status"] == "new" and done["1"]["actioned_by"] == "ann"
    assert done["2"]["actioned_at"] is None and len(done) == 3
    assert {r["seq"] for r in store.invalid_actions(actions).collect()} == {3, 8}


def test_archive_view_shows_swept_rows(spark):
    """The cutoff looks at the last change, which sweeps set as well."""
    swept = store.archive_sweep(posts(spark, {"discovered_at": "2024-01-01 00:00:00"}), AS_OF)
    assert views.archive_view(swept, cutoff="2024-01-30 00:00:00").count() == 1


def test_archive_view_drops_undated_rows_only_with_cutoff(spark):
    df = posts(spark, {"status": "archived"}, {"status": "completed", "status_changed_at": AS_OF})
    assert [r["id"] for r in views.archive_view(df).collect()] == ["1", "0"]
    assert [r["id"] for r in views.archive_view(df, cutoff="2024-01-01").collect()] == ["1"]


def test_lists_limits():
    assert views._list_cap(None) == 100 and views._list_cap(900) == 500 and views._list_cap(7) == 7


def test_drill_keys(spark):
    df = posts(
        spark, {"status": "replied", "categories": ["OCR"]}, {"competitors": ["UiPath"], "platform": "ade"}
    )
    count = lambda key: views.drill_in(df, key).count()
    keys = ["total", "replied", "competitors", "platform:ade", "status:new", "category:OCR", "category:", "other"]
    assert [count(k) for k in keys] == [2, 1, 1, 1, 1, 1, 0, 2]
    both = views.drill_in_all(df, ["total", "replied"])
    assert both.count() == 3


def test_timeline_keeps_days_of_other_statuses(spark):
    df = posts(
        spark,
        {"status": "odd", "status_changed_at": "2024-01-02 10:00:00"},
        {"status": "replied", "status_changed_at": "2024-01-03 10:00:00"},
        {"status": "new", "status_changed_at": "2024-01-04 10:00:00"},
        {"status": "replied"},
    )
    got = {str(r["day"]): tuple(r)[1:] for r in reports.action_timeline(df).collect()}
    assert got == {"2024-01-02": (0, 0, 0, 0), "2024-01-03": (1, 0, 0, 0)}


def test_topics_count_repeats_and_break_ties_by_newest(spark):
    df = posts(
        spark,
        {"categories": ["OCR", "OCR"], "discovered_at": "2024-01-01 00:00:00"},
        {"categories": ["NLP", "IDP"], "discovered_at": "2024-01-03 00:00:00"},
        {"categories": ["IDP", "NLP"], "discovered_at": "2024-01-02 00:00:00"},
    )
    got = [(r["category"], r["n"]) for r in reports.top_topics(df).orderBy("rank").collect()]
    assert got == [("NLP", 2), ("IDP", 2), ("OCR", 2)]


def test_shares_round_half_up(spark):
    df = posts(spark, *[{"platform": "x"}] * 1, *[{"platform": "ade"}] * 7)
    got = {r["platform"]: (r["share"], r["label"]) for r in reports.platform_counts(df).collect()}
    assert got == {"x": (13, "X"), "ade": (88, "ADE")}


def test_empty_day_gives_no_summary(spark):
    old = posts(spark, {"discovered_at": "2024-01-01 00:00:00"})
    assert reports.daily_summary(old, AS_OF).isEmpty()
    assert reports.platform_breakdown(candidates(spark, {}).limit(0)).first()[0] == "none"


def test_error_intake_cuts_and_validates(spark):
    df = spark.createDataFrame(
        [("m" * 1500, "s" * 5000, "u" * 600, "a" * 600, "f" * 64 + str(i), i) for i in range(3)]
        + [("", "s", "u", "a", "f", 9), (None, "s", "u", "a", "f", 10), ("m", "s", "u", "a", None, 11)],
        "message string, stack string, page_url string, user_agent string, fingerprint string, seq long",
    ).withColumn("occurred_at", F.timestamp_seconds(F.col("seq")))
    kept = errors.admit(df, cap=2).collect()
    # The suffixes beyond 64 characters do not make separate fingerprints.
    assert sorted(r["seq"] for r in kept) == [0, 1]
    row = kept[0]
    assert [len(row[c]) for c in ("message", "stack", "page_url", "user_agent", "fingerprint")] == [
        1000, 4000, 500, 500, 64,
    ]


def test_digest_and_marks(spark):
    rows = [
        ("a", "2024-01-01 00:00:02", "m1", None, "u", "", "F1", None),
        ("b", "2024-01-01 00:00:01", None, "s", None, "x", "F2", None),
        ("c", "2024-01-01 00:00:03", "m3", "s", "u", "x", "F1", None),
        ("d", "2024-01-01 00:00:00", "m4", "s", "u", "x", "F3", "2024-01-01 00:00:01"),
        ("e", "2024-01-01 00:00:09", "m5", "s", "u", "x", "F1", None),
    ]
    df = spark.createDataFrame(rows, schemas.CLIENT_ERRORS.replace("timestamp", "string")).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("occurred_at", "alerted_at")}
    )
    batch = errors.unalerted(df, cap=3)
    groups = errors.in_digest_order(errors.digest(batch)).collect()
    assert [(g["fingerprint"], g["occurrences"]) for g in groups] == [("F2", 1), ("F1", 2)]
    assert groups[0]["message"] == "(no message)" and groups[0]["page_url"] == "(no url)"
    assert groups[1]["message"] == "m1" and groups[1]["user_agent"] == "(no user agent)"
    told = errors.mark_alerted(df, batch, errors.digest(batch).filter("fingerprint = 'F1'"), AS_OF)
    alerted = {r["id"] for r in told.filter("alerted_at is not null").collect()}
    assert alerted == {"a", "c", "d"}  # e is of the same group but beyond the batch


def test_fold_steps(spark):
    def at(s):
        return dt.datetime(2024, 1, 1, 0, 0, s)

    rows = [
        ("r", "fetch", "running", None, None, None, at(0), 0),
        ("r", "clean", "success", 5, "n", 9, at(1), 1),
        ("r", "fetch", "success", 3, "done", 8, at(2), 2),
        ("r", "fetch", "running", None, None, None, at(3), 3),
    ]
    schema = schemas.STEP_EVENTS
    steps = {r["name"]: r for r in runs.fold_steps(spark.createDataFrame(rows, schema)).collect()}
    fetch, cleaned = steps["fetch"], steps["clean"]
    assert fetch["status"] == "running" and fetch["ended_at"] == at(2)
    assert (fetch["count"], fetch["note"], fetch["sequence"]) == (3, "done", 1)
    assert cleaned["ended_at"] == at(1) and cleaned["sequence"] == 9 and cleaned["position"] == 2


def test_health(spark):
    per_day = spark.createDataFrame(
        [(dt.date(2024, 1, 30), 101), (dt.date(2024, 1, 29), 100), (dt.date(2024, 1, 28), 0)],
        "day date, n long",
    )
    zero = [str(r["day"]) for r in health.zero_volume_days(per_day, AS_OF).orderBy("day").collect()]
    assert zero == ["2024-01-24", "2024-01-25", "2024-01-26", "2024-01-27"]  # 28 is a Sunday
    assert [str(r["day"]) for r in health.runaway_days(per_day).collect()] == ["2024-01-30"]
    empty = posts(spark, {}).limit(0)
    no_errors = spark.createDataFrame([], schemas.CLIENT_ERRORS)
    no_log = spark.createDataFrame([], "value string")
    found = health.health_findings(empty, no_errors, no_log, AS_OF)
    got = {r["check"] for r in found.collect()}
    assert got == {"zero_volume_days", "silent_platforms", "competitor_mentions"}
    assert health.verdict(found).first()["verdict"] == "NEEDS_ATTENTION"
    assert health.verdict(found.limit(0)).first()["verdict"] == "HEALTHY"


def test_log_scan(spark):
    lines = {
        "2024-01-23 ERROR": True, "2024-01-22 ERROR": False, "ERROR no date": True,
        "2024-13-45 BROKEN": True, "2024-01-30 error": False, "2024-01-30 INFO": False,
        "x 2024-01-01 then 2024-01-30 ERROR": False,
    }
    df = spark.createDataFrame([(k,) for k in lines], "value string")
    kept = {r["value"] for r in health.scan_log(df, AS_OF).collect()}
    assert kept == {k for k, v in lines.items() if v}


STORY = "objectID string, title string, story_title string, author string, created_at string, created_at_i bigint, story_text string"


def test_story_harvest(spark):
    now = 1706659200  # 2024-01-31
    rows = [
        ("1", "OCR fails", None, " bob ", "2024-01-30", now - 10, "<p>why&nbsp;</p> so"),
        ("2", "", "ocr twice", "", "2024-01-30", now - 20, None),
        ("3", " ", "OCR told", None, "2024-01-30", now - 30, None),
        (None, "OCR without id", None, None, "2024-01-30", now - 40, None),
        ("4", "OCR but old", None, None, "2024-01-20", now - 169 * 3600, None),
        ("5", "late OCR", None, None, "2024-01-30", now - 50, None),
        ("1", "ocr table extraction again", None, None, "2024-01-30", now - 60, None),
    ]
    found = harvest.harvest_stories(spark.createDataFrame(rows, STORY), AS_OF, k=4)
    got = {r["post_url"][-1]: r for r in found.collect()}
    # 3 has a blank title: it is not told by its second title, which only '' allows.
    assert set(got) == {"1", "2"}
    assert got["1"]["post_title"] == "OCR fails" and got["1"]["author_handle"] == "bob"
    assert got["1"]["body"] == "why&nbsp; so"
    assert got["2"]["post_title"] == "ocr twice" and got["2"]["author_handle"] is None


def test_question_harvest_marks_links_of_untitled(spark):
    now = 1706659200
    rows = [
        (" https://q/1 ", "  ", str(now - 1), ("a",), ["ocr"]),
        ("https://q/1", "Titled OCR", str(now - 2), ("a",), ["x"]),
        ("https://q/2", "Valuation", str(now - 3), None, [f"t{i}" for i in range(10)]),
        ("https://q/3", "OCR", "soon", None, []),
    ]
    schema = "link string, title string, creation_date string, owner struct<display_name:string>, tags array<string>"
    got = harvest.harvest_questions(spark.createDataFrame(rows, schema), AS_OF).collect()
    assert [r["post_url"] for r in got] == ["https://q/2"]
    assert got[0]["body"] == "Tags: " + ", ".join(f"t{i}" for i in range(8))
    assert got[0]["posted_at"] == "2024-01-30T23:59:57+00:00"


def test_micro_harvest_blank_text_does_not_mark(spark):
    made = "2024-01-30T00:00:00Z"
    rows = [
        ("at://x/1", ("ann", [("bot",)]), ("OCR", made)),
        ("at://x/2", ("ann", None), (" OCR ok ", made)),
        ("at://x/3", (None, []), ("OCR", made)),
        (None, ("ann", []), ("OCR", made)),
        ("at://x/4", ("ann", [("spam",)]), ("OCR", "yesterday")),
    ]
    schema = (
        "uri string, author struct<handle:string,labels:array<struct<val:string>>>, "
        "record struct<text:string,createdAt:string>"
    )
    got = harvest.harvest_micro_posts(spark.createDataFrame(rows, schema), AS_OF).collect()
    assert [(r["post_url"], r["author_handle"], r["post_title"]) for r in got] == [
        ("https://bsky.app/profile/ann/post/2", "@ann", "OCR ok")
    ]


def test_newest_per_query_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as query", "id as _at", "cast(id as string) as t")
    top = harvest.newest_per_query(df.unionByName(df), 2, "t")
    assert [(r["query"], r["rank"], r["t"]) for r in top.orderBy("query", "rank").collect()] == [
        (0, 1, "99"), (0, 2, "96"), (1, 1, "97"), (1, 2, "94"), (2, 1, "98"), (2, 2, "95"),
    ]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "partial_max" in plan


def test_classifier_cannot_add_urls(spark):
    seen = candidates(spark, {"post_url": "https://a.example/1"}, {"post_url": "https://a.example/2"})

    def predict(batch):
        out = batch[["post_url"]].assign(summary="s", opportunity="o")
        out["categories"] = [["OCR"]] * len(out)
        extra = out.assign(post_url="https://made.up/")
        import pandas as pd

        return pd.concat([out[out.post_url.str.endswith("2")], extra])

    got = records.classify(seen, None, predict).collect()
    assert [(r["post_url"], r["seq"], r["summary"]) for r in got] == [("https://a.example/2", 1, "s")]


@pytest.mark.parametrize("size", [1, 2, 10_000])
def test_copies_keep_their_own_payload_in_any_batch(spark, size):
    rows = [{"post_url": f"https://a.example/{i % 2}", "post_title": f"t{i}"} for i in range(6)]

    def predict(batch):
        out = batch[["post_url"]].assign(summary=batch["post_title"], opportunity="o")
        out["categories"] = [["OCR"]] * len(out)
        return out

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        got = records.classify(candidates(spark, *rows).coalesce(1), None, predict).collect()
    finally:
        spark.conf.set(name, old)
    assert sorted((r["seq"], r["summary"]) for r in got) == [(i, f"t{i}") for i in range(6)]


def test_classifier_is_not_called_without_candidates(spark):
    def predict(batch):
        raise AssertionError("called")

    assert records.classify(candidates(spark, {}).limit(0), None, predict).count() == 0


def test_missing_column_gets_its_default(spark):
    df = spark.createDataFrame([(1,)], "id long")
    assert runs.with_default_array(df, "competitors").first()["competitors"] == []


def test_resolving(spark):
    table = runs.error_rows(
        spark.createDataFrame(
            [("e1", dt.datetime(2024, 1, 1), "P", "s", None, None, None, None),
             ("e2", dt.datetime(2024, 1, 1), "P", "s", None, "m" * 900, None, "r")],
            "id string, at timestamp, product string, script string, mode string, message string, "
            "traceback string, run_id string",
        )
    )
    done = runs.resolve_errors(
        table,
        spark.createDataFrame(
            [("e1", None, dt.datetime(2024, 1, 2), 1), ("zz", "x", dt.datetime(2024, 1, 2), 2)],
            "id string, resolved_by string, at timestamp, seq long",
        ),
    )
    got = {r["id"]: r for r in done.collect()}
    assert got["e1"]["resolved"] and got["e1"]["resolved_by"] == "frontend" and got["e1"]["message"] == ""
    assert not got["e2"]["resolved"] and len(got["e2"]["message"]) == 500


def test_fixed_lists():
    assert (len(refdata.KEYWORDS), len(refdata.TAGS), len(refdata.TITLE_PHRASES)) == (45, 9, 32)
    assert (len(refdata.CATEGORIES), len(refdata.TRACKING_PARAMS)) == (17, 20)
