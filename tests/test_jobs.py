"""Sources, the day table, the scheduled jobs and the streams."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from threadsift import schemas, session
from threadsift.operators import clean, dedup, records, reports, views
from threadsift.plans import fixtures as fx, jobs
from threadsift.sources import landed
from threadsift.streaming import ingest, intake
from tests.test_operators import candidates, posts

AS_OF = "2024-01-31 00:00:00"


@pytest.fixture
def table(spark, tmp_path):
    return jobs.post_table(spark, str(tmp_path / "posts"))


class _Session:
    """A session as far as the shared folder asks it."""

    def __init__(self, master, named=None):
        self.conf, self.sparkContext, self.master = self, self, master
        self.named, self.checkpoint = named, None

    def get(self, key, default):
        return self.named if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = path


def test_shared_folder_is_the_one_the_cluster_names():
    assert session.work_dir(_Session("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    with pytest.raises(ValueError):
        session.shared_dir(_Session("yarn"))
    local = _Session("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local) == local.checkpoint


def test_day_table_reads_the_latest_version_of_each_day(spark, table):
    rows = posts(
        spark, {"discovered_at": "2024-01-01 10:00:00"}, {"discovered_at": "2024-01-02 10:00:00"}
    )
    assert table.read().isEmpty()
    table.write(rows)
    table.write(rows.filter("id = '1'").withColumn("status", F.lit("replied")))
    assert table.versions() == [1, 2]
    got = {r["id"]: r["status"] for r in table.read().collect()}
    assert got == {"0": "new", "1": "replied"}
    assert [r["id"] for r in table.read(["2024-01-01", "2024-02-01"]).collect()] == ["0"]


def _scan(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "FileScan" in line]


def test_views_filter_and_prune_in_the_scan(spark, table):
    table.write(posts(spark, {"discovered_at": "2024-01-01 10:00:00"}, {}))
    stored = table.read()
    (queue,) = _scan(views.active_queue(stored).select("id", "discovered_at"))
    assert "EqualTo(status,new)" in queue
    assert "ReadSchema: struct<id:string,status:string,discovered_at:timestamp>" in queue
    window = views.report_window(stored, cutoff="2024-01-02", cap=None)
    (topics,) = _scan(reports.top_topics(window))
    assert "GreaterThanOrEqual(discovered_at,2024-01-02" in topics
    assert "ReadSchema: struct<id:string,categories:array<string>,discovered_at:timestamp>" in topics
    (cards,) = _scan(reports.stat_cards(window))
    assert "ReadSchema: struct<competitors:array<string>,status:string,discovered_at:timestamp>" in cards
    (count,) = _scan(views.row_count(stored))
    assert "ReadSchema: struct<>" in count
    assert all("day=2024-01-30" in f for f in table.since("2024-01-02").inputFiles())


def test_small_batch_does_not_shuffle_the_store(spark, table, tmp_path):
    table.write(posts(spark, {}, {}))
    batch = session.written(candidates(spark, {}), "small")
    known = dedup.stored_urls(batch, table.read())
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_unfinished_version_is_not_read(spark, table):
    rows = posts(spark, {})
    table.write(rows)
    table.write(rows.withColumn("status", F.lit("replied")))
    os.remove(f"{table.root}/version=2/_SUCCESS")
    assert table.versions() == [1]
    assert table.read().first()["status"] == "new"
    assert table.write(rows) == 3


def test_discover_is_idempotent_and_merges(spark, table):
    raw = candidates(
        spark, {}, {"post_url": "https://a.example/1/", "competitors": ["uipath"]},
        {"post_url": "https://a.example/2"}, {"post_url": "ftp://x"},
    )
    first = jobs.discover(table, raw, AS_OF)
    assert first == {"pool": 4, "dropped": 1, "distinct": 2, "inserted": 2, "merged": 0}
    again = jobs.discover(table, raw, "2024-02-01 00:00:00")
    assert (again["inserted"], again["merged"]) == (0, 0)
    assert table.versions() == [1]
    more = candidates(
        spark, {"competitors": ["Reducto"]}, {"post_url": "https://a.example/3"}
    )
    third = jobs.discover(table, more, "2024-02-01 00:00:00")
    assert (third["inserted"], third["merged"]) == (1, 1)
    got = {r["post_url"][-1]: r for r in table.read().collect()}
    assert got["1"]["competitors"] == ["Reducto", "UiPath"]
    assert got["1"]["discovered_at"] == dt.datetime(2024, 1, 31)
    assert got["3"]["discovered_at"] == dt.datetime(2024, 2, 1) and len(got) == 3


def test_later_priority_copy_does_not_raise_a_stored_row(spark, table):
    jobs.discover(table, candidates(spark, {}), AS_OF)
    jobs.discover(table, candidates(spark, {"platform": "ade"}), AS_OF)
    assert table.read().first()["platform"] == "x"


def test_combine_keeps_pool_order(spark):
    a = candidates(spark, {"post_title": "a0"}, {"post_title": "a1"})
    b = jobs.priority(candidates(spark, {"post_title": "b0"}))
    merged = dedup.merge_copies(jobs.combine(a, b)).first()
    assert merged["post_title"] == "a0" and merged["platform"] == "ade"


def test_whole_discovery(spark, table, tmp_path):
    """Landed pages and model responses through to the store."""
    at = 1706655600
    _lines(
        tmp_path / "s.json",
        {"hits": [{"objectID": "1", "title": "OCR is hard", "created_at_i": at, "created_at": "2024-01-30T23:00:00Z"},
                  {"objectID": "2", "title": "OCR of nothing", "created_at_i": at}]},
    )
    _lines(
        tmp_path / "q.json",
        {"items": [{"link": "https://q/9", "title": "Why", "creation_date": at, "tags": ["ocr", "hard"]}]},
    )
    _lines(tmp_path / "m.json", {"posts": []})
    post = {"platform": "Reddit", "post_url": "https://r.example/7/?utm_source=x", "post_title": "T", "summary": "S",
            "categories": ["IDP"]}
    ours = {**post, "post_url": "https://q/9", "competitors": ["uipath"]}
    _lines(tmp_path / "a.json", {"output_text": json.dumps({"posts": [post, {"platform": "x"}]})})
    _lines(tmp_path / "b.json", {"output_text": json.dumps({"posts": [ours]})})

    native = jobs.native_pool(
        landed.story_hits(spark, str(tmp_path / "s.json")),
        landed.questions(spark, str(tmp_path / "q.json")),
        landed.micro_posts(spark, str(tmp_path / "m.json")),
        records.keyword_rules({"OCR": ["hard"]}), AS_OF,
    )
    model = jobs.model_pool(landed.model_responses(spark, str(tmp_path / "a.json")))
    own = jobs.priority(jobs.model_pool(landed.model_responses(spark, str(tmp_path / "b.json"))))
    counts = jobs.discover(table, jobs.combine(native, model, own), AS_OF)
    assert counts == {"pool": 4, "dropped": 0, "distinct": 3, "inserted": 3, "merged": 0}
    got = {r["post_url"]: (r["platform"], r["categories"], r["competitors"]) for r in table.read().collect()}
    assert got == {
        "https://news.ycombinator.com/item?id=1": ("hackernews", ["OCR"], []),
        "https://q/9": ("ade", ["OCR"], ["UiPath"]),
        "https://r.example/7": ("reddit", ["IDP"], []),
    }
    assert table.since("2024-01-31").count() == 3 and table.since("2024-02-01").isEmpty()


def test_archive_and_act_rewrite_only_their_days(spark, table):
    table.write(
        posts(
            spark, {"discovered_at": "2024-01-01 10:00:00"},
            {"discovered_at": "2024-01-30 10:00:00"},
            {"discovered_at": "2024-01-02 10:00:00", "status": "replied"},
        )
    )
    assert jobs.archive(table, AS_OF) == 1
    assert os.listdir(f"{table.root}/version=2").count("day=2024-01-01") == 1
    assert not [n for n in os.listdir(f"{table.root}/version=2") if n in ("day=2024-01-02", "day=2024-01-30")]
    assert jobs.archive(table, AS_OF) == 0
    actions = spark.createDataFrame(
        [("1", "completed", "ann", "2024-01-31 09:00:00", 1), ("9", "new", "x", AS_OF, 2)],
        "id string, status string, user string, at string, seq long",
    ).withColumn("at", F.col("at").cast("timestamp"))
    assert jobs.act(table, actions) == 1
    got = {r["id"]: r["status"] for r in table.read().collect()}
    assert got == {"0": "archived", "1": "completed", "2": "replied"}


def test_digest_marks_delivered_groups_only(spark, tmp_path):
    rows = fx.client_errors(spark, "/root/testdata/sf0.001")
    table = jobs.error_table(spark, str(tmp_path / "errors"))
    table.write(rows)
    waiting = rows.filter("alerted_at is null").count()
    told = jobs.digest(table, lambda g: g.filter("message <> 'Boom 3'"), AS_OF)
    left = table.read().filter("alerted_at is null")
    assert told + left.count() == waiting and told > 0
    assert {r["message"] for r in left.select("message").distinct().collect()} == {"Boom 3"}
    assert jobs.digest(table, lambda g: g.limit(0), AS_OF) == 0


def _lines(path, *items):
    path.write_text("".join(json.dumps(i) + "\n" for i in items))


def test_landed_pages(spark, tmp_path):
    _lines(
        tmp_path / "s.json",
        {"hits": [{"objectID": "1", "title": "OCR", "created_at_i": 5}, {"objectID": None}], "n": 1},
        {"hits": []},
    )
    assert [r["objectID"] for r in landed.story_hits(spark, str(tmp_path / "s.json")).collect()] == ["1", None]
    _lines(tmp_path / "q.json", {"items": [{"link": "l", "creation_date": 7, "owner": {"display_name": "d"}, "tags": ["t"]}]})
    row = landed.questions(spark, str(tmp_path / "q.json")).first()
    assert row["creation_date"] == "7" and row["owner"]["display_name"] == "d" and row["tags"] == ["t"]
    _lines(
        tmp_path / "m.json",
        {"posts": [{"uri": "u", "author": {"handle": "h", "labels": [{"val": "bot"}]}, "record": {"text": "t"}}]},
    )
    row = landed.micro_posts(spark, str(tmp_path / "m.json")).first()
    assert row["author"]["labels"][0]["val"] == "bot" and row["record"]["createdAt"] is None


def test_landed_model_responses(spark, tmp_path):
    post = {"platform": "x", "post_url": "u", "post_title": "t", "summary": "s"}
    text = "Sure!\n" + json.dumps({"summary": "two", "posts": [post, {**post, "post_url": 5}]})
    _lines(tmp_path / "r.json", {"output_text": text}, {"output": []}, {"output_text": "[1]"})
    parsed = records.parse_batches(
        landed.model_responses(spark, str(tmp_path / "r.json")), "payload", "response_id"
    )
    every = records.batch_records(parsed, "response_id")
    assert [r["fault"] for r in every.orderBy("pos").collect()] == [None, "post_url"]
    assert records.valid_records(every).count() == 1
    faults = records.batch_faults(parsed, "response_id")
    assert sorted(r["fault"] for r in faults.collect()) == ["no_object", "no_text"]
    assert [r["summary"] for r in records.batch_summaries(parsed, "response_id").collect()] == ["two"]


def test_stream_ingest_equals_batch_steps(spark, table, tmp_path):
    landing, check = str(tmp_path / "in"), str(tmp_path / "check")
    raw = fx.posts_raw(spark, "/root/testdata/sf0.001")
    raw.write.json(landing)
    ingest.ingest_now(table, landing, check, AS_OF)
    batch = dedup.merge_copies(clean.clean(raw, AS_OF))
    columns = ["post_url", "platform", "post_title", "categories", "competitors"]
    want = sorted(map(str, batch.select(*columns).collect()))
    assert sorted(map(str, table.read().select(*columns).collect())) == want
    # Nothing new landed; then the same rows land again.
    ingest.ingest_now(table, landing, check, AS_OF)
    raw.write.mode("append").json(landing)
    ingest.ingest_now(table, landing, check, AS_OF, files_per_batch=2)
    assert sorted(map(str, table.read().select(*columns).collect())) == want
    assert table.versions() == [1]


def test_limited_stream_goes_on_where_it_ended(spark, tmp_path):
    landing, out, check = (str(tmp_path / n) for n in ("landing", "out", "check"))
    kind = "k string, t timestamp, n long"
    for lo in (0, 40, 80):
        rows = spark.range(lo, lo + 40).selectExpr(
            "if(id % 2 = 0, 'a', NULL) AS k", "timestamp_seconds(id * 10) AS t", "id AS n"
        )
        rows.write.mode("append").parquet(landing)
        for _ in range(2):  # the second run finds nothing new
            stream = landed.report_stream(spark, landing, kind)
            intake.limited_stream(
                stream, out, check, keys=["k"], at="t", order="n", cap=2, window_seconds=100, keep_seconds=3600
            ).awaitTermination()
    got = sorted(r["n"] for r in intake.accepted_rows(spark.read.parquet(landing), out, "n").collect())
    expected = [n for base in (0, 1) for n in _limited([*range(base, 120, 2)])]
    assert got == sorted(expected)


def test_limited_stream_in_many_batches(spark, tmp_path):
    """Micro-batches of one file each, late rows judged on arrival, and a run that fails
    inside a micro-batch, after its offsets were logged, and starts again."""
    import numpy as np
    import pandas as pd

    from tests.test_ratelimit import State

    landing, out, check = (str(tmp_path / n) for n in ("landing", "out", "check"))
    second, rng, expected = 1_000_000, np.random.default_rng(2), set()
    states, rule = {k: State() for k in "abc"}, intake.limiter(3, 500 * second)
    kind = "k string, t timestamp, n long, p string"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "150")

    def run(stream):
        intake.limited_stream(
            stream, out, check, keys=["k"], at="t", order="n", cap=3, window_seconds=500
        ).awaitTermination()

    try:
        for lo, start in ((0, 0), (2000, 900), (4000, 300), (6000, 1500), (8000, 1400)):
            rows = [
                (str(k), int(t), i) for i, (k, t) in enumerate(
                    zip(rng.choice(["a", "a", "a", "b"] + ["c"] * (lo == 0), 2000), start + rng.integers(0, 1000, 2000)), lo
                )
            ]
            frame = spark.createDataFrame(rows, "k string, s long, n long").coalesce(1)
            frame.selectExpr("k", "timestamp_seconds(s) AS t", "n", "repeat('payload', 9) AS p").write.mode("append").parquet(landing)
            stream = landed.report_stream(spark, landing, kind, batch_bytes=1)
            if lo in (2000, 6000):
                broken = stream.withColumn("n", F.when(F.col("n") == lo + 1500, F.raise_error(F.lit("lost"))).otherwise(F.col("n")))
                with pytest.raises(Exception, match="lost"):
                    run(broken)
            if lo != 6000:  # the last three files come as three micro-batches of one run
                run(stream)
            for k in "abc":
                own = pd.DataFrame([(t * second, i) for x, t, i in rows if x == k], columns=["_t", "_id"])
                if len(own):
                    expected |= {int(i) for part in rule((k,), iter([own]), states[k]) for i in part["_id"]}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = intake.accepted_rows(spark.read.parquet(landing), out, "n").collect()
    assert {r["n"] for r in got} == expected and len(got) == len(expected)
    assert all(r["p"] == "payload" * 9 for r in got)


def test_unseen_keys_leave_the_state(spark, tmp_path):
    """After ``keep_seconds`` a key is new again."""
    import time

    landing, out, check = (str(tmp_path / n) for n in ("landing", "out", "check"))
    for n in range(2):
        spark.createDataFrame([("a", n)], "k string, n long").selectExpr("k", "timestamp_seconds(n) AS t", "n").write.mode("append").parquet(landing)
        if n:
            time.sleep(3)
            spark.createDataFrame([("b", 5)], "k string, n long").selectExpr("k", "timestamp_seconds(n) AS t", "n").write.mode("append").parquet(landing)
        stream = landed.report_stream(spark, landing, "k string, t timestamp, n long", batch_bytes=1)
        intake.limited_stream(
            stream, out, check, keys=["k"], at="t", order="n", cap=1, window_seconds=500, keep_seconds=1
        ).awaitTermination()
    assert {r["_id"] for r in spark.read.parquet(out).collect()} >= {0, 5}


def test_digest_stream_marks_once(spark, tmp_path):
    """A run that fails while it marks, after its log was written, delivers nothing again
    and marks what was not marked; ids twice in a batch multiply nothing."""
    kept = jobs.error_table(spark, str(tmp_path / "errors"))
    landing, out, check = (str(tmp_path / n) for n in ("landing", "out", "check"))
    rows = spark.range(12).selectExpr(
        "cast(id AS string) AS id", "timestamp_seconds(id * 40000) AS occurred_at", "concat('m', id % 3) AS message",
        "'s' AS stack", "'u' AS page_url", "'a' AS user_agent", "concat('f', id % 3) AS fingerprint",
        "if(id = 6, timestamp_seconds(5), NULL) AS alerted_at",
    )
    kept.write(rows)
    rows.union(rows.where("id = '3'")).write.parquet(landing)
    sent = []

    def deliver(groups):
        found = groups.where("fingerprint <> 'f1'")
        sent.append(sorted(tuple(r) for r in found.select("batch", "fingerprint", "occurrences").collect()))
        return found

    def run():
        intake.digest_stream(
            landed.report_stream(spark, landing, rows.schema), out, check, table=kept, deliver=deliver, as_of=AS_OF
        ).awaitTermination()

    whole = kept.write
    kept.write = lambda df: 1 / 0
    with pytest.raises(Exception, match="division"):
        run()
    kept.write = whole
    run()
    run()
    assert sent == [[(0, "f0", 4), (0, "f2", 4)]]
    marks = {r["id"]: r["alerted_at"] for r in kept.read().collect()}
    assert len(marks) == 12 and kept.read().count() == 12
    told = [k for k, v in marks.items() if v is not None and str(v).startswith(AS_OF[:10])]
    assert sorted(told, key=int) == ["0", "2", "3", "5", "8", "9", "11"] and marks["6"].year == 1970
    assert all(marks[k] is None for k in ("1", "4", "7", "10"))


def _limited(seconds, cap=2, window=10):
    kept = []
    for n in seconds:
        if len(kept) < cap or kept[-cap] <= n - window:
            kept.append(n)
    return kept


def test_schemas_parse():
    from pyspark.sql.types import StructType

    for name in ("POSTS", "CANDIDATE", "CLIENT_ERRORS", "PIPELINE_RUNS", "PIPELINE_ERRORS", "STEP_EVENTS"):
        assert StructType.fromDDL(getattr(schemas, name)).fields
