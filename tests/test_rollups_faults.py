"""Roll-ups against the reports they replace, failures as data, files of several schemas."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from threadsift import schemas
from threadsift.operators import health, records, reports
from threadsift.plans import catalog, fixtures as fx, jobs
from threadsift.sources import landed

SMALL = "/root/testdata/sf0.001"
AS_OF = fx.AS_OF


@pytest.fixture(scope="module")
def posts(spark):
    odd = spark.createDataFrame(
        [("z1", None, None, None, None, None), ("z2", "x", "new", ["a", None, "a"], [], None)],
        "id string, platform string, status string, categories array<string>, competitors array<string>, discovered_at timestamp",
    )
    columns = odd.columns
    return fx.posts(spark, SMALL).select(*columns).unionByName(odd)


def rows(df, *columns):
    return sorted(map(str, df.select(*(columns or df.columns)).collect()))


def test_rollup_gives_the_reports(posts):
    rollup = reports.roll_up(posts)
    direct = reports.count_by(posts, F.col("platform"), "platform")
    assert rows(reports.rolled_counts(rollup, F.col("platform"), "platform")) == rows(direct)
    assert rows(reports.rolled_topics(rollup)) == rows(reports.topic_counts(posts))
    assert rows(reports.rolled_days(rollup)) == rows(reports.posts_per_day(posts))
    cards = reports.stat_cards(posts).first()
    own = rollup.where("of_post")
    assert own.agg(F.sum("n")).first()[0] == cards["total"]
    assert own.where("competitor").agg(F.sum("n")).first()[0] == cards["competitors"]


def test_rollups_of_parts_merge(posts):
    parts = [posts.where(c) for c in ("platform = 'x'", "platform <> 'x'", "platform IS NULL")]
    merged = reports.merge_rollups(*map(reports.roll_up, parts))
    assert rows(merged, *reports.ROLLUP_KEYS, "n", "newest", "seen") == rows(
        reports.roll_up(posts), *reports.ROLLUP_KEYS, "n", "newest", "seen"
    )


def _scans(df, path):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(path in line for line in plan.splitlines() if "FileScan" in line)


def test_each_source_is_scanned_once(spark, tmp_path, monkeypatch):
    paths = {n: str(tmp_path / n) for n in ("posts", "errors", "log")}
    fx.posts(spark, SMALL).write.parquet(paths["posts"])
    fx.client_errors(spark, SMALL).write.parquet(paths["errors"])
    fx.log_lines(spark, SMALL).write.parquet(paths["log"])
    tables = [spark.read.parquet(p) for p in paths.values()]
    seen = []
    for module in (reports, health):
        keep = module.written
        monkeypatch.setattr(module, "written", lambda df, label, keep=keep: (seen.append(df), keep(df, label))[1])
    seen.append(health.health_findings(*tables, AS_OF))
    assert [sum(_scans(df, p) for df in seen) for p in paths.values()] == [1, 1, 1]
    seen.clear()
    seen.append(reports.daily_summary(tables[0], AS_OF))
    assert sum(_scans(df, paths["posts"]) for df in seen) == 1


def test_days_without_posts_by_key(spark):
    per_day = spark.createDataFrame(
        [("a", "2024-01-29", 1), ("a", "2024-01-30", 0), (None, "2024-01-26", 2), ("b", "2023-01-01", 1)], "k string, d string, n long"
    ).select("k", F.to_date("d").alias("day"), "n")
    got = {(r["k"], str(r["day"])[-2:]) for r in health.zero_volume_days_by(per_day, "k", AS_OF).collect()}
    days = {"24", "25", "26", "27", "29", "30"}  # the 28th is a Sunday
    assert got == {("a", d) for d in days - {"29"}} | {(None, d) for d in days - {"26"}} | {("b", d) for d in days}


def candidates(spark, n=200):
    none = "cast(NULL AS array<string>)"
    return spark.range(n).selectExpr(
        "id AS seq", "'x' AS platform", "concat('u', id) AS post_url", "concat('t', id) AS post_title", "'h' AS author_handle",
        "cast(NULL AS string) AS posted_at", "cast(NULL AS string) AS summary", "cast(NULL AS string) AS opportunity",
        f"{none} AS categories", f"{none} AS competitors",
    )


def picky():
    """A model that fails on some rows and keeps every other one that it takes."""

    def predict(batch):
        bad = batch["post_title"].isin([f"t{i}" for i in (0, 7, 8, 64, 199)])
        if bad.any():
            raise RuntimeError("no answer")
        kept = batch[batch["post_title"].str[1:].astype(int) % 2 == 0]
        return pd.DataFrame({"post_url": kept["post_url"], "summary": "s", "opportunity": "", "categories": [["OCR"]] * len(kept)})

    return predict


@pytest.mark.parametrize("size", [1, 3, 64, 10_000])
def test_failures_take_no_other_row_with_them(spark, size):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
    try:
        found = records.classify_or_fault(candidates(spark).repartition(2), None, picky()).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["seq"] for r in found if r["fault"]} == {0, 7, 8, 64, 199}
    assert {r["fault"] for r in found if r["fault"]} == {"RuntimeError: no answer"}
    assert {r["seq"] for r in found if not r["fault"]} == {i for i in range(200) if i % 2 == 0} - {0, 8, 64}
    assert len(found) == 102 and all(r["categories"] == (None if r["fault"] else ["OCR"]) for r in found)


def test_a_model_that_always_fails_ends_nothing(spark):
    def broken(batch):
        raise KeyError("gone")

    found = records.classify_or_fault(candidates(spark, 20), None, broken)
    assert found.where("fault IS NOT NULL").count() == found.count() == 20
    assert records.classify_or_fault(candidates(spark, 0), None, broken).count() == 0


def test_a_failing_source_drops_only_itself(spark, tmp_path):
    def gone():
        return spark.read.schema(schemas.STORY_HIT).json(str(tmp_path / "gone"))

    pools, failed = jobs.gather(spark, {"a": lambda: spark.range(3), "b": gone, "c": lambda: spark.range(1 / 0)})
    assert list(pools) == ["a"] and pools["a"].count() == 3
    assert {(r["source"], r["message"].split(":")[0]) for r in failed.collect()} == {("b", "AnalysisException"), ("c", "ZeroDivisionError")}


def test_native_pools_go_on_without_a_source(spark):
    broken = fx.question_items(spark, SMALL).withColumn("title", F.raise_error(F.lit("lost page")).cast("string"))
    options = {"hours": catalog.ALL_HOURS}
    predict = catalog.refusing(records.keyword_rules({"OCR": ["e"]}), "ab")
    args = (fx.micro_posts(spark, SMALL), predict, AS_OF)
    whole, refused = jobs.native_pools(fx.story_hits(spark, SMALL), fx.question_items(spark, SMALL), *args, **options)
    found, failed = jobs.native_pools(fx.story_hits(spark, SMALL), broken, *args, **options)
    assert {r["source"] for r in refused.collect()} <= {"classify"}
    assert {r["source"] for r in failed.collect()} >= {"questions"}
    assert rows(found, "post_url") == rows(whole.where("platform <> 'stackoverflow'"), "post_url")


def test_files_of_several_schemas(spark, tmp_path):
    path, none = str(tmp_path / "t"), F.array().cast("array<string>")
    old = spark.createDataFrame([("a", 1)], "id string, n int")
    new = spark.createDataFrame([("b", ["x"]), ("c", None)], "id string, competitors array<string>")
    old.write.parquet(path)
    defaults = {"competitors": none, "status": F.lit("new")}
    assert [tuple(r) for r in landed.evolved(spark, path, defaults).select("id", "competitors", "status").collect()] == [("a", [], "new")]
    new.write.mode("append").parquet(path)
    got = landed.evolved(spark, path, defaults).select("id", "n", "competitors", "status").collect()
    assert sorted(map(tuple, got)) == [("a", 1, [], "new"), ("b", None, ["x"], "new"), ("c", None, [], "new")]
