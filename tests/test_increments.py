"""Mergeable states, kept winners, the phrase index and lines in file order."""

import datetime as dt
import random

import pyarrow as pa
from pyspark.sql import functions as F

from threadsift import schemas
from threadsift.functions import phrases as index
from threadsift.operators import harvest, health, runs
from threadsift.sources import landed
from tests.conftest import SMALL


def _steps(spark, rows):
    return spark.createDataFrame(rows, schemas.STEP_EVENTS)


def _events(n):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    return [
        (str(i % 7), rng.choice("abc"), rng.choice(["running", "success", "failed"]), rng.choice([None, i]),
         rng.choice([None, f"note {i}"]), rng.choice([None, 3]), start + dt.timedelta(minutes=rng.randrange(40)), i)
        for i in range(n)
    ]


def test_states_of_parts_merge_to_the_state_of_all(spark):
    rows = _events(300)
    random.Random(1).shuffle(rows)
    whole = runs.fold_steps(_steps(spark, rows)).collect()
    parts = [runs.step_states(_steps(spark, rows[i::3])) for i in range(3)]
    again = runs.step_states(_steps(spark, rows[:50]))  # taken in a second time
    merged = runs.merge_steps(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(again))
    assert sorted(runs.steps_of(merged).collect()) == sorted(whole)


def test_merged_states_merge_on(spark):
    rows = _events(90)
    a, b, c = (runs.step_states(_steps(spark, rows[i::3])) for i in range(3))
    once = runs.merge_steps(runs.merge_steps(a.unionByName(b)).unionByName(c))
    assert sorted(runs.steps_of(once).collect()) == sorted(runs.fold_steps(_steps(spark, rows)).collect())


def test_values_never_given_stay_null(spark):
    at = dt.datetime(2024, 1, 1)
    a = runs.step_states(_steps(spark, [("1", "a", "running", None, None, None, at, 1)]))
    b = runs.step_states(_steps(spark, [("1", "a", "running", None, "n", None, at, 2)]))
    row = runs.steps_of(runs.merge_steps(a.unionByName(b))).first()
    assert (row["count"], row["note"], row["ended_at"], row["status"]) == (None, "n", None, "running")
    assert runs.steps_of(runs.merge_steps(a.limit(0))).count() == 0


def _stories(spark, rows):
    return spark.createDataFrame(
        [(key, f"OCR {key}", None, "x", "2024-01-01", at, "OCR") for key, at in rows], schemas.STORY_HIT
    )


def test_winners_and_new_items_harvest_like_everything(spark):
    rng, base = random.Random(3), 1706600000
    rows = [(rng.choice([None, "", *map(str, range(60))]), base + rng.randrange(5000)) for _ in range(200)]
    as_of, options = "2024-01-31 00:00:00", {"hours": 10000, "k": 7, "keywords": ["ocr", "1"]}
    kept = _stories(spark, rows[:0])
    for i in range(0, 200, 50):
        kept = harvest.story_winners(kept.unionByName(_stories(spark, rows[i : i + 50])), as_of, **options)
    assert kept.count() <= 14
    got, want = (harvest.harvest_stories(h, as_of, **options).collect() for h in (kept, _stories(spark, rows)))
    assert sorted(got, key=str) == sorted(want, key=str) and want


def _both(spark, docs, phrases):
    found = [
        sorted((r["id"], r["query"]) for r in match(docs, "text", phrases).collect())
        for match in (harvest.match_phrases, harvest.match_many_phrases)
    ]
    assert found[0] == found[1]
    return found[0]


def test_phrase_index_on_odd_texts(spark):
    texts = [None, "", " ", "foo", " foo", "foo ", "xfoo bary", "foo  bar", "foo\nbar", "FOO BAR", "a foo bar b",
             "über Größe", "it's 'quoted' \\ back", "😀 😀x", "foofoo foofoo"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    phrases = ["", " ", "foo", " foo", "foo ", "foo bar", "o b", "oo  ba", "foo\nbar", "größe", "R G", "'quoted' \\",
               "😀", "😀 😀", "foofoo", "foo", "nothing here", "a foo bar b"]
    assert len(_both(spark, docs, phrases)) > 40
    assert harvest.match_many_phrases(docs, "text", []).count() == 0
    assert harvest.match_many_phrases(docs.limit(0), "text", phrases).count() == 0


def test_ten_thousand_phrases_like_one_search_each(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(F.col("doc_id").alias("id"), "text").limit(60)
    words = [w for r in docs.collect() for w in (r["text"] or "").split()]
    rng = random.Random(9)
    phrases = []
    for _ in range(10_000):
        i = rng.randrange(len(words) - 3)
        text = " ".join(words[i : i + rng.randint(1, 3)])
        a = rng.randrange(len(text))
        phrases.append(text[a : a + rng.randint(3, 25)])
    low = [(r["id"], (r["text"] or "").lower()) for r in docs.collect()]
    want = sorted((i, q) for i, text in low for q, p in enumerate(phrases) if p.lower() in text)
    got = sorted((r["id"], r["query"]) for r in harvest.match_many_phrases(docs, "text", phrases).collect())
    assert got == want and len(got) > 10_000


def test_phrase_index_shuffles_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    plan = harvest.match_many_phrases(docs, "text", ["the of", "tion"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_phrase_index_reads_each_text_once(spark):
    """No arrays of words or anchors of a text, and no search for each phrase in it."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    plan = harvest.match_many_phrases(docs, "text", ["the of", "tion"])._jdf.queryExecution().executedPlan().toString()
    assert "zip_with" not in plan and "Contains" not in plan and "Broadcast" not in plan
    assert plan.count("MapInArrow") == 1


def test_phrases_at_the_ends_of_texts_and_chunks(monkeypatch):
    """Every size, common beginnings and ends, texts cut anywhere, and slices of batches."""
    rng = random.Random(2)
    text = "".join(rng.choice(["a", "b", "ab", "ü", "\0"]) for _ in range(900)) + "x" * 40
    phrases = [text[a : a + n] for n in range(1, 45) for a in rng.sample(range(890), 3)]
    phrases += ["", "x" * 16, "x" * 17, "x" * 41, "xxxxxxxxyxxxxxxxx", text, text + "x", phrases[0], "\0", "\0\0"]
    cuts = sorted(rng.sample(range(900), 40))
    texts = ["", *(text[a:b] for a, b in zip(cuts, cuts[3:])), "", text, "x" * 16, "xxxxxxxx", text[:5]]
    want = [[q for q, p in enumerate(phrases) if p in t] for t in texts]
    for chunk in (1, 7, 1 << 16):
        monkeypatch.setattr(index, "CHUNK", chunk)
        got = index.Phrases(phrases).hits(pa.array(["left out", *texts])[1:]).to_pylist()
        assert [sorted(g) for g in got] == want
    assert index.Phrases([]).hits(pa.array(["a", ""])).to_pylist() == [[], []]


def test_lines_keep_the_order_of_split_files(spark, tmp_path):
    lines = [f"ERROR {i} {'x' * (i % 50)}" for i in range(20_000)]
    (tmp_path / "a.log").write_text("\n".join(lines[:12_000]))
    (tmp_path / "b.log").write_text("\n".join(lines[12_000:]))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        for n in names:
            spark.conf.set(n, "50000")
        placed = landed.placed_lines(spark, str(tmp_path))
        assert placed.select("place.file", "place.split").distinct().count() > 8
        assert [r["value"] for r in placed.orderBy("place").collect()] == lines
        tail = health.tail_lines(health.scan_log(placed, "2024-01-31 00:00:00")).collect()
        assert [r["value"] for r in tail] == lines[:-16:-1]
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
