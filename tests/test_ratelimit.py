"""The accepted-only limiter against a plain loop, in all its paths."""

import random
from collections import deque

import pandas as pd
import pytest
from pyspark.sql import functions as F

from threadsift.operators import errors, ratelimit as R
from threadsift.streaming import intake

SECOND = 1_000_000


def loop(rows, cap, window_us):
    recent, out = {}, set()
    for k, t, i in sorted(rows):
        mine = recent.setdefault(k, deque(maxlen=cap))
        if len(mine) < cap or mine[0] <= t - window_us:
            mine.append(t)
            out.add(i)
    return out


def some_rows(n, span_s, step_us, seed, hot_share=0.6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < hot_share else f"k{rng.randrange(20)}"
        rows.append((key, int(rng.random() * span_s * SECOND) // step_us * step_us, i))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "_k string, _t long, _id long")


def ids(df):
    return {r["_id"] for r in df.select("_id").collect()}


CASES = [
    # cap, window s, rows, span s, granularity us
    (1, 60, 4000, 8000, 1),
    (3, 100, 4000, 2000, 1),
    (20, 3600, 6000, 40000, 1),
    (20, 3600, 6000, 20000, 10 * SECOND),
    (2, 7, 3000, 300, SECOND),
]


@pytest.mark.parametrize("cap, window, n, span, step", CASES)
@pytest.mark.parametrize("slots", [1, 16, 4096])
def test_equals_loop(spark, cap, window, n, span, step, slots):
    rows = some_rows(n, span, step, seed=cap * 31 + window)
    got = ids(R.accepted_keys(frame(spark, rows), cap, window, slots))
    assert got == loop(rows, cap, window * SECOND)


def test_thinning_keeps_all_accepted_and_drops_most_others(spark):
    rows = [("hot", i * 1000, i) for i in range(60_000)]  # a row per ms for a minute
    left = ids(R.thin(frame(spark, rows), 5, 10 * SECOND, slots=1024))
    assert loop(rows, 5, 10 * SECOND) <= left
    assert len(left) < 500


def test_never_more_than_cap_in_any_window(spark):
    rows = some_rows(5000, 5000, 1, seed=9)
    accepted = R.accepted_keys(frame(spark, rows), 4, 120).collect()
    times = {}
    for r in accepted:
        times.setdefault(r["_k"], []).append(r["_t"])
    for mine in times.values():
        mine.sort()
        assert all(b - a >= 120 * SECOND for a, b in zip(mine, mine[4:]))


def test_boundaries(spark):
    def run(times, cap, window):
        rows = [("a", int(t * SECOND), i) for i, t in enumerate(times)]
        return sorted(ids(R.accepted_keys(frame(spark, rows), cap, window)))

    assert run([0, 59.999999, 60, 119, 120], 1, 60) == [0, 2, 4]
    # The 21st within the hour is dropped, the one exactly an hour later is not.
    assert run([*range(21), 3600], 20, 3600) == [*range(20), 21]
    # An event dropped does not count: 70 is measured from 0, not from 30.
    assert run([0, 30, 70], 1, 60) == [0, 2]


def test_ties_go_by_order_column(spark):
    rows = [("a", 0, i) for i in (5, 3, 9)]
    assert ids(R.accepted_keys(frame(spark, rows), 2, 60)) == {3, 5}


def test_keys_keep_null_and_empty_apart(spark):
    df = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, None, "x"), (4, "a", "bc"), (5, "ab", "c")],
        "n long, s string, f string",
    ).withColumn("at", F.timestamp_seconds(F.col("n")))
    kept = R.drop_repeats(df, ["s", "f"], "at", "n", 60)
    assert sorted(r["n"] for r in kept.collect()) == [1, 2, 4, 5]


class State:
    """Stands for Spark's state of one key."""

    hasTimedOut = False

    def __init__(self):
        self.value = None

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def arrive(run, state, rows, chunk=None):
    batch = pd.DataFrame(rows, columns=["_k", "_t", "_id"])
    parts = [batch[i : i + (chunk or len(batch))] for i in range(0, len(batch), chunk or len(batch))]
    return {int(i) for out in run(("k",), iter(parts), state) for i in out["_id"]}


def test_batches_with_state_equal_one_batch():
    rows = sorted(some_rows(3000, 6000, 1, seed=4, hot_share=1), key=lambda r: r[1])
    run, state, got = intake.limiter(3, 200 * SECOND), State(), set()
    for lo, hi in ((0, 700), (700, 701), (701, 2000), (2000, 3000)):
        got |= arrive(run, state, random.Random(lo).sample(rows[lo:hi], hi - lo), chunk=97)
        assert len(state.value[0]) <= 3
    assert got == loop(rows, 3, 200 * SECOND)


def test_late_rows_are_judged_on_arrival():
    run, state = intake.limiter(1, 60 * SECOND), State()
    assert arrive(run, state, [("a", 100 * SECOND, 0)]) == {0}
    assert arrive(run, state, [("a", 50 * SECOND, 7)]) == set()
    assert arrive(run, state, [("a", 160 * SECOND, 8), ("a", 70 * SECOND, 9)]) == {8}


@pytest.mark.parametrize("cells", [1, 4, 16])
def test_segments_are_cut_at_gaps_of_a_window(spark, cells):
    """Every cut has a gap of a window, and gaps of a window and two cells are cut."""
    rng, window, times, t = random.Random(cells), 100 * SECOND, [], -5_000 * SECOND
    for _ in range(800):
        t += int(rng.choice([0.2, 1, 30, 99, 101, 130, 160, 250, 400]) * SECOND * rng.random() * 2)
        times.append(t)
    rows = [(k, t + 7 * n, i * 2 + n) for i, t in enumerate(times) for n, k in enumerate("ab")]
    width = window // 64
    slotted = frame(spark, rows).withColumn("_slot", F.floor(F.col("_t") / width).cast("long"))
    got = R.segments(slotted, window, width, cells).collect()
    cell = window // 64 * (64 // cells)
    for k in "ab":
        mine = sorted((r["_t"], r["_seg"]) for r in got if r["_k"] == k)
        assert len(mine) == 800 and len({s for _, s in mine}) > 20
        for (t, s), (u, r) in zip(mine, mine[1:]):
            assert r >= s and (r == s or u - t >= window) and (r != s or u - t < window + 2 * cell + width)


def test_a_hot_key_is_walked_in_several_tasks(spark):
    rows = [("hot", (s * 1000 + i) * SECOND, s * 20 + i) for s in range(200) for i in range(20)]
    thinned = R.thin(frame(spark, rows), 5, 60 * SECOND)
    assert thinned.select("_seg").distinct().count() == 200
    tasks = R._by_bucket(thinned, "_t", "_id").applyInPandas(
        lambda pdf: pd.DataFrame({"n": [len(pdf)], "segments": [pdf["_seg"].nunique()]}), "n long, segments long"
    ).collect()
    assert len(tasks) > 4 and sum(r["segments"] for r in tasks) == 200 and max(r["segments"] for r in tasks) < 100
    assert ids(R.accepted_keys(frame(spark, rows), 5, 60)) == loop(rows, 5, 60 * SECOND)


def test_the_key_is_computed_once(spark, monkeypatch):
    """The decisions read (key, time, id) of the shared folder, not what the key is made of."""
    given, keep = [], R.accepted_keys
    monkeypatch.setattr(R, "accepted_keys", lambda events, *a, **o: (given.append(events), keep(events, *a, **o))[1])
    df = spark.range(50).select(F.col("id").alias("n"), F.col("id").cast("timestamp").alias("at"), F.md5(F.lit("x")).alias("k"))
    assert R.rate_limit(df, ["k"], "at", "n", 3, 10).count() == 15
    plan = given[0]._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "StructsToJson" not in plan and "Range" not in plan


def test_the_fingerprint_is_computed_once(spark):
    rows = [(i, "m" * (i % 3), "a\n  at f", "f") for i in range(9)]
    df = spark.createDataFrame(rows, "seq long, message string, stack string, page string")
    df = df.withColumn("occurred_at", F.col("seq").cast("timestamp"))
    valid = errors.valid_reports(errors.with_fingerprint(df))
    keyed = R.keyed(valid, ["fingerprint"], "occurred_at", "seq").filter("_k IS NOT NULL")
    optimized = keyed._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("static_invoke(Base64.encode(") == 1 and keyed.count() == 6
