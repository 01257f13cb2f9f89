"""Benchmark decontamination, vector codes and whitening against plain versions."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SMALL
from threadsift.llm import decontaminate, vector_codes, whitening

ITEM = "item_id long, text string"
VECTOR = "vec_id long, embedding array<float>, label int"


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_report(docs, items):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).update([] if item is None else [str(item)])
    lengths = {len(w) for w in windows}
    for key, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[g]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield key, len(w), len(hit), len(found), digest, bool(hit)


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("most", [decontaminate.BROADCAST_BYTES, 4000])
def test_report(spark, documents, most):
    """One broadcast, and several of a few windows each."""
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    short = spark.createDataFrame([(900, "Und der"), (901, "x"), (902, ""), (903, None), (None, "erst die"), (904, "und DER")], ITEM)
    items = items.unionByName(short)
    got = [tuple(r) for r in decontaminate.report(documents[0], items, most=most).collect()]
    want = list(plain_report(documents[1].items(), [(r["item_id"], r["text"]) for r in items.collect()]))
    assert order(got) == order(want) and any(r[5] for r in want) and not all(r[5] for r in want)


def test_report_of_odd_rows(spark, odd, empty):
    items = [(1, "One"), (1, "no key no"), (2, "word " * 12), (3, "É̂ ß"), (4, "σς"), (5, "a" * 300_000), (6, " \t "), (None, "end")]
    given = spark.createDataFrame(items, ITEM)
    got = [tuple(r) for r in decontaminate.report(odd, given).collect()]
    assert order(got) == order(plain_report([(r["doc_id"], r["text"]) for r in odd.collect()], items))
    assert decontaminate.report(empty, given).count() == 0
    assert {r["contaminated"] for r in decontaminate.report(odd, given.limit(0)).collect()} == {False}


def test_only_ascii_is_lowered(spark):
    docs = spark.createDataFrame([(1, "ÉTUDE Kelvin K one"), (2, "étude kelvin k one")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "étude Kelvin")], ITEM)
    assert {r["doc_id"] for r in decontaminate.report(docs, items).where("contaminated").collect()} == {2}


def test_spans_and_documents_are_removed(spark, odd):
    docs = odd.withColumn("spans", odd["doc_id"]).withColumn("items", odd["source"]).withColumn("row", odd["lang"])
    more = [(20, "Keep this. One, two-three FOUR! five; then One two three four FIVE six seven eight end", "en", "a", 5, "x", 1, "k", 1, "i", "r")]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    items = spark.createDataFrame([(1, "one two three four five")], ITEM)
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns and order(left.collect()) == order(docs.where("doc_id IS NULL OR doc_id <> 20").collect())
    cut = decontaminate.clean(docs, items, whole=False)
    assert cut.columns == docs.columns
    rows = {r["doc_id"]: r for r in cut.collect()}
    assert rows[20]["text"] == "Keep this; then six seven eight end" and rows[20]["spans"] == 1
    assert order(cut.where("doc_id <> 20 OR doc_id IS NULL").collect()) == order(left.collect())


def plain_codes(vectors, parts=16, entries=64, rounds=2):
    keys = sorted(vectors)
    x = np.array([[int(np.floor(256 * float(c))) for c in vectors[k]] for k in keys])
    books = np.stack([x[:entries, s] for s in np.split(np.arange(x.shape[1]), parts)])

    def assign():
        d = np.stack([((p[:, None] - b[None]) ** 2).sum(2) for p, b in zip(np.split(x, parts, axis=1), books)])
        return d.argmin(2), d.min(2)

    for _ in range(rounds):
        index, _ = assign()
        for p, part in enumerate(np.split(x, parts, axis=1)):
            for e in range(books.shape[1]):
                if (mine := part[index[p] == e]).size:
                    books[p, e] = mine.sum(0) // len(mine)
    index, d = assign()
    return {k: (bytes(index[:, i].astype(np.uint8)).hex(), int(d[:, i].sum())) for i, k in enumerate(keys)}, books


@pytest.fixture(scope="module")
def embeddings(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    return df, {r["vec_id"]: r["embedding"] for r in df.collect()}


def test_vector_codes(embeddings):
    df, vectors = embeddings
    want, books = plain_codes(vectors)
    rows = vector_codes.quantize(df.repartition(3)).collect()
    assert {r["vec_id"]: (r["code"], r["error"]) for r in rows} == want
    assert (vector_codes.fit(df) == books).all()
    labels = {r["vec_id"]: r["label"] for r in df.collect()}
    sums = {}
    for k, (_, e) in want.items():
        sums[labels[k]] = sums.get(labels[k], 0) + e
    assert all(r["label_error"] == sums[labels[r["vec_id"]]] for r in rows)
    text = ",".join(str(c) for c in books.reshape(-1))
    assert {r["codebooks_sha256"] for r in rows} == {hashlib.sha256(text.encode()).hexdigest()}
    k = min(vectors)
    x = np.floor(256 * np.array(vectors[k], np.float64))
    assert ((vector_codes.decode(want[k][0], books) - x) ** 2).sum() == want[k][1]


@pytest.mark.parametrize("spread", [0, 3, 1000, 1 << 23])
def test_cells_lose_no_nearest_entry(spread, monkeypatch):
    """Also where the cache is emptied again and again, and where all cells have one hash."""
    rng = np.random.default_rng(spread)
    entries = rng.integers(-spread, spread + 1, (37, 3))
    entries[5] = entries[20]
    parts = np.concatenate([rng.integers(-2 * spread - 1, 2 * spread + 2, (3000, 3)), entries])
    d = ((parts[:, None] - entries[None]) ** 2).sum(2)
    for same in (False, True):
        if same:
            monkeypatch.setattr(vector_codes, "mix", lambda x: x * np.uint64(0))
        book = vector_codes.Codebook(entries, most=50)
        for cut in np.array_split(parts, 9):
            book.nearest(cut)
        index, least = book.nearest(parts)
        assert (index == d.argmin(1)).all() and (least == d.min(1)).all()
    if spread == 1000:
        book = vector_codes.Codebook(entries)
        monkeypatch.undo()
        book.nearest(parts)
        assert book.open.mean() < 0.5


def broken(vectors):
    nan, inf = float("nan"), float("inf")
    return [(1, None, 1), (2, [], 1), (3, [None, *[0.5] * 31], 1), (4, [nan] * 32, 1), (5, [inf] * 32, None), (6, [0.5] * 31, 1), *vectors]


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    own = [(k, rng.normal(size=32).astype(np.float32).tolist(), None if k % 3 else 4) for k in range(10, 30)]
    own += [own[0], own[0], (None, [0.25] * 32, None)]
    df = spark.createDataFrame(broken(own), VECTOR).selectExpr("*", "vec_id AS key", "label AS c0", "label AS error")
    rows = vector_codes.quantize(df).collect()
    assert sorted(str(r["vec_id"]) for r in rows) == sorted(str(k) for k, _, _ in own)
    label = {str(k): x for k, _, x in own}
    for r in rows:
        same = [o["error"] for o in rows if label[str(o["vec_id"])] == label[str(r["vec_id"])]]
        assert r["label_error"] == sum(same)
    assert vector_codes.fit(df).shape == (16, 20, 2)  # the row without a key starts no entry
    white = whitening.whiten(df)
    assert white.count() == 20 * len(own)  # 21 distinct vectors in 32 dimensions span 20 components
    for made in (vector_codes.quantize(df.limit(0)), whitening.whiten(df.limit(0)), whitening.whiten(df.where("vec_id = 11"))):
        assert made.count() == 0
    assert vector_codes.encode(df, vector_codes.fit(df)).columns == ["vec_id", "label", "key", "c0", "error", "code", "error"]


def plain_whitening(rows, components=32):
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in rows], object)
    n, s = len(x), x.sum(0)
    y = (n * x - s).astype(np.float64) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, ((n * x - s) ** 2).sum(1), y @ vectors / np.sqrt(values), values / values.sum()


def compare(rows, got, components=32):
    n, deviation, white, explained = plain_whitening(rows)
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    for i, (k, _) in enumerate(rows):
        assert sorted(by[k]) == list(range(1, components + 1))
        assert all(r["n"] == n and r["deviation"] == deviation[i] for r in by[k].values())
    sign = np.sign([by[rows[0][0]][c]["whitened"] * white[0, c - 1] for c in range(1, components + 1)])
    mine = np.array([[by[k][c]["whitened"] for c in range(1, components + 1)] for k, _ in rows])
    assert np.abs(mine * sign - white[:, :components]).max() < 1e-7
    assert np.allclose([by[rows[0][0]][c]["explained"] for c in range(1, components + 1)], explained[:components], rtol=1e-9)
    assert {r["identity_error"] for r in got} == {max(r["identity_error"] for r in got)} and got[0]["identity_error"] < 1e-9


def test_whitening(embeddings):
    df, vectors = embeddings
    compare(list(vectors.items()), whitening.whiten(df.repartition(3)).collect())


def test_hot_vectors_and_weights(spark, monkeypatch):
    """A vector that a third of the rows have; hot ones take the broadcast, others not."""
    rng = np.random.default_rng(5)
    vectors = [rng.normal(size=6).round(1).tolist() for _ in range(40)]
    rows = [(i, vectors[i % 40] if i % 3 else vectors[0]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    for hot in (1, 10, 10_000):
        monkeypatch.setattr(whitening, "HOT", hot)
        compare(rows, whitening.whiten(df).collect(), 6)
    plain = {tuple(v): i for i, (_, v) in enumerate(rows)}
    once = spark.createDataFrame([(i, list(v)) for v, i in plain.items()], df.schema)
    each = {(r["vec_id"], r["component"]): abs(r["whitened"]) for r in whitening.whiten(df, weights="one").collect()}
    for r in whitening.whiten(once).collect():
        assert abs(each[r["vec_id"], r["component"]] - abs(r["whitened"])) < 1e-8


def test_deviation_is_exact_beyond_64_bits():
    rest = [5, -3]
    own = whitening.Fit(10**12, [10**18 + 5, 10**18 - 3], np.eye(2), np.ones(2), 2.0)
    x = [[10**6 + 12345, 10**6 - 999], [10**6 + (1 << 40), 10**6]]
    batch = pa.RecordBatch.from_arrays([pa.array(x), pa.array([1, 1])], names=["x", "count"])
    got = next(whitening._whitener(own, 2)(iter([batch]))).column("deviation").to_pylist()
    assert int(got[0]) == sum((10**12 * (a - 10**6) - r) ** 2 for a, r in zip(x[0], rest)) and got[1] is None
