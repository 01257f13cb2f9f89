"""Fingerprints, archives, near duplicates, the classifier and the pipeline."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.conftest import SMALL
from threadsift.llm import classifier, fingerprints, neardup, warc


def test_fingerprints_are_multiset_hashes():
    a, b = "one two three\nfour five\n", "four five\none two three\n"
    assert str(fingerprints.fingerprint(a)) == str(fingerprints.fingerprint(b))
    assert str(fingerprints.fingerprint(a + a)) != str(fingerprints.fingerprint(a))
    whole = fingerprints.fingerprint(a).add(fingerprints.pieces(b"new line\n"))
    assert str(whole) == str(fingerprints.fingerprint(a + "new line\n"))
    assert str(whole.remove(fingerprints.pieces(b"new line\n"))) == str(fingerprints.fingerprint(a))
    assert str(fingerprints.parse(str(whole))) == str(whole)
    assert fingerprints.fingerprint("").likeness(fingerprints.fingerprint("")) == 1


def test_pieces_are_the_text(documents):
    for text in documents[1].values():
        assert b"".join(fingerprints.pieces(text.encode())) == text.encode()


@pytest.mark.parametrize("parts", [1, 7])
def test_compared_edits(documents, parts):
    df, texts = documents
    order, near, following = sorted(texts), [], []
    rows = {r["doc_id"]: r for r in fingerprints.compare_edits(df, parts=parts).collect()}
    assert len(rows) == len(order)
    for i, k in enumerate(order):
        after = texts[order[(i + 1) % len(order)]]
        new, r = fingerprints.edited(texts[k], after), rows[k]
        assert r["n_chars"] == len(texts[k])
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["fingerprint"] == str(fingerprints.fingerprint(texts[k]))
        assert r["edited_fingerprint"] == str(fingerprints.fingerprint(new))
        near.append(r["near_edited"])
        following.append(r["near_next"])
    assert 0.6 < np.mean(near) < 0.85 and np.mean(following) < 0.1


def plain_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def plain_classes(texts):
    own = {k: plain_shingles(t) for k, t in texts.items()}
    order, parent = sorted(texts), {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if texts[a] == texts[b] or similarity(own[a], own[b]) >= 0.8 - 1e-9:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: find(k) for k in order}


def test_shingles_and_signatures():
    rng = np.random.default_rng(4)
    pairs = []
    for n in (8, 40, 300) * 20:
        a = [f"w{x}" for x in rng.integers(0, 300, n)]
        a += a[: rng.integers(0, n)]
        b = [f"w{rng.integers(0, 300)}" if rng.random() < rng.choice([0, 0.01, 0.05]) else x for x in a]
        pairs.append((" ".join(a), " \n".join(b)))
    texts = [t for p in pairs for t in p] + ["", " a ", "É b", "x" * 100]
    value, of = neardup.shingles(neardup._lower(pa.array(texts)))
    assert np.bincount(of, minlength=len(texts)).tolist() == [sum(plain_shingles(t).values()) for t in texts]
    _, points = neardup.signatures(*neardup.multisets(value, of), len(texts))
    error = [
        (points[2 * i] == points[2 * i + 1]).mean() - similarity(plain_shingles(a), plain_shingles(b))
        for i, (a, b) in enumerate(pairs)
    ]
    assert abs(np.mean(error)) < 0.02 and np.abs(error).max() < 0.2


def test_long_texts_are_walked_in_segments(monkeypatch):
    from threadsift.llm import hashing

    texts = pa.array(["word two " * 50, "", "x" * 200 + " y", "a b c d e f"])
    whole = neardup.shingles(texts)
    monkeypatch.setattr(hashing, "SEGMENT", 16)
    assert all((a == b).all() for a, b in zip(whole, neardup.shingles(texts)))


def test_near_duplicates(documents):
    df, texts = documents
    got = {r["doc_id"]: r["class_id"] for r in neardup.groups(df).collect()}
    assert got == plain_classes(texts)
    kept = neardup.kept(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == set(got.values())


def test_chains_and_shared_passages(spark):
    """A chain of texts that each differ a little from the one before is one class,
    texts that share a long passage only are not."""
    rng = np.random.default_rng(8)
    word = lambda: f"w{rng.integers(0, 5000)}"
    chain = [[word() for _ in range(200)]]
    for _ in range(12):
        chain.append([word() if rng.random() < 0.015 else w for w in chain[-1]])
    passage = [word() for _ in range(60)]
    shared = [passage + [word() for _ in range(60)] for _ in range(40)]
    texts = {i: " ".join(w) for i, w in enumerate(chain + shared)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in neardup.groups(df).collect()}
    assert got == plain_classes(texts)


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 101), (100, 102), (50, 101)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["label"] for r in neardup.classes(df).collect()}
    assert got == {i: 0 for i in range(21)} | {i: 50 for i in (50, 100, 101, 102)}


def _pages(rows):
    largest = {}
    for k, html in rows:
        body = (html or "").encode()
        largest[body] = max(largest.get(body, k), k)
    out = {}
    for k, html in rows:
        body = (html or "").encode()
        again = len(body) >= 1000 and largest[body] != k
        out[k] = (len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", largest[body] if again else None)
    return out


def _read(df):
    return {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()}


def test_archives_of_the_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    assert _read(warc.write_read(pages)) == _pages([(r["page_id"], r["html"]) for r in pages.collect()])


@pytest.mark.parametrize("split", ["128m", "700"])
def test_record_starts_inside_payloads_are_rejected(spark, split):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "x" * 1500), (2, "x" * 1500), (3, None), (4, ""), (5, fake * 20), (6, "WARC/1.1\r\n" * 300), (7, "é😀" * 600),
            (8, fake), (9, "é😀" * 600), (10, "\r\n\r\n" * 300), (11, "x" * 1500), (12, fake + "WARC/1.1\r\n")]
    pages = spark.createDataFrame([(k, f"http://a/{k} \r\nX: y", h, "other") for k, h in rows], "page_id long, url string, html string, digest string")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert _read(warc.write_read(pages.coalesce(2))) == _pages(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_settings_that_change_later_lose_no_record(spark, tmp_path):
    """Records with version lines inside, read under other splits than they were found with."""
    fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(k, f"http://a/{k}", fake * (k % 5) + f"{k} " * 40, "own", "file") for k in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, split string")
    warc.write(pages.repartition(3), str(tmp_path / "a"))
    sizes = "spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum"
    old = [spark.conf.get(n) for n in sizes]
    try:
        spark.conf.set(sizes[0], "3000")
        found = warc.read(spark, str(tmp_path / "a"))
        spark.conf.set(sizes[0], "128m")
        spark.conf.set(sizes[1], "1")
        blocks = {bytes(r["block"]).decode().split("\r\n\r\n", 1)[1] for r in found.collect()}
    finally:
        for n, v in zip(sizes, old):
            spark.conf.set(n, v)
    assert blocks == {r[2] for r in rows}


def test_no_pages_and_repeated_rows(spark):
    kind = "page_id long, url string, html string"
    assert warc.write_read(spark.createDataFrame([], kind)).count() == 0
    rows = [(2, None, "y" * 1000), (2, None, "y" * 1000), (1, "u", "y" * 1000), (None, "u", "z")]
    got = warc.write_read(spark.createDataFrame(rows, kind)).collect()
    assert sorted((r["page_id"] or 0, r["record_type"]) for r in got) == [(0, "response"), (1, "revisit"), (2, "response"), (2, "response")]


def test_classifier_on_held_out_labels(documents, labels):
    rows = {r["doc_id"]: r for r in classifier.score(documents[0], labels).collect()}
    held = [(rows[r["doc_id"]], r["quality"]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    assert np.mean([r["predicted"] == q for r, q in held]) > 0.9
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows.values())
    kept = classifier.kept(documents[0], labels)
    assert {r["doc_id"] for r in kept.collect()} == {k for k, r in rows.items() if r["predicted"]}


def test_training_never_sees_held_out_rows(documents, labels):
    import zlib

    seen = labels.where(classifier.held_out("doc_id")).collect()
    assert seen and all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in seen)
    flipped = labels.withColumn("quality", (1 - labels["quality"]).cast("int")).where(classifier.held_out("doc_id"))
    changed = labels.where(~classifier.held_out("doc_id")).unionByName(flipped)
    a, b = (classifier.fit(documents[0], own) for own in (labels, changed))
    assert (a == b).all()


def test_a_repeated_key_takes_no_other_keys_place(spark):
    keys = [k for k in range(60) if zlib.crc32(str(k).encode()) % 4 != 2]
    kind = "doc_id long, text string"
    docs = [(k, f"{'fine' if k % 2 else 'bad'} words {k} here") for k in keys]
    labels = spark.createDataFrame([(k, k % 2) for k in keys], "doc_id long, quality int")
    once = classifier.fit(spark.createDataFrame(docs, kind), labels, rows=len(keys))
    for hot in docs[:4]:
        many = spark.createDataFrame(docs + [hot] * (len(docs) // 2), kind).repartition(3)
        assert (classifier.fit(many, labels, rows=len(keys)) == once).all()


def test_training_has_its_whole_extent():
    assert (classifier.DIM, classifier.TRAIN_ROWS, classifier.STEPS * classifier.BATCH) == (8, 6000, 38_400)


def test_features_are_the_same_in_slices(monkeypatch):
    texts = pa.array(["Und Und der", "", "a\nb c" * 30, "éé |"])
    model = np.random.default_rng(1).normal(size=classifier.BUCKETS + 1).astype(np.float32)
    whole = classifier.scores(texts, model)
    monkeypatch.setattr(classifier, "SLICE", 7)
    assert np.allclose(whole, classifier.scores(texts, model))


def test_odd_rows(odd, empty, no_labels):
    assert neardup.groups(odd).count() == classifier.score(odd, no_labels).count() == 10
    got = {r["doc_id"]: r["class_id"] for r in neardup.groups(odd).collect()}
    assert got[1] == got[2] == 1 and got[3] == got[4] == 3 and got[5] == 5 and got[None] is None
    assert {r["score"] for r in classifier.score(odd, no_labels).collect()} == {0.5}
    assert fingerprints.compare_edits(odd).count() == 10
    for made in (neardup.groups(empty), classifier.score(empty, no_labels), fingerprints.compare_edits(empty)):
        assert made.count() == 0


def test_one_row_of_each_class_stays(spark, odd):
    """Repeated rows, a key with several texts and rows without a key, each beside a
    key that holds a third of the rows."""
    found = neardup.kept(odd)
    assert found.columns == odd.columns
    rows = found.collect()
    assert sorted((r["doc_id"] or 0) for r in rows) == [0, 1, 3, 5, 6, 7, 8]
    assert next(r for r in rows if r["doc_id"] == 1)["text"] is None
    hot = " ".join(f"hot{i}" for i in range(40))
    other, alone, third = (hot.replace("hot", w) for w in ("other", "alone", "third"))
    rows = [(5, hot, "a")] * 20 + [(5, other, "b"), (2, other, "c"), (5, third, "d"), (9, third + " end", "e")]
    rows += [(None, other, "f"), (None, alone, "g"), (None, alone, "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = sorted((r["source"], r["doc_id"], r["text"]) for r in neardup.kept(df).collect())
    assert got == [("a", 5, hot), ("c", 2, other), ("d", 5, third), ("g", None, alone)]


def test_pipeline_stages(spark, documents):
    df, texts = documents
    docs, seen = df, set(texts)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == df.columns, name
        docs = spark.createDataFrame(docs.collect(), df.schema)
        assert {r["doc_id"] for r in docs.collect()} <= seen
        seen = {r["doc_id"] for r in docs.collect()}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in rows} == seen and 100 < len(seen) < len(texts)
    classes = plain_classes({k: texts[k] for k in seen})
    assert set(classes.values()) == seen


def test_blocks_find_every_link(spark, monkeypatch):
    """Groups around the similarity, dealt into blocks of a few nodes each."""
    rng = np.random.default_rng(12)
    word = lambda: f"w{rng.integers(0, 4000)}"
    texts = []
    for share, size in ((0.02, 30), (0.03, 30), (0.045, 20)):
        base = [word() for _ in range(110)]
        texts += [" ".join(word() if rng.random() < share else w for w in base[: 110 - i % 9]) for i in range(size)]
    texts = {i: t for i, t in enumerate(texts)}
    want = plain_classes(texts)
    assert 3 < len(set(want.values())) < len(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for block, hops in ((256, 2), (4, 2), (3, 0)):
        monkeypatch.setattr(neardup, "BLOCK", block)
        monkeypatch.setattr(neardup, "HOPS", hops)
        assert {r["doc_id"]: r["class_id"] for r in neardup.groups(df).collect()} == want


def test_a_group_returns_no_more_links_than_join_it():
    rng = np.random.default_rng(2)
    base = [f"w{x}" for x in range(300)]
    texts = [" ".join(base[:i] + [f"x{i}"] + base[i + 1 :]) for i in range(40)] + ["a b c d e f g"] * 2
    value, of = neardup.shingles(pa.array(texts))
    total = np.bincount(of, minlength=len(texts))
    _, points = neardup.signatures(*neardup.multisets(value, of), len(texts))
    keys = np.repeat(np.arange(len(texts)) < 40, neardup.BANDS).reshape(len(texts), -1).astype(np.int64)
    label = np.array([*range(100, 140), 7, 7])
    for sides in (np.zeros(42, np.int64), rng.integers(0, 2, 42)):
        rows = pa.table({
            "side": sides, "label": label, "total": total, "bands": pa.array(list(keys), pa.list_(pa.int64())),
            "sketch": [p.tobytes() for p in points.astype(np.uint8)], "text": texts,
        })
        found = neardup._group_links(rows).to_pylist()
        assert len(found) == 39
        parent = {x: x for x in label.tolist()}

        def top(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for r in found:
            parent[top(r["a"])] = top(r["b"])
        assert len({top(x) for x in parent}) == 2
