"""Quality classifier: learned embeddings of words and parts of words.

A text's features are its words, its pairs of neighbouring words (a word beside itself
is one and the same pair for all words) and the runs of three to five bytes within
words (with the blank on either side), each hashed to one of ``BUCKETS`` vectors. Their
average, with words and pairs counting ``WORD_WEIGHT`` times, goes through a softmax of two classes. Vectors and
weights are trained by stochastic gradient descent in numpy, in one task, on at most
``TRAIN_ROWS`` labelled documents: one row of each of the least key hashes among the keys
whose checksum modulo 4 is not 2. Only key-free text is seen.

As the average goes into a linear layer, scoring needs one number for each bucket;
this table (one megabyte) is what the tasks receive. Scoring is one narrow pass over
whole texts; long ones are walked in segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices, texts
from .hashing import ODD, TABLE, batch_buffer, is_space, mix, words_of

BUCKETS, DIM = 1 << 18, 8
GRAMS = (3, 4, 5)
WORD_WEIGHT = 4
TRAIN_ROWS, STEPS, BATCH, RATE = 6000, 1200, 32, 4.0
#: Documents of at least this score are predicted to be good.
CUTOFF = 0.7
SLICE = 1 << 19


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


Part = tuple[np.ndarray, np.ndarray, int]


def features(texts: pa.Array) -> Iterator[Part]:
    """Buckets, texts and weight of all features of a batch, kind by kind and part by
    part."""
    data, offsets = batch_buffer(texts)
    start, words, owner = words_of(data, offsets)
    yield (mix(words) % np.uint64(BUCKETS)).astype(np.int64), owner, WORD_WEIGHT
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    code = np.where(words[pair] == words[pair + 1], ODD, mix(words[pair] * ODD + words[pair + 1]))
    yield (code % np.uint64(BUCKETS)).astype(np.int64), owner[pair], WORD_WEIGHT
    for at in range(0, len(data), SLICE):
        yield from _grams(data, offsets, at, min(at + SLICE, len(data)))


def _grams(data: np.ndarray, offsets: np.ndarray, first: int, last: int) -> Iterator[Part]:
    """Runs of bytes that start in a part of the buffer: none has white space inside
    or crosses the end of a text."""
    part = data[first : last + max(GRAMS)]
    space = is_space(part)
    code = np.where(space, TABLE[32], TABLE[part])
    owner = np.searchsorted(offsets, np.arange(first, first + len(part)), side="right") - 1
    inner = np.cumsum(space)
    value = np.zeros(len(part), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        length = min(len(part) - n + 1, last - first)
        if length <= 0:
            return
        value = value[: len(part) - n + 1] * ODD + code[n - 1 :]
        if n in GRAMS:
            whole = owner[:length] == owner[n - 1 : n - 1 + length]
            whole &= inner[n - 2 : n - 2 + length] == inner[:length]  # all but the first and the last
            kept = np.flatnonzero(whole)
            yield (mix(value[kept] + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int64), owner[kept], 1


def counted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, bucket and count of the distinct features of a batch, by text."""
    coded = [2 * (owner * BUCKETS + bucket) + (weight > 1) for bucket, owner, weight in features(texts)]
    coded, n = np.unique(np.concatenate(coded), return_counts=True)
    n = np.where(coded & 1, n * WORD_WEIGHT, n)
    keys = coded >> 1
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    counts = np.add.reduceat(n, first) if len(keys) else n
    return keys[first] // BUCKETS, keys[first] % BUCKETS, counts


def train(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = STEPS, seed: int = 1
) -> np.ndarray:
    """What each bucket adds to the score's log-odds, and last the constant. rows:
    buckets and shares of the features of each text."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (DIM, BUCKETS)).astype(np.float32)
    weights, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    order = np.empty(0, np.int64)
    for step in range(steps):
        if len(order) < BATCH:  # another pass over the rows
            order = np.concatenate([order, rng.permutation(len(rows))])
        own, order = order[:BATCH], order[BATCH:]
        rate = RATE * (1 - step / steps)
        bucket = np.concatenate([rows[i][0] for i in own])
        share = np.concatenate([rows[i][1] for i in own])[:, None]
        sizes = np.array([len(rows[i][0]) for i in own])
        of = np.repeat(np.arange(len(own)), sizes)
        mean = np.zeros((len(own), DIM), np.float32)
        full = np.flatnonzero(sizes)
        if len(full):
            mean[full] = np.add.reduceat(vectors[:, bucket].T * share, (np.cumsum(sizes) - sizes)[full])
        logits = mean @ weights + bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = odds / odds.sum(axis=1, keepdims=True)
        error[np.arange(len(own)), labels[own]] -= 1
        error /= len(own)
        back = error @ weights.T
        weights -= rate * (mean.T @ error)
        bias -= rate * error.sum(axis=0)
        change = back[of] * share * (rate * len(own) / 4)
        for d in range(DIM):
            vectors[d] -= np.bincount(bucket, weights=change[:, d], minlength=BUCKETS).astype(np.float32)
    apart = weights[:, 1] - weights[:, 0]
    return np.append(apart @ vectors, bias[1] - bias[0]).astype(np.float32)


def _trained(batches):
    """The model of all rows of one task: text, label."""
    rows, labels = [], []
    for batch in batches:
        for part in slices(batch, [0], SLICE):
            owner, bucket, count = counted(part.column(0).cast(pa.string()))
            ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
            for a, b in zip(ends[:-1], ends[1:]):
                rows.append((bucket[a:b], (count[a:b] / max(1, count[a:b].sum())).astype(np.float32)))
            labels += part.column(1).to_pylist()
    if rows:
        model = train(rows, np.array(labels, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([model.tobytes()], pa.binary())], names=["model"])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", rows: int = TRAIN_ROWS) -> np.ndarray:
    """The model. A document with several labels counts as good if all say so; without
    labelled documents every score is 0.5."""
    known = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__key"))
        .agg(F.min("quality").cast("int").alias("label")).where(~held_out("__key"))
        .orderBy(F.xxhash64("__key"), "__key").limit(rows)
    )
    chosen = texts(docs, key, text).join(F.broadcast(known), F.col(key) == F.col("__key"))  # `rows` keys at most
    # one row of each key, so that a repeated key takes no other key's place
    least = F.min_by(F.struct(F.col(text).alias("text"), "label"), F.struct(F.xxhash64(text), text)).alias("row")
    sample = chosen.groupBy("__key").agg(least).repartition(1).sortWithinPartitions(F.xxhash64("__key"), "__key")
    found = sample.select("row.text", "row.label").mapInArrow(_trained, "model binary").collect()  # a megabyte
    return np.frombuffer(found[0]["model"], np.float32) if found else np.zeros(BUCKETS + 1, np.float32)


def scores(texts: pa.Array, model: np.ndarray) -> np.ndarray:
    """Scores of a batch: the mean of its features' numbers, as a probability."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for bucket, owner, weight in features(texts):
        total += weight * np.bincount(owner, weights=model[bucket], minlength=len(texts))
        count += weight * np.bincount(owner, minlength=len(texts))
    odds = total / np.maximum(count, 1) + float(model[-1])
    return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score and prediction of every whole text. Null and empty texts have no features,
    so their score is the constant's; rows with a null key are scored, never used for
    training, and not held out; repeated rows give repeated rows."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, key, text))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, [2], SLICE):
                found = scores(part.column(2).cast(pa.string()), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found), pa.array((found >= CUTOFF).astype(np.int32))],
                    names=[key, "held_out", "score", "predicted"],
                )

    own = docs.select(F.col(key), held_out(key).alias("held_out"), F.coalesce(F.col(text), F.lit("")))
    return own.mapInArrow(run, f"`{key}` {kind}, held_out boolean, score double, predicted int")


def kept(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are predicted to be good, with their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, key, text))
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            for part in slices(batch, [at], SLICE):
                found = scores(part.column(at).cast(pa.string()).fill_null(""), shared.value)
                yield part.filter(pa.array(found >= CUTOFF))

    return docs.mapInArrow(run, docs.schema)
