"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A text is cut into pieces: at line ends, and inside a line behind every word whose
checksum is 0 modulo ``EVERY`` or after ``LONGEST`` words without one, so that an edit changes only the pieces it touches. Each
piece is hashed to 512 bits. Two sums over the pieces make the fingerprint:

* eight 64-bit words, added modulo 2**64: equal for equal multisets of pieces only,
  whatever their order;
* 256 counters that each go up or down by one, modulo 2**16.

Sums can be added to and taken from: a piece is inserted or deleted without the rest of
the text. Differences of the counters are a sketch of the multisets' difference: the
expected square of a counter's difference is the number of pieces that only one side
has (counted with squared multiplicity), which gives the likeness
``1 - |a - b|**2 / (|a|**2 + |b|**2)``, between 0 and 1.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import range_bounds, range_bucket, shuffle_parts, slices, texts
from .hashing import batch_buffer, words_of

WORDS, COUNTERS = 8, 256
EVERY, LONGEST = 6, 24
SLICE = 1 << 20


def pieces(text: bytes) -> list[bytes]:
    """The pieces of a text, which joined are the text."""
    buffer = pa.array([text.decode("utf-8", "replace")])
    data, offsets = batch_buffer(buffer)
    start, value, _ = words_of(data, offsets)
    cut = np.zeros(len(data) + 1, bool)
    cut[np.flatnonzero(data == 10) + 1] = True
    lines = np.cumsum(cut)[start]
    begins = np.ones(len(start), bool)  # words that begin a line or follow a chosen one
    begins[1:] = (lines[1:] != lines[:-1]) | (value[:-1] % np.uint64(EVERY) == 0)
    count = np.arange(len(start))
    begins |= (count - np.maximum.accumulate(np.where(begins, count, 0))) % LONGEST == 0
    begins[1:] &= lines[1:] == lines[:-1]  # line ends are cuts already
    cut[start[begins]] = True
    cut[0] = cut[-1] = False
    raw, at = data.tobytes(), np.flatnonzero(cut).tolist()
    return [raw[a:b] for a, b in zip([0, *at], [*at, len(raw)])] if raw else []


class Fingerprint:
    """Sums over pieces; ``add`` and ``remove`` take any pieces, in any order."""

    __slots__ = ("words", "counters")

    def __init__(self):
        self.words = np.zeros(WORDS, np.uint64)
        self.counters = np.zeros(COUNTERS, np.int16)

    def _sums(self, found: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
        hashes = b"".join([hashlib.blake2b(p).digest() for p in found])
        rows = np.frombuffer(hashes, np.uint8).reshape(-1, 64)
        up = np.zeros(COUNTERS, np.int64)
        for at in range(0, len(rows), 4096):
            up += np.unpackbits(rows[at : at + 4096, : COUNTERS // 8], axis=1).sum(axis=0, dtype=np.int64)
        return rows.view("<u8").sum(axis=0, dtype=np.uint64), (2 * up - len(rows)).astype(np.int16)

    def add(self, found: Iterable[bytes]) -> Fingerprint:
        words, counters = self._sums(found)
        self.words += words
        self.counters += counters
        return self

    def remove(self, found: Iterable[bytes]) -> Fingerprint:
        words, counters = self._sums(found)
        self.words -= words
        self.counters -= counters
        return self

    def __str__(self) -> str:
        data = self.words.astype("<u8").tobytes() + self.counters.astype("<i2").tobytes()
        return base64.b64encode(data).decode()

    def likeness(self, other: Fingerprint) -> float:
        if (self.words == other.words).all() and (self.counters == other.counters).all():
            return 1.0
        a, b = self.counters.astype(np.float64), other.counters.astype(np.float64)
        apart = (self.counters - other.counters).astype(np.float64)  # modulo 2**16, too
        size = a @ a + b @ b
        return float(min(1.0, max(0.0, 1 - apart @ apart / size))) if size else 0.0


def parse(fingerprint: str) -> Fingerprint:
    data, out = base64.b64decode(fingerprint), Fingerprint()
    out.words = np.frombuffer(data, "<u8", WORDS).astype(np.uint64)
    out.counters = np.frombuffer(data, "<i2", COUNTERS, 8 * WORDS).astype(np.int16)
    return out


def fingerprint(text: str) -> Fingerprint:
    return Fingerprint().add(pieces(text.encode()))


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the head of the one that follows."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _edited_fingerprint(own: Fingerprint, text: str, new: str) -> Fingerprint:
    """Fingerprint of an edited text: pieces of the changed part are taken out of the
    first one's and the new ones put in. Both parts begin with the line of the edit."""
    same = len(text) - len(text) // 4
    at = text.rfind("\n", 0, same) + 1  # pieces never cross a line's start
    if new == text:
        return own
    out = Fingerprint()
    out.words, out.counters = own.words.copy(), own.counters.copy()
    return out.remove(pieces(text[at:].encode())).add(pieces(new[at:].encode()))


_ROW = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of every whole text and of its edited form, with likenesses.

    The documents are shuffled once, by key ranges; each range also gets a copy of the
    first document of the next one (and the last range that of the first), so every
    document meets its successor in its own task. Keys in a table are expected to
    differ; rows of one key follow each other by their text's hash, a null key comes
    first. A null text is an empty one. A single document follows itself.
    """
    spark = docs.sparkSession
    parts = parts or 2 * shuffle_parts(spark)
    own = texts(docs, key, text)
    kind = docs.schema[key].dataType.simpleString()
    rows = own.withColumn("r", range_bucket(key, range_bounds(own, key, parts))).withColumn("tie", F.xxhash64(text))
    # first row of each range: a few numbers each, one row for each range
    firsts = rows.groupBy("r").agg(F.min(F.struct(F.col(key).isNotNull().alias("k"), key, "tie")).alias("f"))
    ranges = sorted((r["r"], r["f"][key], r["f"]["tie"]) for r in firsts.collect()) if parts else []
    if not ranges:
        return rows.selectExpr(f"`{key}`", *(f"cast(null AS {t}) AS {n}" for n, t in (c.split() for c in _ROW.split(", "))))
    before = [ranges[i - 1][0] for i in range(len(ranges))]  # the range that comes before
    copies = spark.createDataFrame(
        [(b, k, t) for b, (_, k, t) in zip(before, ranges)], f"`to` int, `k` {kind}, `t` long"
    )
    heads = rows.join(
        F.broadcast(copies), rows[key].eqNullSafe(copies["k"]) & (rows["tie"] == copies["t"])  # `parts` rows at most
    ).select(F.col("to").alias("r"), F.lit(True).alias("head"), key, "tie", text)
    heads = heads.dropDuplicates(["r"])
    every = rows.select("r", F.lit(False).alias("head"), key, "tie", text).unionByName(heads)
    ordered = every.repartitionById(parts, F.col("r")).sortWithinPartitions("r", "head", key, "tie").select("r", "head", key, text)

    def run(batches):
        held = None  # range, key, text and fingerprint of the row before
        for batch in batches:
            for part in slices(batch, [3], SLICE):
                out = []
                columns = (part.column(i).to_pylist() for i in range(4))
                for r, head, doc, body in zip(*columns):
                    now = fingerprint(body)
                    if held is not None and held[0] == r:
                        out.append(_compared(*held[1:], body, now))
                    held = None if head else (r, doc, body, now)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[i] for o in out], t) for i, t in enumerate(
                        (part.schema.field(2).type, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()))],
                    names=[key, *(c.split()[0] for c in _ROW.split(", "))],
                )

    return ordered.mapInArrow(run, f"`{key}` {kind}, {_ROW}")


def _compared(doc, text: str, own: Fingerprint, following: str, after: Fingerprint) -> tuple:
    new = edited(text, following)
    of_new = _edited_fingerprint(own, text, new)
    return (doc, len(text), hashlib.sha256(new.encode()).hexdigest(), str(own), str(of_new),
            own.likeness(of_new), own.likeness(after))


