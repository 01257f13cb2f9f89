"""Vector codes: each part of a vector as the index of its nearest codebook entry.

Components become integers, vectors are cut into equal parts, and every part position
has a codebook of up to 256 entries, learned in a few rounds from all vectors: assign,
then replace each entry by the mean of its parts, rounded down. All arithmetic is in
integers, so results do not depend on how Spark deals the rows.

Memoised grid cells. The nearest entry is not looked for among all entries. A part falls
into a coarse cell of a grid, found by hash. The first part in a cell computes, for the
cell's box, the least and the greatest distance to every entry. An entry whose least
distance exceeds some entry's greatest one is nowhere nearest in the box; the others are
cached for the cell. Parts are then compared exactly with the cached entries of their
cell only. A task keeps at most ``CELLS`` cells for each part position and starts anew
when there are more, which costs time and changes nothing.

A round is one scan: each task adds up its parts by entry and returns one row for each
part position and entry, which Spark adds up; only codebooks reach the driver.

Vectors that are null, empty, of another length than most, or hold null or non-finite
components are dropped. Repeated rows give repeated rows and count as often as they
occur. Rows with a null key are coded but never start a codebook; of several vectors with
one key the least starts it. Vectors fewer than the entries make smaller codebooks.
Components beyond ``LARGEST`` after scaling are an error, as their squares would not fit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import written
from .hashing import ODD, mix
from .vectors import matrix, usable

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: A component x becomes floor(SCALE * x).
SCALE = 256
LARGEST = 1 << 24
#: Cells across the extent of a codebook, a power of two of integers wide each; and cells
#: that a task remembers for each part position.
ACROSS, CELLS = 16, 1 << 16


def integers(column: pa.Array, length: int) -> np.ndarray:
    """Scaled components of a column of vectors, rounded down."""
    scaled = np.floor(SCALE * matrix(column, length).astype(np.float64))
    if np.abs(scaled).max(initial=0) > LARGEST:
        raise ValueError(f"a component exceeds {LARGEST / SCALE}")
    return scaled.astype(np.int64)


class Codebook:
    """The entries of one part position, with the cells seen so far."""

    def __init__(self, entries: np.ndarray, most: int = CELLS):
        self.entries, self.most = entries, most
        extent = int((entries.max(axis=0) - entries.min(axis=0)).max()) if len(entries) else 0
        self.shift = max(0, (extent // ACROSS).bit_length())
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.cells = np.empty((0, self.entries.shape[1]), np.int64)
        self.open = np.empty((0, len(self.entries)), bool)

    def _not_dominated(self, cells: np.ndarray) -> np.ndarray:
        """Of each cell: the entries that may be nearest to something in its box."""
        low = (cells << self.shift)[:, None, :]
        high = low + (1 << self.shift) - 1
        below, above = low - self.entries, self.entries - high
        least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
        most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=2)
        return least <= most.min(axis=1, keepdims=True)

    def _slots_of(self, cells: np.ndarray) -> np.ndarray:
        """Each part's place in the cache, after its cell was added where it is new."""
        value = np.zeros(len(cells), np.uint64)
        for k in range(cells.shape[1]):
            value = mix(value * ODD + cells[:, k].view(np.uint64))
        hashes, first, of = np.unique(value, return_index=True, return_inverse=True)
        listed = hashes.tolist()
        new = [i for i, h in enumerate(listed) if h not in self.slots]
        if len(self.slots) + len(new) > self.most:
            self._forget()
            new = range(len(listed))
        for i in range(0, len(new), 1024):
            group = [new[k] for k in range(i, min(i + 1024, len(new)))]
            self.slots.update((listed[k], len(self.cells) + n) for n, k in enumerate(group))
            added = cells[first[group]]
            self.cells = np.concatenate([self.cells, added])
            self.open = np.concatenate([self.open, self._not_dominated(added)])
        return np.array([self.slots[h] for h in listed], np.int64)[of]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each part's nearest entry, the lower index of
        equally near ones."""
        if not len(parts):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        cells = parts >> self.shift
        slot = self._slots_of(cells)
        tried = self.open[slot] | (self.cells[slot] != cells).any(axis=1, keepdims=True)  # equal hashes of two cells
        row, entry = np.nonzero(tried)
        distance = ((parts[row] - self.entries[entry]) ** 2).sum(axis=1)
        start = np.searchsorted(row, np.arange(len(parts)))
        least = np.minimum.reduceat(distance, start)
        index = np.minimum.reduceat(np.where(distance == least[row], entry, len(self.entries)), start)
        return index, least


def _batches(column: pa.Array, length: int) -> Iterator[tuple[slice, np.ndarray]]:
    for at in range(0, len(column), 4096):
        yield slice(at, at + 4096), integers(column[at : at + 4096], length)


def _totals(books: np.ndarray):
    """Counts and sums of the parts nearest to each entry, of a whole task."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Codebook(b) for b in books]
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for _, x in _batches(batch.column(0), parts * width):
                for p, book in enumerate(own):
                    part = x[:, p * width : (p + 1) * width]
                    index = book.nearest(part)[0]
                    count[p] += np.bincount(index, minlength=entries)
                    np.add.at(total[p], index, part)
        p, e = np.nonzero(count)
        columns = [pa.array(a, pa.int64()) for a in (p, e, count[p, e], *total[p, e].T)]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", *(f"s{k}" for k in range(width))])

    return run


def _next(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round; unused entries stay."""
    width = books.shape[2]
    sums = [f"s{k}" for k in range(width)]
    each = vectors.select("vector").mapInArrow(_totals(books), f"part long, entry long, n long, {', '.join(f'{s} long' for s in sums)}")
    rows = each.groupBy("part", "entry").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", *sums))).collect()
    after = books.copy()
    for r in rows:  # a row for each part position and entry at most
        after[r["part"], r["entry"]] = [int(r[s]) // int(r["n"]) for s in sums]
    return after


def _first(vectors: DataFrame, parts: int, entries: int, length: int) -> np.ndarray:
    """Codebooks of the parts of the vectors with the least keys."""
    keys = [r["key"] for r in vectors.select("key").where("key IS NOT NULL").distinct().orderBy("key").limit(entries).collect()]
    rows = vectors.where(F.col("key").isin(keys)).groupBy("key").agg(F.min("vector").alias("vector")).collect() if keys else []
    own = {r["key"]: r["vector"] for r in rows}
    x = integers(pa.array([own[k] for k in keys], pa.list_(pa.float64())), length)
    return x.reshape(len(keys), parts, length // parts).transpose(1, 0, 2)


def fit(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> np.ndarray:
    """Codebooks (part position, entry, component) learned from all usable vectors."""
    kept, length = usable(df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("vector")), "vector")
    if length % parts:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")
    if not 0 < entries <= 256:
        raise ValueError("a code of two hex digits tells 256 entries apart")
    books = _first(kept, parts, entries, length)
    for _ in range(rounds if books.shape[1] else 0):
        books = _next(kept, books)
    return books


def encode(df: DataFrame, books: np.ndarray, vector: str = "embedding", columns: list[str] | None = None) -> DataFrame:
    """The columns given (all others than the vector's by default) of the rows with a
    vector that the codebooks fit, ``code`` (two hex digits for each part) and ``error``,
    the squared distance to what the code stands for. No shuffle."""
    names = [c for c in df.columns if c != vector] if columns is None else columns
    parts, entries, width = books.shape
    own = df.select(F.col(f"`{vector}`").alias("vector"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))
    kept = usable_of_length(own, parts * width) if entries else own.where("false")
    schema = StructType([*kept.schema.fields[1:], StructField("code", StringType()), StructField("error", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Codebook(b) for b in books]
        for batch in batches:
            for rows, x in _batches(batch.column(0), parts * width):
                codes, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
                for p, book in enumerate(own):
                    codes[:, p], distance = book.nearest(x[:, p * width : (p + 1) * width])
                    error += distance
                cut = batch.slice(rows.start, len(x))
                made = [pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)]
                yield pa.RecordBatch.from_arrays([*cut.columns[1:], *made], names=[f.name for f in schema])

    out = kept.mapInArrow(run, schema)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), "code", "error")


def usable_of_length(df: DataFrame, length: int) -> DataFrame:
    """The rows with finite vectors of a known length."""
    return df.where(
        f"size(vector) = {length} AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )


def decode(code: str, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for, in scaled integers."""
    return np.concatenate([books[p, e] for p, e in enumerate(bytes.fromhex(code))])


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimal numbers."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def quantize(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """Key, code and error of every usable row, the error summed over the rows of its
    label (null ones together), and the codebooks' digest. Labels are summed by partial
    aggregates; the sums, one row a label, then meet the rows, which Spark broadcasts
    or, where they are many, joins with its split of skewed keys."""
    books = fit(df, key, vector, parts, entries, rounds)
    own = df.select(
        F.col(f"`{vector}`").alias("vector"), F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label")
    )
    coded = written(encode(own, books, "vector"), "codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("key").alias(key), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
