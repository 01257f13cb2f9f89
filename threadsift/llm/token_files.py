"""Token ids in binary files: patched frame-of-reference blocks.

A file (all numbers little-endian)::

    b"PFORIDS1"
    blocks   count u32 | least u32 | width u8 | exceptions u16 | values minus least,
             packed in `width` bits each | positions u16 ... | whole values u32 ...
    footer   block starts u64 ... | documents: key i64, start u64, ids u64
             | blocks u64, documents u64, ids u64, range u64, number u64, footer bytes u64
    b"PFOREND\\n"

The width is what the given percentile of a block's values needs; larger ones are
exceptions. A file holds whole documents in ascending key order, up to about
``FILE_IDS`` ids. `range` and `number` order the files.

Spark's text writer writes the files (a row each, with the last eight bytes as line
end), so commits, retries and lost executors are Spark's matter and any file system
will do. They are read back with Spark's binary file reader.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import work_dir, written
from .common import range_bounds, range_bucket, shuffle_parts, texts
from .packing import END
from .tokens import encoder

START, STOP = b"PFORIDS1", b"PFOREND\n"
BLOCK_IDS = 4096
FILE_IDS = 1 << 22
PERCENTILE = 95
_HEAD, _TAIL = struct.Struct("<IIBH"), struct.Struct("<6Q")


def pack_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    least = int(ids.min())
    rest = ids - np.uint32(least)
    width = int(np.percentile(rest, percentile, method="higher")).bit_length()
    out = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    bits = np.unpackbits(rest.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return b"".join([
        _HEAD.pack(len(ids), least, width, len(out)),
        np.packbits(bits[:, :width], bitorder="little").tobytes(),
        out.astype("<u2").tobytes(), ids[out].astype("<u4").tobytes(),
    ])


def unpack_block(data: memoryview) -> np.ndarray:
    count, least, width, n = _HEAD.unpack_from(data)
    at = _HEAD.size
    size = (count * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), bitorder="little")[: count * width]
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :width] = bits.reshape(count, width)
    ids = np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel() + np.uint32(least)
    at += size
    ids[np.frombuffer(data, "<u2", n, at)] = np.frombuffer(data, "<u4", n, at + 2 * n)
    return ids


def pack_file(docs: list[tuple[int, bytes]], place: tuple[int, int], percentile: float = PERCENTILE) -> bytes:
    """All of a file but its last eight bytes. docs: key and ids of each document."""
    ids = np.frombuffer(b"".join(d for _, d in docs), "<u4")
    parts, starts, at = [START], [], len(START)
    for i in range(0, len(ids), BLOCK_IDS):
        parts.append(pack_block(ids[i : i + BLOCK_IDS], percentile))
        starts.append(at)
        at += len(parts[-1])
    sizes = np.array([len(d) // 4 for _, d in docs], "<u8")
    listed = np.zeros(len(docs), [("key", "<i8"), ("start", "<u8"), ("ids", "<u8")])
    listed["key"], listed["start"], listed["ids"] = [k for k, _ in docs], np.cumsum(sizes) - sizes, sizes
    footer = np.array(starts, "<u8").tobytes() + listed.tobytes()
    tail = _TAIL.pack(len(starts), len(docs), len(ids), *place, len(footer))
    return b"".join([*parts, footer, tail])


class TokenFile:
    """A file's content; blocks are unpacked when a range of ids needs them."""

    def __init__(self, data: bytes):
        data = memoryview(data)
        if bytes(data[:8]) != START or bytes(data[-8:]) != STOP:
            raise ValueError("not a whole token file")
        blocks, docs, self.ids, *self.place, size = _TAIL.unpack_from(data, len(data) - 8 - _TAIL.size)
        footer = len(data) - 8 - _TAIL.size - size
        self.data, self.starts = data, np.frombuffer(data, "<u8", blocks, footer)
        self.docs = np.frombuffer(
            data, [("key", "<i8"), ("start", "<u8"), ("ids", "<u8")], docs, footer + 8 * blocks
        )
        self.held: tuple[int, np.ndarray] = (-1, np.empty(0, "<u4"))

    def block(self, i: int) -> np.ndarray:
        if self.held[0] != i:
            self.held = (i, unpack_block(self.data[int(self.starts[i]) :]))
        return self.held[1]

    def read(self, start: int, count: int) -> bytes:
        """``count`` ids from ``start`` on, as they were given."""
        out = []
        while count:
            i, skip = divmod(start, BLOCK_IDS)
            part = self.block(i)[skip : skip + count]
            out.append(part.tobytes())
            start, count = start + len(part), count - len(part)
        return b"".join(out)


def write(
    docs: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text",
    file_ids: int = FILE_IDS, parts: int | None = None,
) -> None:
    """Encodes every whole text, ends it with id 1, and writes the files in ascending
    key order. One shuffle by key ranges; a task holds one file's ids at a time."""
    spark = docs.sparkSession
    parts = parts or shuffle_parts(spark)
    own = texts(docs, key, text)
    bucket = range_bucket(key, range_bounds(own, key, parts))
    ordered = (
        own.withColumn("r", bucket).repartitionById(parts, F.col("r")).withColumn("tie", F.xxhash64(text))
        .sortWithinPartitions("r", key, "tie").select("r", key, text)
    )

    def run(batches):
        coder = encoder(path)
        held, size, number, now = [], 0, 0, None
        for batch in batches:
            coded = coder.encode_all(batch.column(2).cast(pa.binary()).to_pylist())
            for r, doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), coded):
                if held and (r != now or size >= file_ids):
                    yield _row(pack_file(held, (now, number)))
                    held, size, number = [], 0, number + 1
                now, size = r, size + len(ids) // 4 + 1
                held.append((-(1 << 63) if doc is None else doc, ids + END))
        if held:
            yield _row(pack_file(held, (now, number)))

    files = ordered.mapInArrow(run, "file binary").select(F.col("file").cast("string").alias("value"))
    files.write.option("lineSep", STOP.decode()).option("maxRecordsPerFile", 1).text(folder)


def _row(data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["file"])


def read(spark, folder: str, key: str = "doc_id") -> DataFrame:
    """Per document, from the files alone: key, start (ids of all documents before
    it), number of ids and their checksum."""
    names = [key, "local", "n_tokens", "ids_crc32", "r", "number", "total"]

    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                file = TokenFile(data)
                rows = file.docs.tolist()
                if rows:
                    checks = [zlib.crc32(file.read(start, n)) for _, start, n in rows]
                    keys = [None if k == -(1 << 63) else k for k, _, _ in rows]
                    columns = [keys, [s for _, s, _ in rows], [n for _, _, n in rows], checks,
                               *([v] * len(rows) for v in (*file.place, file.ids))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    content = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    docs = written(content.mapInArrow(run, ", ".join(f"`{n}` long" for n in names)), "token-docs")
    files = docs.groupBy("r", "number").agg(F.max("total").alias("total"))  # a row for each file
    before = F.sum("total").over(Window.orderBy("r", "number").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("r", "number", F.coalesce(before, F.lit(0)).alias("before"))
    return docs.join(files, ["r", "number"]).select(
        key, (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def write_read(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Writes the documents' ids and reads the files back. Null and empty texts are
    the end id alone; keys are integers, a null key comes first; rows of one key are
    ordered by their text's hash; other columns are not read."""
    folder = work_dir(docs.sparkSession, "token-files")
    write(docs, folder, path, key, text, **options)
    return read(docs.sparkSession, folder, key)
