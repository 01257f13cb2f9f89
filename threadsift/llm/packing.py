"""Packing documents into sequences of a fixed number of token ids.

Bounded-space online packing: each partition keeps a fixed number of open windows. A
document's full windows are emitted at once; its rest goes to the open window that it
fits best. Where it fits none and no further window may be opened, the fullest one is
topped up with the head of the rest and emitted. What is still open when a partition
ends is merged: partitions in groups, the groups' leftovers in groups again, until one
group is left, whose pieces are laid end to end. So no task ever holds more than
``fan_in`` times ``windows`` open windows, and only the very last sequence is short.

Pieces that are final are written once and never move; only open ones carry their ids.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import written
from .common import texts
from .tokens import encoder

SIZE = 2048
#: Open windows of a partition, and how many partitions' leftovers one task merges.
WINDOWS = 32
FAN_IN = 64
END = (1).to_bytes(4, "little")


@dataclass
class Piece:
    doc: object
    start: int
    ids: bytes  # little-endian unsigned 32-bit integers
    total: int

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.start, self.ids[: 4 * n], self.total),
                Piece(self.doc, self.start + n, self.ids[4 * n :], self.total))


class Windows:
    """The open windows of one task. Emitted sequences are lists of pieces."""

    def __init__(self, size: int = SIZE, limit: int = WINDOWS):
        self.size, self.limit = size, limit
        self.rooms: list[tuple[int, int]] = []  # room and number of each open window
        self.held: dict[int, list[Piece]] = {}
        self.next = 0

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece) >= self.size:
            head, piece = piece.cut(self.size)
            yield [head]
        while len(piece):
            at = bisect_left(self.rooms, (len(piece), -1))
            if at < len(self.rooms):  # the smallest room that holds it
                room, number = self.rooms.pop(at)
                self.held[number].append(piece)
                if room == len(piece):
                    yield self.held.pop(number)
                else:
                    insort(self.rooms, (room - len(piece), number))
                return
            if len(self.rooms) < self.limit:
                self.held[self.next] = [piece]
                insort(self.rooms, (self.size - len(piece), self.next))
                self.next += 1
                return
            room, number = self.rooms.pop(0)  # the fullest: top it up and emit it
            head, piece = piece.cut(room)
            self.held[number].append(head)
            yield self.held.pop(number)

    def left(self) -> list[Piece]:
        return [p for _, number in self.rooms for p in self.held[number]]


def _end_to_end(pieces: list[Piece], size: int) -> Iterator[list[Piece]]:
    """All pieces in order, cut wherever a sequence is full."""
    own, room = [], size
    for piece in pieces:
        while len(piece):
            head, piece = piece.cut(min(room, len(piece)))
            own.append(head)
            room -= len(head)
            if not room:
                yield own
                own, room = [], size
    if own:
        yield own


class _Rows:
    """Rows of one task: final pieces with their place, open ones with their ids.
    Sequences are numbered within the task: round, task, count."""

    def __init__(self, turn: int, task: int):
        self.first, self.count, self.task, self.rows = (turn << 57) | (task << 31), 0, task, []

    def final(self, sequence: list[Piece]) -> None:
        number, offset = self.first + self.count, 0
        self.count += 1
        for p in sequence:
            self.rows.append((p.doc, p.start, len(p), zlib.crc32(p.ids), p.total, number, offset, None, None))
            offset += len(p)

    def open(self, pieces: list[Piece]) -> None:
        self.rows += [(p.doc, p.start, len(p), zlib.crc32(p.ids), p.total, None, None, self.task, p.ids) for p in pieces]

    def take(self) -> list:
        rows, self.rows = self.rows, []
        return rows


def _schema(key: str, kind: str) -> str:
    return (
        f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, `offset` long, task int, ids binary"
    )


def pack(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = SIZE,
    windows: int = WINDOWS, fan_in: int = FAN_IN,
) -> DataFrame:
    """One row for each piece of a document: where it starts in its document's ids,
    its length and checksum, its document's ids in all, its sequence and the offset
    there. Every document ends with id 1, so null and empty texts are one id long;
    repeated rows are packed each on its own; other columns are not read.
    """
    kind = docs.schema[key].dataType
    schema = _schema(key, kind.simpleString())
    names = [c.strip().split(" ")[0].strip("`") for c in schema.split(", ")]

    def first(batches):
        coder, open_ = encoder(path), Windows(size, windows)
        out, arrow = _Rows(0, TaskContext.get().partitionId()), None
        for batch in batches:
            arrow = arrow or _arrow(batch.schema.field(0).type)
            keys = batch.column(0).to_pylist()
            for doc, coded in zip(keys, coder.encode_all(batch.column(1).cast(pa.binary()).to_pylist())):
                ids = coded + END
                for sequence in open_.add(Piece(doc, 0, ids, len(ids) // 4)):
                    out.final(sequence)
            yield _batch(out.take(), arrow)
        if arrow is not None:
            out.open(open_.left())
            yield _batch(out.take(), arrow)

    def merge(turn: int, last: bool):
        def run(group: pa.Table) -> pa.Table:
            rows = sorted(group.to_pylist(), key=lambda r: (-r["length"], r["task"], r["start"]))
            pieces = [Piece(r[key], r["start"], r["ids"], r["doc_tokens"]) for r in rows]
            out = _Rows(turn, rows[0]["group"])
            if last:
                for sequence in _end_to_end(pieces, size):
                    out.final(sequence)
            else:
                open_ = Windows(size, windows)
                for piece in pieces:
                    for sequence in open_.add(piece):
                        out.final(sequence)
                out.open(open_.left())
            return pa.Table.from_batches([_batch(out.take(), _arrow(group.schema.field(key).type))])

        return run

    def _arrow(key_type: pa.DataType) -> pa.Schema:
        return pa.schema([
            (key, key_type), *((n, pa.int64()) for n in names[1:7]), ("task", pa.int32()), ("ids", pa.binary()),
        ])

    table = written(texts(docs, key, text).mapInArrow(first, schema), "pack")
    packed = [table.where("sequence_id IS NOT NULL")]
    tasks = (table.agg(F.max("task")).first()[0] or 0) + 1
    turn = 0
    while tasks:
        turn += 1
        groups = -(-tasks // fan_in)
        left = table.where("sequence_id IS NULL").withColumn("group", F.expr(f"cast(task DIV {fan_in} AS int)"))
        table = left.groupBy("group").applyInArrow(merge(turn, groups == 1), schema)
        if groups > 1:
            table = written(table, "pack")
        packed.append(table.where("sequence_id IS NOT NULL"))
        tasks = groups if groups > 1 else 0
    out = packed[0]
    for more in packed[1:]:
        out = out.unionByName(more)
    return out.drop("task", "ids")


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
