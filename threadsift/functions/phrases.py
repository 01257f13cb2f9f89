"""Which of many phrases occur in the texts of an Arrow batch.

Phrases are found by the 8 bytes (or fewer) that they begin with. A text is looked at
from each of its bytes once for every size up to 8 that phrases have, whatever their number;
longer phrases are looked up by length, first and last 8 bytes where their first 8 occur,
and then compared whole. Bytes of UTF-8 decide, as in Spark's ``contains``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of a word, positions looked at at once, and bits of the tables that thin them.
WORD, CHUNK, BITS = 8, 1 << 17, 16
ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - BITS)


def _words(data: bytes | np.ndarray) -> np.ndarray:
    """The 8 bytes from each byte on as one number, zeros after the end."""
    padded = np.zeros(len(data) + WORD, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, strides=(1,))


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys * ODD) >> _SHIFT).view(np.int64)


def _ends(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """One number of the first and the last bytes of a long phrase."""
    return first ^ (last * ODD + (last >> np.uint64(31)))


class _Keys:
    """Sorted keys with a number for each; a key may have several."""

    def __init__(self, pairs: list[tuple[int, int]]):
        keys, numbers = np.array([k for k, _ in pairs], np.uint64), np.array([n for _, n in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.numbers = keys[order], numbers[order]
        self.table = np.zeros(1 << BITS, bool)
        self.table[_slot(self.keys)] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the keys that are here, and the numbers they have."""
        at = np.flatnonzero(self.table[_slot(keys)])
        low = np.searchsorted(self.keys, keys[at])
        many = np.searchsorted(self.keys, keys[at], side="right") - low
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(at, many), self.numbers[np.repeat(low, many) + within]


class Phrases:
    """An index of phrases; the place of a phrase in the list is its query."""

    def __init__(self, phrases: list[str]):
        queries: dict[bytes, list[int]] = defaultdict(list)
        for query, phrase in enumerate(phrases):
            queries[phrase.encode()].append(query)
        self.always = queries.pop(b"", [])
        known = sorted(queries)
        self.sizes = np.array([len(p) for p in known], np.int64)
        self.queries = [queries[p] for p in known]
        self.words = [_words(p) for p in known]
        short, long = defaultdict(list), defaultdict(list)
        for n, p in enumerate(known):
            first, last = self.words[n][:1], self.words[n][max(len(p) - WORD, 0) :][:1]
            if len(p) <= WORD:
                short[len(p)].append((int(first[0]), n))
            else:
                long[len(p)].append((int(_ends(first, last)[0]), n))
        self.short = [(np.uint64((1 << 8 * size) - 1), _Keys(pairs)) for size, pairs in sorted(short.items())]
        self.long = [(size, _Keys(pairs)) for size, pairs in sorted(long.items())]
        heads = {int(self.words[n][0]) for n, p in enumerate(known) if len(p) > WORD}
        self.heads = _Keys([(k, 0) for k in heads])

    def _compared(self, words: np.ndarray, at: np.ndarray, found: np.ndarray, size: int) -> np.ndarray:
        """Which of the phrases of one size really are at their places."""
        same = np.ones(len(at), bool)
        kinds, which = np.unique(found, return_inverse=True)
        for step in [*range(0, size - WORD, WORD), size - WORD]:
            same &= words[at + step] == np.array([self.words[n][step] for n in kinds], np.uint64)[which]
        return same

    def _places(self, words: np.ndarray, start: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of phrases that begin in one chunk, and the phrases there."""
        here = words[start : min(start + CHUNK, len(words) - 1)].astype(np.uint64)
        for mask, keys in self.short:
            at, found = keys.find(here & mask)
            yield at + start, found
        if self.long:
            heads = self.heads.find(here)[0] + start
            for size, keys in self.long:
                at = heads[heads + size < len(words)]
                index, found = keys.find(_ends(words[at], words[at + size - WORD]))
                same = self._compared(words, at[index], found, size)
                yield at[index][same], found[same]

    def hits(self, texts: pa.Array) -> pa.ListArray:
        """For each text, none of them null, the queries whose phrase it contains."""
        texts = texts.cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        data = texts.buffers()[2]
        data = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
        ends, words, pairs = ends - ends[0], _words(data), [np.empty(0, np.int64)]
        for start in range(0, len(data), CHUNK):
            at, found = (np.concatenate(a) for a in zip((np.empty(0, np.int64),) * 2, *self._places(words, start)))
            row = np.searchsorted(ends, at, side="right") - 1
            inside = at + self.sizes[found] <= ends[row + 1]
            pairs.append(np.unique(row[inside] * len(self.sizes) + found[inside]))
        out = [list(self.always) for _ in range(len(texts))]
        for row, n in zip(*(a.tolist() for a in np.divmod(np.unique(np.concatenate(pairs)), max(len(self.sizes), 1)))):
            out[row] += self.queries[n]
        return pa.array(out, pa.list_(pa.int32()))


def search(phrases: list[str], on: str):
    """For ``mapInArrow``: the column ``on`` becomes ``_queries``, the last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Phrases(phrases)
        for batch in batches:
            kept = [c for c in batch.schema.names if c != on]
            found = index.hits(batch.column(on))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), found], names=[*kept, "_queries"])

    return run
