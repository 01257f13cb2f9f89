"""Hashes of words, for whole buffers at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at once.
SEGMENT = 1 << 21
ODD = np.uint64(0x9E3779B97F4A7C15)
TABLE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


def batch_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a batch of strings without nulls, and where each one starts, with
    the end of the last."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _word_hashes(data: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a buffer; none crosses an edge. A word's hash
    is a polynomial over its bytes, from prefix sums."""
    space = is_space(data)
    start = np.flatnonzero(~space & (np.concatenate([[True], space[:-1]]) | edge[:-1]))
    end = np.flatnonzero(~space & (np.concatenate([space[1:], [True]]) | edge[1:])) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(TABLE[data] * _powers(_BASE, len(data)), out=sums[1:])
    value = (sums[end] - sums[start]) * _powers(_INVERSE, len(data) + 1)[start]
    return start, mix(value + (end - start).astype(np.uint64))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, hashes and texts of all words of a batch; long ones are walked in
    segments that end at white space."""
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts, hashes, at = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
    while at < len(data):
        stop = min(at + SEGMENT, len(data))
        while stop < len(data) and not (edge[stop] or data[stop] == 32 or 9 <= data[stop] <= 13):
            stop += 1
        start, value = _word_hashes(data[at:stop], edge[at : stop + 1])
        starts.append(start + at)
        hashes.append(value)
        at = stop
    start = np.concatenate(starts)
    return start, np.concatenate(hashes), np.searchsorted(offsets, start, side="right") - 1
