"""BPE encoding and decoding with forced-boundary splitting.

The vocabulary tells which pairs of neighbouring bytes occur inside some token. A
pair that occurs in none marks a certain cut: no merge ever crosses it, so both
sides are encoded on their own and the ids concatenated. As this vocabulary marks
word ends, a cut is used only where the tokenizer ends a word, too: beside white
space (which is never part of a token), between ASCII bytes of different classes
(letter, digit, other) or two digits, but never behind an apostrophe, as
contractions are words, and between a Latin-1 letter and an ASCII sign.

White space is cut first. The other cuts are looked up for all chunks of a batch that
a cache does not know, at once; fragments that are plain words are merged at once as
well, all others go through the library. Chunks that may hold a special token's
string are not cut further. Long texts are walked in slices; the cache is bounded.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import texts

#: The tokenizer of the registered queries; every operator takes its path as a parameter.
VOCABULARY = "word_bpe_49k.json"
CACHE = 1 << 19
LONGEST = 64
SLICE = 1 << 20
_SPACE = b" \t\n\x0b\f\r"
_NONE = np.int32(1 << 30)
_ENCODERS: dict[str, FragmentEncoder] = {}


def vocabulary(name: str = VOCABULARY) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _class(byte: int) -> str:
    c = chr(byte)
    return "space" if byte in _SPACE else "letter" if c.isalpha() else "digit" if c.isdigit() else "other"


def pairs_inside(tokens: list[str], suffix: str) -> np.ndarray:
    """Row a, column b: whether some token has byte b right behind byte a. Upper case
    counts as lower case, since texts are lower-cased before merging."""
    alphabet, inside = byte_alphabet(), np.zeros((256, 256), bool)
    for token in tokens:
        data = np.array([alphabet[c] for c in token.removesuffix(suffix)])
        inside[data[:-1], data[1:]] = True
    low = np.arange(ord("a"), ord("z") + 1)
    inside[low - 32, :] |= inside[low, :]
    inside[:, low - 32] |= inside[:, low]
    return inside


def cut_tables(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of bytes that are certainly cut, and those that are behind the last byte
    of a Latin-1 letter."""
    always, after = np.zeros((256, 256), bool), np.zeros((256, 256), bool)
    for a in range(128):
        for b in range(128):
            always[a, b] = (_class(a) != _class(b) or _class(a) == "digit") and a != ord("'")
    always[list(_SPACE), :] = always[:, list(_SPACE)] = True
    after[:, [b for b in range(33, 127) if _class(b) != "letter"]] = True
    return always & ~inside, after & ~inside


class PairTable:
    """Rank of a merge by its two symbols, for arrays: hashing, and one more table for
    the pairs whose place was taken."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        rank, self.levels = np.arange(len(key), dtype=np.int32), []
        while len(key):
            bits = max(8, int(len(key)).bit_length() + 3)
            keys = np.full(1 << bits, np.uint64(2**64 - 1))
            ranks = np.full(1 << bits, _NONE)
            at = self._at(key, bits)
            keys[at], ranks[at] = key, rank
            self.levels.append((bits, keys, ranks))
            lost = keys[at] != key
            key, rank = key[lost], rank[lost]

    @staticmethod
    def _at(key: np.ndarray, bits: int) -> np.ndarray:
        return (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Negative symbols stand for none."""
        key = left.astype(np.uint64) << np.uint64(32) | (right.astype(np.uint64) & np.uint64(0xFFFFFFFF))
        out = np.full(key.shape, _NONE)
        for bits, keys, ranks in self.levels:
            at = self._at(key, bits)
            out = np.where(keys[at] == key, ranks[at], out)
        return out


class FragmentEncoder:
    """Encodes texts as the library would, by fragments."""

    def __init__(self, path: str, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        model = json.loads(self.library.to_str())["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.always, self.after = cut_tables(pairs_inside(list(vocab), suffix))
        self.signs = np.array([32 < b < 127 and b != ord("'") and _class(b) == "other" for b in range(256)])
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.pairs = PairTable(*(np.array([vocab[m[k]] for m in merges]) for k in (0, 1)))
        self.merged = np.array([vocab[a.removesuffix(suffix) + b] for a, b in merges], np.int32)
        self.inner, self.last = np.zeros(256, np.int32), np.zeros(256, np.int32)
        for c, byte in byte_alphabet().items():
            self.inner[byte], self.last[byte] = vocab[c], vocab[c + suffix]
        every = self.library.get_vocab()
        self.strings = [b""] * (max(every.values()) + 1)
        for token, i in every.items():
            self.strings[i] = token.encode()
        self.known: dict[bytes, bytes] = {}
        self.odd: dict[bytes, bytes] = {}
        self.long: list[bytes] = []
        self.limit = cache

    @staticmethod
    def simple(text: bytes) -> bool:
        """Whether it has no combining marks or special tokens, so that lower case can
        come first. Marks begin at U+0300."""
        return bool(text) and np.frombuffer(text, np.uint8).max() < 0xCC and b"<|" not in text

    def fragments(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the fragments of a buffer, and which are plain words: lower-case
        letters, signs or a digit."""
        lead = buf == 0xC3
        letter = np.zeros(len(buf), bool)  # last byte of a Latin-1 letter
        letter[1:] = lead[:-1] & (buf[1:] >= 0x80) & (buf[1:] <= 0xBF) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
        a, b = buf[:-1], buf[1:]
        cut = self.always[a, b] | (letter[:-1] & self.after[a, b])
        starts = np.concatenate([[0], np.flatnonzero(cut) + 1])
        plain = ((buf >= 97) & (buf <= 122)) | (letter & (buf >= 0x9F))
        plain[:-1] |= lead[:-1] & plain[1:] & letter[1:]
        sign, digit = self.signs[buf], (buf >= 48) & (buf <= 57)
        whole = np.logical_and.reduceat
        return starts, whole(plain, starts) | whole(sign, starts) | whole(digit, starts)

    def merge(self, buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Ids of plain words: again and again each word's pair of lowest rank is
        merged, in all words at once."""
        width = int(sizes.max())
        place = np.arange(width)
        at = np.minimum(starts[:, None] + place, len(buf) - 1)
        symbols = np.where(place < sizes[:, None] - 1, self.inner[buf[at]], self.last[buf[at]])
        symbols = np.where(place < sizes[:, None], symbols, -1).astype(np.int32)
        ranks = np.full(symbols.shape, _NONE)
        ranks[:, :-1] = np.where(symbols[:, 1:] < 0, _NONE, self.pairs.ranks(symbols[:, :-1], symbols[:, 1:]))
        done, rows = np.full(symbols.shape, -1, np.int32), np.arange(len(sizes))
        while len(rows):
            best = ranks.argmin(axis=1)
            every = np.arange(len(rows))
            lowest = ranks[every, best]
            over = lowest == _NONE
            done[rows[over]] = symbols[over]
            rows, best, lowest = rows[~over], best[~over], lowest[~over]
            symbols, ranks, every = symbols[~over], ranks[~over], np.arange(len(rows))
            if not len(rows):
                break
            symbols[every, best] = self.merged[lowest]
            behind = place[None, :-1] > best[:, None]
            symbols[:, :-1] = np.where(behind, symbols[:, 1:], symbols[:, :-1])
            ranks[:, :-1] = np.where(behind, ranks[:, 1:], ranks[:, :-1])
            symbols[:, -1], ranks[:, -1] = -1, _NONE
            for left in (best - 1, best):
                ok = left >= 0
                r, p = every[ok], left[ok]
                q = np.minimum(p + 1, width - 1)
                second = np.where(p + 1 < width, symbols[r, q], -1)
                found = self.pairs.ranks(symbols[r, p], second)
                ranks[r, p] = np.where(second < 0, _NONE, found)
        return done

    def learn(self, chunks: list[bytes]) -> None:
        """Encodes new chunks and keeps them."""
        whole = [c for c in chunks if len(c) > LONGEST or b"<|" in c]
        self.long = [c for c in whole if len(c) > LONGEST]
        for chunk in whole:
            self.known[chunk] = self.one(chunk)
        chunks = [c for c in chunks if len(c) <= LONGEST and b"<|" not in c]
        if not chunks:
            return
        buf = np.frombuffer(b" ".join(chunks) + b" ", np.uint8)
        starts, plain = self.fragments(buf)
        ends = np.append(starts[1:], len(buf))
        sizes, space = ends - starts, buf[starts] == 32
        counts, merged = np.zeros(len(starts), np.int64), []
        for low, high in ((0, 6), (6, 10), (10, 16), (16, 32), (32, LONGEST)):
            own = np.flatnonzero(plain & (sizes > low) & (sizes <= high))
            if len(own):
                ids = self.merge(buf, starts[own], sizes[own])
                counts[own] = (ids >= 0).sum(axis=1)
                merged.append((own, ids[ids >= 0]))
        odd, coded, data = np.flatnonzero(~plain & ~space), [], buf.tobytes()
        for a, b in zip(starts[odd].tolist(), ends[odd].tolist()):
            part = data[a:b]
            if part not in self.odd:
                self.odd[part] = self.one(part)
            coded.append(self.odd[part])
        counts[odd] = [len(c) // 4 for c in coded]
        merged.append((odd, np.frombuffer(b"".join(coded), "<u4")))
        after = np.cumsum(counts)
        flat = np.empty(after[-1], "<u4")
        for own, ids in merged:
            n = counts[own]
            flat[np.arange(len(ids)) + np.repeat(after[own] - np.cumsum(n), n)] = ids
        data, at = flat.tobytes(), (4 * after[space]).tolist()
        self.known.update(zip(chunks, [data[a:b] for a, b in zip([0, *at], at)]))

    def one(self, part: bytes) -> bytes:
        ids = self.library.encode(part.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()

    def encode_all(self, batch: list[bytes]) -> list[bytes]:
        """Ids of each text (UTF-8), as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for group in _groups(batch):
            words = [
                (part.decode("utf-8", "replace").lower().encode() if self.simple(part) else part).split()
                for part in group
            ]
            for store in (self.known, self.odd):
                if len(store) > self.limit:
                    store.clear()
            self.learn(list(set().union(*words).difference(self.known)))
            known = self.known
            coded = [b"".join([known[w] for w in own]) for own in words]
            for chunk in self.long:  # kept for this group only
                known.pop(chunk, None)
            self.long = []
            if len(group) == 1 and out and group.continues:
                out[-1] += coded[0]
            else:
                out += coded
        return out

    def encode(self, text: bytes) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The library's decoding, special tokens kept, in UTF-8: this vocabulary has
        no decoder, so it is the tokens with a blank between them."""
        strings = self.strings
        return b" ".join([strings[i] for i in ids.tolist()])


class _Group(list):
    """Texts that are encoded together; a slice of a text that began before stands alone."""

    continues = False


def _groups(batch: list[bytes]) -> Iterator[_Group]:
    """Texts of about SLICE bytes together; longer ones in slices that end before
    white space."""
    group, held = _Group(), 0
    for text in batch:
        start = 0
        while len(text) - start > SLICE:
            ends = [p for p in (text.find(bytes([s]), start + SLICE) for s in _SPACE) if p >= 0]
            if not ends:
                break
            if group:
                yield group
                group, held = _Group(), 0
            own = _Group([text[start : min(ends)]])
            own.continues = start > 0
            yield own
            start = min(ends)
        if start:
            own = _Group([text[start:]])
            own.continues = True
            yield own
            continue
        group.append(text)
        held += len(text)
        if held > 4 * SLICE:
            yield group
            group, held = _Group(), 0
    if group:
        yield group


def encoder(path: str) -> FragmentEncoder:
    """One encoder for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = FragmentEncoder(path)
    return _ENCODERS[path]


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every whole text and the text they decode to, as counts and digests.

    One narrow pass without a shuffle. Null and empty texts, and texts of white space
    only, have no ids; repeated rows give repeated rows; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        coder = encoder(path)
        for batch in batches:
            n, ids_sha, decoded_sha = [], [], []
            for coded in coder.encode_all(batch.column(1).cast(pa.binary()).to_pylist()):
                ids = np.frombuffer(coded, "<u4")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(coded).hexdigest())
                decoded_sha.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(decoded_sha, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return texts(docs, key, text).mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
