"""Encoding, packing and token files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from threadsift.llm import packing, token_files, tokens

PATH = tokens.vocabulary()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def ids(library, documents):
    return {k: library.encode(t, add_special_tokens=False).ids for k, t in documents[1].items()}


def _bytes(ids):
    return np.array(ids, "<u4").tobytes()


def test_random_texts_encode_as_the_library_does(library):
    coder, rng = tokens.FragmentEncoder(PATH, cache=200), random.Random(5)
    signs = "aAbzZ09'!?,.<|>-_sStTrRevVmMlLdD \t\n\x0b\x0c\r\x1c\x85  éÉÇçΣσς̧́İıſK中문😀٣½﻿​@#$"
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 14)))
        if rng.random() < 0.1:
            text += rng.choice(["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>x"]) + rng.choice(signs)
        got = np.frombuffer(coder.encode(text.encode()), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_slices_of_long_texts(library, monkeypatch):
    monkeypatch.setattr(tokens, "SLICE", 50)
    coder = tokens.FragmentEncoder(PATH)
    texts = ["the cat sat, " * 40, "x" * 300, "", "on the mat. " * 3, "a b " * 60]
    for text, got in zip(texts, coder.encode_all([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_cut_tables_come_from_the_vocabulary():
    inside = tokens.pairs_inside(["ab</w>", "b,"], "</w>")
    always, after = tokens.cut_tables(inside)
    assert inside[ord("a"), ord("b")] and inside[ord("A"), ord("b")]
    assert not always[ord("b"), ord(",")] and always[ord("a"), ord(",")] and always[ord("1"), ord("2")]
    assert not always[ord("'"), ord("s")] and after[0xA9, ord("!")]


def test_encode_decode(documents, library, ids):
    for r in tokens.encode_decode(documents[0], PATH).collect():
        own = ids[r["doc_id"]]
        decoded = library.decode(own, skip_special_tokens=False)
        assert r["n_tokens"] == len(own)
        assert r["ids_sha256"] == hashlib.sha256(_bytes(own)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def check_packed(rows, ids, size):
    at, sequences = {}, {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]] + [1]
        assert r["start"] == at.get(r["doc_id"], 0) and r["doc_tokens"] == len(own)
        at[r["doc_id"]] = r["start"] + r["length"]
        assert r["ids_crc32"] == zlib.crc32(_bytes(own[r["start"] : at[r["doc_id"]]]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert at == {k: len(v) + 1 for k, v in ids.items()}
    ends = []
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        ends.append(end)
    assert max(ends) <= size
    return ends


@pytest.mark.parametrize("windows,fan_in", [(32, 64), (2, 2)])
def test_packing_is_whole_and_full(documents, ids, windows, fan_in):
    df = documents[0].repartition(5)
    rows = packing.pack(df, PATH, windows=windows, fan_in=fan_in).collect()
    ends = check_packed(rows, ids, 2048)
    assert sum(2048 - e for e in ends) < 2048  # only the last sequence is short


def test_windows_place_best_fit_and_top_up_the_fullest():
    open_ = packing.Windows(10, 2)
    piece = lambda doc, n: packing.Piece(doc, 0, b"\0" * 4 * n, n)
    assert list(open_.add(piece("a", 6))) == [] and list(open_.add(piece("b", 7))) == []
    full = list(open_.add(piece("c", 3)))  # fits b best
    assert [[p.doc for p in s] for s in full] == [["b", "c"]]
    assert list(open_.add(piece("d", 5))) == []
    full = list(open_.add(piece("e", 8)))  # fits none: a is the fullest
    assert [[(p.doc, len(p)) for p in s] for s in full] == [[("a", 6), ("e", 4)]]
    assert sum(map(len, open_.left())) == 9


@pytest.mark.parametrize("width", ["small", "outliers", "equal", "large"])
def test_blocks_round_trip(width):
    rng = np.random.default_rng(2)
    ids = {
        "small": rng.integers(0, 50, 4096), "outliers": np.where(rng.random(4096) < 0.02, 2**32 - 1, 7),
        "equal": np.full(17, 49407), "large": rng.integers(0, 2**32, 1000),
    }[width].astype("<u4")
    data = token_files.pack_block(ids)
    assert (token_files.unpack_block(memoryview(data)) == ids).all()
    if width == "outliers":
        assert len(data) < 1000


def test_damaged_files_are_refused():
    data = token_files.pack_file([(1, _bytes([1, 2, 3]))], (0, 0)) + token_files.STOP
    assert token_files.TokenFile(data).read(1, 2) == _bytes([2, 3])
    with pytest.raises(ValueError):
        token_files.TokenFile(data[:-1])


@pytest.mark.parametrize("options", [{}, {"parts": 3, "file_ids": 500}])
def test_token_files(documents, ids, options):
    start = 0
    rows = {r["doc_id"]: r for r in token_files.write_read(documents[0], PATH, **options).collect()}
    for k in sorted(ids):
        own = ids[k] + [1]
        assert (rows[k]["start"], rows[k]["n_tokens"]) == (start, len(own))
        assert rows[k]["ids_crc32"] == zlib.crc32(_bytes(own))
        start += len(own)


def test_odd_rows(odd, empty, library):
    texts = [r["text"] or "" for r in odd.collect()]
    n = sorted(len(library.encode(t, add_special_tokens=False).ids) for t in texts)
    assert sorted(r["n_tokens"] for r in tokens.encode_decode(odd, PATH).collect()) == n
    rows = packing.pack(odd, PATH).collect()
    assert sum(r["length"] for r in rows) == sum(n) + len(n)
    rows = token_files.write_read(odd, PATH).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 3, 4, 5, 6, 7, 8]
    assert sorted(r["n_tokens"] - 1 for r in rows) == n
    for made in (tokens.encode_decode(empty, PATH), packing.pack(empty, PATH), token_files.write_read(empty, PATH)):
        assert made.count() == 0
