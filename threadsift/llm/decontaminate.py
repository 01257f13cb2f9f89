"""Benchmark decontamination: a broadcast set of n-gram hashes, scanned for in every text.

Benchmark items and documents become words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, A-Z in
lower case). A window is ten consecutive words of an item, or all of a shorter item.
The windows are one small table: hash, words, items. It is broadcast, and every
document's windows, hashed by doubling (of two words, of four, of eight), look their hash
up in the same narrow pass. A hash that is found is verified at once: the words at that
place must be those of the item's window. So texts are never shuffled; only a row for
each document and each hit is.

The table's size is measured before it is broadcast. One of more than ``BROADCAST_BYTES``
is cut by hash into several, and the documents, written once with their row numbers, are
scanned once for each. DataFrame functions only.

Null texts have no words. Documents need no unique keys: rows are told apart by number,
and repeated rows give repeated rows. An item with a null id has windows that hit words,
but is in no list of items; rows of one item id are one item. Without benchmark items
nothing is hit.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..session import written
from .spans import quoted, sha256

#: Words of a window.
WORDS = 10
#: Estimated bytes of windows that are broadcast at once.
BROADCAST_BYTES = 64 << 20

_OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: str) -> str:
    """SQL for the words of a text. ``lower`` is right and fast where all is ASCII;
    elsewhere it would change more than A-Z."""
    lowered = (
        f"CASE WHEN octet_length({text}) = char_length({text}) THEN lower({text}) "
        f"ELSE translate({text}, '{_UPPER}', '{_UPPER.lower()}') END"
    )
    return f"array_remove(split({lowered}, {quoted(_OTHER)}, -1), '')"


def _with_hashes(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds ``h1``, ``h2`` ...: hashes of all windows of so many of the ``words``, for the
    lengths given and those they are made of."""
    made: set[int] = set()

    def add(length: int) -> None:
        nonlocal df
        if length in made:
            return
        made.add(length)
        if length == 1:
            df = df.withColumn("h1", F.expr("transform(words, w -> xxhash64(w))"))
            return
        half = 1 << (length - 1).bit_length() - 1
        add(half)
        add(length - half)
        size = f"greatest(size(words) - {length - 1}, 0)"
        df = df.withColumn(f"h{length}", F.expr(
            f"zip_with(slice(h{half}, 1, {size}), slice(h{length - half}, {half + 1}, {size}), (a, b) -> xxhash64(a, b))"
        ))

    for length in lengths:
        add(length)
    return df


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WORDS) -> DataFrame:
    """Every distinct window once: hash, words (joined by spaces), their number, and the
    ids of the items that hold it, as strings in order."""
    own = benchmark.select(
        F.col(f"`{item}`").cast("string").alias("item"),
        F.expr(words(f"coalesce(`{text}`, '')")).alias("words"),
    ).where("size(words) > 0")
    hashed = _with_hashes(own, list(range(1, size + 1))).withColumn("length", F.expr(f"least(size(words), {size})"))
    of_length = " ".join(f"WHEN {n} THEN h{n}" for n in range(1, size + 1))
    placed = hashed.select("item", "words", "length", F.expr(f"posexplode(CASE length {of_length} END) AS (at, hash)"))
    cut = placed.select("item", "hash", "length", F.expr("array_join(slice(words, at + 1, length), ' ')").alias("words"))
    return cut.groupBy("hash", "words", "length").agg(F.array_sort(F.collect_set("item")).alias("items")).select(
        "hash", "words", F.col("length").cast("int").alias("length"), "items"
    )


def _places(lengths: list[int]) -> tuple[str, str]:
    """SQL for the first word and the length of the window at a place ``at`` of the joined
    lists of hashes, shortest length first, of a text of ``n_words``."""
    starts = [" + ".join(["0", *(f"greatest(n_words - {n - 1}, 0)" for n in lengths[:i])]) for i in range(len(lengths))]
    first = length = ""
    for n, start in reversed(list(zip(lengths, starts))):
        first += f"WHEN at >= {start} THEN at - ({start}) "
        length += f"WHEN at >= {start} THEN {n} "
    return f"CASE {first}END", f"CASE {length}END"


def _hits(rows: DataFrame, found: DataFrame, lengths: list[int]) -> DataFrame:
    """rows: row, text and more; a row for each verified hit (start, length, items), and one
    at least, without a hit, for each row."""
    more = [c for c in rows.columns if c != "text"]
    split = rows.select(*more, F.expr(words("text")).alias("words"))
    every = ", ".join(f"h{n}" for n in lengths)
    hashed = _with_hashes(split, lengths).select(
        *more, "words", F.expr("size(words)").alias("n_words"),
        (F.expr(f"concat({every})") if lengths else F.expr("cast(array() AS array<long>)")).alias("hashes"),
    )
    at_each = hashed.select(*more, "words", "n_words", F.expr("posexplode_outer(hashes) AS (at, h)"))
    first, length = _places(lengths) if lengths else ("0", "0")
    joined = at_each.join(F.broadcast(found.withColumnRenamed("words", "sought")), F.col("h") == F.col("hash"), "left")
    true = f"(sought IS NOT NULL AND sought = array_join(slice(words, {first} + 1, {length}), ' '))"
    return joined.where(f"{true} OR at = 0 OR at IS NULL").select(
        *more, "n_words",
        F.expr(f"CASE WHEN {true} THEN struct({first} AS start, {first} + {length} AS end) END").alias("span"),
        F.expr(f"CASE WHEN {true} THEN items END").alias("items"),
    )


def _scanned(rows: DataFrame, benchmark: DataFrame, item: str, item_text: str, most: int) -> DataFrame:
    """Each of the rows (row, text and more) without its text, with n_words, spans (places
    of hit words, in order, without overlaps) and items."""
    found = written(windows(benchmark, item, item_text), "windows")
    extent = found.agg(
        F.sum(F.expr("octet_length(words) + octet_length(array_join(items, ',')) + 16 * size(items) + 96")).alias("bytes"),
        F.sort_array(F.collect_set("length")).alias("lengths"),  # ten numbers at most
    ).first()
    blocks = max(1, math.ceil((extent["bytes"] or 0) / most))
    if blocks > 1:
        rows = written(rows, "numbered")
    hits = reduce(DataFrame.union, [
        _hits(rows, found if blocks == 1 else found.where(f"pmod(hash, {blocks}) = {b}"), extent["lengths"])
        for b in range(blocks)
    ])
    more = [c for c in rows.columns if c not in ("row", "text")]
    each = hits.groupBy("row").agg(
        *(F.first(c).alias(c) for c in (*more, "n_words")),
        F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("items").alias("lists"),
    )
    joined = """aggregate(spans, cast(array() AS array<struct<start:int,end:int>>), (a, s) -> CASE
        WHEN size(a) > 0 AND s.start <= a[size(a) - 1].end THEN concat(slice(a, 1, size(a) - 1), array(named_struct(
            'start', a[size(a) - 1].start, 'end', greatest(a[size(a) - 1].end, s.end))))
        ELSE concat(a, array(s)) END)"""
    return each.select(
        "row", *more, F.col("n_words").cast("long").alias("n_words"), F.expr(joined).alias("spans"),
        F.expr("array_sort(array_distinct(flatten(lists)))").alias("items"),
    )


def _numbered(docs: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """row, doc (a struct of the columns, so that no name of theirs clashes) and text."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*(F.col(f"`{c}`") for c in columns)).alias("doc"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )


def find(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", most: int = BROADCAST_BYTES,
) -> DataFrame:
    """Of every document: its key, n_words, spans (word places, end exclusive) that windows
    of the benchmark cover, and the items they are of."""
    scanned = _scanned(_numbered(docs, text, [key]), benchmark, item, item_text, most)
    return scanned.select(F.col(f"doc.`{key}`").alias(key), "n_words", "spans", "items")


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Of every document: words, hit words, items with occurring windows and their digest."""
    return find(docs, benchmark, key, text, **options).select(
        key, "n_words", F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), sha256(F.array_join("items", ",")).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def clean(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", *, whole: bool = True,
    item: str = "item_id", item_text: str = "text", most: int = BROADCAST_BYTES,
) -> DataFrame:
    """The documents, with their columns, without contaminated ones; with ``whole=False``
    all documents, but hit words, and what stands before each of them back to the word
    before, cut out of their texts. The table is written once with row numbers, by which
    spans meet the texts."""
    rows = written(_numbered(docs, text, docs.columns), "numbered")
    scanned = _scanned(rows.select("row", "text"), benchmark, item, item_text, most).where("size(spans) > 0")
    names = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    if whole:
        return rows.join(scanned, "row", "left_anti").select(*names)
    word = quoted(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # A-Z are still there
    ends = "concat(transform(spans, s -> s.start), array(size(own)))"
    starts = "concat(array(0), transform(spans, s -> s.end))"
    kept = f"""CASE WHEN size(spans) > 0 THEN concat(array_join(flatten(zip_with({starts}, {ends}, (a, b) ->
        CASE WHEN a < b THEN transform(sequence(a, b - 1), i -> concat(gaps[i], own[i])) ELSE array() END)), ''),
        gaps[size(own)]) ELSE doc.`{text}` END"""
    both = rows.join(scanned.select("row", "spans"), "row", "left").withColumns({
        "own": F.expr(f"CASE WHEN size(spans) > 0 THEN regexp_extract_all(text, {word}, 0) END"),
        "gaps": F.expr(f"CASE WHEN size(spans) > 0 THEN split(text, {word}, -1) END"),
    })
    cut = {text: F.expr(kept).alias(text)}
    return both.select(*(cut.get(c, name) for c, name in zip(docs.columns, names)))
