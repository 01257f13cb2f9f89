"""WARC archives: writing records and reading them back by boundary chains.

Writing. Pages become records of WARC 1.1, one each: the record of a payload's largest
key is a response, the others of at least ``LEAST`` bytes are revisits that refer to
it, smaller ones are all responses. Spark's text writer writes the archives, a record
for each row with the blank lines that end a record as line end, so commits and retries
are Spark's and any file system will do.

Reading. Archives are split like any text file, at the version line that begins a
record. That line may occur inside a payload as well, so every occurrence is only a
candidate: its header tells where its successor would begin. The candidates of a split
are chained in its task; between the splits of a file the chain is followed by pointer
jumping from the file's start, doubling the distance in each round. Only reachable
candidates are records; what lies between two of them belongs to the first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import work_dir, written
from .spans import quoted

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
#: Equal payloads of at least so many bytes are stored once.
LEAST = 1000
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _sql(text: str) -> str:
    return quoted(text).replace("\r", "\\r").replace("\n", "\\n")


def roles(pages: DataFrame, key: str, payload: str) -> DataFrame:
    """Key and digest of the pages that revisit another one, with its key. Only keys
    and digests are shuffled; the largest key of a payload is found by partial
    aggregation."""
    own = pages.select(
        F.col(key).alias("__key"), F.sha1(payload).alias("__digest"), F.octet_length(payload).alias("__bytes")
    ).where(f"__bytes >= {LEAST}")
    largest = own.groupBy("__digest", "__bytes").agg(F.max("__key").alias("__to"), F.count("*").alias("n")).where("n > 1")
    found = own.join(largest.drop("n"), ["__digest", "__bytes"]).where("NOT __key <=> __to")
    return found.select("__key", "__digest", "__to").distinct()


def records(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """A WARC record for each page, without the blank lines that end it."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    own = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), payload.alias("payload"))
    own = own.withColumn("digest", F.sha1("payload"))
    # written first, so that Spark knows its size: few revisits don't move the payloads
    found = own.join(
        written(roles(own, "key", "payload"), "revisits"), own["key"].eqNullSafe(F.col("__key")) & (own["digest"] == F.col("__digest")), "left"
    )
    revisit = "__to IS NOT NULL"
    name = lambda c: f"concat('<urn:page:', coalesce(cast({c} AS string), 'null'), '>')"
    address = "regexp_replace(coalesce(url, ''), '[\\\\x00-\\\\x20\\\\x7f]', '%20')"
    header = f"""concat(
        {_sql(MAGIC)}, 'WARC-Type: ', CASE WHEN {revisit} THEN 'revisit' ELSE 'response' END, {_sql("\r\n")},
        'WARC-Record-ID: ', {name("key")}, {_sql("\r\n")},
        'WARC-Date: 2024-01-01T00:00:00Z', {_sql("\r\n")},
        'WARC-Target-URI: ', {address}, {_sql("\r\n")},
        'WARC-Payload-Digest: sha1:', digest, {_sql("\r\n")},
        CASE WHEN {revisit} THEN concat(
            'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest', {_sql("\r\n")},
            'WARC-Refers-To: ', {name("__to")}, {_sql("\r\n")},
            'X-Payload-Length: ', octet_length(payload), {_sql("\r\n")}) ELSE '' END,
        'Content-Type: application/http; msgtype=response', {_sql("\r\n")},
        'Content-Length: ', octet_length(block), {_sql(END)})"""
    block = f"CASE WHEN {revisit} THEN cast({_sql(_HTTP)} AS binary) ELSE concat(cast({_sql(_HTTP)} AS binary), payload) END"
    return found.withColumn("block", F.expr(block)).select(
        F.expr(f"cast(concat(cast({header} AS binary), block) AS string)").alias("value")
    )


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Writes archives. A null page is an empty payload; a null url an empty one;
    control characters and blanks of a url are escaped; other columns are not read."""
    records(pages, key, url, html).write.option("lineSep", END).text(folder)


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    """What lies between two version lines, in file order within a split. The first of
    a file is empty, as the file begins with such a line."""
    return spark.read.option("lineSep", MAGIC).text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"), "value",
    )


#: Header fields that are returned, by name.
FIELDS = {
    "type": "WARC-Type", "id": "WARC-Record-ID", "url": "WARC-Target-URI", "refers_to": "WARC-Refers-To",
    "digest": "WARC-Payload-Digest", "payload_length": "X-Payload-Length",
}


def _parsed(rows: DataFrame, raw: str, derive: dict[str, str]) -> DataFrame:
    """Adds what the bytes ``raw`` that follow a version line say: the header's size,
    the block's length, the fields, and the derived columns where the block is whole."""
    head = rows.withColumn("head", F.expr(
        f"CASE WHEN contains(cast({raw} AS string), {_sql(END)}) THEN substring_index(cast({raw} AS string), {_sql(END)}, 1) END"
    ))
    head = head.withColumns({
        "size": F.octet_length(raw).cast("long"), "head_size": F.octet_length("head").cast("long"),
        "length": F.expr("try_cast(regexp_extract(head, '(?im)^Content-Length:[ \\\\t]*([0-9]+)', 1) AS long)"),
        **{name: F.regexp_extract("head", rf"(?im)^{field}:[ \t]*([^\r\n]*)", 1) for name, field in FIELDS.items()},
    })
    head = head.withColumn("whole", F.expr(f"coalesce(size >= head_size + {len(END)} + length, false)"))
    head = head.withColumn("block", F.expr(
        f"CASE WHEN whole THEN substring({raw}, cast(head_size AS int) + {len(END) + 1}, cast(length AS int)) END"
    ))
    return head.withColumns({f"_{name}": F.expr(f"CASE WHEN whole THEN {sql} END") for name, sql in derive.items()})


def _candidates(pieces: DataFrame, derive: dict[str, str]) -> DataFrame:
    """Pieces with their place and what they say, and, where a header can be read, the
    successor's place. Of the bytes themselves nothing is shuffled."""
    own = _parsed(pieces.withColumn("raw", F.col("value").cast("binary")), "raw", derive)
    own = own.select(
        "file", "split", "row", "size", "head_size", "length", "whole", *FIELDS, *(f"_{name}" for name in derive)
    )
    in_split = Window.partitionBy("file", "split").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    step = F.col("size") + len(MAGIC)
    own = own.withColumn("before", F.coalesce(F.sum(step).over(in_split), F.lit(0)))
    own = written(own, "pieces")
    splits = own.groupBy("file", "split").agg(F.sum(step).alias("all"))  # a row for each split
    in_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "split", F.coalesce(F.sum("all").over(in_file), F.lit(0)).alias("base"))
    placed = own.join(splits, ["file", "split"]).withColumn("place", F.expr(f"base + before - {len(MAGIC)}"))
    # a file's first piece stands for nothing: no version line is before it
    return placed.drop("base", "before").withColumn("next", F.expr(
        f"CASE WHEN place >= 0 THEN place + {len(MAGIC)} + head_size + {len(END)} + length + {len(END)} END"
    ))


def _exits(split: pa.Table) -> pa.Table:
    """For each candidate of a split, where its chain leaves the split."""
    split = split.sort_by("place")
    places, following = split["place"].to_pylist(), split["next"].to_pylist()
    exits: dict[int, int] = {}
    for place, onward in zip(reversed(places), reversed(following)):
        exits[place] = exits.get(onward, onward)
    return split.select(["file", "split", "place"]).append_column("next", pa.array([exits[p] for p in places], pa.int64()))


def _walk(entries: pa.Table, split: pa.Table) -> pa.Table:
    """The candidates of a split that its entries reach."""
    following = dict(zip(split["place"].to_pylist(), split["next"].to_pylist()))
    found = []
    for place in entries["place"].to_pylist():
        while place in following:
            found.append(place)
            place = following.pop(place)
    file = split["file"][0].as_py() if len(split) else None
    return pa.table({"file": pa.array([file] * len(found), pa.string()), "place": pa.array(found, pa.int64())})


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, place) of all records: candidates that the chain from the file's start
    reaches. A split is bounded by the file system, so its chain is one task's work."""
    steps = candidates.where("next IS NOT NULL").select("file", "split", "place", "next")
    exits = written(steps.groupBy("file", "split").applyInArrow(_exits, "file string, split long, place long, next long"), "exits")
    most = steps.select("file", "split").distinct().groupBy("file").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    jumps = exits.select("file", "place", "next")
    entries = exits.where("place = 0").select("file", "place")
    for _ in range(math.ceil(math.log2(most)) if most > 1 else 0):
        onward = entries.join(jumps, ["file", "place"]).select("file", F.col("next").alias("place"))
        entries = written(entries.union(onward).distinct(), "entries")
        far = jumps.select("file", F.col("place").alias("next"), F.col("next").alias("far"))
        jumps = written(jumps.join(far, ["file", "next"]).select("file", "place", F.col("far").alias("next")), "jumps")
    located = entries.join(exits.select("file", "split", "place"), ["file", "place"])
    return located.groupBy("file", "split").cogroup(steps.groupBy("file", "split")).applyInArrow(_walk, "file string, place long")


@contextmanager
def _fixed_splits(spark: SparkSession) -> Iterator[None]:
    """Scans in this block split files alike: without a number of their own, splits follow
    the number of cores, and that changes as executors come and go."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def read(spark: SparkSession, folder: str, derive: dict[str, str] | None = None) -> DataFrame:
    """The records of all archives: file, place, header fields, and the columns that
    ``derive`` names as SQL over ``block`` and the fields (by default the block). A
    file that does not begin with a record has none.

    A record that lies between two version lines is read where it is scanned. Only of
    records with version lines inside are the pieces brought together.
    """
    derive = derive or {"block": "block"}
    pieces = _pieces(spark, folder)
    candidates = written(_candidates(pieces, derive), "candidates")
    found = written(reachable(candidates).withColumn("record", F.col("place")), "records")
    shown = [*FIELDS, *(F.col(f"_{name}").alias(name) for name in derive)]
    single = candidates.where("whole").join(found, ["file", "place"]).select("file", "record", *shown)
    # a piece belongs to the last record that begins at or before it
    in_file = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    owned = (
        candidates.select("file", "split", "row", "place", "whole").join(found, ["file", "place"], "left")
        .withColumn("split_up", F.last(F.when(F.col("record").isNotNull(), ~F.col("whole")), ignorenulls=True).over(in_file))
        .withColumn("record", F.last("record", ignorenulls=True).over(in_file))
        .where("record IS NOT NULL AND split_up").select("file", "split", "row", "place", "record")
    )
    gathered = pieces.join(written(owned, "parts"), ["file", "split", "row"]).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("place", F.col("value").cast("binary").alias("value")))).alias("parts")
    )
    raw = gathered.select("file", "record", F.expr(
        f"""aggregate(slice(parts, 2, size(parts)), parts[0].value,
            (a, p) -> concat(a, cast({_sql(MAGIC)} AS binary), p.value))"""
    ).alias("raw"))
    joined = written(_parsed(raw, "raw", derive).where("whole").select("file", "record", *shown), "gathered")
    return single.unionByName(joined)


def write_read(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes the pages' records and reads the archives back: per page its key, size
    and digest of the payload (of responses as read, of revisits as their header says),
    record type and what it refers to. Of repeated rows of the largest key all are
    responses; a null key is never referred to."""
    spark = pages.sparkSession
    folder = work_dir(spark, "warc")
    write(pages, folder, key, url, html)
    kind = pages.schema[key].dataType.simpleString()
    number = lambda c: f"try_cast(regexp_extract({c}, '^<urn:page:(.*)>$', 1) AS {kind})"
    payload = f"substring(block, {len(_HTTP) + 1}, octet_length(block))"
    return read(spark, folder, {
        key: number("id"),
        "payload_bytes": f"CASE WHEN type = 'revisit' THEN cast(payload_length AS long) ELSE cast(octet_length({payload}) AS long) END",
        "payload_digest": f"CASE WHEN type = 'revisit' THEN replace(digest, 'sha1:', '') ELSE sha1({payload}) END",
        "record_type": "type",
        "refers": f"CASE WHEN type = 'revisit' THEN {number('refers_to')} END",
    }).select(key, "payload_bytes", "payload_digest", "record_type", F.col("refers").alias("refers_to"))
