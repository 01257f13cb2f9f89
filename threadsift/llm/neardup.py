"""Near duplicates: BagMinHash signatures, bands, and a check of the multisets.

Two texts are linked if the multisets of their five-word shingles (lower-cased words
between ASCII white space) have a Jaccard similarity, sum of minima by sum of maxima,
of 0.8 or more. Texts of one to four words have one shingle, all their words; texts
without words are linked only to equal ones. Classes are connected components.

Signatures. In BagMinHash every shingle owns Poisson processes over its weight axis,
cut into the intervals (0, 1], (1, 2], (2, 4], (4, 8] ...: points come at exponential
times, each with a component and a weight. Component i of a text is the least time of
a point of component i whose weight the text's count of that shingle reaches. So equal
components have the probability of the weighted similarity. Points are made in order
of time, in rounds over all shingles of a batch at once; a process ends as soon as its
time exceeds all components of its text.

Search. Equal texts are one node from the start. Bands of the signature are keys. First
every node of a key is compared with one node of the key, its hub, which is the least; a
group of thousands of copies so costs a few comparisons each. A node's label is its least
linked hub (and that one's, twice over), so nodes of one label are known to be in one
class. Then the pairs that share a key but no label are left, unless the key has two
nodes only. For them, nodes are dealt into blocks: a node's home is the most frequent key
that it reaches over keys, nodes of one home are put together, small homes many to a
block, large ones cut by length and then by hash into blocks of about ``BLOCK``. Two
blocks that hold nodes of one key, of lengths that can be similar, are a pair of blocks, as
is each block with itself; each pair of blocks is a group of its own, with the nodes' texts,
signatures and keys, and every pair of nodes meets in one group only, whatever number of
keys it shares. There, a pair that shares no key, or whose lengths exclude the similarity,
or whose signatures are five standard deviations below it, goes no further; for the
others the multisets are compared by sparse sums of minima. A group returns links between
labels, and of these only as many as join them, so that neither pairs of candidates nor
links between all members of a class are ever rows. No pair of candidates goes unchecked
unless both are known to be in one class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from .common import slices
from .hashing import ODD, batch_buffer, mix, words_of

WORDS, SIMILARITY = 5, 0.8
#: Components of a signature in a band, and bands: a pair of similarity 0.8 shares no
#: band with a probability of 1e-7.
ROWS, BANDS = 5, 40
SIZE = ROWS * BANDS
#: Least number of equal components (of SIZE) of a pair that is compared by its texts.
LEAST_EQUAL = int(SIZE * SIMILARITY - 5 * (SIZE * SIMILARITY * (1 - SIMILARITY)) ** 0.5)
#: About how many nodes a block has, and how many shingles; and how many times a node
#: takes over the home of the nodes with which it shares a key.
BLOCK, BLOCK_SHINGLES, HOPS = 256, 1 << 18, 2
#: Bytes of text that are worked on at once.
SLICE = 1 << 21

def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a batch of lower-cased texts, and each one's text."""
    _, words, owner = words_of(*batch_buffer(texts))
    counts = np.bincount(owner, minlength=len(texts))
    # windows of five words that stay in their text; a shorter text is one window
    first = np.cumsum(counts) - counts
    windows = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    of = np.repeat(np.arange(len(texts)), windows)
    at = np.repeat(first - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    length = np.minimum(counts[of], WORDS)
    value = np.zeros(len(at), np.uint64)
    for k in range(WORDS):
        inside = k < length
        value[inside] = mix(value[inside] * ODD + words[at[inside] + k])
    return value, of


def multisets(value: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, with their counts."""
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    return value[at], of[at], np.diff(np.append(at, len(value)))


def signatures(value: np.ndarray, of: np.ndarray, weight: np.ndarray, n: int, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Component times and identities (hashes of the least points) of n texts."""
    times, points = np.full(n * size, np.inf), np.zeros(n * size, np.uint64)
    # a process for each interval that begins below the weight
    seeds, texts, lows, tops, weights = [], [], [], [], []
    low, top = 0, 1
    while len(value):
        seeds.append(mix(value + np.uint64(int(ODD) * top % 2**64)))
        texts.append(of)
        weights.append(weight)
        lows.append(np.full(len(of), low))
        tops.append(np.full(len(of), top))
        more = weight > top
        value, of, weight = value[more], of[more], weight[more]
        low, top = top, 2 * top
    if not seeds:
        return times.reshape(n, size), points.reshape(n, size)
    seed, text, low, top, weight = map(np.concatenate, (seeds, texts, lows, tops, weights))
    time, unit = np.zeros(len(seed)), 2.0**-53
    while len(seed):
        seed = mix(seed + ODD)
        time = time - np.log1p(-((seed >> np.uint64(11)) * unit)) / (size * (top - low))
        pick = mix(seed)
        slot = text * size + ((pick & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        height = low + (top - low) * ((pick >> np.uint64(32)) + 1) * 2.0**-32
        hit = np.flatnonzero((height <= weight) & (time < times[slot]))
        np.minimum.at(times, slot[hit], time[hit])
        won = hit[times[slot[hit]] == time[hit]]
        points[slot[won]] = seed[won]
        alive, most = np.flatnonzero(np.bincount(text, minlength=n)), np.zeros(n)
        most[alive] = times.reshape(n, size)[alive].max(axis=1)
        go = time < most[text]
        seed, text, low, top, weight, time = (a[go] for a in (seed, text, low, top, weight, time))
    return times.reshape(n, size), points.reshape(n, size)


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.string()))


_SKETCH = "node long, total long, sketch binary, bands array<long>"


def _sketches(batches):
    """Of each text: its number of shingles, a byte of each component, and band keys."""
    for batch in batches:
        for part in slices(batch, [1], SLICE):
            value, of = shingles(_lower(part.column(1)))
            n = part.num_rows
            total = np.bincount(of, minlength=n)
            _, points = signatures(*multisets(value, of), n)
            keys = np.zeros((n, BANDS), np.uint64)
            grouped = points.reshape(n, BANDS, ROWS)
            for r in range(ROWS):
                keys = mix(keys * ODD + grouped[:, :, r])
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64))
            keep = total > 0
            yield pa.RecordBatch.from_arrays([
                part.column(0).filter(pa.array(keep)), pa.array(total[keep], pa.int64()),
                pa.array([p.tobytes() for p in mix(points[keep]).astype(np.uint8)], pa.binary()),
                pa.array(list(keys[keep].view(np.int64)), pa.list_(pa.int64())),
            ], names=["node", "total", "sketch", "bands"])


def _verified(batches):
    """Pairs whose multisets are similar enough."""
    for batch in batches:
        for part in slices(batch, [2, 3], SLICE):
            n = part.num_rows
            value, of = shingles(_lower(pa.concat_arrays([part.column(2).cast(pa.string()), part.column(3).cast(pa.string())])))
            value, of, count = multisets(value, of)
            total = np.bincount(of, weights=count, minlength=2 * n)
            pair = of % n
            order = np.lexsort((value, pair))
            value, pair, count = value[order], pair[order], count[order]
            both = np.flatnonzero((value[1:] == value[:-1]) & (pair[1:] == pair[:-1]))
            shared = np.bincount(pair[both], weights=np.minimum(count[both], count[both + 1]), minlength=n)
            every = total[:n] + total[n:] - shared
            ok = shared >= SIMILARITY * every - 1e-9
            yield pa.RecordBatch.from_arrays(
                [part.column(0).filter(pa.array(ok)), part.column(1).filter(pa.array(ok))], names=["a", "b"]
            )


def _similar_sketches(batches):
    """Pairs that lengths and signatures do not exclude."""
    for batch in batches:
        size = np.array(batch.column(2), np.float64), np.array(batch.column(3), np.float64)
        sketch = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SIZE) for c in (4, 5)]
        ok = (np.minimum(*size) >= SIMILARITY * np.maximum(*size) - 1e-9)
        ok &= (sketch[0] == sketch[1]).sum(axis=1) >= LEAST_EQUAL
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], names=["a", "b"]
        )


def _near(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) that lengths and signatures leave, written."""
    own = sketches.select("node", "total", "sketch")
    a, b = (own.select([F.col(c).alias(f"{c}_{s}") for c in own.columns]) for s in "ab")
    wide = pairs.join(a, F.col("a") == F.col("node_a")).join(b, F.col("b") == F.col("node_b"))
    wide = wide.select("a", "b", "total_a", "total_b", "sketch_a", "sketch_b")
    return written(wide.mapInArrow(_similar_sketches, "a long, b long"), "near-pairs")


def _links(near: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose texts are similar enough, written."""
    text = nodes.select("node", "text")
    full = near.join(text.toDF("b", "text_b"), "b").join(text.toDF("a", "text_a"), "a")
    return written(full.select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a long, b long"), "links")


def _compared(own: tuple[np.ndarray, ...], p: np.ndarray, q: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Links of labels that the pairs (p, q) of texts make, only as many as join the labels.
    own: the multisets of all texts, ascending by text."""
    value, of, count = own
    value = np.unique(value, return_inverse=True)[1]
    n = len(label)
    start, total = np.searchsorted(of, np.arange(n + 1)), np.bincount(of, weights=count, minlength=n)
    names, root = np.unique(label, return_inverse=True)
    member, tree, links = root.copy(), np.arange(len(names)), []
    weight = np.zeros(value.max(initial=-1) + 1)
    for i, others in zip(*_by_first(p, q)):
        others = others[tree[member[others]] != tree[member[i]]]
        if not len(others):
            continue
        mine = slice(start[i], start[i + 1])
        weight[value[mine]] = count[mine]
        size = start[others + 1] - start[others]
        first = np.cumsum(size) - size
        at = np.repeat(start[others] - first, size) + np.arange(size.sum())
        shared = np.add.reduceat(np.minimum(count[at], weight[value[at]]), first)
        weight[value[mine]] = 0
        for j in others[shared >= SIMILARITY * (total[i] + total[others] - shared) - 1e-9]:
            x, y = tree[member[i]], tree[member[j]]
            if x != y:
                tree[tree == y] = x
                links.append((int(label[i]), int(label[j])))
    return links


def _by_first(p: np.ndarray, q: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    order = np.argsort(p, kind="stable")
    first, at = np.unique(p[order], return_index=True)
    return first.tolist(), np.split(q[order], at[1:])


def _group_links(rows: pa.Table) -> pa.Table:
    """Links of labels between the two sides of a pair of blocks, or inside the one block."""
    rows = rows.combine_chunks()
    label, total, side = (rows[c].to_numpy() for c in ("label", "total", "side"))
    sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(-1, SIZE)
    bands = np.concatenate([c.flatten().to_numpy() for c in rows["bands"].chunks]).reshape(-1, BANDS)
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if side.any() else left
    ok = np.zeros((len(left), len(right)), bool)
    for k in range(BANDS):
        ok |= bands[left, k][:, None] == bands[right, k]
    ok &= label[left][:, None] != label[right]
    ok &= np.minimum(total[left][:, None], total[right]) >= SIMILARITY * np.maximum(total[left][:, None], total[right]) - 1e-9
    if right is left:
        ok = np.triu(ok, 1)
    p, q = np.nonzero(ok)
    p, q = left[p], right[q]
    near = np.zeros(len(p), bool)
    for at in range(0, len(p), 16384):
        cut = slice(at, at + 16384)
        near[cut] = (sketch[p[cut]] == sketch[q[cut]]).sum(axis=1) >= LEAST_EQUAL
    p, q = p[near], q[near]
    needed, of = np.unique(np.concatenate([p, q]), return_inverse=True)
    if not len(needed):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    texts = pc.take(rows["text"], pa.array(needed)).combine_chunks()
    found = _compared(multisets(*shingles(_lower(texts))), of[: len(p)], of[len(p) :], label[needed])
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _homes(open_: DataFrame) -> DataFrame:
    """(node, home) of all open nodes: the most frequent key that a node reaches."""
    home = open_.groupBy("node").agg(F.max(F.struct("n", "band")).alias("home"))
    for _ in range(HOPS):
        around = open_.select("node", "band").join(home, "node").groupBy("band").agg(F.max("home").alias("home"))
        home = open_.select("node", "band").join(around, "band").groupBy("node").agg(F.max("home").alias("home"))
    return home.select("node", F.col("home.band").alias("home"))


def _dealt(open_: DataFrame, sketches: DataFrame) -> DataFrame:
    """(node, block) of all open nodes, written."""
    sized = _homes(open_).join(sketches.select("node", "total"), "node")
    sized = written(sized.withColumn("length", F.expr(f"cast(floor(ln(total) / ln({1 / SIMILARITY})) AS int)")), "homes")
    whole = sized.groupBy("home").agg(F.count("*").alias("members"), F.sum("total").alias("mass"))
    large = whole.where(f"members > {BLOCK} OR mass > {BLOCK_SHINGLES}").select("home", F.lit(True).alias("large"))
    parts = sized.join(large, "home").groupBy("home", "length").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("total") / BLOCK_SHINGLES)).alias("parts")
    )
    rest = whole.where(f"NOT (members > {BLOCK} OR mass > {BLOCK_SHINGLES})")
    held = rest.agg(F.sum("members").alias("n"), F.sum("mass").alias("mass")).first()
    packs = 1 + max((held["n"] or 0) // BLOCK, (held["mass"] or 0) // BLOCK_SHINGLES)
    # a block's number is a hash; should two be equal, one block has the nodes of both
    block = F.expr(f"""CASE WHEN parts IS NULL THEN pmod(xxhash64(home), {packs})
        ELSE xxhash64(home, length, pmod(xxhash64(node), parts)) END""")
    return written(sized.join(parts, ["home", "length"], "left").select("node", "total", block.alias("block")), "dealt")


def _block_links(open_: DataFrame, sketches: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between labels of the nodes that share a key and no label, written. open_:
    node, band, n, label."""
    dealt = _dealt(open_, sketches)
    held = open_.select("node", "band").join(dealt, "node").groupBy("band", "block").agg(
        F.min("total").alias("low"), F.max("total").alias("high")
    )
    x, y = (held.select("band", *(F.col(c).alias(f"{c}_{s}") for c in ("block", "low", "high"))) for s in "xy")
    pairs = x.join(y, "band").where("block_x < block_y").where(
        f"high_x >= {SIMILARITY} * low_y - 1e-9 AND high_y >= {SIMILARITY} * low_x - 1e-9"
    ).select("block_x", "block_y").distinct()
    pairs = written(pairs, "block-pairs")
    alone = dealt.select(F.col("block").alias("block_x"), F.col("block").alias("block_y"), F.lit(0).alias("side"), "block").distinct()
    taken = pairs.select("*", F.lit(0).alias("side"), F.col("block_x").alias("block")).union(
        pairs.select("*", F.lit(1).alias("side"), F.col("block_y").alias("block"))
    ).union(alone)
    labels = open_.groupBy("node").agg(F.min("label").alias("label"))
    members = dealt.join(labels, "node").join(sketches.select("node", "sketch", "bands"), "node").join(nodes.select("node", "text"), "node")
    groups_ = written(members, "members").join(taken, "block").groupBy("block_x", "block_y")
    return written(groups_.applyInArrow(_group_links, "a long, b long"), "links")


def classes(links: DataFrame) -> DataFrame:
    """(node, label): the least node of each node's component, for all nodes that have
    links. Each round takes the least label among neighbours and the label's own
    label; a round's table is written, so lost executors cost a read."""
    edges = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        around = (
            edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("around"))
        )
        nearer = labels.join(around, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "around").alias("via")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        after = written(
            nearer.join(jump, "via", "left").select("node", "old", F.least("via", "far").alias("label")), "labels"
        )
        labels = after.select("node", "label")
        if after.where("label <> old").limit(1).isEmpty():
            return labels


def _known(links: DataFrame) -> DataFrame:
    """(node, label) of the nodes that are linked to a hub (a, the lesser node), written:
    their least hub, that one's and again that one's."""
    label = written(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label")), "labels")
    for _ in range(2):
        next_ = label.select(F.col("node").alias("label"), F.col("label").alias("far"))
        label = label.join(next_, "label", "left").select("node", F.coalesce("far", "label").alias("label"))
    return written(label, "labels")


def _open(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """The keys with nodes of several labels, written. A key of two nodes was decided when
    they were compared."""
    labelled = shared.where("n > 2").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return written(labelled.join(mixed.select("band"), "band").select("node", "band", "n", "label"), "open")


def _nodes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One node for each distinct text, written: its digest, its text and, as
    ``row_*``, the row that bears it and has the least key (a null key comes last; among
    rows of one key, the least of the other columns)."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (key, text)]
    rank = [F.col(key).isNull(), F.col(key), *([F.to_json(F.struct(*others))] if others else [])]
    row = F.min_by(F.struct(*(F.col(f"`{c}`").alias(f"row_{c}") for c in docs.columns)), F.struct(*rank))
    equal = docs.groupBy(_digest(text)).agg(row.alias("row")).select("digest", "row.*")
    nodes = written(equal.withColumn("node", F.monotonically_increasing_id()), "nodes")
    return nodes.withColumn("text", F.coalesce(f"`row_{text}`", F.lit("")))


def _digest(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest")


def _labelled(nodes: DataFrame, key: str) -> DataFrame:
    """Node, digest, least key and label, the least node of its class, of every node."""
    sketches = written(nodes.select("node", "text").mapInArrow(_sketches, _SKETCH), "sketches")
    keys = sketches.select("node", F.explode("bands").alias("band"))
    hubs = keys.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("hub")).where("n > 1")
    shared = written(keys.join(hubs, "band"), "shared")
    pairs = shared.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = _links(_near(pairs, sketches), nodes)
    labels = classes(links.unionByName(_block_links(_open(shared, _known(links)), sketches, nodes)))
    every = nodes.select("node", "digest", F.col(f"`row_{key}`").alias("least")).join(labels, "node", "left")
    return every.withColumn("label", F.coalesce("label", "node"))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of the documents: key and class_id, the least key of its class.

    Null texts are empty ones. Rows with a null key are grouped by their text like the
    others; a class of such rows only has the id null. Repeated rows give repeated
    rows; other columns are not read.
    """
    own = docs.select(key, text)
    every = _labelled(_nodes(own, key, text), key)
    ids = every.groupBy("label").agg(F.min("least").alias("class_id"))
    named = every.join(ids, "label").select("digest", "class_id")
    return own.select(key, _digest(text)).join(named, "digest").select(key, "class_id")


def kept(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, with its columns: that with the least key, null keys last.
    Of several texts or rows with that key in the class only one stays."""
    nodes = _nodes(docs, key, text)
    least = F.min(F.struct(F.col("least").isNull(), "least", "digest", "node")).alias("least")
    chosen = _labelled(nodes, key).groupBy("label").agg(least).select("least.node")
    return nodes.join(chosen, "node", "left_semi").select(*(F.col(f"`row_{c}`").alias(c) for c in docs.columns))
