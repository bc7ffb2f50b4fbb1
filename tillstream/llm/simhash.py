"""SimHash near-duplicates found with BK-trees.

A fingerprint is 64 bits over the XXH64 values of a text's three-word shingles.  Two
fingerprints within ``RADIUS`` bits agree on one of ``RADIUS + 1`` parts of the word, and
on one of as many parts of the rest, so every such pair meets in one of sixteen shards
keyed by 28 equal bits.  A shard's fingerprints go into BK-trees (children by Hamming
distance to the parent); a search follows only edges within the radius of the distance.
Trees hold ``TREE`` fingerprints at most: larger shards are several trees, and every
fingerprint of the shard is sent to all of them.

Equal fingerprints are one node, so copies cost one search.  Each tree reports a spanning
forest of what it links, never all pairs, and components come from alternating star steps
on stored edges.

Null and empty texts have fingerprint zero and link like any other.  Null ids take part;
a component's id is its smallest id that is not null.  Repeated rows and rows with one id
are ordinary rows, except that :func:`deduplicate` keeps one of them.  Empty tables give
empty results; columns named like the added ones are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.common import append_arrow, packed, stored, texts_as_bytes, unpacked

RADIUS = 3
WORDS = 3
SEED = 42
TREE = 2048
#: Shingles whose bits are spread out at a time.
CHUNK = 1 << 15


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Bits set in over half the shingles' hashes, as a signed 64-bit number."""
    from xxhash import xxh64_intdigest

    found = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    n = len(found)
    if not n:
        return 0
    joined = b" ".join(found)
    if n <= words:
        return int(np.uint64(xxh64_intdigest(joined, SEED)).astype(np.int64))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, n) + 1)
    stops = (ends[words - 1 :] - 1).tolist()
    starts = [0, *ends[: n - words].tolist()]
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprinted(docs: DataFrame, words: int = WORDS, drop: tuple[str, ...] = ()) -> DataFrame:
    """Every document with ``fp``, its fingerprint as a signed number."""

    def make():
        import pyarrow as pa

        return lambda batch: [pa.array([fingerprint(t, words) for t in texts_as_bytes(batch)], pa.int64())]

    return append_arrow(docs, make, "fp long", drop)


class Tree:
    """BK-tree over 64-bit words under Hamming distance."""

    def __init__(self) -> None:
        self.words: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, word: int) -> None:
        words, children, at = self.words, self.children, 0
        if words:
            while True:
                distance = (words[at] ^ word).bit_count()
                below = children[at].get(distance)
                if below is None:
                    children[at][distance] = len(words)
                    break
                at = below
        words.append(word)
        children.append({})

    def near(self, word: int, radius: int):
        """Numbers of the words within the radius."""
        if not self.words:
            return
        words, children, open_nodes = self.words, self.children, [0]
        while open_nodes:
            at = open_nodes.pop()
            distance = (words[at] ^ word).bit_count()
            if distance <= radius:
                yield at
            for edge, below in children[at].items():
                if distance - radius <= edge <= distance + radius:
                    open_nodes.append(below)


def forest(nodes: np.ndarray, queries: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that connect what lies within the radius: one fewer than the words joined.

    With no queries the words of the tree are compared among themselves.
    """
    words = nodes.view(np.uint64).tolist()
    asked = queries.view(np.uint64).tolist()
    parent = list(range(len(words) + len(asked)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tree, edges = Tree(), []

    def link(i: int, word: int) -> None:
        for j in tree.near(word, radius):
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                edges.append((word, words[j]))

    for i, word in enumerate(words):
        if not asked:
            link(i, word)
        tree.add(word)
    for i, word in enumerate(asked):
        link(len(words) + i, word)
    return edges


def masks(radius: int = RADIUS) -> list[int]:
    """Bit masks such that words within the radius agree under one of them."""
    parts = np.array_split(np.arange(64), radius + 1)
    out = []
    for part in parts:
        rest = np.setdiff1d(np.arange(64), part)
        for other in np.array_split(rest, radius + 1):
            mask = sum(1 << int(b) for b in (*part, *other))
            out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def links(fps: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all pairs in the radius."""
    import pyarrow as pa

    keys = F.array(
        *[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks(radius))]
    )
    members = fps.select("fp", F.explode(keys).alias("shard"))
    sizes = members.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = members.join(sizes, "shard").withColumn("trees", F.ceil(F.col("n") / tree).cast("int"))
    # Tree i meets the words of tree j in unit (i, j), i <= j: once for each pair of trees.
    own = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
    sent = shared.withColumn("own", own).select(
        "fp", "shard", "own", F.explode(F.expr("sequence(0, trees - 1)")).alias("other")
    )
    units = sent.select(
        F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
        (F.col("own") > F.col("other")).alias("asks"),
        "fp",
    )

    def search(batches):
        held: list[np.ndarray] = []
        unit = None

        def report(parts):
            fp = np.concatenate([p[0] for p in parts])
            asks = np.concatenate([p[1] for p in parts])
            return forest(fp[~asks], fp[asks], radius) if len(fp) > 1 else []

        def table(edges):
            a = np.array([e[0] for e in edges], np.uint64).view(np.int64)
            b = np.array([e[1] for e in edges], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            asks = batch.column(1).to_numpy(zero_copy_only=False)
            fp = batch.column(2).to_numpy()
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            edges: list[tuple[int, int]] = []
            for a, b in zip(cuts, cuts[1:]):
                if key[a] != unit:
                    if held:
                        edges += report(held)
                    held, unit = [], key[a]
                held.append((fp[a:b], asks[a:b]))
            if edges:
                yield table(edges)
        if held and (edges := report(held)):
            yield table(edges)

    found = units.repartition("unit").sortWithinPartitions("unit", "asks", "fp")
    return found.mapInArrow(search, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges; label is the smallest node it reaches.

    Alternating large-star and small-star steps; each round is written, so that neither
    the plan nor what a lost executor costs grows with the number of rounds.
    """
    spark = edges.sparkSession
    edges = stored(edges.where("a != b"), "edges")
    mark = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(floor, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            floor.select("a", F.col("m").alias("b"))
        )
        edges = stored(small.where("a != b").distinct(), "edges")
        now = tuple(
            edges.select(
                F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
            ).first()
        )
        if now == mark:
            break
        mark = now
    # At the end every node points at its component's smallest one.
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        roots.select("node", F.col("node").alias("label"))
    )


def classes(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint in (doc_id, fp)."""
    fps = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fps")
    labels = components(links(fps.select("fp"), radius))
    labelled = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label")
    )
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return labelled.join(smallest, "label").select("fp", "label", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id of every document; texts are read once."""
    marked = stored(fingerprinted(docs.select("doc_id", "text"), words, ("text",)), "fingerprints")
    found = stored(classes(marked, radius).select("fp", "component_id"), "classes")
    return marked.join(found, "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One document of each component: the one with the smallest id, then text hash."""
    narrow = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
    marked = stored(fingerprinted(narrow, words, ("text",)), "fingerprints")
    found = classes(marked, radius).select("fp", "label")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "_h")
    chosen = marked.join(found, "fp").groupBy("label").agg(F.min(place).alias("_first"))
    first = chosen.select(F.col("_first.doc_id").alias("_id"), F.col("_first._h").alias("_h"))
    rows = marked.groupBy("doc_id", "_h").agg(F.count(F.lit(1)).alias("_rows"))
    same = rows["doc_id"].eqNullSafe(first["_id"]) & (rows["_h"] == first["_h"])
    # Rows that share id and text cannot be told apart by the join below.
    winners = stored(rows.join(first, same).select("_id", first["_h"], "_rows"), "winners")
    marked = docs.select(packed(docs), F.col("doc_id").alias("of"), F.xxhash64("text").alias("text_hash"))
    kept = marked.join(winners, marked["of"].eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_h")))
    once = kept.where("_rows = 1").select("row")
    many = kept.where("_rows > 1").dropDuplicates(["of", "text_hash"]).select("row")
    return once.unionAll(many).select(*unpacked(docs.columns))
