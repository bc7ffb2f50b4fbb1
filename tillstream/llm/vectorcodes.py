"""Vectors as short codes: each part of a vector becomes the number of a codebook entry.

Components become the integers ``floor(256 * x)``, so sums, distances and ties are exact and
do not depend on the order of rows or tasks.  A vector is cut into equal parts and each part
position has a codebook of its own, trained by rounds of assigning and averaging.

Vectors are taken in portions.  For each part position a portion's points are sorted along a
Hilbert curve and cut into flat blocks; a block keeps its points, the smallest box around
them and their sum.  Blocks are written once and every round reads them.  An entry whose
least distance to a box is over the least greatest distance of any entry cannot be nearest
to a point in it; what is left is the block's shortlist.  A block with one entry on its list
adds its stored sum, the others compare their points with the short list only.

A round sends one row per (part, entry, component) and task; codebooks, at most ``parts *
entries`` rows, are all that comes to the driver.  Rows carry their columns through the
blocks, so codes need no join.

* Vectors that are null or hold a null, NaN or infinity are left out.
* The first codebooks are the vectors of smallest id (null ids last, equal ids by vector);
  with fewer vectors than entries there are fewer entries; repeated rows count each.
* All vectors must have the length of the first one, a multiple of ``parts``, and components
  up to 2**19 in size, so that errors fit a long; others end the job with that message.
* Extra columns stay, also those called like inner ones; ``code`` and ``error`` are replaced.
  An empty table, or one of unusable vectors, gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from tillstream.llm.common import quoted, stored, without

#: Vectors of a portion and points of a block.
PORTION = 8_192
BLOCK = 64
#: Largest integer component: 64 squared differences of this size still fit a long.
LARGEST = 1 << 27


@dataclass
class Compressed:
    """Rows with ``code`` (a byte for each part) and ``error``, and the final codebooks."""

    rows: DataFrame
    codebooks: np.ndarray  # part, entry, component

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with coordinates below ``2 ** bits``.

    The transposed form of Skilling (2004), over whole columns.
    """
    axes = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    tops = [1 << b for b in range(bits - 1, 0, -1)]
    for top in tops:
        low = top - 1
        for i in range(len(axes)):
            turned = (axes[i] & top) != 0
            swapped = np.where(turned, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(turned, axes[0] ^ low, axes[0] ^ swapped)
            if i:
                axes[i] = axes[i] ^ swapped
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    flips = np.zeros(len(points), np.int64)
    for top in tops:
        flips ^= np.where(axes[-1] & top, top - 1, 0)
    keys = np.zeros(len(points), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            keys = keys << 1 | (axis ^ flips) >> bit & 1
    return keys


def curve_order(points: np.ndarray) -> np.ndarray:
    """An order in which near points tend to be near; it decides speed, never results."""
    axes = points[:, :62]
    if not axes.shape[1]:
        return np.arange(len(points))
    bits = max(1, min(10, 62 // axes.shape[1]))
    low = axes.min(0)
    span = np.maximum(axes.max(0) - low + 1, 1)
    return np.argsort(hilbert_keys((axes - low) * (1 << bits) // span, bits), kind="stable")


def block_starts(n: int) -> np.ndarray:
    return np.arange(0, n, BLOCK)


def packed(vectors: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places, points, boxes and sums of a portion; vectors as (row, part, component)."""
    n, parts, _ = vectors.shape
    starts = block_starts(n)
    places, points, low, high, sums = [], [], [], [], []
    for part in range(parts):
        order = curve_order(vectors[:, part])
        mine = vectors[order, part]
        places.append(order)
        points.append(mine)
        low.append(np.minimum.reduceat(mine, starts))
        high.append(np.maximum.reduceat(mine, starts))
        sums.append(np.add.reduceat(mine, starts))
    return tuple(map(np.stack, (places, points, low, high, sums)))


def shortlists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """For each block (row) the entries that can be nearest to a point in its box."""
    below, above = low[:, None] - book, book - high[:, None]
    gap = np.maximum(np.maximum(below, above), 0)
    reach = np.maximum(np.abs(below), np.abs(above))
    most = (reach * reach).sum(-1).min(1, keepdims=True)
    return (gap * gap).sum(-1) <= most


def nearest(points: np.ndarray, book: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest listed entry of each point, ties to the lower one, and squared distances."""
    gaps = points[:, None] - book[listed]
    distances = (gaps * gaps).sum(-1)
    best = distances.argmin(1)
    return listed[best], distances[np.arange(len(points)), best]


class Portion:
    """One stored row of blocks."""

    FIELDS = "places array<int>, points array<int>, low array<int>, high array<int>, sums array<long>"

    def __init__(self, batch, row: int, shape: tuple[int, int, int]):
        parts, _, width = shape
        self.n = len(batch.column(0)[row])
        held = [batch.column(i)[row].values.to_numpy().astype(np.int64) for i in range(1, 6)]
        blocks = len(block_starts(self.n))
        self.places = held[0].reshape(parts, self.n)
        self.points = held[1].reshape(parts, self.n, width)
        self.low, self.high, self.sums = (h.reshape(parts, blocks, width) for h in held[2:])

    def blocks(self, part: int, book: np.ndarray):
        """Number, slice of points and shortlist of each block."""
        listed = shortlists(self.low[part], self.high[part], book)
        for block, start in enumerate(block_starts(self.n)):
            yield block, slice(start, min(start + BLOCK, self.n)), np.flatnonzero(listed[block])


def portions_of(usable: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """Blocks of all vectors; rows are (struct of the caller's columns, integers)."""
    import pyarrow as pa

    parts, _, width = shape
    fields = T.StructType.fromDDL(Portion.FIELDS)
    schema = T.StructType([T.StructField("rows", T.ArrayType(usable.schema[0].dataType)), *fields])
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]

    def one(rows, whole) -> pa.RecordBatch:
        n = len(rows)
        lengths = np.diff(whole.offsets.to_numpy())
        flat = whole.flatten().to_numpy()
        if (lengths != parts * width).any():
            raise ValueError(f"all vectors must have {parts * width} components")
        if flat.size and np.abs(np.clip(flat, -LARGEST * 2, LARGEST * 2)).max() > LARGEST:
            raise ValueError(f"components must not exceed {LARGEST // 256} in size")
        arrays = packed(flat.astype(np.int64).reshape(n, parts, width))
        lists = [
            pa.ListArray.from_arrays(pa.array([0, a.size], pa.int32()), pa.array(a.ravel(), kind))
            for a, kind in zip(arrays, kinds)
        ]
        own = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), rows)
        return pa.RecordBatch.from_arrays([own, *lists], names=schema.names)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                piece = batch.slice(0, PORTION - n)
                batch = batch.slice(piece.num_rows)
                held.append(piece)
                n += piece.num_rows
                if n == PORTION:
                    yield one(*(joined(held, i) for i in (0, 1)))
                    held, n = [], 0
        if n:
            yield one(*(joined(held, i) for i in (0, 1)))

    def joined(held, i):
        return pa.concat_arrays([b.column(i) for b in held])

    return stored(usable.mapInArrow(run, schema), "vector-blocks")


def round_sums(portions: DataFrame, books: np.ndarray) -> list:
    """Sum and count of the points of each entry, one row for each component."""
    import pyarrow as pa

    def run(batches):
        totals, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                portion = Portion(batch, row, books.shape)
                for part, book in enumerate(books):
                    for block, where, listed in portion.blocks(part, book):
                        if len(listed) == 1:
                            totals[part, listed[0]] += portion.sums[part, block]
                            counts[part, listed[0]] += where.stop - where.start
                            continue
                        points = portion.points[part, where]
                        entries, _ = nearest(points, book, listed)
                        np.add.at(totals[part], entries, points)
                        np.add.at(counts[part], entries, 1)
        part, entry = np.nonzero(counts)
        width = books.shape[2]
        columns = [
            np.repeat(part, width),
            np.repeat(entry, width),
            np.tile(np.arange(width), len(part)),
            totals[part, entry].ravel(),
            np.repeat(counts[part, entry], width),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    names = ["part", "entry", "at", "total", "n"]
    sums = portions.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    return sums.groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()


def coded(portions: DataFrame, books: np.ndarray) -> DataFrame:
    """Rows with the nearest entry of every part and the squared distances' sum."""
    import pyarrow as pa

    own = portions.schema["rows"].dataType.elementType
    schema = T.StructType([T.StructField("row", own), *T.StructType.fromDDL("code binary, error long")])

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                portion = Portion(batch, row, books.shape)
                codes = np.zeros((portion.n, len(books)), np.uint8)
                errors = np.zeros(portion.n, np.int64)
                for part, book in enumerate(books):
                    for _, where, listed in portion.blocks(part, book):
                        entries, distances = nearest(portion.points[part, where], book, listed)
                        codes[portion.places[part, where], part] = entries
                        errors[portion.places[part, where]] += distances
                arrays = [batch.column(0)[row].values, pa.array([c.tobytes() for c in codes]), pa.array(errors)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return portions.mapInArrow(run, schema)


def compress(
    vectors: DataFrame,
    column: str = "embedding",
    key: str = "vec_id",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
) -> Compressed:
    """Train a codebook for each part position and code every usable vector."""
    if entries > 256:
        raise ValueError("a code has one byte for each part")
    vector, by = quoted([column])[0], quoted([key])[0]

    def usable(x):
        number = x.cast("double")
        return x.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))

    kept = vectors.where(vector.isNotNull() & F.forall(vector, usable))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * 256)).alias("whole")
    first = kept.select(by.alias("key"), whole).orderBy(F.col("key").asc_nulls_last(), "whole").limit(entries)
    books = [r["whole"] for r in first.collect()]
    own = without(vectors, "code", "error")
    row = F.struct(*quoted(own)).alias("row")
    if not books:
        none = vectors.select(*quoted(own), F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
        return Compressed(none.where("false"), np.zeros((parts, 0, 0), np.int64))
    if {len(b) % parts for b in books} != {0} or len({len(b) for b in books}) > 1:
        raise ValueError(f"all vectors must have one length, a multiple of {parts}")
    books = np.array(books, np.int64).reshape(len(books), parts, -1).transpose(1, 0, 2).copy()
    portions = portions_of(kept.select(row, whole), books.shape)
    for _ in range(rounds):
        after = books.copy()
        for r in round_sums(portions, books):
            after[r["part"], r["entry"], r["at"]] = r["total"] // r["n"]
        books = after
    out = coded(portions, books)
    columns = [F.col("row").getField(c).alias(c) for c in own]
    return Compressed(out.select(*columns, "code", "error"), books)
