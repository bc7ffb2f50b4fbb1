"""Fingerprints of the improbable features of a text, and how alike two of them are.

A feature is a window of 16 bytes.  Its entropy falls into one of 1,001 bins; how many
windows of all documents fall into each bin is counted first, and the rarer its bin the
better a window ranks.  Every run of 16 neighbouring windows votes for its best one (the
first of equals), and a window with 8 votes or more is selected.  Runs reach over the ends
of a text, so its best window always has votes enough.  (Windows of 64 bytes, as for files,
are longer than half of a short text and find nothing in common after an edit.)  Windows of very low entropy, which
say little, rank last.

Selected windows are hashed, repeats within a text once, into a chain of Bloom filters:
256 bytes and 5 bits a feature, 160 features to a filter.  A fingerprint is the filters one
after the other.  Two filters are as alike as their common bits exceed what chance gives,
normalised by what they could share at most; a fingerprint is as alike to another as the
mean over its filters, weighted by bits, of the best match there.  The side with fewer
filters is held against the other; with equal numbers it is the mean of both ways.

Entropy is in whole numbers, so fingerprints do not depend on how rows are dealt.  Ranks
are a list of 1,001 numbers: kept, they make fingerprints of several corpora comparable.

* Null and empty texts have an empty fingerprint; two of those are alike (1), one and
  another are not (0).  A text under 16 bytes is one feature, padded with zeros.
* Equal texts have equal fingerprints, so repeated rows and ties do.  Long texts have as
  many filters as they need.  An empty table has equal ranks and no fingerprints.
* :func:`with_fingerprints` keeps extra columns and replaces only those it adds.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tillstream.llm.common import append_arrow, stored

WINDOW = 16
RUN = 16
VOTES = 8
BINS = 1_001
#: Bins below this rank last.
PLAIN = 100
FILTER_BITS, FILTER_FEATURES, FEATURE_BITS = 2_048, 160, 5
FILTER = FILTER_BITS // 8
#: Bytes of text worked on together, and of a piece whose windows slide together.
PORTION = 2 << 20
PIECE = 1 << 17

_C = np.arange(WINDOW + 1)
#: Whole-number c * log2(c) of a byte found c times in a window, and what one more adds.
_WEIGHT = np.round(_C * np.log2(np.maximum(_C, 1)) * 1024).astype(np.int32)
_GAIN = np.diff(_WEIGHT)


def _piece_bins(data: np.ndarray) -> np.ndarray:
    n = len(data)
    before, after, equal = np.zeros(n, np.uint8), np.zeros(n, np.uint8), np.empty(n, np.bool_)
    for back in range(1, WINDOW):
        same = np.equal(data[back:], data[:-back], out=equal[: n - back]).view(np.uint8)
        before[back:] += same
        after[:-back] += same
    total = np.empty(n - WINDOW + 1, np.int32)
    total[0] = _WEIGHT[np.bincount(data[:WINDOW])].sum()
    # Sliding by one adds a byte to those equal to it and takes one from those equal to it.
    total[1:] = _GAIN[before[WINDOW:]] - _GAIN[after[:-WINDOW]]
    np.cumsum(total, out=total)
    full = _WEIGHT[WINDOW]
    return ((full - total) * (BINS - 1) // full).astype(np.int16)


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """Entropy bin of the window at each byte but the last 15."""
    last = len(data) - WINDOW + 1
    pieces = [_piece_bins(data[i : min(i + PIECE, last) + WINDOW - 1]) for i in range(0, max(last, 0), PIECE)]
    return np.concatenate(pieces) if pieces else np.zeros(0, np.int16)


class Texts:
    """Texts as one string of bytes, with the places of whole windows."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(self.sizes)
        self.bins = entropy_bins(self.data)
        # A window belongs to a text if it ends there too.
        inside = np.zeros(len(self.data) + 1, np.int32)
        whole = self.sizes >= WINDOW
        np.add.at(inside, (self.ends - self.sizes)[whole], 1)
        np.add.at(inside, (self.ends - WINDOW + 1)[whole], -1)
        self.inside = np.cumsum(inside)[: len(self.bins)].astype(bool)


def _selected(texts: Texts, ranks: np.ndarray) -> np.ndarray:
    """Places of the windows with votes enough."""
    n = len(texts.bins)
    none = np.int64(BINS) << 40
    keys = np.full(n + 2 * (RUN - 1), none)
    keys[RUN - 1 : RUN - 1 + n] = np.where(
        texts.inside, ranks[texts.bins].astype(np.int64) << 40 | np.arange(n), none
    )
    # Between two texts lie 15 places without a window, so no run reaches into both.
    width = 1
    while width < RUN:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    votes = np.bincount(keys[keys < none] & ((1 << 40) - 1), minlength=1)
    return np.flatnonzero(votes >= VOTES)


def _hashes(windows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each window, by multiplying and shifting its words."""
    found = np.full(len(windows), 0x9E3779B97F4A7C15, np.uint64)
    for word in np.ascontiguousarray(windows).view("<u8").T:
        found = (found ^ word) * np.uint64(0xBF58476D1CE4E5B9)
        found ^= found >> np.uint64(29)
        found *= np.uint64(0x94D049BB133111EB)
        found ^= found >> np.uint64(32)
    return found


def fingerprints(texts: list[bytes], ranks: np.ndarray) -> list[bytes]:
    """The filters of each text, one after the other."""
    held = Texts(texts)
    places = _selected(held, ranks)
    windows = held.data[places[:, None] + np.arange(WINDOW)] if len(places) else np.zeros((0, WINDOW), np.uint8)
    owner = np.searchsorted(held.ends, places, side="right")
    short = np.flatnonzero((held.sizes > 0) & (held.sizes < WINDOW))
    padded = b"".join(texts[i].ljust(WINDOW, b"\0") for i in short)
    windows = np.concatenate([windows, np.frombuffer(padded, np.uint8).reshape(-1, WINDOW)])
    owner = np.concatenate([owner, short])
    if not len(owner):
        return [b""] * len(texts)
    hashes = _hashes(windows)
    # Features of each text in their order, repeats at their first place only.
    order = np.lexsort((np.arange(len(owner)), hashes, owner))
    repeat = np.zeros(len(owner), bool)
    repeat[order[1:]] = (owner[order[1:]] == owner[order[:-1]]) & (hashes[order[1:]] == hashes[order[:-1]])
    owner, hashes = owner[~repeat], hashes[~repeat]
    order = np.argsort(owner, kind="stable")
    owner, hashes = owner[order], hashes[order]
    number = np.arange(len(owner)) - np.searchsorted(owner, owner)
    filters = -(-np.bincount(owner, minlength=len(texts)) // FILTER_FEATURES)
    first = np.cumsum(filters) - filters
    bits = np.zeros((int(filters.sum()), FILTER_BITS), bool)
    rows = first[owner] + number // FILTER_FEATURES
    for i in range(FEATURE_BITS):
        bits[rows, (hashes >> np.uint64(11 * i)).astype(np.int64) % FILTER_BITS] = True
    made = np.packbits(bits, axis=1).tobytes()
    return [made[f * FILTER : (f + k) * FILTER] for f, k in zip(first.tolist(), filters.tolist())]


def _one_way(mine: np.ndarray, other: np.ndarray) -> float:
    p, q = np.bitwise_count(mine).sum(1, np.int64), np.bitwise_count(other).sum(1, np.int64)
    best = np.empty(len(mine))
    for i, filter_ in enumerate(mine):
        common = np.bitwise_count(other & filter_).sum(1, np.int64)
        most, chance = np.minimum(q, p[i]), q * p[i] / FILTER_BITS
        best[i] = np.max(np.where(common == most, 1.0, (common - chance) / np.maximum(most - chance, 1e-9)))
    return float(np.average(np.clip(best, 0.0, 1.0), weights=p))


def likeness(a: bytes, b: bytes) -> float:
    """How alike two fingerprints are, 0 to 1."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x, y = (np.frombuffer(f, "<u8").reshape(-1, FILTER // 8) for f in (a, b))
    if len(x) == len(y):
        return (_one_way(x, y) + _one_way(y, x)) / 2
    return _one_way(x, y) if len(x) < len(y) else _one_way(y, x)


def portions(texts: list[bytes]):
    """Slices of a list that hold about ``PORTION`` bytes each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= PORTION:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _bytes(column) -> list[bytes]:
    import pyarrow as pa

    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def entropy_ranks(docs: DataFrame, column: str = "text") -> list[int]:
    """Rank of each entropy bin over all windows of a table: 0 for the rarest.

    Equally frequent bins go by number.  1,001 counts a task are added up in Spark.
    """

    def run(batches):
        import pyarrow as pa

        counts = np.zeros(BINS, np.int64)
        for batch in batches:
            texts = _bytes(batch.column(0))
            for part in portions(texts):
                held = Texts(texts[part])
                counts += np.bincount(held.bins[held.inside], minlength=BINS)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["bin", "n"])

    rows = docs.select(F.col(column)).mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    counts = {r["bin"]: r["n"] for r in rows.collect()}
    order = sorted(range(BINS), key=lambda b: (b < PLAIN, counts.get(b, 0), b))
    ranks = [0] * BINS
    for rank, b in enumerate(order):
        ranks[b] = rank
    return ranks


def with_fingerprints(docs: DataFrame, ranks: list[int], column: str = "text", name: str = "fingerprint") -> DataFrame:
    """Every row with the fingerprint of a text column, as binary."""
    table = np.array(ranks, np.int16)

    def make():
        import pyarrow as pa

        def step(batch):
            texts = _bytes(batch.column(batch.schema.get_field_index(column)))
            return [pa.array([f for p in portions(texts) for f in fingerprints(texts[p], table)], pa.binary())]

        return step

    return append_arrow(docs, make, f"{name} binary")


def with_likeness(pairs: DataFrame, left: str, right: str, name: str = "likeness") -> DataFrame:
    """Every row with how alike two fingerprint columns are; null counts as empty."""

    def make():
        import pyarrow as pa

        def step(batch):
            sides = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (left, right)]
            return [pa.array([likeness(a or b"", b or b"") for a, b in zip(*sides)], pa.float64())]

        return step

    return append_arrow(pairs, make, f"{name} double")


def edited(text: str, after: str) -> str:
    """A text whose last half is replaced by the start of the text after it."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


_EDITS = (
    "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)


def _pairs(texts: list[str], prints: list[bytes], afters: list[str], after_prints: list[bytes], table) -> list:
    """The columns of ``_EDITS`` for texts with their successors."""
    changed = [edited(t, a).encode() for t, a in zip(texts, afters)]
    changed_prints = [f for p in portions(changed) for f in fingerprints(changed[p], table)]
    return [
        [len(t) for t in texts],
        [hashlib.sha256(c).hexdigest() for c in changed],
        prints,
        changed_prints,
        list(map(likeness, prints, changed_prints)),
        list(map(likeness, prints, after_prints)),
    ]


def edits(docs: DataFrame, ranks: list[int]) -> DataFrame:
    """Fingerprints of documents and of their edited texts, and their likeness.

    The edited text ends with the start of the document that follows by ``doc_id`` (nulls
    last, equal ids by the text's hash; the first one follows the last).  Texts are sorted
    over all tasks once and each task pairs neighbours as they pass; what pairs a task's last
    document with the first of the next task is one text a task, joined afterwards.
    """
    import pyarrow as pa

    spark, table = docs.sparkSession, np.array(ranks, np.int16)
    key = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(_EDITS)])
    sides = T.StructType.fromDDL("part int, head string, tail string")
    schema = T.StructType([*key, *sides])
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]

    def batch_of(ids, columns, *rest):
        arrays = [ids, *(pa.array(c, k) for c, k in zip(columns, kinds)), *rest]
        return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema][: len(arrays)])

    def run(batches):
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            raw = [t.encode() for t in texts]
            for at in portions(raw):
                prints = fingerprints(raw[at], table)
                now, mine, head = ids[at], texts[at], None
                if held is None:
                    head = mine[0]
                else:
                    now, mine, prints = pa.concat_arrays([held[0], now]), [held[1], *mine], [held[2], *prints]
                done = len(mine) - 1
                held = now[done:], mine[done], prints[done]
                rest = pa.array([part] * done, pa.int32()), pa.array([None] * done, pa.string())
                columns = _pairs(mine[:done], prints[:done], mine[1:], prints[1:], table)
                yield batch_of(now[:done], columns, *rest, rest[1])
                if head is not None:
                    first = [[None], [None], [prints[0]], [None], [None], [None]]
                    sides = pa.array([part], pa.int32()), pa.array([head]), pa.array([None], pa.string())
                    yield batch_of(now[:1], first, *sides)
        if held is not None:
            last = [[None], [None], [held[2]], [None], [None], [None]]
            sides = pa.array([part], pa.int32()), pa.array([None], pa.string()), pa.array([held[1]])
            yield batch_of(held[0], last, *sides)

    def finish(batches):
        for batch in batches:
            _, texts, prints, afters, after_prints = (c.to_pylist() for c in batch.columns)
            yield batch_of(batch.column(0), _pairs(texts, prints, afters, after_prints, table))

    order = [F.col("doc_id").asc_nulls_last(), F.col("hash"), F.col("at")]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("at"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    found = stored(rows.mapInArrow(run, schema), "edits", "zstd")
    heads = found.where("head is not null").select(
        F.col("part").alias("after"), F.col("head").alias("after_text"), F.col("fingerprint").alias("after_print")
    )
    parts = sorted(r["after"] for r in heads.select("after").collect())
    follows = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, after int")
    tails = found.where("tail is not null").select("doc_id", "part", "tail", "fingerprint")
    met = tails.join(follows, "part").join(heads, "after")
    ends = met.select("doc_id", "tail", "fingerprint", "after_text", "after_print").mapInArrow(finish, key)
    return found.where("head is null and tail is null").select(*key.names).unionAll(ends)
