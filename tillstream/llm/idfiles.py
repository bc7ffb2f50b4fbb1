"""Token ids of a corpus in compressed files.

Documents are range-partitioned and sorted by id, encoded to token ids with an end id
after each, and written as a Parquet table of frames.  A frame holds whole documents with
at least ``FRAME`` ids together; its payload is one or more blocks of the range coder
(:mod:`tillstream.llm.rangecoder`), each reset and checksummed on its own.  A frame also
has its place in the corpus (``part``, and ``part_start``: ids before it in the part) and
the ids and lengths of its documents.

Null and empty texts are an end id only.  Null ids come first; documents with one id go
by the text's hash; repeated rows follow each other.  An empty table gives an empty file.
"""

from __future__ import annotations

from itertools import chain, islice
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, Window as W, functions as F

from tillstream.llm import rangecoder
from tillstream.llm.common import texts_as_bytes

FRAME = 1 << 15
#: Words a worker remembers the ids of.
REMEMBERED = 1 << 20
#: Bytes of text encoded together.
PORTION = 2 << 20

_ENCODERS: dict[int, "Encoder"] = {}


class Encoder:
    """Encodes texts word by word with a tokenizer file.

    Only for tokenizers that never join what ASCII blanks separate, as those that drop
    white space do: then the ids of a text are the ids of its words.
    """

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(file)
        self.tokenizer.no_padding()
        self.clear()

    def clear(self) -> None:
        self.words: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def learn(self, fresh: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in fresh], add_special_tokens=False)
        ids = [e.ids for e in found]
        sizes = np.array(list(map(len, ids)), np.int64)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        flat = np.array(list(chain.from_iterable(ids)), np.uint32)
        self.ids = np.concatenate([self.ids, flat])

    def encode(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with its end, and their lengths."""
        if len(self.words) > REMEMBERED:
            self.clear()
        split = [t.split() for t in texts]
        flat = list(chain.from_iterable(split))
        at = list(map(self.words.get, flat))
        if None in at:
            known, add = len(self.words), self.words.setdefault
            for i, place in enumerate(at):
                if place is None:
                    at[i] = add(flat[i], len(self.words))
            self.learn(list(islice(reversed(self.words), len(self.words) - known))[::-1])
        at = np.array(at, np.int64)
        sizes = self.starts[at + 1] - self.starts[at]
        # Ids per text, from the words' running totals.
        totals = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum([len(ws) for ws in split])
        lengths = np.diff(np.concatenate([[0], totals[ends]])) + 1 if texts else np.zeros(0, np.int64)
        out = np.full(int(lengths.sum()), end, np.uint32)
        inside = np.ones(len(out), bool)
        inside[np.cumsum(lengths) - 1] = False
        source = np.repeat(self.starts[at] - totals[:-1], sizes) + np.arange(totals[-1])
        out[inside] = self.ids[source]
        return out, lengths


def portions(batch):
    """A batch in parts of about ``PORTION`` bytes of text: a text's words are many objects."""
    import pyarrow.compute as pc

    sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy()
    part = np.cumsum(sizes) // PORTION
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def encoder(file: bytes) -> Encoder:
    """The worker's encoder; it outlives a task so that words are learned once."""
    key = crc32(file)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(file)
    return _ENCODERS[key]


def frames(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """The corpus as rows of encoded frames, in ascending order of id.

    The tokenizer's file is read here and sent to the tasks, a few megabytes of any corpus.
    """
    with open(tokenizer, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = encoder(sent.value).encode
        done = 0
        held: list[tuple[list, list[int], np.ndarray]] = []
        blocks_held = 0
        docs_now, sizes_now, ids_now, n_now = [], [], [], 0

        def flush():
            nonlocal done, held, blocks_held
            blocks, counts = [], []
            for _, _, ids in held:
                cuts = range(0, len(ids), rangecoder.BLOCK)
                blocks += [ids[a : a + rangecoder.BLOCK] for a in cuts]
                counts.append(len(cuts))
            coded = iter(rangecoder.encode(blocks))
            payloads = [b"".join(next(coded) for _ in range(n)) for n in counts]
            starts = np.cumsum([done, *[len(ids) for _, _, ids in held]])
            done = int(starts[-1])
            rows = pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(held), pa.int32()),
                    pa.array(starts[:-1], pa.int64()),
                    pa.array([d for d, _, _ in held], pa.list_(id_field)),
                    pa.array([s for _, s, _ in held], pa.list_(pa.int64())),
                    pa.array(payloads, pa.binary()),
                ],
                names=["part", "part_start", "doc_ids", "lengths", "payload"],
            )
            held, blocks_held = [], 0
            return rows

        id_field = None
        for batch in batches:
            id_field = batch.schema.field(0).type
            for some in portions(batch):
                ids, lengths = encode(texts_as_bytes(some), end)
                stops = np.cumsum(lengths).tolist()
                for doc, size, stop in zip(some.column(0).to_pylist(), lengths.tolist(), stops):
                    docs_now.append(doc)
                    sizes_now.append(size)
                    ids_now.append(ids[stop - size : stop])
                    n_now += size
                    if n_now >= FRAME:
                        held.append((docs_now, sizes_now, np.concatenate(ids_now)))
                        blocks_held += -(-n_now // rangecoder.BLOCK)
                        docs_now, sizes_now, ids_now, n_now = [], [], [], 0
                        if blocks_held >= rangecoder.LANES:
                            yield flush()
        if docs_now:
            held.append((docs_now, sizes_now, np.concatenate(ids_now)))
        if held:
            yield flush()

    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash")]
    placed = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"))
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = f"part int, part_start long, doc_ids array<{id_type}>, lengths array<long>, payload binary"
    return placed.mapInArrow(run, schema)


def write_ids(docs: DataFrame, tokenizer: str, end: int, path: str) -> None:
    frames(docs, tokenizer, end).write.parquet(path)


def read_ids(files: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document, decoded from the files.

    ``start`` counts the ids of all documents before it; both checksums of every block
    are verified.
    """
    return _read(files, "ids array<long>", lambda ids: ids.tolist())


def read_checksums(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    return _read(files, "ids_crc32 long", lambda ids: crc32(ids.astype("<u4").tobytes()))


def _read(files: DataFrame, column: str, make) -> DataFrame:
    id_type = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        import pyarrow as pa

        def table(rows, kinds):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        names = ["part", "at", "doc_id", "n_tokens", "value"]
        value = pa.list_(pa.int64()) if "array" in column else pa.int64()
        for batch in batches:
            kinds = [pa.int32(), pa.int64(), batch.schema.field(2).type.value_type, pa.int64(), value]
            held, blocks = [], []
            for i in range(batch.num_rows):
                payload = rangecoder.split(batch.column(4)[i].as_py())
                held.append((i, len(payload)))
                blocks += payload
                if len(blocks) >= rangecoder.LANES or i + 1 == batch.num_rows:
                    decoded = iter(rangecoder.decode(blocks))
                    rows = []
                    for j, n in held:
                        ids = np.concatenate([next(decoded) for _ in range(n)])
                        part, at = batch.column(0)[j].as_py(), batch.column(1)[j].as_py()
                        stop = 0
                        for doc, size in zip(batch.column(2)[j].as_py(), batch.column(3)[j].as_py()):
                            rows.append((part, at + stop, doc, size, make(ids[stop : stop + size])))
                            stop += size
                    yield table(rows, kinds)
                    held, blocks = [], []

    read = files.select("part", "part_start", "doc_ids", "lengths", "payload").mapInArrow(
        run, f"part int, at long, doc_id {id_type}, n_tokens long, {column}"
    )
    # One row for each part; their number is that of the writing tasks.
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    parts = files.groupBy("part").agg(F.sum(total).alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select(
        F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")
    )
    name = column.split()[0]
    return read.join(F.broadcast(offsets) if parts.count() <= 100_000 else offsets, F.col("part") == F.col("_part")).select(
        "doc_id", (F.col("_before") + F.col("at")).alias("start"), "n_tokens", name
    )
