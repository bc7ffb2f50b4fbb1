"""Which tokens of two tokenizers cover the same bytes of a text.

Both sides tile the bytes of space + text.  The tokens of a batch are laid out one document
after the other and joined with ``pandas.merge_asof`` within documents: the start of each
token finds the token of the other side that covers it.  The union of both directions holds
every overlapping pair once (equal starts are found twice and kept once), and where ends are
equal a group ends.

Neither tokenizer joins what a space after a character that is no white space separates:
the byte-level pattern starts a new piece at that space, and no piece of the other holds a
space after another character (both are looked at when the tokenizers are read).  So a
document is a row of stretches, both sides end where a stretch ends, and what a task has
aligned once is remembered; only stretches not remembered are tokenized and joined.
Memory is bounded by ``REMEMBERED`` stretches of up to ``STRETCH`` characters.

How many documents hold a pair linked is counted in the tasks, each document's pairs once,
and added up in Spark.  Counts of up to ``PAIRS`` pairs go to every task as sorted arrays;
more are joined with the documents' pairs in Spark, with the same rows.

* Null and empty texts, and those whose joined tokens differ from space + text, have no
  tokens: numbers are 0 and the digest is ''.  They count for no pair.
* Null and repeated ids change nothing, each row is a document of its own; repeated rows
  count for a pair as often as they stand there.  Long texts are taken whole.
* Extra columns stay; those of the names in ``ADDED`` are replaced.  An empty table gives none.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from tillstream.llm.common import append_arrow, quoted, stored, without

REMEMBERED, STRETCH = 1 << 19, 32
#: Pairs whose counts are sent to the tasks: 16 bytes each.
PAIRS = 4 << 20
#: Characters of text worked on together, and pairs a task holds before it adds them up.
PORTION = 1 << 20
HELD = 4 << 20
SPACE = "▁"
_CUT = re.compile(r"(?<=\S) ")
_ODD = re.compile(r"\s ")
#: What a worker keeps from one task to the next: loaded tokenizers and aligned stretches.
_KEPT: dict[str, tuple[str, object]] = {}
ADDED = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


@dataclass
class Tokenizers:
    """The contents of both vocabulary files; sent to the tasks, which load them."""

    a_json: str
    b_model: bytes

    @classmethod
    def from_files(cls, a: str, b: str) -> "Tokenizers":
        with open(a, encoding="utf-8") as left, open(b, "rb") as right:
            made = cls(left.read(), right.read())
        if any(SPACE in piece.lstrip(SPACE) for piece in made.b_pieces):
            raise ValueError("a piece holds a space after another character")
        if '"ByteLevel"' not in made.a_json:
            raise ValueError("the first tokenizer must be byte-level")
        return made

    @cached_property
    def a(self):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        loaded = Tokenizer.from_str(self.a_json)
        loaded.encode_special_tokens = True
        return loaded

    @cached_property
    def b(self):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_proto=self.b_model)

    @property
    def b_pieces(self) -> list[str]:
        return [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]

    @cached_property
    def a_bytes(self) -> list[bytes]:
        """Bytes of each entry.  The byte-level alphabet shows printable bytes as
        themselves and the others, in order, as the characters from 256 on."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = sorted(set(range(256)) - set(shown))
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        found = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            found[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        return found

    @cached_property
    def b_bytes(self) -> list[bytes]:
        return [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(self.b_pieces)
        ]

    @cached_property
    def a_ranks(self):
        """The first side as byte ranks, where its file says that ids are the merges' order.

        Ranks give the same tokens and take long texts at once; None if ids differ.
        """
        import public_tokenizers
        import tiktoken

        model = json.loads(self.a_json)["model"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        singles = [t for t in model["vocab"] if len(t) == 1]
        ordered = len(singles) == 256 and all(model["vocab"].get(x + y) == 256 + i for i, (x, y) in enumerate(pairs))
        if not ordered or sorted(model["vocab"][t] for t in singles) != list(range(256)):
            return None
        ranks = {self.a_bytes[i]: i for i in range(256 + len(pairs))}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
        """For both sides all ids and how many each text has.

        Texts are stretches: they begin with a space, which the second side adds itself.
        """
        if self.a_ranks is None:
            left = _flat([e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)])
        else:
            left = self._by_rank(texts)
        right = self.b.encode([t[1:] for t in texts], num_threads=1)
        alone = [self.b.piece_to_id(SPACE)]
        return left, _flat([ids or alone for ids in right])

    def _by_rank(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One text of many stretches ends a token where each ends, as documents do."""
        encode, sizes = self.a_ranks.encode_ordinary, self.a_sizes
        open_ends = [t[-1].isspace() for t in texts]
        if any(open_ends):  # white space may only end a text
            runs, start = [], 0
            for i in np.flatnonzero(open_ends).tolist():
                runs.append("".join(texts[start : i + 1]))
                start = i + 1
            runs.append("".join(texts[start:]))
        else:
            runs = ["".join(texts)]
        ids = np.fromiter(chain.from_iterable(map(encode, runs)), np.int64)
        ends = np.cumsum(sizes[ids])
        stops = np.cumsum([len(t.encode()) for t in texts])
        at = np.searchsorted(ends, stops)
        if len(stops) and not np.array_equal(ends[at], stops):
            raise ValueError("a token crosses a space after another character")
        return ids, np.diff(at + 1, prepend=0)

    @cached_property
    def a_sizes(self) -> np.ndarray:
        return np.array(list(map(len, self.a_bytes)), np.int64)

    @cached_property
    def b_sizes(self) -> np.ndarray:
        return np.array(list(map(len, self.b_bytes)), np.int64)

    @cached_property
    def shown(self) -> tuple[np.ndarray, np.ndarray]:
        """Decimal ids with a comma, a bar or a semicolon behind, and their lengths."""
        n = max(len(self.a_bytes), len(self.b_bytes))
        texts = [f"{i}{mark}" for mark in ",|;" for i in range(n)]
        return np.array(texts, object), np.array(list(map(len, texts)), np.int64)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(chain.from_iterable(lists), np.int64), np.array(list(map(len, lists)), np.int64)


def overlaps(left, right):
    """Pairs of row numbers of tokens that share bytes, in order of the left side.

    Frames have ``doc``, ``start`` and ``end``, sorted by ``start``; starts go on from one
    document to the next.
    """
    import pandas as pd

    left = left.assign(left=np.arange(len(left)))
    right = right.assign(right=np.arange(len(right)))
    ahead = pd.merge_asof(left, right[["doc", "start", "right"]], on="start", by="doc")
    back = pd.merge_asof(
        right, left[["doc", "start", "left"]].assign(begun=left["start"]), on="start", by="doc"
    )
    back = back[back["start"] > back["begun"]]
    pairs = pd.concat([ahead[["left", "right"]], back[["left", "right"]]])
    return pairs.sort_values(["left", "right"], ignore_index=True)


@dataclass
class Stretches:
    """What is remembered of stretches, by number: arrays that grow with new ones."""

    tokenizers: Tokenizers
    #: Sorted pairs, their counts and whether each is its A id's highest.
    counts: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    known: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.clear()

    def clear(self) -> None:
        self.known.clear()
        #: n_a, n_b, n_groups, n_links, whether the bytes differ, n_best, count_sum
        self.numbers = np.zeros((0, 7), np.int64)
        self.groups: list[str] = []
        self.pairs = np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)

    def learn(self, texts: list[str], docs: list[int]) -> None:
        """Align stretches; ``docs`` are the documents they stand in, ascending."""
        import pandas as pd

        made = self.tokenizers
        raw = [t.encode() for t in texts]
        sizes = np.array(list(map(len, raw)), np.int64)
        n = len(texts)
        sides, wrong = [], np.zeros(n, bool)
        for (ids, many), widths, table in zip(
            made.encode(texts), (made.a_sizes, made.b_sizes), (made.a_bytes, made.b_bytes)
        ):
            owner = np.repeat(np.arange(n), many)
            wrong |= np.bincount(owner, widths[ids], n) != sizes
            if b"".join([table[i] for i in ids.tolist()]) != b"".join(raw):
                stops = np.cumsum(many).tolist()
                for i, (a, b) in enumerate(zip([0, *stops[:-1]], stops)):
                    wrong[i] |= b"".join([table[t] for t in ids[a:b].tolist()]) != raw[i]
            sides.append((ids, owner, widths))
        bases = np.concatenate([[0], np.cumsum(np.where(wrong, 0, sizes))])
        frames, owners = [], []
        for ids, owner, widths in sides:
            ids, owner = ids[~wrong[owner]], owner[~wrong[owner]]
            ends = np.cumsum(widths[ids])
            doc = np.array(docs, np.int64)[owner]
            frames.append(pd.DataFrame({"doc": doc, "start": ends - widths[ids], "end": ends, "id": ids}))
            owners.append(owner)
        left, right = frames
        met = overlaps(left, right)
        met = [met[side].to_numpy(np.int64) for side in ("left", "right")]
        link = left["id"].to_numpy()[met[0]] << 20 | right["id"].to_numpy()[met[1]]
        holder = owners[0][met[0]]
        cuts = np.intersect1d(left["end"].to_numpy(), right["end"].to_numpy(), assume_unique=True)
        numbers = np.zeros((n, 7), np.int64)
        numbers[:, 0], numbers[:, 1] = (np.bincount(o, minlength=n) for o in owners)
        numbers[:, 2] = np.bincount(np.searchsorted(bases[1:], cuts), minlength=n)
        numbers[:, 3] = np.bincount(holder, minlength=n)
        numbers[:, 4] = wrong
        if self.counts is not None:
            pairs, totals, best = self.counts
            at = np.searchsorted(pairs, link)
            sums = np.concatenate([[0], np.cumsum(totals[at])])
            bests = np.concatenate([[0], np.cumsum(best[at], dtype=np.int64)])
            bounds = np.searchsorted(holder, np.arange(n + 1))
            numbers[:, 5], numbers[:, 6] = np.diff(bests[bounds]), np.diff(sums[bounds])
        self.numbers = np.concatenate([self.numbers, numbers])
        self.groups += self._groups(frames, owners, cuts, n)
        bounds = np.searchsorted(holder, np.arange(1, n + 1))
        self.starts = np.concatenate([self.starts, len(self.pairs) + bounds])
        self.pairs = np.concatenate([self.pairs, link])

    def _groups(self, frames, owners, cuts, n: int) -> list[str]:
        """Text of each stretch's groups, made in one string and cut."""
        shown, lengths = self.tokenizers.shown
        per_mark = len(shown) // 3
        ids, order, owner = [], [], []
        for side, (frame, mine) in enumerate(zip(frames, owners)):
            end = frame["end"].to_numpy()
            group = np.searchsorted(cuts, end)
            last = np.ones(len(end), bool)
            last[:-1] = group[1:] != group[:-1]
            # The last id of a side's group has a bar or a semicolon behind it.
            ids.append(frame["id"].to_numpy() + per_mark * (last * (side + 1)))
            order.append(2 * group + side)
            owner.append(mine)
        sort = np.argsort(np.concatenate(order), kind="stable")
        ids, owner = np.concatenate(ids)[sort], np.concatenate(owner)[sort]
        text = "".join(shown[ids].tolist())
        stops = np.cumsum(np.bincount(owner, lengths[ids], n).astype(np.int64)).tolist()
        return [text[a : max(a, b - 1)] for a, b in zip([0, *stops[:-1]], stops)]

    def number(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Stretch numbers of all texts one after the other, and how many each text has."""
        if len(self.known) > REMEMBERED:
            self.clear()
        parts: list[str] = []
        sizes = []
        for text in texts:
            # Where no white space stands before a space, every space is a cut.
            mine = [] if not text else _CUT.split(text) if _ODD.search(" " + text) else text.split(" ")
            sizes.append(len(mine))
            parts += mine
        known = self.known
        found = [known.get(p, -1) for p in parts]
        numbers, sizes = np.array(found, np.int64), np.array(sizes, np.int64)
        if -1 in found:
            fresh: dict[str, int] = {}
            docs, owner = [], np.repeat(np.arange(len(texts)), sizes)
            missing = np.flatnonzero(numbers < 0)
            base = len(self.numbers)
            for i in missing.tolist():
                part = parts[i]
                if part not in fresh:
                    fresh[part] = base + len(fresh)
                    docs.append(int(owner[i]))
            self.learn([" " + p for p in fresh], docs)
            numbers[missing] = [fresh[parts[i]] for i in missing.tolist()]
            known.update((p, i) for p, i in fresh.items() if len(p) <= STRETCH)
        return numbers, sizes

    def trim(self) -> None:
        """Forget everything once long stretches, which are not remembered, take most room."""
        if len(self.pairs) > 16 * REMEMBERED or len(self.numbers) > 2 * REMEMBERED:
            self.clear()


def _held(sent, key: str, counts=None) -> Stretches:
    """This worker's stretches for a job, with tokenizers that outlive it."""
    contents = sent.value[:2]
    digest = hashlib.md5(contents[0].encode() + contents[1]).hexdigest()
    if _KEPT.get("tokenizers", ("",))[0] != digest:
        _KEPT["tokenizers"] = digest, Tokenizers(*contents)
    if _KEPT.get("stretches", ("",))[0] != key:
        _KEPT["stretches"] = key, Stretches(_KEPT["tokenizers"][1], counts)
    return _KEPT["stretches"][1]


def _portions(texts: list[str]):
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= PORTION:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers start, start + 1, ... of each span, one span after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _document_pairs(held: Stretches, numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of each text, with repeats only between stretches, and the text's number."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    wrong = np.bincount(doc, held.numbers[numbers, 4], len(sizes)) > 0
    once = np.unique((doc << 32 | numbers)[~wrong[doc]])
    doc, numbers = once >> 32, once & (1 << 32) - 1
    many = np.diff(held.starts)[numbers]
    return held.pairs[_spans(held.starts[numbers], many)], np.repeat(doc, many)


def pair_counts(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """Number of documents that hold a pair linked, and whether no pair of its A id has more.

    ``pair`` is the A id times 2**20 plus the B id.
    """
    import pyarrow as pa

    sent, key = docs.sparkSession.sparkContext.broadcast((tokenizers.a_json, tokenizers.b_model)), uuid.uuid4().hex

    def run(batches):
        held, kept = _held(sent, key), []
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def added():
            every = np.concatenate([pairs, *(k[0] for k in kept)])
            weights = np.concatenate([counts, *(k[1] for k in kept)])
            once, at = np.unique(every, return_inverse=True)
            sums = np.zeros(len(once), np.int64)
            np.add.at(sums, at, weights)
            kept.clear()
            return once, sums

        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for at in _portions(texts):
                mine, doc = _document_pairs(held, *held.number(texts[at]))
                # A pair's documents are equal only next to each other after the sort.
                order = np.lexsort((doc, mine))
                mine, doc = mine[order], doc[order]
                new = np.ones(len(mine), bool)
                new[1:] = (mine[1:] != mine[:-1]) | (doc[1:] != doc[:-1])
                kept.append(np.unique(mine[new], return_counts=True))
                held.trim()
                if sum(len(k[0]) for k in kept) > HELD:
                    pairs, counts = added()
        pairs, counts = added()
        for start in range(0, len(pairs), 1 << 16):
            part = slice(start, start + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(pairs[part]), pa.array(counts[part])], names=["pair", "n"])

    found = docs.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = stored(found, "pair-counts")
    a = F.shiftright("pair", 20)
    highest = found.groupBy(a.alias("a")).agg(F.max("n").alias("highest"))
    return found.join(highest, a == F.col("a")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _digest(groups: list[str]) -> str:
    return hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""


def _aligned(docs: DataFrame, tokenizers: Tokenizers, counts) -> DataFrame:
    """Every document with its columns; without counts those of counts are 0."""
    sent = docs.sparkSession.sparkContext.broadcast((tokenizers.a_json, tokenizers.b_model, counts))
    key = uuid.uuid4().hex

    def make():
        import pyarrow as pa

        held = _held(sent, key, sent.value[2])

        def portion(texts):
            numbers, sizes = held.number(texts)
            sums = np.zeros((len(numbers) + 1, 7), np.int64)
            np.cumsum(held.numbers[numbers], axis=0, out=sums[1:])
            ends = np.cumsum(sizes)
            rows = sums[ends] - sums[ends - sizes]
            groups, all_groups = [], held.groups
            for wrong, end, size in zip(rows[:, 4].tolist(), ends.tolist(), sizes.tolist()):
                mine = [] if wrong else [all_groups[i] for i in numbers[end - size : end].tolist()]
                groups.append(_digest(mine))
            rows[rows[:, 4] > 0] = 0
            held.trim()
            return rows, groups

        def step(batch):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            parts = [portion(texts[at]) for at in _portions(texts)]
            rows = np.concatenate([np.zeros((0, 7), np.int64), *(p[0] for p in parts)])
            digests = [g for p in parts for g in p[1]]
            return [*(pa.array(rows[:, i]) for i in (0, 1, 2, 3, 5, 6)), pa.array(digests, pa.string())]

        return step

    return append_arrow(docs, make, ADDED)


def _joined(docs: DataFrame, tokenizers: Tokenizers, counts: DataFrame) -> DataFrame:
    """The same where the counts are too many to send: pairs of documents meet them in Spark."""
    import pyarrow as pa

    rows = stored(_aligned(docs, tokenizers, None).withColumn("_row", F.monotonically_increasing_id()), "aligned")
    sent, key = docs.sparkSession.sparkContext.broadcast((tokenizers.a_json, tokenizers.b_model)), uuid.uuid4().hex

    def run(batches):
        held = _held(sent, key)
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), [t or "" for t in batch.column(1).to_pylist()]
            for at in _portions(texts):
                numbers, sizes = held.number(texts[at])
                doc = np.repeat(np.arange(len(sizes)), sizes)
                wrong = np.bincount(doc, held.numbers[numbers, 4], len(sizes)) > 0
                numbers, doc = numbers[~wrong[doc]], doc[~wrong[doc]]
                many = np.diff(held.starts)[numbers]
                pairs, doc = held.pairs[_spans(held.starts[numbers], many)], np.repeat(doc, many)
                order = np.lexsort((pairs, doc))
                pairs, doc = pairs[order], doc[order]
                first = np.ones(len(pairs), bool)
                first[1:] = (pairs[1:] != pairs[:-1]) | (doc[1:] != doc[:-1])
                where = np.flatnonzero(first)
                times = np.diff(np.append(where, len(pairs)))
                columns = [pa.array(ids[at][doc[where]]), pa.array(pairs[where]), pa.array(times)]
                held.trim()
                yield pa.RecordBatch.from_arrays(columns, names=["_row", "pair", "times"])

    pairs = rows.select("_row", "text").mapInArrow(run, "_row long, pair long, times long")
    met = pairs.join(counts, "pair").groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
        F.sum(F.col("times") * F.col("n")).alias("_sum"),
    )
    found = {"n_best": F.coalesce("_best", F.lit(0)), "count_sum": F.coalesce("_sum", F.lit(0))}
    columns = [c for c in rows.columns if c != "_row"]
    return rows.join(met, "_row", "left").select(
        *[found[c].alias(c) if c in found else quoted([c])[0] for c in columns]
    )


def align(docs: DataFrame, tokenizers: Tokenizers, most_pairs: int = PAIRS) -> DataFrame:
    """Every document with the columns ``ADDED``."""
    docs = docs.select(*quoted(without(docs, *T.StructType.fromDDL(ADDED).names)))
    counts = stored(pair_counts(docs, tokenizers), "best-pairs")
    if counts.count() > most_pairs:
        return _joined(docs, tokenizers, counts)
    table = counts.sort("pair").toArrow()
    arrays = tuple(table.column(i).to_numpy() for i in range(3))
    return _aligned(docs, tokenizers, arrays)
