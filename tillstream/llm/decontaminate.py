"""Benchmark decontamination: BM25 over an index of test items, then word overlap.

Test items go into an inverted index with BM25 impacts; every passage of every document
is a query that must retrieve all items above the item's own threshold.  The threshold is
what a passage holding 80% of the item's five-word shingles scores at least, so nothing
that could pass the check below is lost.

Search is block-max WAND.  Items are numbered and cut into blocks of ``BLOCK``; for each
term and each block it occurs in the largest impact is kept.  Sums of those maxima over a passage, taken for
all passages of a text at once, leave few blocks open; in an open block the postings are
walked item by item, skipping ahead while the maxima of the lists before the pivot cannot
reach the threshold.

A retrieved item counts as leaked if the passage holds at least 80% of its five-word
shingles, and at least 80% of the words of its question and of its answer.  An item's
answer is what follows its last question mark or ``answer:``; without either it is its
last sentence, and for a single sentence its last third.

Passages are windows moved by half over the whole text.  Items are searched in classes by
length, doubling from ``SHORT`` words, and a window is twice the class's bound, so a passage
never depends on the other items.  Scores weigh words within a class of a part.  Items are indexed in parts of bounded size, one pass over the documents each, so no
more than a part is ever sent to the tasks.  Null and empty texts hold no passage; items
without words are never matched; null and repeated ids are ordinary.  Empty tables and
tables without items give an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from math import ceil, log

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.common import quoted, stored

SHINGLE = 5
SIMILARITY = 0.8
BLOCK = 4
#: Bytes of item text that one index holds; larger benchmarks take more passes.
PART_BYTES = 8 << 20
#: Words of the items in the first class by length.
SHORT = 64
#: Words of a text that are looked at together.
STRETCH = 1 << 16
#: Sums over pieces and blocks, and maxima added to them, that are held at a time.
CELLS, ADDED = 1 << 18, 1 << 20
K1, B = 1.2, 0.75

TOKEN = re.compile(r"\w+")
ANSWER = re.compile(r"\banswer\s*:", re.I)
SENTENCE = re.compile(r"[.!?]\s+(?=\S)")


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    if len(words) <= SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(SHINGLE)]))


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    marks = list(ANSWER.finditer(text))
    if marks:
        question, answer = text[: marks[-1].start()], text[marks[-1].end() :]
    elif "?" in text.rstrip()[:-1]:
        at = text.rstrip()[:-1].rindex("?") + 1
        question, answer = text[:at], text[at:]
    else:
        stops = list(SENTENCE.finditer(text))
        at = stops[-1].end() if stops else None
        if at is None:
            words = tokens(text)
            at = len(words) - len(words) // 3
            return words[:at], words[at:]
        question, answer = text[:at], text[at:]
    return tokens(question), tokens(answer)


def share(words: list[str], held: set[str]) -> float:
    return sum(w in held for w in words) / len(words) if words else 1.0


def class_of(n_words: int) -> int:
    """The most words an item of the same class may have."""
    return max(SHORT, 1 << (n_words - 1).bit_length())


@dataclass
class Item:
    item_id: object
    words: list[str]
    shingles: set[tuple[str, ...]]
    question: list[str]
    answer: list[str]
    threshold: float = 0.0


class Maxima:
    """Largest impacts by term and block of items, for the blocks a term occurs in."""

    def __init__(self, postings: list[tuple[list[int], list[float]]], n_blocks: int) -> None:
        self.shape = (len(postings), n_blocks)
        sizes = np.array([len(numbers) for numbers, _ in postings], np.int64)
        blocks = np.concatenate([np.array(numbers, np.int64) // BLOCK for numbers, _ in postings] or [sizes])
        impacts = np.concatenate([np.array(x, np.float32) for _, x in postings] or [sizes])
        cells = np.repeat(np.arange(len(postings)), sizes) * n_blocks + blocks
        # Postings are in the order of their items, so cells are sorted.
        first = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else sizes
        self.cells = cells[first]
        self.impacts = np.maximum.reduceat(impacts, first) if len(first) else impacts
        self.starts = np.searchsorted(self.cells, np.arange(len(postings) + 1) * n_blocks)

    def at(self, terms: np.ndarray, block: int) -> np.ndarray:
        """The terms' maxima in a block, zero where they do not occur."""
        wanted = terms * self.shape[1] + block
        place = np.minimum(np.searchsorted(self.cells, wanted), len(self.cells) - 1)
        return np.where(self.cells[place] == wanted, self.impacts[place], np.float32(0))

    def sums(self, rows: np.ndarray, terms: np.ndarray, n_rows: int) -> np.ndarray:
        """Maxima of the terms added up by row and block."""
        n_blocks = self.shape[1]
        sizes = self.starts[terms + 1] - self.starts[terms]
        ends = np.cumsum(sizes)
        out = np.zeros(n_rows * n_blocks)
        a = 0
        while a < len(terms):
            done = int(ends[a - 1]) if a else 0
            b = max(a + 1, int(np.searchsorted(ends, done + ADDED, "right")))
            part = sizes[a:b]
            place = np.arange(int(part.sum())) + np.repeat(self.starts[terms[a:b]] - (ends[a:b] - part - done), part)
            to = self.cells[place] + np.repeat((rows[a:b] - terms[a:b]) * n_blocks, part)
            out += np.bincount(to, self.impacts[place], len(out))
            a = b
        return out.reshape(n_rows, n_blocks)


@dataclass
class Index:
    """Inverted index of items with block maxima."""

    items: list[Item]
    terms: dict[str, int] = field(default_factory=dict)
    #: For each term the items holding it in order, and the impacts there.
    postings: list[tuple[list[int], list[float]]] = field(default_factory=list)
    #: Largest impact by term and block of items.
    maxima: Maxima = field(default_factory=lambda: Maxima([], 0))
    #: Lowest threshold by block.
    floors: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    window: int = 2

    @classmethod
    def of(cls, rows: list[tuple[object, str]]) -> "Index":
        items = []
        for item_id, text in rows:
            words = tokens(text or "")
            if words:
                items.append(Item(item_id, words, shingles(words), *question_and_answer(text)))
        holding = Counter(w for i in items for w in set(i.words))
        # Items that share their commonest words, so those of one language, and of like
        # length next to each other give tighter block maxima.
        items.sort(key=lambda i: (min(set(i.words), key=lambda w: (-holding[w], w)), len(i.words), i.words))
        index = cls(items)
        if not items:
            return index
        mean = sum(len(i.words) for i in items) / len(items)
        lists: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for n, item in enumerate(items):
            norm = K1 * (1 - B + B * len(item.words) / mean)
            impacts = {}
            for word, tf in Counter(item.words).items():
                idf = log(1 + (len(items) - holding[word] + 0.5) / (holding[word] + 0.5))
                impacts[word] = idf * tf * (K1 + 1) / (tf + norm)
                lists[word].append((n, impacts[word]))
            # A word is missing only if every shingle over it is, so at most as many
            # words are missing as shingles may be.
            spare = len(item.shingles) - ceil(SIMILARITY * len(item.shingles) - 1e-9)
            lost = sum(sorted(impacts.values(), reverse=True)[:spare])
            item.threshold = (sum(impacts.values()) - lost) * (1 - 1e-6)
        index.terms = {w: k for k, w in enumerate(lists)}
        index.postings = [([n for n, _ in p], [x for _, x in p]) for p in lists.values()]
        n_blocks = -(-len(items) // BLOCK)
        index.maxima = Maxima(index.postings, n_blocks)
        index.floors = np.array(
            [min(i.threshold for i in items[b * BLOCK : (b + 1) * BLOCK]) for b in range(n_blocks)],
            np.float32,
        )
        index.window = 2 * class_of(max(len(i.words) for i in items))
        return index

    def retrieve(self, found: set[int], block: int) -> list[tuple[int, float]]:
        """Items of a block whose score for the terms reaches their threshold (WAND)."""
        floor = float(self.floors[block])
        last = min((block + 1) * BLOCK, len(self.items))
        cursors = []  # next item, place in the list, maximum in this block, list
        order = list(found)
        for term, bound in zip(order, self.maxima.at(np.array(order, np.int64), block).tolist()):
            if bound > 0:
                numbers, impacts = self.postings[term]
                at = bisect_left(numbers, block * BLOCK)
                cursors.append([numbers[at], at, bound, numbers, impacts])
        out = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            reach, pivot = 0.0, None
            for c in cursors:
                reach += c[2]
                if reach >= floor - 1e-4:
                    pivot = c[0]
                    break
            if pivot is None:
                break
            if cursors[0][0] == pivot:
                score = sum(c[4][c[1]] for c in cursors if c[0] == pivot)
                if score >= self.items[pivot].threshold:
                    out.append((pivot, score))
                target = pivot + 1
            else:
                target = pivot
            for c in cursors:
                if c[0] < target:
                    c[1] = bisect_left(c[3], target, c[1])
                    c[0] = c[3][c[1]] if c[1] < len(c[3]) else last
            cursors = [c for c in cursors if c[0] < last]
        return out

    def leaks(self, words: list[str]) -> dict[int, tuple[float, float]]:
        """Leaked items of a text's words: best score and share of shingles found."""
        best: dict[int, tuple[float, float]] = {}
        step = self.window // 2
        # Few pieces at a time if there are many blocks: all their sums are held.
        stretch = max(1, min(STRETCH // step, CELLS // self.maxima.shape[1])) * step
        for start in range(0, max(1, len(words) - step), stretch):
            # Stretches overlap by a window, so no window is missed between them.
            self._leaks(words[start : start + stretch + self.window], best)
        return best

    def _leaks(self, words: list[str], best: dict[int, tuple[float, float]]) -> None:
        unknown = len(self.terms)
        get = self.terms.get
        ids = np.array([get(w, unknown) for w in words], np.int64)
        known = np.flatnonzero(ids != unknown)
        if not len(known):
            return
        # A passage is two neighbouring pieces; each piece counts a word once.
        step = self.window // 2
        held = np.unique(known // step * unknown + ids[known])
        piece, term = np.divmod(held, unknown)
        sums = self.maxima.sums(piece, term, max(2, -(-len(words) // step)))
        reach = sums[:-1] + sums[1:]
        # Sums of float32 values are off by far less than the margin.
        edges = np.searchsorted(piece, np.arange(len(sums) + 1))
        for w, block in zip(*np.nonzero(reach >= self.floors - 0.01)):
            here = term[edges[w] : edges[w + 2]]
            here = np.unique(here)  # words of both pieces had been counted twice
            bounds = self.maxima.at(here, block)
            if bounds.sum() < self.floors[block] - 0.01:
                continue
            hits = self.retrieve(set(here[bounds > 0].tolist()), int(block))
            if hits:
                passage = words[w * step : w * step + self.window]
                have, single = shingles(passage), set(passage)
                for n, score in hits:
                    item = self.items[n]
                    if len(item.words) < SHINGLE:
                        text = " ".join(passage)
                        part = float(f" {' '.join(item.words)} " in f" {text} ")
                    else:
                        part = len(item.shingles & have) / len(item.shingles)
                    if (
                        part >= SIMILARITY
                        and share(item.question, single) >= SIMILARITY
                        and share(item.answer, single) >= SIMILARITY
                    ):
                        was = best.get(n, (0.0, 0.0))
                        best[n] = max(was[0], score), max(was[1], part)


def item_parts(benchmark: DataFrame, part_bytes: int = PART_BYTES):
    """The items in lists of bounded size; each list fits in memory whatever the table."""
    rows = benchmark.where("text is not null").select("item_id", "text")
    total = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    for part in range(parts):
        chosen = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        items = sorted((tuple(r) for r in chosen.distinct().collect()), key=lambda r: (str(r[0]), r[1]))
        if items:
            yield items


def indexes_of(rows: list[tuple[object, str]]) -> list[Index]:
    """One index for each class of items by length; items without words are in none."""
    classes = defaultdict(list)
    for row in rows:
        if n_words := len(tokens(row[1] or "")):
            classes[class_of(n_words)].append(row)
    return [Index.of(classes[c]) for c in sorted(classes)]


def leaking_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, score, overlap) of every leaked item of every document."""
    import pyarrow as pa

    item_type = benchmark.schema["item_id"].dataType.simpleString()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text_hash long, item_id {item_type}, score double, overlap double"
    out = None
    for items in item_parts(benchmark):
        indexes = indexes_of(items)
        if not indexes:
            continue
        sent = docs.sparkSession.sparkContext.broadcast(indexes)  # grows with the words of a part

        def run(batches, sent=sent):
            indexes = sent.value
            for batch in batches:
                ids, hashes, texts = batch.columns
                rows = [
                    (i, index.items[n].item_id, score, part)
                    for i, text in enumerate(texts)
                    for words in (tokens(text.as_py() or ""),)
                    for index in indexes
                    for n, (score, part) in index.leaks(words).items()
                ]
                if rows:
                    at, item, score, part = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(at)), hashes.take(pa.array(at)),
                            pa.array(item), pa.array(score, pa.float64()), pa.array(part, pa.float64()),
                        ],
                        names=["doc_id", "text_hash", "item_id", "score", "overlap"],
                    )

        found = docs.select("doc_id", F.xxhash64("text"), "text").mapInArrow(run, schema)
        out = found if out is None else out.unionAll(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, overlap) of every leaked item of every document."""
    return leaking_rows(docs, benchmark).drop("text_hash")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without leaked items; other texts under the id of a leak stay."""
    bad = stored(leaking_rows(docs, benchmark).select("doc_id", "text_hash").distinct(), "leaks")
    marked = bad.select(F.col("doc_id").alias("_leaked"), F.col("text_hash").alias("_leaked_text"))
    same = docs["doc_id"].eqNullSafe(marked["_leaked"]) & (F.xxhash64(docs["text"]) == marked["_leaked_text"])
    return docs.join(marked, same, "left_anti").select(*quoted(docs.columns))
