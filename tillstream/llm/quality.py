"""Quality rules: fixed base rules and a log-likelihood ratio of hashed n-grams.

Words and pairs of words are hashed into ``BUCKETS`` buckets.  Two multinomials are
counted over whole texts: one over all documents, one over the trusted labelled ones.  A document's score is the mean over its n-grams of log(target / raw).  Documents
below the threshold go; the threshold lies between the scores of trusted and of rejected
labelled documents (:func:`threshold`).

Every labelled id counts: counts, model and threshold come from all of them, and the verdict
covers every document.  Without trusted rows there is no verdict and only the base rules act.

Null texts count as empty and fail the base rules.  Null or repeated ids, ties, repeated
rows and extra columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import islice
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.common import append_arrow, numbered, quoted, stored, texts_as_bytes, without

BUCKETS = 1 << 16
MIN_WORDS = 50
REPEAT_PERCENT = 50
SMOOTHING = 1.0
#: Words whose ids and hashes a task remembers before it starts over.
REMEMBERED = 1 << 20

# Fixed value: the characters counted as symbols.
SYMBOLS = b"#*$%&|<>"

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


class Words:
    """Numbers words in order of appearance; numbers stay below 2**21."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.hashes = np.empty(REMEMBERED, np.uint64)
        self.hashed = 0

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.numbers) > REMEMBERED // 2:
            self.numbers.clear()
            self.hashed = 0
        numbers = self.numbers
        add = numbers.setdefault
        return np.fromiter((add(w, len(numbers)) for w in words), np.int64, len(words))

    def hash(self, ids: np.ndarray) -> np.ndarray:
        known = len(self.numbers)
        if known > len(self.hashes):  # one very long text can hold more
            self.hashes = np.resize(self.hashes, known)
        if known > self.hashed:
            fresh = list(islice(reversed(self.numbers), known - self.hashed))
            self.hashes[self.hashed : known] = [crc32(w.lower()) for w in reversed(fresh)]
            self.hashed = known
        return self.hashes[ids]


def repeated_words(ids: np.ndarray) -> int:
    """Words lying in a window of three that occurs twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    if int(ids.max()) < 1 << 21:
        windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:  # exact for any number of words: pair up twice
        _, pairs = np.unique(np.stack([ids[:-1], ids[1:]]), axis=1, return_inverse=True)
        windows = pairs.reshape(-1)[:-1] * (int(ids.max()) + 1) + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    found = 0
    for line in text.split(b"\n"):
        if line in seen:
            found += 1
        elif line.strip():
            seen.add(line)
    return found


def buckets(hashes: np.ndarray) -> np.ndarray:
    """Buckets of a text's words and pairs of words."""
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
    pairs = (mixed[:-1] ^ (hashes[1:] + np.uint64(1))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (np.concatenate([mixed, pairs]) >> np.uint64(48)).astype(np.int64)


def ngram_counts(docs: DataFrame) -> np.ndarray:
    """Counts per bucket over all documents and over those with ``trusted``.

    Each task adds up its whole partition, so it sends one row per bucket at most; the
    result has ``BUCKETS`` rows whatever the input.
    """
    import pyarrow as pa

    def run(batches):
        words, raw, target = Words(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            seen: dict[bool, list[np.ndarray]] = {False: [], True: []}
            for text, trusted in zip(texts_as_bytes(batch), batch.column("trusted").to_pylist()):
                found = text.split()
                if found:
                    seen[trusted].append(buckets(words.hash(words.of(found))))
            for trusted, parts in seen.items():
                if parts:
                    counts = np.bincount(np.concatenate(parts), minlength=BUCKETS)
                    raw += counts
                    target += counts * trusted
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "n", "n_target"]
        )

    rows = (
        docs.select("text", "trusted")
        .mapInArrow(run, "bucket long, n long, n_target long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))
        .toPandas()
    )
    out = np.zeros((2, BUCKETS))
    out[:, rows["bucket"].to_numpy()] = rows[["n", "n_target"]].to_numpy().T
    return out


def ratios(counts: np.ndarray) -> np.ndarray | None:
    """log(target / raw) per bucket.

    The raw model is the prior of the target: where the trusted sample says nothing the
    ratio is near zero, however small the sample is.
    """
    raw, target = counts
    if not target.sum():
        return None
    p = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS)
    prior = BUCKETS * SMOOTHING
    q = (target + prior * p) / (target.sum() + prior)
    return np.log(q / p)


def scored(docs: DataFrame, ratio: np.ndarray | None, drop: tuple[str, ...] = ()) -> DataFrame:
    """Every document with its base counts and its score (null without words or model)."""

    def make():
        import pyarrow as pa

        words = Words()

        def one(text: bytes):
            found = text.split()
            n = len(found)
            if not n:
                return 0, 0, sum(text.count(c) for c in SYMBOLS), 0, 0, None
            codes = np.frombuffer(text, np.uint8)
            points = int(np.count_nonzero((codes & 0xC0) != 0x80))
            blanks = len(text) - sum(map(len, found))
            ids = words.of(found)
            score = None
            if ratio is not None:
                score = float(ratio[buckets(words.hash(ids))].mean())
            symbols = sum(text.count(c) for c in SYMBOLS)
            return n, points - blanks, symbols, duplicate_lines(text), repeated_words(ids), score

        def step(batch):
            rows = [one(t) for t in texts_as_bytes(batch)]
            columns = list(zip(*rows)) or [[]] * 6
            return [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.float64())]

        return step

    return append_arrow(docs, make, f"{COUNTS}, score double", drop)


def known_labels(labels: DataFrame) -> DataFrame:
    """Labelled ids, trusted (``_good``) or rejected; an id that is both is trusted."""
    good = F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))
    bad = F.coalesce(F.col("quality") == 0, F.lit(False))
    ids = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(good).alias("_good"), F.max(bad).alias("_bad"))
    return ids.where("_good or _bad").select("doc_id", "_good")


class Scores:
    """Scores of labelled ids; quantiles are found in Spark by rank, none is sent whole."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        self.ranked = numbered(rows, ["_good"], "_rank", ("score",))
        self.sizes = {r["_good"]: r["n"] for r in rows.groupBy("_good").agg(F.count(F.lit(1)).alias("n")).collect()}

    def __len__(self) -> int:
        return sum(self.sizes.values())

    def quantile(self, good: bool, q: float) -> float | None:
        """As numpy's: linear between the two nearest ranks; none without scores."""
        n = self.sizes.get(good, 0)
        if not n:
            return None
        low = int(q * (n - 1))
        near = F.col("_rank").isin(low, min(low + 1, n - 1))
        found = sorted(r["score"] for r in self.ranked.where((F.col("_good") == good) & near).collect())
        return float(np.interp(q * (n - 1) - low, [0, 1], [found[0], found[-1]]))


def threshold(scores: Scores) -> float:
    """Halfway between the lowest scores of trusted documents and the typical rejected one.

    Kept low on purpose: a trusted document should almost never fall below it.
    """
    low = scores.quantile(True, 0.001)
    if low is None:
        return float("-inf")
    typical = scores.quantile(False, 0.5)
    return low - max(0.0, low - (low - 1.0 if typical is None else typical)) / 2


def judge(docs: DataFrame, labels: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Every document with its counts, score, ``base_failed`` and ``kept``."""
    # One plan at every size: texts are shuffled once, for the counts, and scored once.
    known = known_labels(labels).hint("shuffle_hash")
    marked = docs.select("doc_id", "text").join(known, "doc_id", "left")
    ratio = ratios(ngram_counts(marked.withColumn("trusted", F.coalesce("_good", F.lit(False)))))
    cut = float("-inf")
    out = scored(docs.select(*quoted(without(docs, "base_failed", "kept"))), ratio, drop)
    if ratio is not None:
        out = stored(out, "scored")
        # One row for each labelled id, however many documents bear it.
        rows = out.where(f"n_words >= {MIN_WORDS}").select("doc_id", "score").join(known, "doc_id")
        lowest = rows.groupBy("doc_id", "_good").agg(F.min("score").alias("score"))
        cut = threshold(Scores(stored(lowest.select("_good", "score"), "scores")))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT
    )
    good = F.coalesce(F.col("score") >= F.lit(cut), F.lit(True))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & good)
