"""Vector codes, fingerprints of edits and token alignment against plain versions."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from helpers import prose
from tillstream.llm import alignment, digests, queries, vectorcodes

SF = "/root/testdata/sf0.001"

# --- vector codes


def coded_plainly(rows, parts=16, entries=64, rounds=2):
    """(id, label, code, error) of usable rows and the codebooks, one vector at a time."""
    kept = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(r[2], p) for r in kept[:entries]] for p in range(parts)]

    def nearest(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = defaultdict(list)
            for r in kept:
                members[nearest(cut(r[2], p), book)[1]].append(cut(r[2], p))
            for k, points in members.items():
                book[k] = [sum(c) // len(points) for c in zip(*points)]
    out = []
    for i, label, v in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return out, books


def vectors(n, width=32, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(width)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += [(n + i, list(rows[7][1]), 1) for i in range(30)]  # copies of one vector
    rows += [rows[5], rows[5], (5, [0.5] * width, 2), (None, [0.25] * width, None)]
    rows += [(9000, None, 1), (9001, [None] * width, 1), (9002, [float("nan")] * width, 1), (9003, [float("inf")] * width, 2)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n, block", [(300, 16), (30, 64), (900, 1)])
def test_codes_match_plain_ones(spark, monkeypatch, n, block):
    monkeypatch.setattr(vectorcodes, "BLOCK", block)
    monkeypatch.setattr(vectorcodes, "PORTION", 250)
    rows = vectors(n)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    found = vectorcodes.compress(table)
    want, books = coded_plainly(rows)
    got = [(r["vec_id"], r["label"], r["code"].hex(), r["error"]) for r in found.rows.collect()]
    assert Counter(got) == Counter(want)
    assert found.codebooks.tolist() == books


def test_codes_keep_clashing_columns_and_take_empty_tables(spark):
    schema = "vec_id long, embedding array<float>, label int, code string, rows int, row int, whole int, key int, points int"
    rows = [(i, v, label, "c", 1, 2, 3, 4, 5) for i, v, label in vectors(40)]
    found = vectorcodes.compress(spark.createDataFrame(rows, schema)).rows
    assert found.columns == ["vec_id", "embedding", "label", "rows", "row", "whole", "key", "points", "code", "error"]
    assert {tuple(r)[3:8] for r in found.collect()} == {(1, 2, 3, 4, 5)}
    none = vectorcodes.compress(spark.createDataFrame([(9, None, 1)], "vec_id long, embedding array<float>, label int"))
    assert none.rows.collect() == [] and none.rows.columns == ["vec_id", "embedding", "label", "code", "error"]


def test_vectors_of_other_lengths_and_sizes_are_told(spark):
    schema = "vec_id long, embedding array<float>, label int"
    uneven = spark.createDataFrame([(1, [0.0] * 15, 1)], schema)
    with pytest.raises(ValueError, match="multiple of 16"):
        vectorcodes.compress(uneven)
    for other in ([0.0] * 16, [1e30] * 32):
        mixed = spark.createDataFrame([(i, [0.1] * 32, 1) for i in range(64)] + [(99, other, 1)], schema)
        with pytest.raises(Exception, match="must have 32 components|must not exceed"):
            vectorcodes.compress(mixed)


def test_hilbert_curve_visits_neighbours():
    for width, bits in [(2, 3), (3, 2), (4, 2)]:
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * width), -1).reshape(-1, width)
        keys = vectorcodes.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1)
        assert set(steps) == {1}


def test_shortlists_hold_every_nearest_entry():
    rng = np.random.default_rng(5)
    points, book = rng.integers(-50, 50, (4000, 4)), rng.integers(-50, 50, (64, 4))
    points = points[vectorcodes.curve_order(points)]
    distances = ((points[:, None] - book) ** 2).sum(-1)
    blocks = points.reshape(-1, 40, 4)
    listed = vectorcodes.shortlists(blocks.min(1), blocks.max(1), book)
    for block, list_ in zip(distances.reshape(-1, 40, 64), listed):
        assert list_[block.argmin(1)].all()
    assert listed.mean() < 0.7  # the boxes do leave entries out


def test_vector_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, books = coded_plainly(rows)
    sums = Counter()
    for _, label, _, error in want:
        sums[label] += error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    got = queries.op12_vector_codes(spark, SF)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter((i, c, e, sums[label], digest) for i, label, c, e in want)


# --- fingerprints


def bins_plainly(data):
    found = []
    for i in range(len(data) - digests.WINDOW + 1):
        counts = Counter(data[i : i + digests.WINDOW]).values()
        weight = lambda c: round(c * math.log2(c) * 1024)
        full = weight(digests.WINDOW)
        found.append((full - sum(map(weight, counts))) * (digests.BINS - 1) // full)
    return found


def selected_plainly(data, ranks):
    bins = bins_plainly(data)
    votes = Counter()
    for start in range(-digests.RUN + 1, len(bins) if bins else -digests.RUN):
        run = range(max(start, 0), min(start + digests.RUN, len(bins)))
        votes[min(run, key=lambda i: (ranks[bins[i]], i))] += 1
    return [i for i in sorted(votes) if votes[i] >= digests.VOTES]


def test_entropy_bins_match_plain_ones(monkeypatch):
    monkeypatch.setattr(digests, "PIECE", 100)
    rng = random.Random(2)
    for text in (b"", b"short", bytes(rng.choice(b"abc ") for _ in range(517)), b"a" * 90, prose(1, 80).encode()):
        assert digests.entropy_bins(np.frombuffer(text, np.uint8)).tolist() == bins_plainly(text)


def test_selected_windows_match_plain_ones():
    ranks = list(range(digests.BINS))
    random.Random(4).shuffle(ranks)
    texts = [prose(i, n).encode() for i, n in enumerate([1, 9, 60, 200, 3])] + [b"", b"a" * 100, b"ab" * 300]
    held = digests.Texts(texts)
    got = digests._selected(held, np.array(ranks, np.int16)).tolist()
    want, base = [], 0
    for t in texts:
        want += [base + i for i in selected_plainly(t, ranks)]
        base += len(t)
    assert got == want


def test_fingerprints_do_not_depend_on_neighbours():
    ranks = np.arange(digests.BINS, dtype=np.int16)
    texts = [prose(i, n).encode() for i, n in enumerate([1, 40, 3000, 7, 500])] + [b"", b"tiny", b"x" * 5000]
    together = digests.fingerprints(texts, ranks)
    assert together == [digests.fingerprints([t], ranks)[0] for t in texts]
    assert [len(f) // digests.FILTER > 0 for f in together] == [bool(t) for t in texts]
    assert len(together[2]) > digests.FILTER


def test_likeness():
    ranks = np.arange(digests.BINS, dtype=np.int16)
    base = prose(1, 3000)
    words = base.split(" ")
    make = lambda t: digests.fingerprints([t.encode()], ranks)[0]
    whole, half = make(base), make(" ".join(words[:1500]) + prose(9, 1500))
    part, other = make(" ".join(words[1000:1400])), make(prose(7, 3000))
    assert digests.likeness(whole, whole) == 1 == digests.likeness(b"", b"")
    assert digests.likeness(whole, b"") == 0 == digests.likeness(b"", whole)
    assert digests.likeness(whole, half) == digests.likeness(half, whole)
    assert digests.likeness(whole, half) > 0.4 and digests.likeness(part, whole) > 0.4
    assert digests.likeness(whole, other) < 0.12


def edits_plainly(rows, ranks):
    """Rows in order; every text with its successor, the first after the last."""
    table = np.array(ranks, np.int16)
    make = lambda t: digests.fingerprints([t.encode()], table)[0]
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        prints = [make(t) for t in (text, changed, after)]
        out.append(
            (i, len(text), hashlib.sha256(changed.encode()).hexdigest(), prints[0].hex(), prints[1].hex(),
             digests.likeness(*prints[:2]), digests.likeness(prints[0], prints[2]))
        )
    return out


def test_edit_query(spark):
    rows = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ranks = digests.entropy_ranks(docs)
    counts = Counter(b for _, t in rows for b in bins_plainly(t.encode()))
    order = sorted(range(digests.BINS), key=lambda b: (b < digests.PLAIN, counts[b], b))
    assert [ranks[b] for b in order] == list(range(digests.BINS))
    got = queries.op11_fingerprints(spark, SF)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == edits_plainly(sorted(rows), ranks)


@pytest.mark.parametrize("parts", [1, 7])
def test_edits_of_awkward_documents(spark, awkward, parts):
    ranks = list(range(digests.BINS))
    keyed = awkward.selectExpr("doc_id", "coalesce(text, '') as text", "xxhash64(text) as hash").collect()
    rows = sorted(keyed, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["hash"]))
    got = digests.edits(awkward.repartition(parts), ranks).collect()
    plain = lambda r: (r[0], r[1], r[2], bytes(r[3]).hex(), bytes(r[4]).hex(), r[5], r[6])
    want = edits_plainly([(r["doc_id"], r["text"]) for r in rows], ranks)
    assert Counter(map(plain, got)) == Counter(want)


def test_edits_of_few_documents(spark, empty):
    ranks = digests.entropy_ranks(empty)
    assert digests.edits(empty, ranks).collect() == []
    one = digests.edits(spark.createDataFrame([(4, prose(1, 90))], "doc_id long, text string"), ranks).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_fingerprint_columns(spark, awkward):
    ranks = digests.entropy_ranks(awkward)
    out = digests.with_fingerprints(awkward, ranks, name="fp")
    assert out.columns == [c for c in awkward.columns if c != "fp"] + ["fp"]
    rows = digests.with_likeness(out.selectExpr("fp as a", "fp as b"), "a", "b", "same").collect()
    assert len(rows) == awkward.count() and {r["same"] for r in rows} == {1.0}


# --- alignment

PATHS = [public_tokenizers.path(n) for n in (queries.BYTE_TOKENIZER, queries.PIECE_TOKENIZER)]


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.Tokenizers.from_files(*PATHS)


def aligned_plainly(texts):
    """The contract, whole texts at a time."""
    a, b = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    table = {chr(x): x for x in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    table |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if chr(x) not in table)}
    docs = []
    for text in texts:
        full = (" " + (text or "")).encode()
        left, right = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        left = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in left]
        right = [(i, b.id_to_piece(i)) for i in right]
        right = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in right]
        if not text or b"".join(x for _, x in left) != full or b"".join(x for _, x in right) != full:
            left, right = [], []
        spans = []
        for side in (left, right):
            at, mine = 0, []
            for i, x in side:
                mine.append((i, at, at + len(x)))
                at += len(x)
            spans.append(mine)
        links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e] if len(full) < 9000 else None
        if links is None:  # the same in one pass
            links, k = [], 0
            for i, s, e in spans[0]:
                while k and spans[1][k][1] > s:
                    k -= 1
                while spans[1][k][2] <= s:
                    k += 1
                m = k
                while m < len(spans[1]) and spans[1][m][1] < e:
                    links.append((i, spans[1][m][0]))
                    m += 1
        ends = [{e for _, _, e in s} for s in spans]
        groups, last = [], 0
        for cut in sorted(ends[0] & ends[1]):
            groups.append("|".join(",".join(str(i) for i, s, e in side if s >= last and e <= cut) for side in spans) if len(full) < 9000 else None)
            last = cut
        docs.append((spans, links, groups))
    counts = Counter(pair for _, links, _ in docs for pair in set(links))
    highest = defaultdict(int)
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    out = []
    for spans, links, groups in docs:
        digest = "" if not links else None if None in groups else hashlib.sha256(";".join(groups).encode()).hexdigest()
        best = sum(counts[x] == highest[x[0]] for x in links)
        out.append((len(spans[0]), len(spans[1]), len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return out


ODD = [
    "a  b", "x\n y", "x \n y ", " lead", "  two lead", "tail ", "tail  ", " ", "  ", "\n", "\t \t", "a  b", "a　 b c",
    "it's we'll <|endoftext|> </s> <s> <unk> <0x41>", "▁ already", "x▁y", "日本語 テキスト です", "naïve café — “quoted”",
    "\x00 nul", "\x1c \x1d x", "emoji 👩‍👩‍👧 ‍", "\r\n \r\n a", "﻿ bom", "é combining", "½ ﬁ ①", "a" * 300, "<" * 70,
]


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_alignment_matches_whole_texts(spark, tokenizers, monkeypatch, most):
    monkeypatch.setattr(alignment, "PORTION", 700)
    texts = ODD + [prose(i, 30) for i in range(20)] + [None, "", ODD[0], ODD[0]]
    docs = spark.createDataFrame([(i // 2, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a string")
    out = alignment.align(docs.repartition(2), tokenizers, most)
    assert out.columns == ["doc_id", "text", *queries_columns()]
    got = Counter((r["doc_id"], r["text"], *(r[c] for c in queries_columns())) for r in out.collect())
    want = Counter((i // 2, t, *w) for i, (t, w) in enumerate(zip(texts, aligned_plainly(texts))))
    assert got == want


def queries_columns():
    return ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_forgets_and_learns_again(spark, tokenizers, monkeypatch):
    texts = [prose(i % 5, 40) for i in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    counts = alignment.pair_counts(docs, tokenizers).sort("pair").toArrow()
    held = alignment.Stretches(tokenizers, tuple(counts.column(i).to_numpy() for i in range(3)))
    monkeypatch.setattr(alignment, "REMEMBERED", 10)

    def sums(text):
        numbers, _ = held.number([text])
        return held.numbers[numbers].sum(0).tolist()

    first = [sums(t) for t in texts]
    assert len(held.known) < 60
    monkeypatch.undo()
    assert first == [sums(t) for t in texts]


def test_alignment_of_an_empty_table(spark, tokenizers, empty):
    assert alignment.align(empty, tokenizers).collect() == []


def test_alignment_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: w for r, w in zip(rows, aligned_plainly([r["text"] for r in rows]))}
    got = queries.op13_alignment(spark, SF)
    assert got.columns == ["doc_id", *queries_columns()]
    for r in got.collect():
        mine, plain = tuple(r)[1:], want[r["doc_id"]]
        assert mine[:6] == plain[:6] and (plain[6] is None or mine[6] == plain[6])


def test_both_ways_of_the_first_side_agree(tokenizers):
    words = [" " + w for t in ODD[:3] + [prose(1, 200)] for w in t.split(" ") if w] + [" x\n", " ", " y"]
    plain = alignment.Tokenizers(tokenizers.a_json, tokenizers.b_model)
    plain.__dict__["a_ranks"] = None
    assert tokenizers.a_ranks is not None
    for fast, slow in zip(tokenizers.encode(words), plain.encode(words)):
        assert all(np.array_equal(x, y) for x, y in zip(fast, slow))
