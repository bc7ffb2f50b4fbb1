"""The registered queries over their whole tables against brute force."""

import hashlib
from collections import Counter, defaultdict
from zlib import crc32

import public_tokenizers
import pytest

from conftest import SF
from helpers import texts_of
from test_text_operators import (
    base_counts,
    brute_components,
    brute_cut,
    brute_fingerprint,
    brute_leaks,
    brute_scores,
    unigram,
)
from tillstream.llm import lm, queries, tokens


@pytest.fixture(scope="module")
def rows(spark):
    return texts_of(spark.read.parquet(f"{SF}/documents.parquet"))


def result(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def test_token_counts(spark, rows):
    vocabulary = tokens.Vocabulary.from_sentencepiece(public_tokenizers.path("piece_bpe_32k.model"))
    model = unigram(vocabulary)
    want = {i: len(model.encode("▁" + t.replace(" ", "▁")).ids) if t else 0 for i, t in rows}
    assert {r["doc_id"]: r["n_tokens"] for r in result(spark, "op1_token_counts")} == want


def test_sharding(spark, rows):
    got = result(spark, "op2_sharding")
    want = Counter((i, len((t or "").encode()) + 8, crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(s) for s in slots.values()]
    assert max(counts) - min(counts) <= 1
    key = lambda r: (r["shard"], r["slot"])
    again = sorted(result(spark, "op2_sharding"), key=key)
    assert [r["doc_id"] for r in again] == [r["doc_id"] for r in sorted(got, key=key)]
    assert [r["doc_id"] for r in again] != sorted(r["doc_id"] for r in again)


def test_leaks(spark, rows):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    want = brute_leaks(rows, [tuple(r) for r in items])
    assert {(r["doc_id"], r["item_id"]) for r in result(spark, "op3_decontamination")} == want


def test_quality(spark, rows):
    texts = dict(rows)
    got = result(spark, "op4_quality")
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        base = r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]
        assert base == base_counts(texts[r["doc_id"]])
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert any(r["kept"] for r in got)


def test_near_duplicates(spark, rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for root, (i, _) in zip(roots, rows):
        least[root] = min(i, least.get(root, i))
    want = Counter((i, f"{p:016x}", least[root]) for root, p, (i, _) in zip(roots, prints, rows))
    got = result(spark, "op5_simhash")
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


def test_repeated_strings(spark, rows):
    sizes = {i: len((t or "").encode()) for i, t in rows}
    want = Counter(
        (i, sizes[i], removed, spans, hashlib.sha256(kept).hexdigest()) for i, removed, spans, kept in brute_cut(rows)
    )
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(r[c] for c in columns) for r in result(spark, "op6_suffixes")) == want


def test_token_ids(spark, rows):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for i, t in sorted(rows):
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        start += len(ids)
    got = result(spark, "op9_token_ids")
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want


def test_language_model(spark, rows):
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    got = sorted(tuple(r[c] for c in columns) for r in result(spark, "op10_lm"))
    want = sorted(brute_scores(rows, lm.ORDER))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-6)
