"""Operators on single texts and on pairs of texts against brute force."""

import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from helpers import prose, texts_of
from tillstream.llm import decontaminate, hashed, lm, quality, simhash, suffixes, tokens

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# --- token counts


@pytest.fixture(scope="module")
def vocabulary():
    return tokens.Vocabulary.from_sentencepiece(public_tokenizers.path("piece_bpe_32k.model"))


def unigram(vocabulary):
    from tokenizers import Tokenizer, models

    names = [p for p, _ in vocabulary.pieces]
    return Tokenizer(
        models.Unigram(vocabulary.pieces, names.index(vocabulary.unknown), vocabulary.byte_fallback)
    )


def test_token_counts_match_the_public_model(spark, awkward, documents, vocabulary):
    model = unigram(vocabulary)
    for docs in (documents, awkward):
        got = tokens.token_counts(docs, vocabulary).select("text", "n_tokens").collect()
        assert len(got) == docs.count()
        for r in got:
            text = r["text"] or ""
            want = len(model.encode("▁" + text.replace(" ", "▁")).ids) if text else 0
            assert r["n_tokens"] == want, text[:80]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.text("ab▁c", min_size=1, max_size=4), st.integers(-4, 0)), min_size=1, max_size=12),
    st.text("ab cdé", max_size=30),
    st.booleans(),
)
def test_token_count_ties(pieces, text, fallback):
    """Few scores make many ties; the library's rules decide them."""
    named = {p: float(s) for p, s in pieces}
    vocab = [("<unk>", 0.0), *[(p, s) for p, s in named.items()]]
    if fallback:
        vocab += [(f"<0x{b:02X}>", 0.0) for b in range(256)]
    v = tokens.Vocabulary(vocab, "<unk>", fallback)
    want = unigram(v).encode("▁" + text.replace(" ", "▁")).ids if text else []
    assert tokens.Counter(v).count(text) == len(want)


def test_token_counts_of_nothing(empty, vocabulary):
    assert tokens.token_counts(empty, vocabulary).collect() == []


# --- quality rules


def base_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    seen, lines = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            lines += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered)


def features_of(text):
    words = [w.encode() for w in WORDS.findall(text or "")]
    if not words:
        return []
    return quality.buckets(np.array([crc32(w.lower()) for w in words], np.uint64)).tolist()


def test_quality_counts_and_scores(spark, awkward, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    for docs in (documents, awkward):
        out = quality.judge(docs, labels).collect()
        assert len(out) == docs.count()
        raw, target = Counter(), Counter()
        known = [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()]
        good = {i for i, q, t in known if q == 1 and not t}
        for i, text in texts_of(docs):
            raw.update(features_of(text))
            if i in good:
                target.update(features_of(text))
        b, n, m = quality.BUCKETS, sum(raw.values()), sum(target.values())
        p = {k: (c + 1) / (n + b) for k, c in raw.items()}
        ratio = {k: math.log((target[k] + b * p[k]) / (m + b) / p[k]) for k in raw}
        for r in out:
            got = r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]
            assert got == base_counts(r["text"])
            failed = got[0] < 50 or 100 * got[4] > 50 * got[0]
            assert r["base_failed"] == failed
            assert not (failed and r["kept"])
            features = features_of(r["text"])
            if features and m:
                assert r["score"] == pytest.approx(sum(ratio[f] for f in features) / len(features), abs=1e-9)


def test_quality_without_labels_uses_the_base_rules(spark, awkward, empty):
    none = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    out = quality.judge(awkward, none).collect()
    assert all(r["kept"] != r["base_failed"] and r["score"] is None for r in out)
    assert quality.judge(empty, none).collect() == []


def test_quality_separates_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.judge(spark.read.parquet(f"{sf}/documents.parquet"), labels, ("text",))
    rows = out.join(labels, "doc_id").where("not base_failed").select("quality", "kept").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.995 * len(good)
    assert not bad or sum(bad) < len(bad)


def test_many_distinct_words_in_one_text():
    ids = np.arange(50)
    ids[30:33] = ids[10:13]
    assert quality.repeated_words(ids) == 6
    assert quality.repeated_words(ids + (1 << 22)) == 6


# --- SimHash


def brute_fingerprint(text, k=3):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, joined):
    parent = list(range(len(nodes)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            if joined(nodes[i], nodes[j]):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(nodes))]


@pytest.mark.parametrize("which", ["documents", "awkward"])
def test_simhash_components(request, which):
    docs = request.getfixturevalue(which)
    rows = texts_of(docs)
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    least = defaultdict(list)
    for r, (i, _) in zip(roots, rows):
        if i is not None:
            least[r].append(i)
    want = Counter((i, f"{fp:016x}", min(least[r], default=None)) for r, fp, (i, _) in zip(roots, fps, rows))
    out = simhash.near_duplicates(docs).select(
        "doc_id", simhash.hex_digits(simhash.F.col("fp")).alias("fp"), "component_id"
    )
    assert Counter(tuple(r) for r in out.collect()) == want
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(roots))


def test_simhash_of_nothing(empty):
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.deduplicate(empty).collect() == []


@pytest.mark.parametrize("tree", [3, 2048])
def test_simhash_links_connect_every_near_pair(spark, tree):
    """A dense ball of fingerprints, in one tree and split over many."""
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 62))
    fps = {centre}
    for _ in range(150):
        f = centre
        for b in rng.integers(0, 64, int(rng.integers(1, 7))):
            f ^= 1 << int(b)
        fps.add(f)
    fps |= {int(x) for x in rng.integers(0, 1 << 62, 100)}
    words = sorted(fps)
    signed = [w - (1 << 64) if w >> 63 else w for w in words]
    roots = brute_components(words, lambda a, b: (a ^ b).bit_count() <= 3)
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), tree=tree)
    labels = {r["node"]: r["label"] for r in simhash.components(edges).collect()}
    groups = defaultdict(set)
    for s, r in zip(signed, roots):
        groups[r].add(s)
    for group in groups.values():
        assert {labels.get(s, s) for s in group} == {min(group)}


def test_tree_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    words = [int(w) for w in rng.integers(0, 1 << 16, 300)]
    tree = simhash.Tree()
    for w in words:
        tree.add(w)
    for q in words[:40]:
        near = {i for i, w in enumerate(words) if (w ^ q).bit_count() <= 3}
        assert set(tree.near(q, 3)) == near


# --- decontamination


def brute_leaks(docs, items):
    found = set()
    for item_id, text in items:
        words = decontaminate.tokens(text or "")
        if not words:
            continue
        need = decontaminate.shingles(words)
        for doc_id, body in docs:
            have = decontaminate.shingles(decontaminate.tokens(body or ""))
            if len(need & have) >= 0.8 * len(need):
                found.add((doc_id, item_id))
    return found


def test_leaks_match_brute_force(spark, documents, awkward):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    pairs = texts_of(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    want = brute_leaks(pairs, [tuple(r) for r in items.select("item_id", "text").collect()])
    got = decontaminate.leaks(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), items)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    assert decontaminate.leaks(awkward, items).collect() == []


def test_leaks_with_changes_parts_and_cuts(spark):
    item = "What is the tall grey tower in the old harbour town called by sailors? It is called the watchman of the bay."
    words = item.split()
    docs = {
        1: f"{prose(8, 400)} {item} {prose(9, 400)}",
        2: f"{prose(8, 100)} {' '.join(words[:15])} {prose(9, 100)}",  # no answer
        3: f"{prose(8, 100)} {item.upper().replace(' ', '  ')}",
        4: prose(10, 40_000) + " " + item + " " + prose(11, 30),
        5: None,
    }
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, prose(12, 40))], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(table, items).collect())
    assert got == [(1, 7), (3, 7), (4, 7)]
    assert sorted(r["doc_id"] for r in decontaminate.decontaminate(table, items).collect()) == [2, 5]
    none = items.where("item_id = 8")
    assert decontaminate.leaks(table, none).collect() == []
    assert decontaminate.decontaminate(table, none).count() == 5


def test_index_parts_give_the_same_leaks(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert len(list(decontaminate.item_parts(items, 3000))) > 2
    whole = decontaminate.leaks(documents, items).select("doc_id", "item_id").collect()
    size, decontaminate.item_parts.__defaults__ = decontaminate.item_parts.__defaults__, (3000,)
    try:
        parts = decontaminate.leaks(documents, items).select("doc_id", "item_id").collect()
    finally:
        decontaminate.item_parts.__defaults__ = size
    assert sorted(map(tuple, whole)) == sorted(map(tuple, parts))


def test_retrieval_gives_exactly_the_items_above_the_threshold():
    items = [(i, prose(i, 25)) for i in range(40)]
    index = decontaminate.Index.of(items)
    for seed in range(60):
        text = prose(seed, 20) + " " + prose(seed % 40, 25)
        found = {index.terms[w] for w in decontaminate.tokens(text) if w in index.terms}
        want = {}
        for n, item in enumerate(index.items):
            score = sum(
                index.postings[t][1][index.postings[t][0].index(n)] for t in found if n in index.postings[t][0]
            )
            if score >= item.threshold:
                want[n] = score
        got = {n: s for b in range(index.maxima.shape[1]) for n, s in index.retrieve(found, b)}
        assert got == pytest.approx(want)
        assert want


def test_maxima_grow_with_the_words_of_the_items():
    items = [(i, prose(i, 12)) for i in range(6000)]
    index = decontaminate.Index.of(items)
    words = sum(len(set(i.words)) for i in index.items)
    held = sum(a.nbytes for a in vars(index.maxima).values() if isinstance(a, np.ndarray))
    assert held <= 24 * words  # a dense matrix would hold 4 bytes for each term and block
    text = " ".join(f"{prose(9000 + n, 40)} {prose(n, 12)}" for n in (0, 17, 5999))
    got = index.leaks(decontaminate.tokens(text))
    assert {index.items[n].item_id for n in got} == {0, 17, 5999}


def test_a_very_long_item_leaves_the_others_as_they_are(spark):
    long, short = prose(30, 70_000), prose(31, 40)
    words = short.split()
    scattered = " ".join(f"{' '.join(words[i : i + 9])} {prose(40 + i, 150)}" for i in range(0, 32))
    docs = [(1, f"{prose(32, 90)} {short} {prose(33, 90)}"), (2, scattered), (3, f"a {long} b")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, short), (2, long)], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(table, items).collect())
    alone = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(table, items.where("item_id = 1")).collect())
    assert alone == [(1, 1)]
    assert got == [(1, 1), (3, 2)]


# --- suffixes


def brute_cut(rows):
    """Removed bytes by looking at every string."""
    places = defaultdict(list)
    texts = [(t or "").encode() for _, t in rows]
    for i, t in enumerate(texts):
        for s in range(len(t) - suffixes.LENGTH + 1):
            places[t[s : s + suffixes.LENGTH]].append((i, s))
    gone = [bytearray(len(t)) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for i, s in found:
                gone[i][s : s + suffixes.LENGTH] = b"\1" * suffixes.LENGTH
    return [
        (i, sum(g), len(re.findall(b"\1+", bytes(g))), bytes(c for c, x in zip(t, g) if not x))
        for (i, _), t, g in zip(rows, texts, gone)
    ]


def cut_rows(docs, group=suffixes.GROUP, hot=suffixes.HOT):
    rows = suffixes.cut(docs, group, hot).collect()
    return Counter(
        (r["doc_id"], sum(s["stop"] - s["start"] for s in r["removed"]), len(r["removed"]), bytes(r["kept"]))
        for r in rows
    )


@pytest.mark.parametrize("which", ["documents", "awkward", "passages"])
def test_cut_matches_brute_force(request, which):
    docs = request.getfixturevalue(which)
    assert cut_rows(docs) == Counter(brute_cut(texts_of(docs)))


@pytest.fixture(scope="module")
def passages(spark):
    """Passages around the length shared by many documents with other text around them."""
    shared = [prose(100 + k, 60)[: 395 + 6 * k] for k in range(12)] + [prose(200, 900)]
    rows = []
    for i in range(60):
        parts = [prose(1000 + i, 30), shared[i % 13], prose(2000 + i, 40), shared[(i * 5) % 13][: 380 + i]]
        rows.append((i, "".join(parts)))
    rows.append((98, "ab" * 900))
    rows.append((99, "\0" * 700))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_frequent_strings_are_compared_exactly(passages):
    """With small groups the strings are counted across partitions instead."""
    assert cut_rows(passages, group=3) == Counter(brute_cut(texts_of(passages)))


@pytest.mark.parametrize("which", ["awkward", "passages"])
@pytest.mark.parametrize("group, hot", [(suffixes.GROUP, 0), (3, 0), (suffixes.GROUP, 4), (3, 4)])
def test_frequent_strings_are_dealt_by_context(request, which, group, hot):
    """Rows of frequent strings are spread; all, some or none of the strings are frequent."""
    docs = request.getfixturevalue(which).repartition(7)
    assert cut_rows(docs, group, hot) == Counter(brute_cut(texts_of(docs)))


def test_frequent_strings_are_few(spark):
    keys = spark.range(40_000).selectExpr("case when id % 3 = 0 then 7 else id end as key")
    assert [r["key"] for r in suffixes.frequent_strings(keys, 1000).collect()] == [7]
    assert suffixes.frequent_strings(keys, 20_000).isEmpty()
    assert suffixes.frequent_strings(keys.limit(0), 0).isEmpty()


def test_cut_keeps_other_columns(awkward):
    out = suffixes.cut(awkward)
    assert out.columns == [*awkward.columns, "removed", "kept"]
    assert {r["hash"] for r in out.collect()} == {"h", None}


def test_cut_of_nothing(empty):
    assert suffixes.cut(empty).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=60))
def test_multikey_quicksort(strings):
    order, shared = suffixes.multikey_quicksort(strings)
    ranked = [strings[i] for i in order]
    assert ranked == sorted(strings)
    for a, b, n in zip(ranked, ranked[1:], shared[1:]):
        same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert n == same


@settings(max_examples=40, deadline=None)
@given(st.data())
def test_extents_pairwise_and_by_classes_agree(data):
    rng = np.random.default_rng(data.draw(st.integers(0, 1 << 30)))
    core = rng.bytes(suffixes.GRAM)
    group = set()
    for _ in range(14):
        before = bytearray(b"x" * suffixes.REACH)
        after = bytearray(core + b"y" * (suffixes.LENGTH - suffixes.GRAM))
        before[int(rng.integers(0, suffixes.REACH))] = int(rng.integers(65, 68))
        after[int(rng.integers(suffixes.GRAM, suffixes.LENGTH))] = int(rng.integers(65, 68))
        group.add((bytes(before[int(rng.integers(0, 3)) :]), bytes(after)))
    group = sorted(group)
    was = suffixes.PAIRWISE
    try:
        suffixes.PAIRWISE = 1 << 30
        pairs = suffixes.extents(group)
        suffixes.PAIRWISE = 1
        classes = suffixes.extents(group)
    finally:
        suffixes.PAIRWISE = was
    assert pairs == classes


# --- language model


def brute_scores(rows, order):
    """Modified Kneser-Ney with dictionaries."""
    def words(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return [*WORDS.findall(low), None]

    def grams(ws, k):
        padded = ["<s>"] * (order - 1) + ws
        return [tuple(padded[i - k + 1 : i + 1]) for i in range(order - 1, len(padded))]

    train = [words(t) for i, t in rows if crc32(("" if i is None else str(i)).encode()) % 10]
    uni = Counter(w for ws in train for w in ws)
    n, v = sum(uni.values()), len(uni)
    counts = {order: Counter(g for ws in train for g in grams(ws, order))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])

    def ds(counts):
        k = Counter(counts)
        n1, n2, n3, n4 = (k[c] for c in (1, 2, 3, 4))
        if not n1:
            return [0, 0, 0, 0]
        y = n1 / (n1 + 2 * n2)
        d1 = 1 - 2 * y * n2 / n1
        d2 = 2 - 3 * y * n3 / n2 if n2 else d1
        d3 = 3 - 4 * y * n4 / n3 if n3 else d2
        return [0, *[min(max(d, 0), k) for k, d in ((1, d1), (2, d2), (3, d3))]]

    d = {k: ds(c.values()) for k, c in counts.items()}
    total, kinds = defaultdict(Counter), defaultdict(lambda: defaultdict(Counter))
    for k, grams_of_k in counts.items():
        for g, c in grams_of_k.items():
            total[k][g[:-1]] += c
            kinds[k][g[:-1]][min(c, 3)] += 1

    def p(gram):
        if not gram:
            return 1 / (v + 1)
        k, context = len(gram), gram[:-1]
        low = p(gram[1:])
        if not total[k][context]:
            return low
        c = counts[k][gram]
        spare = sum(d[k][j] * x for j, x in kinds[k][context].items())
        return (max(c - d[k][min(c, 3)], 0) + spare * low) / total[k][context]

    for context in list(total[order])[:20]:
        assert sum(p((*context, b)) for b in [*uni, "\n"]) == pytest.approx(1)
    out = []
    for i, text in rows:
        ws = words(text)
        base = sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        score = sum(math.log10(p(g)) for g in grams(ws, order))
        held = crc32(("" if i is None else str(i)).encode()) % 10 == 0
        out.append((i, held, len(ws), sum(uni[w] > 0 for w in ws), n, base, score))
    return out


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("which", ["documents", "awkward"])
def test_scores_match_brute_force(request, which, order):
    docs = request.getfixturevalue(which)
    key = lambda r: (str(r[0]), r[2], r[5])
    got = sorted((tuple(r) for r in lm.held_out_scores(docs, order).collect()), key=key)
    want = sorted(brute_scores(texts_of(docs), order), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-6)


def test_scores_without_training_or_documents(spark, empty):
    assert lm.held_out_scores(empty).collect() == []
    held = next(i for i in range(100) if crc32(str(i).encode()) % 10 == 0)
    only = spark.createDataFrame([(held, "some words")], "doc_id long, text string")
    row = lm.held_out_scores(only).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["score"]) == (3, 0, 0, 0.0)


@pytest.mark.parametrize("order", [2, 3])
def test_held_out_text_is_better_predicted_than_by_word_counts(spark, order):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    t = lm.held_out_scores(docs, order).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert t["sum(score)"] > t["sum(base_score)"]


def test_mix_is_undone():
    keys = np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64)
    assert (hashed.unmix(hashed.mix(keys)) == keys).all()


def test_arrays_need_a_mounted_folder():
    with pytest.raises(ValueError):
        hashed.local_path("hdfs://somewhere/model")
    assert hashed.local_path("file:///a%20b/c") == "/a b/c"
