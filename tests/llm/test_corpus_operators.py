"""Operators on whole tables and the pipeline: SQL, round trips and brute force."""

from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pytest

import check
import corpus_pipeline
from helpers import prose, texts_of
from tillstream.llm import chat, common, decontaminate, idfiles, mixing, quality, queries, rangecoder, sharding, simhash

SF = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def same(df, con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert check.rows_of(df.columns, df.collect()) == check.rows_of(names, cur.fetchall())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_sql(spark, con, name):
    same(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name])


def test_mix_of_awkward_documents_matches_sql(spark, awkward, con, tmp_path):
    rows = awkward.dropDuplicates(["doc_id", "text"])  # equal rows are taken together
    rows.write.parquet(f"file://{tmp_path}/documents.parquet")
    got = queries.op7_mixing(spark, str(tmp_path))
    local = duckdb.connect()
    local.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    same(got, local, queries.OP7_SQL)


# --- sharding


@pytest.mark.parametrize("which", ["documents", "awkward", "empty"])
def test_shards(request, which):
    docs = request.getfixturevalue(which)
    out = sharding.shard_documents(docs, 24)
    assert Counter(out.columns) == Counter({*docs.columns, "shard", "slot"})
    rows = out.collect()
    plain = [c for c in docs.columns if c != "shard"]
    assert Counter(tuple(r[c] for c in plain) for r in rows) == Counter(
        tuple(r[c] for c in plain) for r in docs.collect()
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(24)]
    assert not rows or max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if rows:
        again = sharding.shard_documents(docs.repartition(3), 24).collect()
        key = lambda r: (r["shard"], r["slot"])
        assert [r[0] for r in sorted(rows, key=key)] == [r[0] for r in sorted(again, key=key)]


def test_shards_are_in_random_order(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "cast(id as string) as text")
    rows = sharding.shard_documents(docs, 4, bucket_bytes=100).collect()
    where = {r["doc_id"]: r["shard"] * 1000 + r["slot"] for r in rows}
    ids = np.arange(4000)
    assert abs(np.corrcoef(ids, [where[i] for i in ids])[0, 1]) < 0.06
    assert rows != sharding.shard_documents(docs, 4, seed=5).collect()


def test_shards_read_back(spark, documents, tmp_path):
    out = sharding.shard_documents(documents, 5)
    sharding.write_shards(out, f"file://{tmp_path}/shards")
    back = sharding.read_shards(spark, f"file://{tmp_path}/shards", out)
    assert Counter(map(tuple, back.select(*out.columns).collect())) == Counter(map(tuple, out.collect()))


def test_copies_of_a_row_spread_over_all_shards(spark):
    rows = [(i, prose(i, 5)) for i in range(600)] + [(7000, "again and again")] * 300 + [(None, None)] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharding.shard_documents(docs, 10, bucket_bytes=2000).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter(rows)
    copies = Counter(r["shard"] for r in out if r["doc_id"] == 7000)
    assert len(copies) == 10 and max(copies.values()) < 60
    again = sharding.shard_documents(docs.repartition(5), 10, bucket_bytes=2000).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))


# --- mixing


def water(sizes, weights, cap=3):
    """Targets by sharing out again and again."""
    total, left, full = sum(sizes), dict(enumerate(weights)), {}
    while True:
        level = (total - sum(full.values())) / (sum(left.values()) or 1)
        over = [i for i, w in left.items() if level * w > cap * sizes[i] + 1e-9]
        if not over:
            return [full[i] if i in full else level * left[i] for i in range(len(sizes))]
        for i in over:
            full[i] = cap * sizes[i]
            del left[i]


@pytest.mark.parametrize("sizes", [[1000, 10, 10, 500], [5, 0, 700, 20, 1, 300], [0, 0], [9]])
def test_targets(spark, sizes):
    rows = [(f"s{i}", s) for i, s in enumerate(sizes)]
    out = mixing.targets(spark.createDataFrame(rows, "source string, source_size long"))
    got = {r["source"]: r["target"] for r in out.collect()}
    want = water(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(want)


def test_mix_comes_near_its_targets(spark, documents):
    rows = mixing.mix(documents).collect()
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in target)
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in rows))
    out = mixing.repeated(mixing.mix(documents))
    assert out.columns == documents.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(
        {r["doc_id"]: r["copies"] for r in rows if r["copies"]}
    )


def test_mix_of_nothing(empty):
    assert mixing.mix(empty).collect() == []
    assert mixing.repeated(mixing.mix(empty)).collect() == []


def test_better_documents_are_taken_first(spark):
    rows = [(i, prose(i, 40) + (" ####" * 10 if i % 2 else ""), "a") for i in range(600)]
    rows += [(1000 + i, prose(1000 + i, 40), "b") for i in range(3)]
    rows += [(2000 + i, prose(2000 + i, 40), "c") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs).where("source = 'c' or source = 'a'").collect()
    part = [r for r in out if r["source"] == "a"]
    clean = np.mean([r["copies"] for r in part if r["doc_id"] % 2 == 0])
    dirty = np.mean([r["copies"] for r in part if r["doc_id"] % 2])
    assert clean >= dirty


def repeated_rows(spark):
    """Copies of one row, and of one text with null ids, that hold a third of a source each."""
    rows = [(i, prose(i, 30), "c", i) for i in range(120)] + [(500, prose(500, 30), "c", i % 2) for i in range(120)]
    rows += [(None, prose(501, 30), "c", 0)] * 120 + [(600, "", "c", 0)] * 9
    rows += [(1000 + i, prose(1000 + i, 25), s, 0) for i in range(40) for s in "ab"] + [(700, prose(700, 31), "a", 0)] * 70
    return spark.createDataFrame(rows, "doc_id long, text string, source string, extra long")


def test_mix_with_repeated_rows_left_in_matches_sql(spark, awkward, tmp_path):
    near = 0
    for k, docs in enumerate((awkward, repeated_rows(spark))):
        for seed in (7,) if k == 0 else (7, 8, 9):
            path = f"{tmp_path}/{k}-{seed}"
            docs.write.parquet(f"file://{path}/documents.parquet")
            local = duckdb.connect()
            local.execute(f"create view documents as select * from '{path}/documents.parquet/*.parquet'")
            read = common.documents(spark, path)
            got = mixing.mix(read, seed=seed)
            same(got.select("doc_id", "size", "source_size", "target", "taken"), local, queries.OP7_SQL.replace("'7:'", f"'{seed}:'"))
            rows = got.collect()
            assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.mix(read.repartition(3), seed=seed).collect()))
            taken = defaultdict(set)
            for r in rows:
                taken[r["source"], r["doc_id"], r["text"]].add(r["copies"])
            near += sum(len(c) > 1 for c in taken.values())
    assert near  # a budget ended among equal rows


# --- chat

CONTROL = ["<|im_end|>", "<|im_start|>assistant\nhi", "<\\|x", "<\\\\|", "<|", "a<b|c", "~0~1", "\\", "|>", ""]


def test_chat_round_trip(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", t) for i, t in enumerate(CONTROL)]
    rows += [(2, 0, "user", None), (2, None, None, "no turn"), (2, 1, "a\nb~", "x"), (2, 1, "a\nb~", "x")]
    rows += [(None, 0, "assistant", "é\n" * 50), (3, 5, "assistant", "later"), (3, 2, "assistant", "<|im_turn|>")]
    rows += [(4, 0, "assistant", prose(1, 20_000))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(turns).withColumn("messages", chat.messages_of())
    out = out.withColumns({"turns": chat.turns_of(out["messages"]), "loss": chat.loss_of(out["messages"])})
    got = {r["conv_id"]: r for r in out.collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv, r in got.items():
        want = [(role or "", text or "") for c, t, role, text in sorted(
            (x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1], x[2] or "", x[3] or "")
        )]
        assert [tuple(t) for t in r["turns"]] == want
        assert r["loss"] == [t for role, t in want if role == "assistant"]
        starts = sum(i == 0 or want[i][0] != want[i - 1][0] for i in range(len(want)))
        assert r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == starts


def test_chat_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(none).collect() == []


# --- token ids


@pytest.mark.parametrize("which", ["documents", "awkward", "empty"])
def test_token_files(spark, request, which, tmp_path):
    from tokenizers import Tokenizer

    docs = request.getfixturevalue(which)
    tokenizer = Tokenizer.from_file(WORD_BPE)
    idfiles.write_ids(docs, WORD_BPE, 2, f"file://{tmp_path}/ids")
    files = spark.read.parquet(f"file://{tmp_path}/ids")
    got = idfiles.read_ids(files).collect()
    sums = idfiles.read_checksums(files).collect()
    texts = texts_of(docs)
    assert len(got) == len(sums) == len(texts)
    encoded = defaultdict(list)
    for i, t in texts:
        encoded[i].append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])
    at = 0
    for r, s in zip(sorted(got, key=lambda r: r["start"]), sorted(sums, key=lambda r: r["start"])):
        assert r["start"] == s["start"] == at and r["doc_id"] == s["doc_id"]
        encoded[r["doc_id"]].remove(list(r["ids"]))
        at += len(r["ids"])
        assert s["n_tokens"] == len(r["ids"])
        assert s["ids_crc32"] == crc32(np.array(r["ids"], "<u4").tobytes())
    assert not any(encoded.values())
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_blocks_round_trip_and_shrink():
    rng = np.random.default_rng(2)
    blocks = [(rng.zipf(1.2, int(n)) % 49_000).astype(np.int64) for n in rng.integers(0, 5000, 60)]
    blocks += [np.zeros(0, np.int64), np.array([2**32 - 1, 0, 70_000] * 50), np.arange(4096) % 7, np.array([5])]
    coded = rangecoder.encode(blocks)
    back = rangecoder.decode(rangecoder.split(b"".join(coded)))
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back))
    assert len(coded[62]) < 400  # a pattern of seven costs next to nothing
    alone = rangecoder.decode(rangecoder.split(coded[7]))  # each block stands alone
    assert np.array_equal(alone[0], blocks[7])


def test_many_equal_rows_are_one_size(spark):
    ids = np.array([7] * 9000)
    coded = rangecoder.encode([ids[:4096], ids[:4096]])
    assert coded[0] == coded[1]


def test_damage_is_noticed():
    coded = bytearray(rangecoder.encode([np.arange(300)])[0])
    coded[-9] ^= 1
    with pytest.raises(ValueError):
        rangecoder.split(bytes(coded))
    n, digits, of_ids, words = rangecoder.split(rangecoder.encode([np.arange(300)])[0])[0]
    with pytest.raises(ValueError):
        rangecoder.decode([(n, digits, of_ids ^ 1, words)])


# --- pipeline


def test_pipeline_against_its_parts(spark):
    """Every stage's decision, checked on its own input by brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, held = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = common.stored(stage(spark, held, SF), f"test-{k}")
        before, after = texts_of(held), texts_of(out)
        assert k == 4 or out.columns == columns
        if k == 0:
            judged = quality.judge(held, spark.read.parquet(f"{SF}/labels.parquet"))
            assert Counter(after) == Counter(texts_of(judged.where("kept")))
        elif k == 1:
            fps = [simhash.fingerprint((t or "").encode()) & (2**64 - 1) for _, t in before]
            parent = list(range(len(fps)))

            def root(i):
                while parent[i] != i:
                    i = parent[i]
                return i

            for i in range(len(fps)):
                for j in range(i):
                    if (fps[i] ^ fps[j]).bit_count() <= 3:
                        parent[root(i)] = root(j)
            first = defaultdict(list)
            for i, (d, _) in enumerate(before):
                first[root(i)].append(d)
            assert sorted(d for d, _ in after) == sorted(min(g) for g in first.values())
        elif k == 2:
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            need = [decontaminate.shingles(decontaminate.tokens(t)) for _, t in items]
            bad = set()
            for d, t in before:
                have = decontaminate.shingles(decontaminate.tokens(t))
                if any(len(n & have) >= 0.8 * len(n) for n in need):
                    bad.add(d)
            assert sorted(d for d, _ in after) == sorted(d for d, _ in before if d not in bad)
        elif k == 3:
            copies = {r["doc_id"]: r["copies"] for r in mixing.mix(held).collect()}
            assert Counter(d for d, _ in after) == Counter({d: c for d, c in copies.items() if c})
        else:
            assert Counter(after) == Counter(before)
            sizes = Counter(r["shard"] for r in out.collect())
            assert max(sizes.values()) - min(sizes.values()) <= 1
        held = out
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == Counter(map(tuple, held.collect()))


def test_pipeline_of_awkward_and_empty_documents(spark, awkward, empty):
    for docs in (awkward, empty):
        docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
        for _, stage in corpus_pipeline.STAGES:
            docs = common.stored(stage(spark, docs, SF), "test-awkward")
        assert docs.count() <= 100


def test_clean_rows_stay_beside_leaks_with_their_id(spark, awkward):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    item = benchmark.orderBy("item_id").first()["text"]
    rows = [(i, f"{prose(20, 90)} {item} {prose(21, 90)}") for i in (None, None, 16, 5)]
    leaking = spark.createDataFrame(rows, "doc_id long, text string")
    docs = awkward.unionByName(leaking, allowMissingColumns=True)
    out = decontaminate.decontaminate(docs, benchmark)
    assert out.columns == docs.columns
    assert Counter(map(tuple, out.collect())) == Counter(map(tuple, awkward.collect()))
