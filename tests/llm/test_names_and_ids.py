"""Columns of inner names, ids of other types, repeated labels and very long messages."""

import re
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from helpers import prose
from tillstream.llm import chat, mixing, quality, simhash, suffixes

LLM = Path(mixing.__file__).parent


def inner_names(module):
    """Every quoted word of an operator's source: among them all names it gives to columns."""
    found = re.findall(r'"([A-Za-z_][A-Za-z_0-9]*)"', (LLM / f"{module}.py").read_text())
    names = {n.lower(): n for n in found}
    return sorted(n for k, n in names.items() if k not in ("doc_id", "text", "source"))


def crowded(spark, module, added):
    """Documents with a column of each such name, all holding 'mine'."""
    names = [n for n in inner_names(module) if n.lower() not in added]
    texts = [prose(i % 9, 120) for i in range(24)] + [None, "", prose(3, 120), prose(3, 120)]
    rows = [(i // 2, t, f"s{i % 3}", *["mine"] * len(names)) for i, t in enumerate(texts)]
    schema = ", ".join(["doc_id long", "text string", "source string", *[f"`{n}` string" for n in names]])
    return spark.createDataFrame(rows, schema), names


@pytest.mark.parametrize(
    "module, operator, added",
    [
        ("mixing", mixing.mix, mixing.ADDED),
        ("simhash", simhash.deduplicate, ()),
        ("suffixes", suffixes.cut, ("removed", "kept")),
    ],
)
def test_columns_of_inner_names_come_back(spark, module, operator, added):
    docs, names = crowded(spark, module, added)
    out = operator(docs)
    assert out.columns == [*docs.columns, *added]
    rows = out.collect()
    assert rows and {r[n] for r in rows for n in names} == {"mine"}
    if module == "mixing":
        again = mixing.repeated(out)
        assert again.columns == docs.columns and {r[n] for r in again.collect() for n in names} == {"mine"}


def test_mix_takes_ids_of_other_types(spark):
    texts = [prose(i, 40) for i in range(60)]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(texts)] + [(None, texts[0], "s0"), (7, texts[7], "s1"), (7, texts[7], "s1")]
    numbers = spark.createDataFrame(rows, "doc_id long, text string, source string")
    named = numbers.withColumn("doc_id", numbers["doc_id"].cast("string"))
    columns = ["doc_id", "size", "source_size", "target", "copies", "taken"]
    plain = lambda df: Counter((str(r[0]), *r[1:]) for r in df.select(*columns).collect())
    # Ids are drawn by their decimal text, so the same documents are taken.
    assert plain(mixing.mix(named)) == plain(mixing.mix(numbers))
    dated = numbers.withColumn("doc_id", numbers["doc_id"].cast("decimal(20,0)"))
    assert plain(mixing.mix(dated)) == plain(mixing.mix(numbers))


def test_one_labelled_id_on_many_documents_gives_one_row(spark, monkeypatch):
    seen = []
    real = quality.threshold
    monkeypatch.setattr(quality, "threshold", lambda scores: seen.append(len(scores)) or real(scores))
    rows = [(1, prose(i, 70)) for i in range(400)] + [(2, prose(900, 70)), (3, prose(901, 70)), (None, prose(902, 70))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    out = quality.judge(docs, labels).collect()
    assert len(out) == len(rows) and seen == [2]


def formatted_and_read(spark, n, roles):
    turns = spark.range(n).selectExpr(
        "1 as conv_id", "id as turn", f"element_at(array({roles}), cast(id % size(array({roles})) + 1 as int)) as role",
        "concat('turn <|im_end|> number ', id) as text",
    )
    start = time.perf_counter()
    out = chat.format_conversations(turns)
    both = out.withColumn("m", chat.messages_of())
    row = both.select(chat.turns_of(both["m"]).alias("t"), chat.loss_of(both["m"]).alias("l")).collect()[0]
    return row, time.perf_counter() - start


@pytest.mark.parametrize("roles", ["'assistant'", "'user', 'assistant'", "'assistant', 'assistant', 'user'"])
def test_chat_of_many_turns_is_read_back(spark, roles):
    row, _ = formatted_and_read(spark, 700, roles)
    kinds = re.findall(r"'(\w+)'", roles)
    want = [(kinds[i % len(kinds)], f"turn <|im_end|> number {i}") for i in range(700)]
    assert [tuple(t) for t in row["t"]] == want
    assert row["l"] == [text for role, text in want if role == "assistant"]


def test_chat_time_is_in_proportion_to_turns(spark):
    formatted_and_read(spark, 500, "'assistant'")
    _, few = formatted_and_read(spark, 8_000, "'assistant'")
    row, many = formatted_and_read(spark, 32_000, "'assistant'")
    assert len(row["t"]) == len(row["l"]) == 32_000
    assert many < 8 * few + 2 and many < 16


def test_running_sums(spark):
    for n in (0, 1, chat.BLOCK, chat.BLOCK + 1, 1000):
        sizes = list(range(n))
        row = spark.createDataFrame([(sizes,)], "sizes array<int>")
        from pyspark.sql import functions as F

        got = row.select(chat.running(F.col("sizes"), F.lit(5))).collect()[0][0]
        assert got == [5 + sum(sizes[:i]) for i in range(n)]


def test_all_labelled_documents_fit_the_threshold(spark, monkeypatch):
    n, seen = 12_000, []
    real = quality.threshold
    monkeypatch.setattr(quality, "threshold", lambda scores: seen.append(len(scores)) or real(scores))
    ids = spark.range(2 * n)
    text = "array_join(transform(sequence(1, 60), i -> concat('w', (id * 7 + i * i) % 1000)), ' ') as text"
    docs = ids.selectExpr("id as doc_id", text)
    labels = ids.selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "0 as toxic")
    out = quality.judge(docs, labels).select("doc_id", "score", "kept", "base_failed").collect()
    assert seen == [2 * n]
    good = [r["score"] for r in out if r["doc_id"] % 2]
    low, typical = np.quantile(good, 0.001), np.median([r["score"] for r in out if r["doc_id"] % 2 == 0])
    cut = low - max(0.0, low - typical) / 2
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= cut) for r in out if abs(r["score"] - cut) > 1e-12)


def test_quantiles_by_rank_equal_numpys(spark):
    values = [(True, float(x * x % 101)) for x in range(57)] + [(False, 3.5)]
    scores = quality.Scores(spark.createDataFrame(values, "_good boolean, score double"))
    for q in (0.0, 0.001, 0.3, 0.5, 1.0):
        assert scores.quantile(True, q) == pytest.approx(np.quantile([v for g, v in values if g], q), abs=1e-12)
    assert scores.quantile(False, 0.5) == 3.5
    assert quality.Scores(scores.rows.where("false")).quantile(True, 0.5) is None


def test_texts_are_shuffled_once_and_scored_once(spark, monkeypatch):
    plans, calls = [], []
    counts, score = quality.ngram_counts, quality.scored

    def counted(docs):
        plans.append(docs._jdf.queryExecution().executedPlan().toString())
        return counts(docs)

    monkeypatch.setattr(quality, "ngram_counts", counted)
    monkeypatch.setattr(quality, "scored", lambda *args: calls.append(1) or score(*args))
    rows = [(i, prose(i, 70)) for i in range(40)] + [(None, prose(90, 70))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    out = quality.judge(docs, labels).collect()
    assert len(out) == len(rows) and len(calls) == 1
    # The same join whether labels are few or many, so disk grows with the texts.
    assert "ShuffledHashJoin" in plans[0]
