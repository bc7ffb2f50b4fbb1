"""Mixing sources to target weights.

Each source has a target in words.  Complete epochs come first: a source whose target is
at least its size is taken whole as often as it fits.  What is left is a weighted sample
without replacement after Efraimidis and Spirakis: each document draws an exponential
key divided by its quality weight, documents are taken in key order, and a prefix sum of
sizes says where the budget ends.  The last document is the one whose middle the budget
reaches.

Nothing sorts a source as a whole.  Keys fall into ``KEY_BUCKETS`` ranges; sums per
source and range say in which range the budget ends, only that range is put in order, and
the result is one cut per source that every document is compared with.

A null text has no words and is never counted; null sources form one source, last in
order.  Null and repeated ids are fine.  Ties in the key fall to doc_id and then to the
text's hash.  Rows equal in all three are one row with a count until the cut is known;
where the budget ends among them, as many as fit are taken, in the order of a hash of all
columns.  Empty tables give empty results.  Columns named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillstream.llm.common import numbered, packed, quoted, small, unpacked, without, words

# Weights by source order, repeating, and the most epochs of a source.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# Fixed value: symbols that lower a document's quality weight.
SYMBOLS = "#*$%&|<>"

SEED = 7
KEY_BUCKETS = 4096
ADDED = ("size", "source_size", "target", "copies", "taken")


def quality(text: Column) -> Column:
    """Weight between 0.1 and 1: five times the share of symbols is taken off."""
    n = F.length(text)
    symbols = n - F.length(F.translate(text, SYMBOLS, ""))
    share = F.when(n > 0, symbols.cast("double") / n.cast("double")).otherwise(1.0)
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(5.0) * share)


def draw(doc_id: Column, text_hash: Column, seed: int) -> Column:
    """Uniform in (0, 1), fixed by the seed, the id and the text."""
    mixed = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("-")), text_hash))
    return (F.conv(F.substring(mixed, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def keyed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds size, the exponential key, its range and the hash that breaks ties."""
    text = F.coalesce("text", F.lit(""))
    out = docs.withColumns({"size": words(F.col("text")), "_hash": F.md5(text)})
    key = -F.log(draw(F.col("doc_id"), F.col("_hash"), seed)) / quality(text)
    out = out.withColumn("_key", key)
    part = F.floor((1.0 - F.exp(-F.col("_key"))) * KEY_BUCKETS).cast("int")
    return out.withColumn("_part", F.least(part, F.lit(KEY_BUCKETS - 1)))


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Words each source should give, from (source, source_size).

    Sharing out again until nobody is above the cap ends where the capped sources are
    those with the lowest cap for their weight, so sorting by that ratio finds them.
    """
    every = W.partitionBy(F.lit(0))
    order = every.orderBy(F.col("source").asc_nulls_last())
    pick = F.array(*[F.lit(w) for w in weights])
    rank = F.row_number().over(order) - 1
    out = sizes.select("source", "source_size", F.get(pick, rank % len(weights)).alias("_w"))
    out = out.withColumns(
        {
            "_cap": F.col("source_size") * max_epochs,
            "_ratio": F.col("source_size") * F.lit(float(max_epochs)) / F.col("_w"),
        }
    )
    by_ratio = every.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    heavy = F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    # The level if this source and all after it by ratio were not capped.
    out = out.withColumn("_level", left.cast("double") / heavy)
    open_level = F.min(F.when(F.col("_ratio") >= F.col("_level"), F.struct("_ratio", "source", "_level"))).over(every)
    out = out.withColumn("_open", open_level)
    target = F.least(F.col("_cap").cast("double"), F.col("_open._level") * F.col("_w"))
    return out.select("source", "source_size", F.coalesce(target, F.col("_cap").cast("double")).alias("target"))


def fitting() -> Column:
    """How many of ``_rows`` equal rows after ``_before`` words have their middle in the budget."""
    size, left = F.col("size"), F.col("_left")
    fits = lambda nth: F.col("_before") + nth * size + size / 2 <= left
    # The quotient may be off by its rounding; the comparison itself decides.
    near = F.floor((left - F.col("_before") - size / 2) / F.nullif(size, F.lit(0))) + 1
    exact = F.when(fits(near), near + 1).when(~fits(near - 1), near - 1).otherwise(near)
    all_or_none = F.when(F.col("_before") <= left, F.col("_rows")).otherwise(0)
    return F.when(size == 0, all_or_none).otherwise(F.greatest(F.lit(0), F.least(F.col("_rows"), exact))).cast("long")


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Every document with its size, its source's size and target, and how often it is taken."""
    docs = docs.select(*quoted(without(docs, *ADDED)))
    full = keyed(docs.select(packed(docs), "doc_id", "source", "text"), seed)
    narrow = full.select("source", "size", "_key", "_part", "doc_id", "_hash")
    # A hot source is summed per task and range before anything moves.
    parts = small(narrow.groupBy("source", "_part").agg(F.sum("size").alias("_words")), "mix-parts")
    shares = targets(parts.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, max_epochs)
    epochs = F.when(
        F.col("source_size") > 0,
        F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs)),
    ).otherwise(0)
    plan = shares.withColumn("_epochs", epochs.cast("long")).withColumn(
        "_left", F.col("target") - F.col("_epochs") * F.col("source_size")
    )

    running = W.partitionBy("source").orderBy("_part")
    ends = parts.withColumn("_end", F.sum("_words").over(running))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    p, e = plan.alias("p"), ends.alias("e")
    border = (
        p.join(e, same(plan, ends) & (ends["_end"] > plan["_left"]), "left")
        .groupBy(plan["source"], plan["source_size"], plan["target"], plan["_epochs"], plan["_left"])
        .agg(F.min(F.struct("e._part", "e._end", "e._words")).alias("_b"))
        .select(
            "source", "source_size", "target", "_epochs", "_left",
            F.coalesce(F.col("_b._part"), F.lit(KEY_BUCKETS)).alias("_border"),
            (F.col("_b._end") - F.col("_b._words")).alias("_start"),
        )
    )
    border = small(border, "mix-border")

    inside = narrow.join(
        border.select("source", "_border", "_left", "_start"),
        narrow["source"].eqNullSafe(border["source"]) & (narrow["_part"] == border["_border"]),
    ).drop(border["source"])
    # Equal rows meet as a count, so a repeated row is one row under the window.
    alike = inside.groupBy("source", "_key", "doc_id", "_hash", "size", "_left", "_start").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    in_order = W.partitionBy("source").orderBy("_key", "doc_id", "_hash").rowsBetween(W.unboundedPreceding, -1)
    before = F.col("_start") + F.coalesce(F.sum(F.col("size") * F.col("_rows")).over(in_order), F.lit(0))
    cut = (
        alike.withColumn("_before", before)
        .withColumn("_fits", fitting())
        .where("_fits > 0")
        .groupBy("source")
        .agg(
            F.max(F.struct("_key", "doc_id", "_hash", "_fits", "_rows")).alias("_c")
        )
        .select("source", F.struct("_c._key", "_c.doc_id", "_c._hash").alias("_last"), "_c._fits", "_c._rows")
    )
    b, c = border.alias("b"), cut.alias("c")
    rules = small(
        b.join(c, F.col("b.source").eqNullSafe(F.col("c.source")), "left").select(
            F.col("b.source").alias("_source"), "source_size", "target", "_epochs", "_border", "_last",
            F.when(F.col("_fits") < F.col("_rows"), F.col("_fits")).alias("_fits"),
        ),
        "mix-rules",
    )
    # Structs are compared field by field with nulls first, as the window above sorts them.
    place = F.struct("_key", "doc_id", "_hash")
    fraction = (F.col("_part") < F.col("_border")) | (
        (F.col("_part") == F.col("_border")) & F.coalesce(place <= F.col("_last"), F.lit(False))
    )
    out = full.join(rules, full["source"].eqNullSafe(F.col("_source")))
    if not rules.where("_fits is not null").isEmpty():
        # The budget ends among equal rows: they are numbered, apart from all others.
        parted = F.coalesce(F.col("_fits").isNotNull() & (place == F.col("_last")), F.lit(False))
        tied = numbered(
            out.where(parted).withColumn("_all", F.xxhash64("row")), ["_source"], "_nth", ("_all",)
        )
        tied = tied.withColumn("_taken", F.col("_nth") < F.col("_fits")).drop("_all", "_nth")
        out = out.where(~parted).withColumn("_taken", fraction).unionByName(tied)
        fraction = F.col("_taken")
    copies = F.col("_epochs") + fraction.cast("long")
    return (
        out.withColumn("copies", copies)
        .withColumn("taken", F.col("size") * F.col("copies"))
        .select(*unpacked(docs.columns), *ADDED)
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken."""
    kept = without(mixed, *ADDED)
    rows = mixed.where("copies > 0").select(packed(mixed), F.explode(F.expr("sequence(1L, copies)")))
    return rows.select(*unpacked(kept))
