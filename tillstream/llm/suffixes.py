"""Removal of long repeated byte strings by sorted suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else too, in
the same document or another.  Sorting every suffix of a corpus costs far more than its
bytes, so only some suffixes are sorted, chosen so that no repeat is missed: the rolling
hash of every ``GRAM``-byte string is taken, and a position is an anchor if its hash is the
smallest among those of some ``LENGTH``-byte string.  Equal strings have equal anchors.

1. Every text gives its anchors, each with a hash of its whole context (``REACH`` bytes
   before, ``LENGTH`` after).  A task reports a context it sees twice once.  Rows sorted by
   (string hash, context hash) show by their neighbours which contexts occur again, and
   those are repeats to their full extent, and which strings occur in different contexts.
   Rows of a frequent string are dealt by string and context, so they meet in no one task.
2. For the latter the contexts' bytes are fetched.  Sampled splitters range-partition the
   suffixes by their leading bytes (``repartitionByRange``); within a partition suffixes
   are put in order by multikey quicksort, neighbours are compared, and the texts before
   the anchors are sorted backwards likewise.  Two contexts hold a repeat if they agree on
   enough bytes both ways; classes of agreement are read off the two orders.
3. Splitters lie between leading strings, so strings that must be compared share a
   partition; a string in more than ``GROUP`` contexts is taken out of its partition and
   compared across partitions by counting its ``LENGTH``-byte strings (:func:`counted`).
   Frequent strings known to have as many contexts are counted at once.

Null texts are empty and lose nothing, as do texts shorter than ``LENGTH``.  Rows that
repeat an id or a whole row are documents of their own and so repeat each other.  Null ids
and extra columns are fine, added columns replace columns of the same name, and an empty
table gives an empty result.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from tillstream.llm.common import packed, quoted, small, stored, texts_as_bytes, unpacked, without

LENGTH = 400
GRAM = 200
REACH = LENGTH - GRAM
#: Contexts of one string that are compared in one task.
GROUP = 65_536
#: A string is frequent if its rows are more than this and than ``HOT_SHARE`` of the mean of
#: ``BUCKETS`` buckets of strings; so there are at most ``BUCKETS / HOT_SHARE`` such strings.
HOT, HOT_SHARE, BUCKETS = 1 << 13, 4, 1 << 16
#: Bytes of a text whose hashes are taken together.
STRETCH = 1 << 20
#: Contexts sent on at a time.
CONTEXTS = 10_000
#: Groups up to this size are compared pair by pair.
PAIRWISE = 12

# Fixed value: base of the rolling hash, odd so that it has an inverse.
BASE = 0x5851F42D4C957F2D


def _spread(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of bytes, powers of the base and of its inverse."""
    inverse = pow(BASE, -1, 1 << 64)
    up = np.full(size, BASE, np.uint64)
    down = np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    values = _spread(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return values, np.multiply.accumulate(up), np.multiply.accumulate(down)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at every position that has as many."""
    values, up, down = _powers(STRETCH + LENGTH)
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * up[:n], out=sums[1:])
    return _spread((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Anchor positions and the hashes of the strings there."""
    data = np.frombuffer(text, np.uint8)
    width = LENGTH - GRAM + 1
    at, keys = [], []
    for start in range(0, len(data) - LENGTH + 1, STRETCH):
        # Stretches overlap so that every string lies within one of them.
        hashes = gram_hashes(data[start : start + STRETCH + LENGTH - 1])
        n = len(hashes)
        # The place in the low bits makes the leftmost of equal hashes the smallest.
        ranked = (hashes & np.uint64(0xFFFFFFFFFF000000)) | np.arange(n, dtype=np.uint64)
        blocks = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
        blocks[:n] = ranked
        blocks = blocks.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
        least = least[np.flatnonzero(np.r_[True, least[1:] != least[:-1]])]
        found = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        at.append(found + start)
        keys.append(hashes[found])
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, keys = np.concatenate(at), np.concatenate(keys)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[first], keys[first]


def merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping and touching (start, end) spans made one."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.r_[True, spans[1:, 0] > ends[:-1]])
    return np.stack([spans[first, 0], ends[np.r_[first[1:] - 1, len(spans) - 1]]], axis=1)


def _reverse(text: bytes) -> bytes:
    return text[::-1]


def multikey_quicksort(strings: list[bytes]) -> tuple[list[int], np.ndarray]:
    """Order of the strings, and bytes each shares with the one before it in that order.

    Strings are split three ways by a pivot's next eight bytes; only those equal to the
    pivot go on to the eight bytes after.
    """
    if not strings:
        return [], np.zeros(0, np.int64)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    longest = max(8, -(-int(sizes.max()) // 8) * 8)
    table = np.frombuffer(b"".join(s.ljust(longest, b"\0") for s in strings), ">u8")
    table = table.reshape(len(strings), -1).astype(np.uint64)
    order: list[int] = []
    todo = [(np.arange(len(strings)), 0)]
    while todo:
        rows, depth = todo.pop()
        if len(rows) == 1:
            order.append(int(rows[0]))
            continue
        if depth == table.shape[1]:
            # Equal but for trailing zero bytes: the shorter one first.
            order.extend(rows[np.argsort(sizes[rows], kind="stable")].tolist())
            continue
        words = table[rows, depth]
        pivot = words[len(words) // 2]
        less, more = words < pivot, words > pivot
        # Last in, first out: the smaller strings are finished first.
        for mask, deeper in ((more, depth), (~(less | more), depth + 1), (less, depth)):
            if mask.any():
                todo.append((rows[mask], deeper))
    shared = np.zeros(len(strings), np.int64)
    if len(order) > 1:
        ranked = table[order]
        differ = ranked[1:] != ranked[:-1]
        at = np.where(differ.any(axis=1), differ.argmax(axis=1), table.shape[1])
        safe = np.minimum(at, table.shape[1] - 1)
        pick = np.arange(len(order) - 1)
        gap = ranked[1:][pick, safe] ^ ranked[:-1][pick, safe]
        # Whole equal bytes at the front of the first differing word.
        same = np.full(len(gap), 8, np.int64)
        for k in range(8):
            same = np.minimum(same, np.where(gap >> np.uint64(8 * (7 - k)) != 0, k, 8))
        both = np.minimum(sizes[order][1:], sizes[order][:-1])
        shared[1:] = np.minimum(at * 8 + np.where(at == table.shape[1], 0, same), both)
    return order, shared


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def extents(group: list[tuple[bytes, bytes]]) -> list[tuple[int, int] | None]:
    """How far repeats reach before and after the anchor, for each (before, after)."""
    out: list[tuple[int, int] | None] = [None] * len(group)

    def add(i: int, before: int, after: int) -> None:
        was = out[i]
        out[i] = (before, after) if was is None else (max(before, was[0]), max(after, was[1]))

    if len(group) <= PAIRWISE:
        backward = [_reverse(b) for b, _ in group]
        for i in range(len(group)):
            for j in range(i):
                after = _shared(group[i][1], group[j][1])
                if after >= LENGTH - REACH:
                    before = _shared(backward[i], backward[j])
                    if before + after >= LENGTH:
                        add(i, before, after)
                        add(j, before, after)
        return out

    n = len(group)
    order, forward = multikey_quicksort([a for _, a in group])
    back_order, backward = multikey_quicksort([_reverse(b) for b, _ in group])
    order, back_order = np.array(order), np.array(back_order)
    before = np.fromiter((len(b) for b, _ in group), np.int64, n)
    after = np.fromiter((len(a) for _, a in group), np.int64, n)
    places = np.unique(np.r_[LENGTH - forward[1:], backward[1:]])
    low, high = np.full(n, LENGTH), np.full(n, -1)
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    for place in places[(places >= 0) & (places <= REACH)].tolist():
        # Strings that start `place` bytes before the anchor: equal if both halves are.
        right[order] = np.cumsum(forward < LENGTH - place)
        left[back_order] = np.cumsum(backward < place)
        fits = np.flatnonzero((before >= place) & (after >= LENGTH - place))
        both = right[fits] * (n + 1) + left[fits]
        _, at, counts = np.unique(both, return_inverse=True, return_counts=True)
        twice = fits[counts[at] > 1]
        low[twice] = np.minimum(low[twice], place)
        high[twice] = np.maximum(high[twice], place)
    for i in np.flatnonzero(high >= 0).tolist():
        out[i] = int(high[i]), LENGTH - int(low[i])
    return out


MARK = "key long, ctx long, doc_id {id}, hash long, start int, stop int"


def _table(*columns):
    """A record batch; all batches of a task must have one schema, so names are numbers."""
    import pyarrow as pa

    def array(column):
        if isinstance(column, pa.ChunkedArray):
            return column.combine_chunks()
        return column if isinstance(column, pa.Array) else pa.array(column)

    arrays = [array(c) for c in columns]
    return pa.RecordBatch.from_arrays(
        [a.chunk(0) if isinstance(a, pa.ChunkedArray) else a for a in arrays],
        names=[f"c{i}" for i in range(len(arrays))],
    )


def anchor_rows(docs: DataFrame) -> DataFrame:
    """One row for each context a task sees, and spans of contexts it sees twice.

    Rows with a null key are spans (start, stop) known to repeat; others are anchors at
    ``start``; ``stop`` is 1 if the task has already reported all its places.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        #: Context seen by this task: where its row is, among those not sent yet.
        for batch in batches:
            texts = texts_as_bytes(batch)
            rows, at, keys, contexts = [], [], [], []
            for i, text in enumerate(texts):
                places, found = anchors(text)
                if len(places):
                    rows.append(np.full(len(places), i))
                    at.append(places)
                    keys.append(found)
                    contexts.append(
                        [
                            xxh64_intdigest(text[max(0, p - REACH) : p + LENGTH], min(p, REACH))
                            for p in places.tolist()
                        ]
                    )
            if not rows:
                continue
            row, place = np.concatenate(rows), np.concatenate(at)
            key, ctx = np.concatenate(keys), np.array([c for cs in contexts for c in cs], np.uint64)
            order = np.lexsort((ctx, key))
            same = (key[order][1:] == key[order][:-1]) & (ctx[order][1:] == ctx[order][:-1])
            again = np.r_[False, same]
            twice = again | np.r_[same, False]
            ids, hashes = batch.column(0), batch.column(2)
            first = order[~again]
            done = twice[~again].astype(np.int32)
            yield _table(
                key[first].view(np.int64), ctx[first].view(np.int64), ids.take(pa.array(row[first])),
                hashes.take(pa.array(row[first])), place[first].astype(np.int32), done,
            )
            # Places of contexts seen twice here need no comparison with other tasks.
            known = np.sort(order[twice])
            if len(known):
                cuts = np.flatnonzero(np.diff(row[known], prepend=-1, append=-1))
                spans = []
                for a, b in zip(cuts, cuts[1:]):
                    p = place[known[a:b]]
                    part = merged(np.stack([np.maximum(0, p - REACH), p + LENGTH], axis=1))
                    spans.append(np.column_stack([np.full(len(part), row[known[a]]), part]))
                spans = np.concatenate(spans)
                none = pa.nulls(len(spans), pa.int64())
                yield _table(
                    none, none, ids.take(pa.array(spans[:, 0])), hashes.take(pa.array(spans[:, 0])),
                    spans[:, 1].astype(np.int32), spans[:, 2].astype(np.int32),
                )

    return docs.select("doc_id", "text", "hash").mapInArrow(run, MARK.format(id=id_type))


def frequent_strings(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """Keys with very many rows; few enough to be sent to every task, whatever the table."""
    rows = rows.select("key").where("key is not null")
    bucket = F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).alias("bucket")
    counts = stored(rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")), "string-buckets")
    total = counts.agg(F.sum("n")).first()[0] or 0
    many = F.col("n") > max(hot, HOT_SHARE * total / BUCKETS)
    buckets = small(counts.where(many).select("bucket"), "full-buckets")
    if buckets.isEmpty():
        return rows.limit(0)
    keys = rows.join(buckets, bucket == buckets["bucket"], "left_semi").groupBy("key")
    return small(keys.agg(F.count(F.lit(1)).alias("n")).where(many).select("key"), "frequent-strings")


def repeated_contexts(rows: DataFrame, group: int = GROUP, hot: int = HOT) -> tuple[DataFrame, DataFrame | None]:
    """Spans that repeat in full (null key) and contexts of strings with several.

    Also gives the frequent strings with more than ``group`` contexts, if any.
    """
    spans, rows = rows.where("key is null"), rows.where("key is not null")
    often = frequent_strings(rows, hot)
    if often.isEmpty():
        return spans.unionAll(_judged(rows, ["key"])), None
    dealt = stored(_judged(rows.join(often, "key", "left_semi"), ["key", "ctx"]), "frequent-contexts")
    # One row for each context of a frequent string: pre-aggregated, a row a task and string.
    known = dealt.where("key is not null")
    contexts_of = small(known.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "contexts-of-strings")
    several = known.join(contexts_of.where("n > 1").select("key"), "key", "left_semi").select(*rows.columns)
    rare = _judged(rows.join(often, "key", "left_anti"), ["key"])
    marks = spans.unionAll(rare).unionAll(dealt.where("key is null")).unionAll(several)
    return marks, contexts_of.where(F.col("n") > group).select("key")


def _judged(rows: DataFrame, by: list[str]) -> DataFrame:
    """Spans of contexts that occur again (null key), and contexts.

    Rows dealt by key give the contexts of strings with several; dealt by key and context
    they give each context once.  They come sorted by key and context, so a row's neighbours
    tell all there is to know and only one row is carried from batch to batch, however often
    a string occurs.
    """
    import pyarrow as pa

    apart = len(by) > 1

    def run(batches):
        held = None
        for batch in batches:
            batch = pa.Table.from_batches([batch]).combine_chunks()
            if not batch.num_rows:
                continue
            window = batch if held is None else pa.concat_tables([held[0], batch])
            yield from judged(window, held[1] if held else (False, False), last=False)
            held = tail(window, held[1] if held else (False, False))
        if held is not None:
            yield from judged(held[0], held[1], last=True)

    def neighbours(window):
        key, ctx = window["key"].to_numpy(), window["ctx"].to_numpy()
        same_key = key[1:] == key[:-1]
        return same_key, same_key & (ctx[1:] == ctx[:-1])

    def tail(window, before):
        same_key, same_ctx = neighbours(window)
        seen = before if window.num_rows == 1 else (bool(same_key[-1]), bool(same_ctx[-1]))
        return window.slice(window.num_rows - 1), seen

    def judged(window, before, last):
        """All rows of the window but the last, which waits for its next neighbour."""
        same_key, same_ctx = neighbours(window)
        key_before, ctx_before = np.r_[before[0], same_key], np.r_[before[1], same_ctx]
        key_after, ctx_after = np.r_[same_key, False], np.r_[same_ctx, False]
        keep = slice(None) if last else slice(0, window.num_rows - 1)
        again = (ctx_before | ctx_after)[keep]
        if apart:
            several = ~ctx_before[keep]
        else:
            several = ((~ctx_before & key_before) | (~ctx_after & key_after))[keep]
        window = window.slice(0, len(again))
        for mask, spans in ((again, True), (several, False)):
            part = window.filter(pa.array(mask))
            if not part.num_rows:
                continue
            if spans:
                place = part["start"].to_numpy()
                none = pa.nulls(part.num_rows, pa.int64())
                yield _table(
                    none, none, part["doc_id"], part["hash"],
                    np.maximum(0, place - REACH).astype(np.int32), (place + LENGTH).astype(np.int32),
                )
            else:
                yield _table(*part.columns)

    return rows.repartition(*by).sortWithinPartitions("key", "ctx").mapInArrow(run, rows.schema)


def contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes before and after each wanted anchor; a document's anchors travel together."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    places = wanted.groupBy(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).agg(
        F.collect_set(F.struct("key", "ctx", "start")).alias("places")
    )
    found = docs.join(places, docs["doc_id"].eqNullSafe(F.col("_id")) & (docs["hash"] == F.col("_hash")))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []

            def table(batch=batch):
                key, ctx, row, at, before, after = zip(*out)
                rows = pa.array(row)
                return _table(
                    list(key), list(ctx), batch.column(0).take(rows), batch.column(2).take(rows),
                    pa.array(at, pa.int32()), pa.array(before, pa.binary()), pa.array(after, pa.binary()),
                )

            for i, text in enumerate(texts_as_bytes(batch)):
                for p in batch.column(3)[i].as_py():
                    at = p["start"]
                    out.append((p["key"], p["ctx"], i, at, text[max(0, at - REACH) : at], text[at : at + LENGTH]))
                if len(out) >= CONTEXTS:
                    yield table()
                    out.clear()
            if out:
                yield table()

    schema = f"key long, ctx long, doc_id {id_type}, hash long, at int, before binary, after binary"
    return found.select("doc_id", "text", "hash", "places").mapInArrow(run, schema)


def compared(found: DataFrame, most: int = GROUP) -> DataFrame:
    """Spans from sorted suffixes, and the contexts of strings that have too many.

    A span has start and stop and no bytes; a context that is left over keeps its bytes.
    """
    import pyarrow as pa

    bounds = [T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]
    schema = T.StructType(list(found.drop("at").schema) + bounds)
    places = ("key", "ctx", "doc_id", "hash", "at", "before", "after")

    def run(batches):
        group: dict[int, tuple] = {}
        key, large = None, False

        def rows(spans):
            cols = list(zip(*spans))
            kinds = [f.type for f in ids]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[f.name for f in ids])

        def solved():
            spans = []
            members = list(group.values())
            for (k, ctx, doc, h, at, _, _), reach in zip(members, extents([m[5:7] for m in members])):
                if reach is not None:
                    spans.append((None, None, doc, h, None, None, at - reach[0], at + reach[1]))
            return spans

        ids = None
        for batch in batches:
            if ids is None:
                ids = [
                    *[pa.field(n, batch.schema.field(n).type) for n in ("key", "ctx", "doc_id", "hash")],
                    *[pa.field(n, batch.schema.field(n).type) for n in ("before", "after")],
                    pa.field("start", pa.int32()),
                    pa.field("stop", pa.int32()),
                ]
            out = []
            for row in zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in places]):
                if row[0] != key:
                    if len(group) > 1:
                        out += solved()
                    group, key, large = {}, row[0], False
                if not large:
                    group[row[1]] = row  # of equal contexts one is enough
                    if len(group) > most:
                        out += [(k, c, d, h, b, a, at, None) for k, c, d, h, at, b, a in group.values()]
                        group, large = {}, True
                else:
                    k, c, d, h, at, b, a = row
                    out.append((k, c, d, h, b, a, at, None))
            if out:
                yield rows(out)
        if len(group) > 1:
            out = solved()
            if out:
                yield rows(out)

    # The key follows the leading bytes, so that strings of one hash come together.
    lead = F.substring("after", 1, GRAM)
    ranged = found.withColumn("lead", lead).repartitionByRange("lead", "key").sortWithinPartitions("lead", "key", "ctx")
    return ranged.select(*places).mapInArrow(run, schema)


def counted(large: DataFrame) -> DataFrame:
    """Spans of contexts of very frequent strings: count each of their strings."""
    import pyarrow as pa

    id_type = large.schema["doc_id"].dataType.simpleString()

    def run(batches):
        from xxhash import xxh64_intdigest

        for batch in batches:
            kinds = [pa.int64(), pa.int64(), batch.schema.field("doc_id").type, pa.int64(), pa.int32()]
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in names}
                text, low = row["before"] + row["after"], len(row["before"])
                # One context's strings at a time: a batch of contexts makes very many.
                out = []
                for s in range(min(low, len(text) - LENGTH) + 1):
                    string = text[s : s + LENGTH]
                    a, b = xxh64_intdigest(string, 1), xxh64_intdigest(string, 2)
                    out.append((a - (1 << 63), b - (1 << 63), row["doc_id"], row["hash"], row["start"] - low + s))
                if out:
                    yield _table(*[pa.array(c, t) for c, t in zip(zip(*out), kinds)])

    names = ("doc_id", "hash", "start", "before", "after")
    strings = stored(
        large.dropDuplicates(["key", "ctx"])
        .select(*names)
        .mapInArrow(run, f"a long, b long, doc_id {id_type}, hash long, start int"),
        "frequent-strings",
    )
    # Contexts overlap, so one string can come from several; two places are needed.
    place = F.struct("doc_id", "hash", "start")
    places = strings.groupBy("a", "b").agg(F.min(place).alias("p"), F.max(place).alias("q"))
    twice = places.where("not p <=> q").select("a", "b")
    return strings.join(twice, ["a", "b"], "left_semi").select(
        "doc_id", "hash", "start", (F.col("start") + LENGTH).alias("stop")
    )


def repeats(docs: DataFrame, group: int = GROUP, hot: int = HOT) -> DataFrame:
    """(doc_id, hash, start, stop): byte spans that repeat; they may overlap.

    ``docs`` has doc_id, text and hash, the XXH64 of the text.
    """
    marks, often = repeated_contexts(stored(anchor_rows(docs), "anchors"), group, hot)
    marks = stored(marks, "repeat-marks")
    found = stored(contexts(docs, marks.where("key is not null")), "repeat-contexts")
    rare = found if often is None else found.join(often, "key", "left_anti").select(*found.columns)
    solved = stored(compared(rare, group), "repeat-spans")
    spans = [
        marks.where("key is null").select("doc_id", "hash", "start", "stop"),
        solved.where("stop is not null").select("doc_id", "hash", "start", "stop"),
    ]
    large = solved.where("stop is null").drop("stop")
    if often is not None:
        many = found.join(often, "key", "left_semi").withColumnRenamed("at", "start")
        large = large.unionByName(many.select(*large.columns))
    if not large.isEmpty():
        spans.append(counted(large))
    out = spans[0]
    for more in spans[1:]:
        out = out.unionAll(more)
    return out


def cut(docs: DataFrame, group: int = GROUP, hot: int = HOT) -> DataFrame:
    """Every document with its removed spans and what is left of its text.

    Adds ``removed`` (sorted byte spans) and ``kept`` (the remaining bytes).
    """
    docs = docs.select(*quoted(without(docs, "removed", "kept")))
    marked = docs.select(packed(docs), "doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    spans = (
        repeats(marked.select("doc_id", "text", "hash"), group, hot)
        .groupBy(F.col("doc_id").alias("id"), F.col("hash").alias("of"))
        .agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    )
    same = marked["doc_id"].eqNullSafe(F.col("id")) & (marked["hash"] == F.col("of"))
    both = marked.join(spans, same, "left").select("row", F.col("row").getField("text").alias("text"), "spans")
    row = both.schema["row"]

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            removed, kept = [], []
            for text, spans in zip(texts_as_bytes(batch), batch.column(2).to_pylist()):
                found = np.array([(s["start"], min(s["stop"], len(text))) for s in spans or []], np.int64)
                parts = merged(found.reshape(-1, 2)).tolist()
                edges = [0, *[e for p in parts for e in p], len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                removed.append([{"start": a, "stop": b} for a, b in parts])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, kind), pa.array(kept, pa.binary())],
                names=["row", "removed", "kept"],
            )

    added = T.StructType.fromDDL("removed array<struct<start:int,stop:int>>, kept binary")
    found = both.mapInArrow(run, T.StructType([row, *added]))
    return found.select(*unpacked(docs.columns), "removed", "kept")
