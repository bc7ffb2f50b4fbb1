"""Chat formatting with a reversible template and a loss mask, in Spark expressions only.

A conversation is one string of messages ``<|im_start|>role\\n...<|im_end|>\\n``.
Adjacent turns of one role share a message, divided by ``<|im_turn|>``.  Inside texts
every ``<``, any backslashes and ``|`` gain one backslash, so a control string never
appears in a text and taking one backslash away gives the text back.

The loss mask is a list of spans ``(message, start, length)`` in code points of that
message, one for every turn of the trained role.

Turns are sorted by number; null numbers come first and equal numbers go by role and
text.  Null texts and roles are empty strings, repeated rows are turns of their own, a
null conv_id is a conversation of its own, other columns are ignored.  A conversation is
one output string, so its turns meet in one task by nature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Control strings of the template.
START, END, TURN = "<|im_start|>", "<|im_end|>", "<|im_turn|>"


#: Numbers that are added up one by one; sums of so many are added up in turn.
BLOCK = 128


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, not at each use in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sums_before(numbers: Column) -> Column:
    """Sum of the numbers before each, adding up anew for each."""
    total = lambda some: F.aggregate(some, F.lit(0), lambda a, b: a + b)
    return F.transform(numbers, lambda _, i: total(F.slice(numbers, F.lit(1), i)))


def running(sizes: Column, first: Column) -> Column:
    """``first`` and the numbers before each, added up.

    An array that grows number by number would be copied each time.  Blocks of bounded
    length are added up on their own and moved by the sums of the blocks before them.
    """

    def blocks(s):
        ends = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(s) - 1, F.lit(0)), F.lit(BLOCK)),
            lambda i: F.struct(i.alias("from"), (F.least(i + BLOCK, F.size(s)) - 1).alias("to")),
        )
        return F.transform(
            F.filter(ends, lambda e: e["from"] <= e["to"]),
            lambda e: F.transform(F.sequence(e["from"], e["to"]), lambda j: F.get(s, j)),
        )

    def moved(parts):
        totals = F.transform(parts, lambda part: F.aggregate(part, F.lit(0), lambda a, b: a + b))
        shift = lambda part, base: F.transform(_sums_before(part), lambda x: x + base + first)
        return F.flatten(F.zip_with(parts, _let(totals, _sums_before), shift))

    return _let(sizes, lambda s: _let(blocks(s), moved))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role must not hold the line break that ends it."""
    return F.replace(F.replace(escape(role), F.lit("~"), F.lit("~0")), F.lit("\n"), F.lit("~1"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("~1"), F.lit("\n")), F.lit("~0"), F.lit("~")))


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    # Indexes of the turns that open a message: the role differs from the one before.
    opens = F.expr("filter(sequence(0, size(turns) - 1), i -> i = 0 or turns[i].role != turns[i - 1].role)")
    runs = sorted_turns.withColumn("opens", opens).withColumn(
        "runs",
        F.expr(
            "transform(opens, (o, k) -> slice(turns, o + 1, "
            "coalesce(get(opens, k + 1), size(turns)) - o))"
        ),
    )
    messages = runs.withColumn(
        "messages",
        F.transform(
            "runs",
            lambda run: F.struct(
                run[0]["role"].alias("role"),
                escape_role(run[0]["role"]).alias("head"),
                F.transform(run, lambda t: escape(t["text"])).alias("texts"),
            ),
        ),
    )
    body = F.transform(
        "messages",
        lambda m: F.concat(
            F.lit(START), m["head"], F.lit("\n"), F.array_join(m["texts"], TURN), F.lit(END + "\n")
        ),
    )
    # A turn's text starts after the head and, for each earlier turn, its text and a divider.
    ends = F.transform(
        "messages",
        lambda m: F.zip_with(
            running(
                F.transform(m["texts"], lambda t: F.length(t) + len(TURN)),
                F.lit(len(START) + 1) + F.length(m["head"]),
            ),
            F.transform(m["texts"], lambda t: F.length(t)),
            lambda start, length: F.struct(start.alias("start"), length.alias("length")),
        ),
    )
    spans = F.flatten(
        F.transform(
            F.col("ends"),
            lambda spans, k: F.when(
                F.col("messages")[k]["role"] == loss_role,
                F.transform(
                    spans,
                    lambda s: F.struct(k.alias("message"), s["start"].alias("start"), s["length"].alias("length")),
                ),
            ).otherwise(F.array().cast("array<struct<message:int,start:int,length:int>>")),
        )
    )
    return messages.withColumn("ends", ends).select(
        "conv_id", F.array_join(body, "").alias("formatted"), spans.alias("loss_spans")
    )


def messages_of() -> Column:
    """The messages of a formatted string, each with its control strings.

    Splitting at every start mark leaves an empty first part.
    """
    parts = F.split("formatted", r"<\|im_start\|>")
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda m: F.concat(F.lit(START), m))


def _inner(message: Column) -> Column:
    """A message without its start mark and its end."""
    return F.substring(message, len(START) + 1, F.length(message) - len(START) - len(END) - 1)


def _head(inner: Column) -> Column:
    return F.substring_index(inner, "\n", 1)


def _texts(inner: Column) -> Column:
    """The texts of a message, still escaped."""
    return F.split(F.substring(inner, F.length(_head(inner)) + 2, F.length(inner)), r"<\|im_turn\|>")


def turns_of(messages: Column) -> Column:
    """The turns (role, text) of the messages of a formatted string."""
    return F.flatten(
        F.transform(
            F.transform(messages, _inner),
            lambda m: F.transform(
                _texts(m),
                lambda t: F.struct(unescape_role(_head(m)).alias("role"), unescape(t).alias("text")),
            ),
        )
    )


def loss_of(messages: Column) -> Column:
    """The texts under the row's loss mask, in order.

    Messages are split once.  Spans and texts are sorted by place together, so a text under
    the mask stands right behind its span; nothing is searched or read from the start again.
    """
    kind = "struct<message:int,start:int,text_after:boolean,length:int,text:string>"
    spans = F.transform(
        "loss_spans",
        lambda s: F.struct(s["message"], s["start"], F.lit(False), s["length"], F.lit(None).cast("string")).cast(kind),
    )
    texts = F.flatten(
        F.transform(
            F.transform(messages, _inner),
            lambda m, k: F.zip_with(
                _texts(m),
                running(
                    F.transform(_texts(m), lambda t: F.length(t) + len(TURN)),
                    F.lit(len(START) + 1) + F.length(_head(m)),
                ),
                lambda t, start: F.struct(k, start, F.lit(True), F.length(t), t).cast(kind),
            ),
        )
    )
    return F.transform(
        F.filter(
            _neighbours(F.sort_array(F.concat(spans, texts))),
            lambda p: p["now"]["text_after"]
            & ~p["before"]["text_after"]
            & (p["now"]["message"] == p["before"]["message"])
            & (p["now"]["start"] == p["before"]["start"])
            & (p["now"]["length"] == p["before"]["length"]),
        ),
        lambda p: unescape(p["now"]["text"]),
    )


def _neighbours(items: Column) -> Column:
    """Each item with the one before it; the first has none."""
    shifted = F.slice(items, F.lit(1), F.greatest(F.size(items) - 1, F.lit(0)))
    return F.zip_with(
        items,
        F.concat(F.array(F.lit(None)), shifted),
        lambda now, before: F.struct(now.alias("now"), before.alias("before")),
    )
