"""Made-up prose and other helpers of the tests."""

import random


def prose(seed, words):
    rng = random.Random(seed)
    common = ["the", "of", "and", "in", "to"]
    return " ".join(
        rng.choice(common) if rng.random() < 0.3 else "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
        for _ in range(words)
    )


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
