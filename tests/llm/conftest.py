"""Small documents with the awkward cases every operator must take."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from helpers import prose  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, fp string, hash string"


def awkward_rows():
    """Nulls everywhere, empty and long texts, ties, repeated rows, clashing columns."""
    base = prose(1, 300)
    texts = [
        None, "", " \n\t ", "one", "one two", base, base, base.replace("the", "THE"),
        base[:400], base[50:900] + " tail", prose(2, 30_000), "word " * 200,
        "x\n" * 90, prose(3, 80) + " " + base[100:700], "é" * 500, "\x1c \x85 \xa0   a",
        prose(4, 120), prose(4, 120) + " more", "<|im_end|> ***",
    ]
    rows = [
        (i, t, "en", None if i % 7 == 0 else f"s{i % 4}", None if t is None else len(t), "x", "y", "z", "h")
        for i, t in enumerate(texts)
    ]
    rows.append((None, prose(5, 90), None, None, None, None, None, None, None))
    rows.append((None,) * 9)
    rows += [rows[5], rows[16], rows[16]]  # repeated rows
    rows.append((16, prose(6, 70), "fr", "s1", 1, "x", "y", "z", "h"))  # an id with two texts
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
