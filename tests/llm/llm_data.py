"""Fixtures of these tests."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BLANKS = " \t\n\x0b\x0c\r"


@pytest.fixture
def make_docs(spark):
    """Documents from texts, or from (doc_id, text) pairs."""

    def build(rows):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(k, t, "en", f"src{i % 3}", len(t or "")) for i, (k, t) in enumerate(pairs)], DOCS)

    return build


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, repeated rows, a very long text, and columns
    whose names operators use themselves."""
    rows = [
        (1, None, "en", "src1", None), (2, "", None, None, 0), (None, "a text without an id", None, "src2", 20), (3, " \n\t ", "en", "src1", 4),
        (4, "the same words twice over here", "en", "src1", 30), (4, "the same words twice over here", "en", "src1", 30),
        (5, "the same words twice over here", "de", "", 30), (6, "word " * 40_000, "en", "src3", 200_000), (7, "x" * 100_000, "en", "src3", 100_000),
        (8, "one", "fr", "src4", 3), (None, None, None, None, None), (9, "\U0001f600 é 漢字 ß", "xx", "s", 10),
    ]
    docs = spark.createDataFrame([(*r, 7, "mine", 0.5) for r in rows], DOCS + ", n_tokens int, component_id string, score double")
    return docs.selectExpr("*", "1 AS fp", "'k' AS kept", "2 AS bucket", "3 AS h", "'l' AS label", "0 AS epoch")


@pytest.fixture
def odd_labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (1, 0, 1), (None, 1, 1), (4, None, None), (6, 0, 0), (99, 1, 1), (8, 1, 0)], "doc_id long, quality int, toxic int"
    )


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def prose(r: random.Random, n: int, vocabulary: int = 3000) -> str:
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))
