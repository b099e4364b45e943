from __future__ import annotations

import pytest


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    from tablesync.llm.deploy import ship

    ship(spark)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in every column, empty and white-space texts, repeated rows, ties.
ODD_ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n", "en", None, 3),
    (4, "one two three", "en", "a", 13),
    (4, "one two three", "en", "a", 13),
    (5, "one two three", "en", "b", 13),
    (None, "four five", None, "b", 9),
    (6, "1234 !!", "en", "b", 7),
    (7, "é中\U0001f600 " * 3000, "fr", "b", 12000),
]


@pytest.fixture
def odd(rows):
    """A small table of awkward documents."""
    return rows(SCHEMA, *ODD_ROWS)


@pytest.fixture
def clashing(odd):
    """The same with further columns named like those that operators add."""
    from pyspark.sql import functions as F

    names = [
        "size", "taken", "rate", "copies", "_row", "_all", "key", "block", "learned", "score",
        "lang_pred", "lang_score", "lang_rejected", "quality_score", "toxicity", "group_id",
        "_gone", "_key", "_times", "tokens", "ids", "position", "label", "keys",
    ]
    return odd.select("*", *[F.lit(name).alias(name) for name in names])


@pytest.fixture
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
