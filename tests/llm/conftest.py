from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(words))


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, a very long one, copies, near copies, repeated rows."""
    long = prose(1, 30_000)
    base = prose(2, 80)
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b ", None, None, None),
        (4, long, "en", "a", len(long)),
        (5, base, "en", "b", len(base)),
        (6, base, "en", "b", len(base)),
        (7, base + " tail", "en", "c", 0),
        (8, "one two", "en", "c", 7),
        (9, "one two", "en", "c", 7),
        (9, "one two", "en", "c", 7),
        (None, prose(3, 60), "en", "d", 0),
        (10, "line one is here\nline one is here\nÜber straße 日本 😀\n\n" + prose(4, 70), "de", "d", 0),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def clashing_docs(spark, edge_docs):
    """Columns named like those that operators make themselves."""
    from pyspark.sql import functions as F

    names = ("cid", "key", "keys", "blob", "words", "score", "held", "dk", "drop", "line", "component", "shard", "tokens", "cluster", "_t", "kinds", "starts", "ends", "n_lines", "quality", "pos", "b")
    return edge_docs.withColumns({n: F.lit("x") for n in names})


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns):
    return sorted(((tuple(r[c] for c in ("doc_id", *columns))) for r in df.collect()), key=repr)
