"""Awkward rows that every operator must take: nulls, empty, very long, repeated, clashing extra columns."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, label string, word string, rep string"


def words(seed: int, n: int) -> str:
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 99991}" for i in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    long = words(1, 30_000)
    rows = [
        (1, words(2, 200), "en", "a"), (2, words(2, 200), "en", "a"), (3, None, None, None), (4, "", "en", "b"), (5, "   \t\n ", "fr", "b"),
        (6, long, "en", "a"), (7, words(3, 120) + " " + words(2, 200)[:900], "de", "c"), (7, words(9, 80), "de", "c"), (8, words(4, 3), "fr", "a"), (8, words(4, 3), "fr", "a"),
        (None, words(2, 200), "en", "a"), (9, "é" * 50_000, "fr", "b"), (10, "…", "en", "b"), (11, words(5, 60), "en", None),
    ]
    return spark.createDataFrame([(i, t, g, s, None if t is None else len(t), "x", "y", "z", "v") for i, t, g, s in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")
