from __future__ import annotations

import pytest

NASTY = "edge cases every operator has to take: nulls, empty and long texts, ties, repeated rows, clashing names"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, columns with names used inside."""
    long = " ".join(f"word{i % 977} {i}" for i in range(12_000))
    rows = [
        (1, None, "en", "a", 0, 1, "x"),
        (2, "", None, "a", 0, 2, None),
        (3, " \t\n ", "en", None, 3, 3, "x"),
        (4, "one two", "en", "b", 7, 4, "x"),
        (5, long, "en", "b", len(long), 5, "x"),
        (6, long, "de", "b", len(long), 5, "x"),
        (7, "same words here " * 40, "en", "c", 1, 6, "x"),
        (7, "same words here " * 40, "en", "c", 1, 6, "x"),
        (8, "Äß ñ 日本 ́ 𝒳 \x00 end", "de", "", 1, 7, "x"),
        (None, "no id here but a text of some words", None, None, None, None, None),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, size long, pattern string"
    )


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
