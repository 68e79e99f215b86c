from __future__ import annotations

import pytest

LONG = "lorem ipsum dolor " * 40_000

#: Rows with nulls, empty and very long texts, repeats, and columns named like outputs.
EDGE = [
    (1, "A plain text about nothing much at all.", "en", 5, "x"),
    (1, "A plain text about nothing much at all.", "en", 5, "x"),
    (2, None, "en", 6, None),
    (3, "", None, 7, "y"),
    (None, "A plain text about nothing much at all.", "de", None, "z"),
    (None, None, None, None, None),
    (4, LONG, "en", 9, "x"),
    (5, "\n\n \t\n", "fr", 1, "x"),
    (6, "Größe 日本語 \U0001F600 á \x00 end", "fr", 2, "x"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(EDGE, "doc_id long, text string, lang string, n_words long, fingerprint string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, n_words long, fingerprint string")
