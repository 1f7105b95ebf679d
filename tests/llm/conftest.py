import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_data import DOCS, clashing, prose  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    """A documents table from (doc_id, text[, lang, source]) rows, in two partitions."""

    def build(rows, clash=False):
        full = [(*r, *(None, None)[len(r) - 2 :], None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(2)
        return clashing(df) if clash else df

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows and equal texts."""
    long = prose(1, 30_000)
    return [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\n ", None, None),
        (4, long, "en", "b"),
        (5, long, "en", None),
        (6, "x" * 200_000, None, "b"),
        (7, "one two three", "fr", "a"),
        (7, "one two three", "fr", "a"),
        (None, "one two three", "fr", "a"),
        (None, prose(2, 80), "de", "c"),
        (None, None, None, None),
        (8, prose(2, 80), "de", "c"),
        (9, "café ☃ naïve \U0001f600 " + prose(3, 50), "fr", "c"),
        (10, prose(4, 400), "en", "b"),
        (11, "  ", "en", "b"),
    ]
