"""Small tables for the corpus operators."""

import pytest


@pytest.fixture
def documents(spark):
    """Builds a table from ``(doc_id, text)`` pairs, with columns whose names clash with internal ones."""

    def make(rows, lang=None):
        full = [(d, t, (lang or {}).get(d), f"s{i % 3}", None if t is None else len(t), "x", i) for i, (d, t) in enumerate(rows)]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, words string, h int").repartition(3)

    return make
