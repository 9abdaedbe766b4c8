"""Fixtures of the operators' tests; imported by name, so that no second ``conftest`` hides the first."""

import pytest


@pytest.fixture
def docs(spark):
    """Rows with the awkward cases: null, empty, one word, ties, repeated rows,
    a very long text, and extra columns whose names clash with the operators'."""
    def make(texts, first=0):
        rows = [(None if t == "NOID" else first + i, "no id here at all" if t == "NOID" else t, "x", i)
                for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, part string, rank int")
    return make
