from __future__ import annotations

import pytest


@pytest.fixture()
def docs_of(spark):
    """A documents table with the given (doc_id, text) rows, and columns whose
    names clash with what the operators add."""

    def make(rows, **columns):
        full = [(i, t, "en", "src", len(t or ""), 0.5, 7, "x") for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, ids string"
        return spark.createDataFrame(full, schema)

    return make
