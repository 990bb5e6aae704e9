from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table, with an extra column and clashing names."""

    def build(rows):
        full = [(i, t, lang, src, len(t) if t is not None else None, "x", 1) for i, t, lang, src in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, size string, taken int")

    return build
