from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """(doc_id, text) rows as a frame with the columns of ``documents`` and one that clashes."""

    def build(rows):
        full = [(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), "x") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, fp string")

    return build
