from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, score string, _note string"


@pytest.fixture
def docs(spark):
    """Documents with clashing extra columns, from ``(doc_id, text, lang, source)``."""
    return lambda *rows: spark.createDataFrame(
        [(i, t, lang, src, len(t or ""), "x", "y", "z") for i, t, lang, src in rows], SCHEMA)


@pytest.fixture
def hard(docs):
    """Nulls everywhere, empty and very long texts, repeated rows, a repeated id."""
    long = "\n".join(f"line {i % 50} of the long text with more words {i}" for i in range(5000))
    return docs((1, None, "en", "a"), (2, "", "en", None), (3, long, None, "a"), (3, long, None, "a"), (4, "one two", "de", "b"),
                (4, "another text", "de", "b"), (None, "no id here", "en", "b"), (None, None, None, None), (5, " \n\t\n ", "en", "c"))
