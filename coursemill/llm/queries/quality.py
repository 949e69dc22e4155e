from __future__ import annotations

from coursemill.llm.common import table
from coursemill.llm.quality import judge_quality


def op10_quality(spark, sf_dir):
    return judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


QUERIES = {"op10_quality": op10_quality}
SQL = {}  # the verdict is an iterative estimate; tests compare with brute force
