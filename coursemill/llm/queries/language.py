from __future__ import annotations

from coursemill.llm.common import table
from coursemill.llm.language import identify


def op4_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents").select("doc_id", "lang", "text")).select(
        "doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op4_language_id": op4_language_id}
SQL = {}  # held-out accuracy is tested instead
