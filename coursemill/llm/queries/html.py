from __future__ import annotations

from coursemill.llm.common import table
from coursemill.llm.html import extract_text


def op1_html_text(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES = {"op1_html_text": op1_html_text}
SQL = {}  # a trained model; tests compare with labelled pages
