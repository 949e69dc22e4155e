from __future__ import annotations

from coursemill.llm.common import table
from coursemill.llm.licenses import ADDED, scan_licenses


def op9_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *ADDED)


QUERIES = {"op9_license_scan": op9_license_scan}
SQL = {}  # base columns are compared with brute force in the tests
