"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from importlib import import_module

AREAS = ("html", "packing", "matrices", "language", "lines", "topk", "mixing", "simhash", "licenses", "quality", "lexical", "merkle", "bpe")

QUERIES: dict = {}
SQL: dict = {}
for area in AREAS:
    module = import_module(f"coursemill.llm.queries.{area}")
    QUERIES.update(module.QUERIES)
    SQL.update(module.SQL)

import corpus_pipeline  # noqa: E402  (at the top of the repository, counted with this package)

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
