from __future__ import annotations

from coursemill.llm.common import table
from coursemill.llm.matrices import pack_matrices


def op3_token_matrices(spark, sf_dir):
    return pack_matrices(table(spark, sf_dir, "documents"))


QUERIES = {"op3_token_matrices": op3_token_matrices}
SQL = {}  # token ids; tests check the exact round trip
