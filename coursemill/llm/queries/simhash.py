from __future__ import annotations

from pyspark.sql import functions as F

from coursemill.llm.common import table
from coursemill.llm.simhash import simhash_groups


def op8_simhash(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op8_simhash": op8_simhash}
SQL = {}  # XXH64 is not in the SQL engine; tests compare with brute force
