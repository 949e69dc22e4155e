from __future__ import annotations

from pyspark.sql import functions as F

from coursemill.llm.bpe import coded_documents
from coursemill.llm.common import table


def op13_bpe(spark, sf_dir):
    return coded_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op13_bpe": op13_bpe}
SQL = {}  # merges are not in SQL; tests compare with the tokenizers library
