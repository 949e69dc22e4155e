from __future__ import annotations

from pyspark.sql import functions as F

from coursemill.llm.common import table
from coursemill.llm.packing import pack_in_order


def digest(pieces):
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_packing(spark, sf_dir):
    return digest(pack_in_order(table(spark, sf_dir, "documents")))


QUERIES = {"op2_packing": op2_packing}
SQL = {}  # token ids; tests check the exact round trip
