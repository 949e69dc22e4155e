"""SimHash near-dedup: inverted index on the bytes of a fingerprint by position, count filter, exact check.

Two 64-bit fingerprints that differ in at most r bits differ in at most r of their 8 bytes, so they agree in at least
8 - r byte positions. Fingerprints are posted under their bytes at each set of positions of a family in which every
possible agreement of 8 - r positions holds one set; pairs under a key are tallied over all 8 positions, kept from the
guaranteed minimum on, and checked bit by bit. Equal fingerprints are one entry, so copies never form pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import saved
from coursemill.llm.components import components

#: Entries of a key that are compared as one cell; larger keys are cut into blocks that meet block by block.
BLOCK = 2048


def fingerprint(text: str | None, words: int = 4) -> int:
    """Signed 64-bit fingerprint of one text: the majority bits of the hashes of its word shingles; no words: 0."""
    own = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not own:
        return 0
    joined, n = b" ".join(own), max(1, len(own) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    hashes = [xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[-n:].tolist(), strict=True)]
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 65536):  # a bounded bit matrix, however long the text
        part = np.array(hashes[at:at + 65536], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, fp`` for each row; only the id and the text reach Python."""
    @F.pandas_udf("bigint")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t if isinstance(t, str) else None, words) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), fp(F.col(text_col)).alias("fp"))


def position_sets(size: int, agree: int) -> list[tuple[int, ...]]:
    """Sets of ``size`` of the 8 positions such that any ``agree`` positions hold one of them, chosen greedily."""
    open_, sets = set(combinations(range(8), agree)), []
    choice = list(combinations(range(8), size))
    while open_:
        best = max(choice, key=lambda s: sum(set(s) <= set(o) for o in open_))
        sets.append(best)
        open_ = {o for o in open_ if not set(best) <= set(o)}
    return sorted(sets)


def close_pairs(fps: DataFrame, radius: int = 4, entries: int | None = None) -> DataFrame:
    """``a, b``: links that connect all of the distinct ``fp`` that lie within ``radius`` bits of each other.

    Per key and block only links that join something new are returned, so a dense group of m fingerprints gives about m
    rows and not m squared. The keys have 3 bytes up to ``entries`` of 50 million and 4 beyond; both are complete.
    """
    agree = 8 - radius
    if not 1 <= agree <= 7:
        raise ValueError("radius must be 1 to 7: beyond that no byte is sure to agree")
    sets = position_sets(min(agree, 3 if (entries or 0) < 50_000_000 else 4), agree)
    own = lambda p: F.shiftright("fp", 8 * p).bitwiseAND(F.lit(255))
    keys = [F.struct(F.lit(k).cast("tinyint").alias("k"), sum((own(p) * (1 << 8 * i) for i, p in enumerate(s)), F.lit(0)).alias("v"))
            for k, s in enumerate(sets)]
    posted = fps.select("fp", F.inline(F.array(*keys)))
    full = posted.groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1")
    cells = (posted.join(full, ["k", "v"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
             .select("k", "v", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"))
    cell = ["k", "v", "i", "j"]
    first = np.array([next((k for k, s in enumerate(sets) if all(m >> p & 1 for p in s)), -1) for m in range(256)])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            new = (rest[cell] != rest[cell].shift()).any(axis=1).to_numpy()
            last = int(np.flatnonzero(new)[-1]) if len(new) else 0
            if last:
                yield _links(rest["k"].to_numpy()[:last], new[:last], rest["fp"].to_numpy()[:last], radius, first)
                rest = rest.iloc[last:].reset_index(drop=True)
        if rest is not None and len(rest):
            new = (rest[cell] != rest[cell].shift()).any(axis=1).to_numpy()
            yield _links(rest["k"].to_numpy(), new, rest["fp"].to_numpy(), radius, first)

    return cells.repartition(*cell).sortWithinPartitions(*cell).mapInPandas(compare, "a bigint, b bigint")


def _links(k: np.ndarray, new: np.ndarray, fp: np.ndarray, radius: int, first: np.ndarray) -> pd.DataFrame:
    """Compare the rows of each cell at all distances; a pair counts in the first key that it shares."""
    run, bits, at, found = np.cumsum(new), fp.view(np.uint64), np.arange(len(fp)), []
    step = 1
    while True:
        at = at[at + step < len(fp)]
        at = at[run[at] == run[at + step]]
        if not len(at):
            break
        apart = bits[at] ^ bits[at + step]
        same = np.packbits(apart.view(np.uint8).reshape(-1, 8) == 0, axis=1, bitorder="little")[:, 0]
        ok = (np.bitwise_count(same) >= 8 - radius) & (first[same] == k[at])  # the tally of agreeing positions
        ok &= np.bitwise_count(apart) <= radius
        found.append(np.stack([at[ok], at[ok] + step]))
        step += 1
    if not found:
        return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
    a, b = np.concatenate(found, axis=1)
    values, index = np.unique(np.concatenate([fp[a], fp[b]]), return_inverse=True)
    x, y = index[:len(a)], index[len(a):]
    root = np.arange(len(values))
    while True:  # least label over the links, then over the labels, until nothing moves
        before = root.copy()
        least = np.minimum(root[x], root[y])
        for side in (x, y):
            np.minimum.at(root, side, least)
            np.minimum.at(root, before[side], least)
        root = root[root]
        if (root == before).all():
            break
    node = np.flatnonzero(root != np.arange(len(values)))
    return pd.DataFrame({"a": values[node], "b": values[root[node]]})


def simhash_groups(docs: DataFrame, words: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, fp, group, component_id`` for each row.

    ``group``: the smallest fingerprint (signed) reachable over links of at most ``radius`` bits; ``component_id``: the
    smallest id in that group. Null and empty texts have fingerprint 0 and link like any other. Null ids count as
    larger than all ids, so a group is null only if all its ids are. Repeated rows are rows of one group.
    """
    rows = saved(fingerprints(docs, words, id_col, text_col))
    unique = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(saved(close_pairs(unique.select("fp"), radius, rows.count())))
    group = F.coalesce("root", "fp")
    named = unique.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", group.alias("group"))
    ids = named.groupBy("group").agg(F.min("least").alias("component_id"))
    return rows.join(named.drop("least"), "fp").join(ids, "group").select("id", "text_hash", "fp", "group", "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = 5, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, all columns as they came: the smallest id, of equal ids the smallest text hash."""
    row = F.struct(F.col("id").isNull(), F.col("id"), F.col("text_hash"))
    kept = (simhash_groups(docs, words, radius, id_col, text_col).groupBy("group")
            .agg(F.min(row).alias("_kept")).select(F.col("_kept.id").alias("_id"), F.col("_kept.text_hash").alias("_hash")))
    rows = docs.withColumn("_row", F.xxhash64(text_col))
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_hash"))
    return rows.join(kept, same, "left_semi").dropDuplicates([id_col, "_row"]).drop("_row")
