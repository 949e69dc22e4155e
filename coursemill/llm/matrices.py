"""Best-fit-decreasing packing into id matrices: a segment tree over free space finds the tightest open row.

Overlong documents are split into full rows and a rest, losing nothing. Every task packs what it reads in chunks of
about a million ids: nothing is shuffled, and a chunk is large enough for its rows to be full to a fraction of a percent.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from coursemill.llm.tokens import default_tokenizer, encoder

CHUNK = 1 << 20


class FreeSpace:
    """Open rows by free space; ``take`` gives a row with the least space that suffices."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.tree = [0] * (2 * self.leaves)  # open rows below each node
        self.rows: list[list[int]] = [[] for _ in range(self.leaves)]

    def _count(self, space: int, by: int) -> None:
        node = space + self.leaves
        while node:
            self.tree[node] += by
            node >>= 1

    def put(self, space: int, row: int) -> None:
        if space:
            self.rows[space].append(row)
            self._count(space, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        node = need + self.leaves
        while not self.tree[node]:  # up and to the right, until some row is below
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.tree[2 * node] else 2 * node + 1
        space = node - self.leaves
        self._count(space, -1)
        return space, self.rows[space].pop()


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Items of each row: longest first, each into the row that it fills most."""
    free, rows = FreeSpace(size), []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = free.take(lengths[item])
        if found is None:
            found = (size, len(rows))
            rows.append([])
        rows[found[1]].append(item)
        free.put(found[0] - lengths[item], found[1])
    return rows


def pack_matrices(docs: DataFrame, size: int = 1024, tokenizer: str | None = None, id_col: str = "doc_id",
                  text_col: str = "text", end_id: int = 0) -> DataFrame:
    """A row per sequence: ``sequence_id, n_tokens, doc_ids, starts, cu_seqlens, ids, position_ids``.

    ``doc_ids`` and ``starts`` (ids of the document before) name the segments, ``cu_seqlens`` has their cumulative lengths
    from 0 on. ``ids`` and ``position_ids`` are one row of a matrix each, ``size`` little-endian unsigned 32-bit numbers:
    ids padded with ``end_id``, positions that start anew with each segment and with the padding. Each document ends with
    ``end_id``; null and empty texts are that id alone; rows that repeat an id are segments each.
    """
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    end, ramp = np.array([end_id], "<u4").tobytes(), np.arange(size, dtype="<u4").tobytes()
    id_type = rows.schema["doc_id"].dataType
    kinds = {"sequence_id": pa.int64(), "n_tokens": pa.int32(), "doc_ids": pa.list_(to_arrow_type(id_type)), "starts": pa.list_(pa.int64()),
             "cu_seqlens": pa.list_(pa.int32()), "ids": pa.binary(), "position_ids": pa.binary()}

    def lay(items: list[tuple], first: int) -> pa.RecordBatch:
        bins = best_fit([len(i[2]) // 4 for i in items], size)
        out = {name: [] for name in kinds}
        for row, own in enumerate(bins):
            segments = [items[i] for i in own]
            lengths = [len(s[2]) // 4 for s in segments]
            used = sum(lengths)
            all_lengths = [*lengths, size - used] if used < size else lengths
            values = (first + row, used, [s[0] for s in segments], [s[1] for s in segments], list(accumulate(lengths, initial=0)),
                      b"".join([*(s[2] for s in segments), end * (size - used)]), b"".join([ramp[:4 * n] for n in all_lengths]))
            for column, value in zip(out.values(), values):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(out[n], kind) for n, kind in kinds.items()], [*kinds])

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, following, items, n = encoder(path), TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for key, ids in zip(part.column(0).to_pylist(), code.encode(part.column(1).to_pylist())):
                    ids += end
                    items += [(key, a // 4, ids[a:a + 4 * size]) for a in range(0, len(ids), 4 * size)]
                    n += len(ids) // 4
                    if n >= CHUNK:
                        out = lay(items, following)
                        yield out
                        following, items, n = following + out.num_rows, [], 0
        if items:
            yield lay(items, following)

    return rows.mapInArrow(matrices, f"sequence_id bigint, n_tokens int, doc_ids array<{id_type.simpleString()}>, starts array<bigint>, "
                                     "cu_seqlens array<int>, ids binary, position_ids binary")
