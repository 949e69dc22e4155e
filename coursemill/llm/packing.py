"""Order-preserving packing: window cuts by dynamic programming over all places, with monotone queues.

Documents follow each other in stored order (or by given columns), each with an end id. A window holds at most ``size``
ids and costs its padding: nothing if its length is a power of two (an eighth of ``size`` at least), else what is missing. A cut costs nothing at a
document end, a little at a sentence end, more inside a sentence. The least cost of all ids before a place is that of the
best window that ends there; since padding grows by one with each id that a window begins later, its best start is the
head of a monotone queue of the places up to ``size`` ids back, or a power of two away. That is the minimum over all cuts.

Every task packs what it reads, in chunks of about four million ids, so nothing is shuffled and memory is bounded. A chunk
is cut into lanes of a few full windows each, which take their steps side by side. A lane ends at a sentence end a little
before it is full: the ids that it lacks are the padding that its inner cuts may spend to reach sentence ends too.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from coursemill.llm.tokens import default_tokenizer, encoder

#: Ids of a chunk and of a lane, and the costs of a cut at a sentence end and inside a sentence, in ids of padding.
CHUNK, LANE, SENTENCE_CUT, INNER_CUT = 1 << 22, 1 << 12, 1.0, 32.0
#: Ids that are looked up at once, and pieces that Spark is sent at once: a chunk's ids are 16 MB.
LOOKED_UP, SENT = 1 << 16, 1 << 10


def unpadded(size: int) -> list[int]:
    """Powers of two that a window may be long without padding: an eighth of ``size`` at least."""
    return [1 << b for b in range(size.bit_length()) if size <= 8 << b]


def padding(length: int, size: int) -> int:
    return 0 if length in unpadded(size) else size - length


def lane_cuts(price: np.ndarray, length: np.ndarray, size: int) -> tuple[list[list[int]], np.ndarray]:
    """Window edges (0 first, its length last) of each lane, and what they cost.

    ``price[p, lane]`` is that of a cut before id ``p`` of a lane; lanes are ``length`` ids long.
    """
    steps, lanes = price.shape
    own = np.arange(lanes)
    # Costs are kept for the places that a window may begin at, cuts as the length of the window before them.
    recent = (1 << (size - 1).bit_length()) - 1
    best, least = np.zeros((recent + 1, lanes), np.float32), np.zeros(lanes, np.float32)
    ended = {n: np.flatnonzero(length == n) for n in np.unique(length).tolist()}
    source = np.zeros((steps, lanes), np.min_scalar_type(size))
    shorts = [w for w in unpadded(size) if w < size]
    # Queues of places, the cheapest start first: rings of a power of two entries, one behind the other.
    mask = (1 << size.bit_length()) - 1
    base = own * (mask + 1)
    worth, place = np.zeros(lanes * (mask + 1), np.float32), np.zeros(lanes * (mask + 1), np.int32)
    head, tail = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)  # entries head to below tail
    for p in range(1, steps):
        new = best[(p - 1) & recent] + np.float32(p - 1)
        # Starts that are no cheaper and leave the window sooner are of no more use.
        over = np.flatnonzero((worth[base + ((tail - 1) & mask)] >= new) & (tail > head))
        while len(over):
            tail[over] -= 1
            over = over[tail[over] > head[over]]
            over = over[worth[base[over] + ((tail[over] - 1) & mask)] >= new[over]]
        at = base + (tail & mask)
        worth[at] = new
        place[at] = p - 1
        tail += 1
        first = base + (head & mask)
        start = place[first]
        if p > size:
            gone = start < p - size
            if gone.any():
                head += gone
                first = base + (head & mask)
                start = place[first]
        cost = worth[first] + np.float32(size - p)
        for short in shorts:
            if p >= short:
                free = best[(p - short) & recent]
                better = free < cost
                cost = np.where(better, free, cost)
                start = np.where(better, p - short, start)
        source[p] = p - start
        np.add(cost, price[p], out=best[p & recent])
        if p in ended:
            least[ended[p]] = cost[ended[p]]
    edges = []
    for lane, end in enumerate(length.tolist()):
        at, cuts = end, [end]
        while at > 0:
            at -= int(source[at, lane])
            cuts.append(at)
        edges.append(cuts[::-1])
    return edges, least


def lane_starts(ends: np.ndarray, lane: int) -> np.ndarray:
    """Where lanes of at most ``lane`` ids begin: at the last end that leaves the lane before short of 3 ids in 512 or more.

    Without one within a 64th of the lane it is the last end at all there, else the lane is full.
    """
    least, most, stops, starts = lane * 3 // 512, lane // 64, ends.tolist(), [0]
    while stops[-1] - starts[-1] > lane:
        full = starts[-1] + lane
        for upto in (full - least, full):
            at = bisect_right(stops, upto) - 1
            if at >= 0 and stops[at] > max(full - most, starts[-1]):
                starts.append(stops[at])
                break
        else:
            starts.append(full)
    return np.array(starts)


def window_cuts(ends: np.ndarray, is_document: np.ndarray, size: int = 1024, lane: int = LANE) -> list[int]:
    """Window edges (0 first, the total last) over ids whose sentences end at ``ends``, in order, the last at the total.

    They cost the least of all that have an edge wherever a lane begins; ``lane`` is rounded to a multiple of ``size``.
    """
    total = int(ends[-1])
    begin = lane_starts(ends, size * max(1, lane // size))
    length = np.diff(np.append(begin, total))
    price = np.full((int(length.max()) + 1, len(length)), INNER_CUT, np.float16)  # which holds the costs exactly
    own = np.searchsorted(begin, ends - 1, "right") - 1
    price[ends - begin[own], own] = np.where(is_document, 0.0, SENTENCE_CUT)
    edges = [0]
    for a, cuts in zip(begin.tolist(), lane_cuts(price, length, size)[0]):
        edges.extend(a + c for c in cuts[1:])
    # What is left at the very end is cut into powers of two where that is cheaper.
    rest, last = edges[-1] - edges[-2], edges[-2]
    if padding(rest, size) > INNER_CUT * (rest.bit_count() - 1):
        edges[-1:] = [last := last + (1 << b) for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return edges


def _pack(keys: list, coded: list[bytes], ends: np.ndarray, size: int, first: int, kind: pa.DataType) -> tuple[pa.RecordBatch, int]:
    """Pieces of one chunk; ``first``: the sequence id to begin with. Empties ``coded``, whose ids are held joined."""
    raw = b"".join(coded)
    ids = np.frombuffer(raw, "<u4")
    stops = np.cumsum([len(c) // 4 for c in coded])
    last = np.zeros(len(ids), bool)
    last[stops - 1] = True
    coded.clear()
    stop = last.copy()
    for a in range(0, len(ids), LOOKED_UP):
        stop[a:a + LOOKED_UP] |= ends.take(ids[a:a + LOOKED_UP], mode="clip")
    at = np.flatnonzero(stop)
    del stop
    cuts = np.array(window_cuts(at + 1, last[at], size))
    edges = np.union1d(cuts, stops)
    edges = edges[edges > 0]
    a = np.concatenate(([0], edges[:-1]))
    doc = np.searchsorted(stops, a, "right")
    starts = np.concatenate(([0], stops[:-1]))
    seq = np.searchsorted(cuts, a, "right") - 1
    pieces = pa.Array.from_buffers(pa.binary(), len(edges), [None, pa.py_buffer(np.concatenate(([0], 4 * edges)).astype(np.int32)), pa.py_buffer(raw)])
    columns = [pa.array(keys, kind).take(pa.array(doc)), pa.array(a - starts[doc]), pa.array(edges - a), pa.array((stops - starts)[doc]),
               pa.array(first + seq), pa.array(a - cuts[seq]), pieces]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]), first + len(cuts) - 1


def pack_in_order(docs: DataFrame, size: int = 1024, tokenizer: str | None = None, order: list[str] | None = None,
                  id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """A row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids`` (little-endian unsigned 32-bit).

    The pieces of a sequence fill it from offset 0 on without gaps, in document order; each id of each document is in one
    piece. Null and empty texts are their end id alone. Rows that repeat an id are packed one after the other; ids may be
    null and of any type. With ``order`` rows are first sorted by range; without, they keep the order in which they are
    stored.
    """
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order or [])])
    if order:
        by = [f"_order{i}" for i in range(len(order))]
        rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop(*by)
    end = np.array([end_id], "<u4").tobytes()
    id_type = rows.schema["doc_id"].dataType
    kind = to_arrow_type(id_type)

    def sent(out: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        return (out.slice(at, SENT) for at in range(0, out.num_rows, SENT))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        following = TaskContext.get().partitionId() << 33
        keys, coded, n = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for key, ids in zip(part.column(0).to_pylist(), code.encode(part.column(1).to_pylist())):
                    keys.append(key)
                    coded.append(ids + end)
                    n += len(ids) // 4 + 1
                    if n >= CHUNK:
                        out, following = _pack(keys, coded, code.ends, size, following, kind)
                        yield from sent(out)
                        keys, coded, n = [], [], 0
        if keys:
            yield from sent(_pack(keys, coded, code.ends, size, following, kind)[0])

    return rows.mapInArrow(pieces, f"doc_id {id_type.simpleString()}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
                                   "offset bigint, ids binary")
