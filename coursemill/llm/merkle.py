"""Merkle manifest of a table: every row a leaf, a tree per group, a tree of the groups, and a witness for each row.

Rows of a group stand in order and are cut into aligned blocks of ``2 ** HEIGHT``. A block is a stream that is appended
leaf by leaf: the open subtrees stand side by side, largest first, and each of their rows has a partial witness, the
siblings met so far. When two open subtrees of one height meet, they close into one, and each side's witnesses are
extended by the other's root. At the end of a stream a subtree without a sibling is hashed alone until it meets the next.

The roots of all blocks are the appends of the next round, so a tree of any size takes a few rounds, each over a table
``2 ** HEIGHT`` times smaller; the last round is over the groups. At the end a row's witness is that of its block's root
put behind its own. Rows are hashed where they are read; only digests, ids and groups are shuffled.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursemill.llm.common import saved

#: Leaves of a block are 2 to this power.
HEIGHT = 11

#: A step of a witness: where the sibling stands and its digest, or that there is none.
LEFT, RIGHT, ALONE = "l", "r", "-"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_text(columns: list[str]) -> Column:
    """The text of a row: each value as ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    values = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in values])


class Appends:
    """Open subtrees of a stream of digests, and the partial witnesses of all that was appended."""

    def __init__(self) -> None:
        self.open: list[tuple[int, int, str]] = []  # height, first leaf, root
        self.witness: list[list[str]] = []

    def append(self, leaf: str) -> None:
        self.open.append((0, len(self.witness), leaf))
        self.witness.append([])
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._close_two()

    def _close_two(self) -> None:
        height, first, left = self.open[-2]
        _, middle, right = self.open.pop()
        for own in self.witness[first:middle]:
            own.append(RIGHT + right)
        for own in self.witness[middle:]:
            own.append(LEFT + left)
        self.open[-1] = (height + 1, first, digest(left + right))

    def _alone(self) -> None:
        height, first, root = self.open[-1]
        for own in self.witness[first:]:
            own.append(ALONE)
        self.open[-1] = (height + 1, first, digest(root))

    def end(self, height: int | None) -> str:
        """End the stream: the root of everything, raised to ``height`` if that is given."""
        while len(self.open) > 1:
            if self.open[-1][0] < self.open[-2][0]:
                self._alone()
            else:
                self._close_two()
        while height is not None and self.open[0][0] < height:
            self._alone()
        return self.open[0][2]


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``pos``, a row's place in its group by ``order`` from 0, and ``n``, the group's size; whole-equal rows are dealt out too.

    Rows are sorted by range; only the sizes of each group in each range meet to be added up.
    """
    by = [group, *order, "_tie"]
    # Rows have been written, so that the running number is the same each time they are read.
    parts = saved(saved(rows).withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(group).orderBy("_part")
    before = sizes.select(group, "_part", (F.sum("_size").over(earlier) - F.col("_size")).alias("_before"),
                          F.sum("_size").over(Window.partitionBy(group)).alias("n"))
    place = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order, "_tie"))
    return (parts.withColumn("_place", place).join(before, [group, "_part"])
            .withColumn("pos", F.col("_before") + F.col("_place") - 1).drop("_part", "_place", "_before", "_tie"))


def _appended(block: pa.Table, height: int) -> tuple[pa.Table, Appends, str]:
    """A block's rows in order, appended one after the other, and its root."""
    block = block.sort_by("pos")
    stream = Appends()
    for leaf in block["node"].to_pylist():
        stream.append(leaf)
    several = block["n"][0].as_py() > 1 << height
    return block, stream, stream.end(height if several else None)


def _up(n: int, height: int) -> int:
    """Blocks of ``n`` nodes."""
    return (n + (1 << height) - 1) >> height


def _block(height: int) -> Column:
    return F.shiftright("pos", height).alias("_block")


def _roots(nodes: DataFrame, height: int) -> DataFrame:
    """The roots of all blocks of ``_g, pos, n, node`` as the nodes of the next round."""
    def root(rows: pa.Table) -> pa.Table:
        own, _, top = _appended(rows, height)
        n, pos = own["n"][0].as_py(), own["pos"][0].as_py()
        return pa.table({"_g": pa.array([own["_g"][0].as_py()], pa.string()), "pos": pa.array([pos >> height], pa.int64()),
                         "n": pa.array([_up(n, height)], pa.int64()), "node": pa.array([top], pa.string())})

    return nodes.groupBy("_g", _block(height)).applyInArrow(root, "_g string, pos bigint, n bigint, node string")


def _behind(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """Each node with its steps inside its block, then those of the block's root, and what else is known of that root."""
    further = [f for f in above.schema.fields if f.name not in ("_g", "pos", "witness")]
    fields = [*nodes.schema.fields, above.schema["witness"], *further]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, stream, _ = _appended(left, height)
        steps = right["witness"][0].as_py()
        out = rows.append_column("witness", pa.array([w + steps for w in stream.witness], pa.list_(pa.string())))
        for f in further:
            out = out.append_column(f.name, pa.array([right[f.name][0].as_py()] * len(rows), pa.string()))
        return out

    return nodes.groupBy("_g", _block(height)).cogroup(above.groupBy("_g", F.col("pos").alias("_block"))).applyInArrow(join, schema)


def climb(nodes: DataFrame, height: int = HEIGHT) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of each round, ``_g, pos, n, node`` from the leaves on, and the root of each group."""
    largest, levels = nodes.agg(F.max("n")).first()[0] or 0, []
    while largest > 1 or not levels:
        levels.append(nodes)
        nodes = saved(_roots(nodes.select("_g", "pos", "n", "node"), height))
        largest = _up(largest, height)
    return levels, nodes


def descend(levels: list[DataFrame], above: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The leaves with their witnesses, from those of the groups' roots: ``_g, pos, witness`` and columns of text."""
    for level in reversed(levels[1:]):
        above = saved(_behind(level, above, height).drop("n", "node"))
    return _behind(levels[0], above, height)


def manifest(rows: DataFrame, columns: list[str], group: str, order: str, keep: dict[str, Column] | None = None,
             height: int = HEIGHT) -> DataFrame:
    """A row per row: ``order`` column, ``group`` column, those of ``keep``, ``leaf``, ``subroot``, ``root``, ``witness``.

    ``columns`` make the leaf. In a group leaves ascend by ``order`` (null first), equal ones by their digest, so equal rows
    are leaves of their own; groups ascend bytewise, null first. Null and empty texts differ in the leaf. A witness has a
    step for each level up to the root: ``l`` or ``r`` and the digest of the sibling on that side, or ``-`` without one.
    An empty table has no rows. Other columns are dropped.
    """
    kept = {f"_k{i}": n for i, n in enumerate(keep or {})}
    own = rows.select(F.col(order).alias("_o"), F.col(group).alias("_name"), F.sha2(leaf_text(columns), 256).alias("node"),
                      *[keep[n].alias(k) for k, n in kept.items()])
    # Null before all others, which keep their bytewise order behind a mark.
    own = own.withColumn("_g", F.when(F.col("_name").isNull(), "").otherwise(F.concat(F.lit("="), "_name")))
    levels, subroots = climb(saved(numbered(own, "_g", ["_o", "node"])), height)
    groups = subroots.select(F.lit("").alias("_g"), F.col("_g").alias("_member"), "node")
    group_levels, top = climb(saved(numbered(groups, "_g", ["_member"])), height)
    above = descend(group_levels, top.select("_g", "pos", F.array().cast("array<string>").alias("witness"), F.col("node").alias("root")), height)
    above = saved(above.select(F.col("_member").alias("_g"), F.lit(0).cast("bigint").alias("pos"), "witness", F.col("node").alias("subroot"), "root"))
    return descend(levels, above, height).select(
        F.col("_o").alias(order), F.col("_name").alias(group), *[F.col(k).alias(n) for k, n in kept.items()],
        F.col("node").alias("leaf"), "subroot", "root", "witness")


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its witness give."""
    def up(node: Column, step: Column) -> Column:
        other = F.substring(step, 2, 64)
        return F.sha2(F.when(step.startswith(LEFT), F.concat(other, node)).otherwise(F.concat(node, other)), 256)

    return F.aggregate(witness, leaf, up)


def proof_digest(witness: Column) -> Column:
    """Digest of all siblings, level by level."""
    return F.sha2(F.concat_ws("", F.transform(witness, lambda step: F.substring(step, 2, 64))), 256)

