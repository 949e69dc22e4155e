"""The manifest against a tree built level by level."""

from __future__ import annotations

from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from coursemill.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS))


def tree(leaves):
    """Root, and the siblings of each leaf."""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for path, i in zip(paths, at):
            if i ^ 1 < len(level):
                path.append(level[i ^ 1])
        level, at = [h(*level[i:i + 2]) for i in range(0, len(level), 2)], [i // 2 for i in at]
    return level[0], paths


def plain(rows):
    """Sorted ``(doc_id, leaf, subroot, root, proof)``."""
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r["doc_id"]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = [tree([x[2] for x in sorted(groups[g])]) for g in names]
    root, above = tree([s for s, _ in subs])
    return sorted((str(i), own, sub, root, h(*path, *up)) for g, (sub, paths), up in zip(names, subs, above)
                  for (*_, own, i), path in zip(sorted(groups[g]), paths))


def check(docs, height):
    out = merkle.manifest(docs, COLUMNS, "lang", "doc_id", {"extra": F.col("source")}, height)
    got = out.select("*", merkle.folded(F.col("leaf"), F.col("witness")).alias("up"), merkle.proof_digest(F.col("witness")).alias("proof"))
    rows = got.collect()
    assert all(r["up"] == r["root"] for r in rows)
    assert sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["proof"]) for r in rows) == plain(docs.collect())
    return rows


@pytest.mark.parametrize("height, sizes", [(1, [1, 2, 3, 7, 9]), (2, [4, 5, 16, 17, 33]), (2, [19]), (11, [1]), (3, [64, 65])])
def test_trees_of_any_size_over_blocks_of_any_height(docs, height, sizes):
    names = [None, "", "de", "en", "fr"]
    rows = [(1000 * g + 7 * i, f"text {i}", names[g], "a") for g, n in enumerate(sizes) for i in range(n)]
    assert len(check(docs(*rows), height)) == sum(sizes)


def test_hard_rows_and_empty_table(docs, hard):
    check(hard, 1)
    same = docs(*[(5, "same", "en", "a")] * 9, *[(None, None, None, None)] * 3)
    check(same, 1)
    assert merkle.manifest(hard.limit(0), COLUMNS, "lang", "doc_id").collect() == []


def test_a_changed_row_does_not_fold_to_the_root(docs):
    rows = merkle.manifest(docs(*[(i, f"t{i}", "en", "a") for i in range(11)]), COLUMNS, "lang", "doc_id", height=2)
    assert not any(r[0] for r in rows.select(merkle.folded(F.sha2(F.col("leaf"), 256), F.col("witness")) == F.col("root")).collect())


def test_appends_keep_witnesses_whole_while_the_stream_goes_on():
    stream, leaves = merkle.Appends(), [h(str(i)) for i in range(13)]
    for n, own in enumerate(leaves, 1):
        stream.append(own)
        assert sum(1 << height for height, _, _ in stream.open) == n
    assert stream.end(None) == tree(leaves)[0]
    assert [[s[1:] for s in w if s != merkle.ALONE] for w in stream.witness] == tree(leaves)[1]
