"""A Merkle manifest of a dataset, and a version of it for each row that has changed.

Rows are leaves in trees, one tree for each value of a column, by ascending key; each run of FAN consecutive nodes becomes
their digest until one is left. The trees' roots, by the column's value, are the leaves of one more tree, whose root
stands for the dataset.

Leaves are numbered by a range shuffle and cut into aligned blocks of FAN ** LEVELS, each of which folds to one node
LEVELS higher. These nodes are cut into blocks again, and so on: no task meets more than a block, and each table above
the leaves is that many times smaller. On the way down each block gets the siblings on its own path to the root.

Nodes are never changed. A changed leaf makes a version of its own: it copies only the nodes above that leaf, inside its
block first, then by the siblings of the block's path through the upper tables, and shares all others with the tree.

NULL is the least value of the tree's column and of the key, and counts as ``-`` in a leaf. Equal rows are leaves of
equal digest, so their order doesn't matter; very many of them are still spread over tasks and blocks. A table without
rows has no leaves and no root. Rows hold nothing but digests after the first scan, however long their texts are. Only
the columns named are read, so others may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

FAN = 3
LEVELS = 7  # of a block, which so has 2187 nodes

#: a path from a node upwards: for each level its place in the run and the digests of the run's others, in order
PATH = "array<struct<at:int,others:array<string>>>"
WITHIN_FILE = (1 << 33) - 1  # the part of monotonically_increasing_id that counts a partition's rows


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(*values: Column) -> Column:
    """The digest of a row's values: ``-`` for NULL, else the UTF-8 length, a colon and the value as text."""
    def one(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(one, values)), 256)


def height(nodes: int) -> int:
    """Levels above so many nodes."""
    levels, left = 0, nodes
    while left > 1:
        levels, left = levels + 1, -(-left // FAN)
    return levels


class Block:
    """Aligned nodes of one tree with all levels above them in the block."""

    def __init__(self, nodes: list[str], levels: int):
        self.levels = [nodes]
        for _ in range(levels):
            below = self.levels[-1]
            self.levels.append([digest(below[i:i + FAN]) for i in range(0, len(below), FAN)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, i: int) -> list[tuple[int, list[str]]]:
        """From node i to the block's top."""
        out = []
        for nodes in self.levels[:-1]:
            first, at = i - i % FAN, i % FAN
            out.append((at, [n for k, n in enumerate(nodes[first:first + FAN]) if k != at]))
            i //= FAN
        return out


def copied(node: str, path: Sequence[tuple[int, list[str]]]) -> list[str]:
    """The nodes that a version copies: those above ``node`` along a path, lowest first. All others are shared."""
    out = []
    for at, others in path:
        node = digest([*others[:at], node, *others[at:]])
        out.append(node)
    return out


def _numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Rows of ``tree`` with ``place`` (from 0, by ``order``) and ``n``, the tree's rows.

    Ranges of rows are counted, so a tree of any size is spread over tasks; ``nth``, a number of the row, splits equals.
    """
    by = ["tree", *order, "nth"]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(WITHIN_FILE).alias("at"))
    ranged = written(ranged, name)
    parts = ranged.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    each = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(each.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(each).alias("n"))
    placed = ranged.join(written(parts, name), ["tree", "part"])
    return placed.withColumn("place", F.col("at") + F.col("shift")).drop("part", "at", "shift", "nth")


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"place div {FAN**levels}"))


def _block_of(table: pa.Table, levels: int) -> tuple[pa.Table, Block]:
    table = table.sort_by("place")
    return table, Block(table["digest"].to_pylist(), min(levels, height(table["n"][0].as_py())))


def _tables(nodes: DataFrame, levels: int, name: str) -> list[DataFrame]:
    """``nodes`` and the tables above it; in the last each tree has one node."""

    def fold(table: pa.Table) -> pa.Table:
        """A block's nodes to one node of the next table."""
        table, block = _block_of(table, levels)
        n = -(-table["n"][0].as_py() // FAN**levels)
        return pa.table({"tree": table["tree"][:1], "place": table["block"][:1], "n": pa.array([n], pa.int64()), "digest": [block.top]})

    tables = [nodes]
    while (tables[-1].agg(F.max("n")).first()[0] or 0) > 1:
        cut = _in_blocks(tables[-1].select("tree", "place", "n", "digest"), levels)
        up = cut.groupBy("tree", "block").applyInArrow(fold, "tree string, place long, n long, digest string")
        tables.append(written(up, name))
    return tables


PATHS = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.list_(pa.string()))]))


def _as_arrow(paths: list) -> pa.Array:
    return pa.array([[{"at": at, "others": others} for at, others in path] for path in paths], PATHS)


def _upper(above: pa.Table) -> list[tuple[int, list[str]]]:
    return [(step["at"], step["others"]) for step in above["path"][0].as_py()]


def _with_paths(nodes: DataFrame, above: DataFrame, levels: int, work: Callable, schema: str) -> DataFrame:
    """Nodes, block by block, beside the path of the block they are in: ``work(nodes, block, path)`` gives the columns
    beside ``subroot`` and ``root``."""

    def run(own: pa.Table, above: pa.Table) -> pa.Table:
        own, block = _block_of(own, levels)
        upper = [(step["at"], step["others"]) for step in above["path"][0].as_py()]
        same = {c: pa.array([above[c][0].as_py()] * own.num_rows, pa.string()) for c in ("subroot", "root")}
        return pa.table({**work(own, block, upper), **same})

    blocks = above.withColumnRenamed("place", "block").groupBy("tree", "block")
    return _in_blocks(nodes, levels).groupBy("tree", "block").cogroup(blocks).applyInArrow(run, f"{schema}, subroot string, root string, path {PATH}")


def _steps(own: pa.Table, block: Block, upper: list) -> dict:
    """The path of each node: inside its block, then its block's own."""
    return {"tree": own["tree"], "place": own["place"], "path": _as_arrow([block.path(i) + upper for i in range(own.num_rows)])}


def _leaves(own: pa.Table, block: Block, upper: list) -> dict:
    """Each leaf's proof, and the nodes that its version copies: first those in its block, then those above."""
    paths, versions = [], []
    for i, (leaf, changed) in enumerate(zip(own["digest"].to_pylist(), own["changed"].to_pylist())):
        inside = block.path(i)
        version = copied(changed or leaf, inside)
        versions.append(version + copied(version[-1] if version else changed or leaf, upper))
        paths.append(inside + upper)
    kept = {c: own[c] for c in ("key", "group", "place", "digest", "changed")}
    return {**kept, "path": _as_arrow(paths), "version": pa.array(versions, pa.list_(pa.string()))}


def _paths(tables: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """Paths of the nodes of the first of some tables, from the paths of those above the last."""
    paths = tops
    for nodes in reversed(tables):
        paths = written(_with_paths(nodes.select("tree", "place", "n", "digest"), paths, levels, _steps, "tree string, place long"), "paths")
    return paths


def manifest(
    docs: DataFrame, values: dict[str, Column], tree: str, key: str,
    changed: dict[str, Column] | None = None, when: Column | None = None, levels: int = LEVELS,
) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``tree``, ``place long`` (in the tree, from 0), ``leaf``, ``subroot``,
    ``root``, ``proof`` (PATH: the siblings from the leaf to the root), ``changed_leaf``, ``version array<string>`` (the
    nodes its version copies, lowest first), ``folded_root`` and ``verified``.

    A leaf is the digest of ``values`` in order. Where ``when`` holds, ``changed`` replaces some of them; the leaf of
    those is folded with the siblings of the unchanged tree. Elsewhere ``changed_leaf`` is NULL and the leaf itself is.
    """
    group = values[tree].cast("string")
    hit = F.lit(False) if when is None else F.coalesce(when, F.lit(False))
    leaves = docs.select(
        values[key].alias("key"),
        group.alias("group"),
        F.coalesce(F.concat(F.lit("1"), group), F.lit("0")).alias("tree"),  # NULL comes first and is a key like others
        leaf_digest(*values.values()).alias("digest"),
        F.when(hit, leaf_digest(*(values | (changed or {})).values())).alias("changed"),
        F.monotonically_increasing_id().alias("nth"),
    )
    tables = _tables(_numbered(written(leaves, "leaves"), ["key", "digest"], "placed"), levels, "nodes")
    subroots = tables[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("digest"), F.lit(0).alias("nth"))
    upper = _tables(_numbered(subroots, ["name"], "subroots"), levels, "tops")
    root = upper[-1].select("tree", "place", F.col("digest").alias("root"), F.lit("").alias("subroot"), F.expr(f"cast(array() as {PATH})").alias("path"))
    above = _paths(upper[:-1], root, levels).select("place", "root", "path")
    tops = upper[0].select("place", "name", F.col("digest").alias("subroot")).join(above, "place")
    tops = tops.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("place"), "subroot", "root", "path")
    above = _paths(tables[1:-1], written(tops, "paths"), levels)
    kind = tables[0].schema["key"].dataType.simpleString()
    found = _with_paths(tables[0], above, levels, _leaves, f"key {kind}, group string, place long, digest string, changed string, version array<string>")
    folded = F.coalesce(F.try_element_at("version", F.lit(-1)), F.col("changed"), F.col("digest"))
    return found.select(
        F.col("key").alias(key),
        F.col("group").alias(tree),
        "place",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.col("path").alias("proof"),
        F.col("changed").alias("changed_leaf"),
        "version",
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf to the root."""
    return F.sha2(F.array_join(F.flatten(F.transform(proof, lambda step: step["others"])), ""), 256)
