"""Approximate nearest neighbours by cosine with a hierarchical k-means tree.

The upper tree is fitted on a bounded sample and holds only centres, at most ``MAX_LEAVES``, so it can be given to
every task. Every vector is put into its leaf. A leaf with more than ``SPLIT_ROWS`` vectors gets a tree of its own,
fitted on a bounded sample of its rows, so the number of leaves grows with the table. Such trees are a table beside the
vectors: they meet vectors and queries by leaf, in blocks.

A query walks a tree best-bin-first: a priority queue holds the branches seen but not taken, by the least angle that
a leaf below can have to the query. Leaves come out nearest first, and visits widen up to a calibrated angle. That
angle is the one within which the wanted share of true neighbours lies, found for a fixed number of probes against
all vectors; so a query in a crowd of leaves visits many, and one far from most visits few.

Vectors meet queries leaf by leaf; a leaf is cut into blocks of bounded size, so a leaf that holds a third of all
vectors is many tasks. Equal vectors are kept once with their smallest ids, which are all that can be among the
nearest.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .held import held

SAMPLE_ROWS = 20_000  # vectors that a tree is fitted on
BRANCHES = 8
LEAF_ROWS = 400  # a leaf of about so many vectors in the whole table
MAX_LEAVES = 4_096  # leaves of one tree
SPLIT_ROWS = BRANCHES * LEAF_ROWS  # a leaf of more vectors gets its own tree
TREE_ROWS = 20_000  # vectors or queries that meet a leaf's own tree in one block
LEAF_SPACE = 1 << 20  # leaf numbers that a leaf's own tree may use
BLOCK_ROWS = 4_096
CALIBRATION = 400  # probes whose neighbours are looked up among all vectors
LEAST_ROWS = 1_000  # a query visits the leaves of about so many vectors at least
QUERIES_KEPT = 100_000  # queries whose best a task keeps before it hands them on


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


class Tree:
    """Centres by node; children[i] are the numbers of node i's children, none for a leaf. ``least`` leaves are visited
    by every query."""

    def __init__(self, sample: np.ndarray, rows: int, leaf_rows: int = LEAF_ROWS, max_leaves: int = MAX_LEAVES, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.children: list[list[int]] = [[]]
        centres = [np.zeros(sample.shape[1])]
        work = [(0, np.arange(len(sample)))]
        most = max(BRANCHES, leaf_rows * len(sample) / max(rows, 1))
        leaves = 1
        while work:
            node, some = work.pop(0)
            if len(some) <= most or leaves + BRANCHES > max_leaves:
                continue
            found, of = _kmeans(sample[some], rng)
            if len(found) < 2:
                continue
            leaves += len(found) - 1
            for k, centre in enumerate(found):
                self.children[node].append(len(centres))
                work.append((len(centres), some[of == k]))
                self.children.append([])
                centres.append(centre)
        self.centres = np.array(centres)
        self.least = -(-LEAST_ROWS * leaves // max(rows, 1))
        self.spread = self._spreads()

    def _spreads(self) -> np.ndarray:
        """The largest angle between each node's centre and that of a leaf below it."""
        spread, below = np.zeros(len(self.centres)), {}
        for node in range(len(self.centres) - 1, -1, -1):
            below[node] = np.concatenate([below.pop(c) for c in self.children[node]]) if self.children[node] else np.array([node])
            if self.children[node]:
                spread[node] = self.angles(self.centres[node][None], below[node]).max() if node else np.pi
        return spread

    def angles(self, vectors: np.ndarray, nodes: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Angles between unit vectors and centres; the root has none, its row counts as a right angle."""
        return np.arccos(np.clip(vectors @ self.centres[nodes].T, -1, 1))

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector: the nearest child, from the root on."""
        at = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            below = self.children[node]
            if not below or not len(rows):
                at[rows] = node
                continue
            best = np.argmax(vectors[rows] @ self.centres[below].T, axis=1)
            todo += [(child, rows[best == k]) for k, child in enumerate(below)]
        return at

    def leaves_by_nearness(self, vector: np.ndarray) -> Iterator[int]:
        """All leaves, nearest centre first, by a best-bin-first walk."""
        return (leaf for leaf, _ in self._walk(self.angles(vector[None])[0]))

    def visits(self, vectors: np.ndarray, angle: float) -> Iterator[list[int]]:
        """For each unit vector the leaves of centres within ``angle``, at least ``least`` leaves."""
        for angles in self.angles(vectors):
            seen: list[int] = []
            for leaf, apart in self._walk(angles):
                if apart > angle and len(seen) >= self.least:
                    break
                seen.append(leaf)
            yield seen

    def _walk(self, angles: np.ndarray) -> Iterator[tuple[int, float]]:
        """A branch waits by the least angle a leaf below it can have, so no nearer leaf comes after a farther one."""
        queue = [(0.0, 0)]
        bound = np.maximum(angles - self.spread, 0.0).tolist()
        while queue:
            apart, node = heapq.heappop(queue)
            if not self.children[node]:
                yield node, apart
            for below in self.children[node]:
                heapq.heappush(queue, (bound[below], below))


def _kmeans(vectors: np.ndarray, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Unit centres by spherical k-means, empty ones left out, and each vector's."""
    centres = vectors[rng.choice(len(vectors), min(BRANCHES, len(vectors)), replace=False)]
    for _ in range(rounds):
        of = np.argmax(vectors @ centres.T, axis=1)
        sums = np.stack([np.bincount(of, vectors[:, d], minlength=len(centres)) for d in range(vectors.shape[1])], axis=1)
        size = np.linalg.norm(sums, axis=1)
        used = np.flatnonzero((np.bincount(of, minlength=len(centres)) > 0) & (size > 1e-12))
        centres = sums[used] / size[used, None]
    return centres, np.argmax(vectors @ centres.T, axis=1) if len(centres) else np.zeros(len(vectors), np.int64)


def _usable(vector: str) -> Column:
    """Vectors without nulls, non-finite components or zero length."""
    x = F.col(f"`{vector}`")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(fine & F.exists(x, lambda v: v != 0), F.lit(False))


@held
def _load(state: bytes) -> Tree:
    return pickle.loads(state)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def fit_tree(vectors: DataFrame, rows: int, sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS, max_leaves: int = MAX_LEAVES) -> bytes:
    """The upper tree, pickled; fitted in one task on ``sample_rows`` of the ``rows`` vectors (id, x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), _matrix(b.column(1))) for b in batches if b.num_rows]
        if parts:
            order = np.argsort(np.concatenate([p[0] for p in parts]), kind="stable")
            tree = Tree(unit(np.concatenate([p[1] for p in parts])[order]), rows, leaf_rows, max_leaves)
            yield pa.RecordBatch.from_pydict({"state": [pickle.dumps(tree)]})

    some = vectors.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    found = some.coalesce(1).mapInArrow(run, "state binary").collect()
    return bytes(found[0][0]) if found else b""


def _own_trees(placed: DataFrame, sizes: dict[int, int], sample_rows: int, leaf_rows: int, max_leaves: int) -> DataFrame:
    """(top, state): a tree for each leaf in ``sizes``, fitted on at most ``sample_rows`` of its own vectors."""

    def fit(rows: pa.Table) -> pa.Table:
        top = rows.column("top")[0].as_py()
        order = np.argsort(rows.column("id").to_numpy(), kind="stable")
        tree = Tree(unit(_matrix(rows.column("x"))[order]), sizes[top], leaf_rows, max_leaves)
        return pa.table({"top": pa.array([top], pa.int32()), "state": pa.array([pickle.dumps(tree)], pa.binary())})

    # the limit also holds before the shuffle, so a leaf with most of the vectors sends little
    place = F.row_number().over(Window.partitionBy("top").orderBy(F.xxhash64("id"), "id"))
    some = placed.filter(F.col("top").isin(list(sizes))).select("top", "id", "x").withColumn("place", place)
    return some.filter(F.col("place") <= sample_rows).drop("place").groupBy("top").applyInArrow(fit, "top int, state binary")


def _with_own_trees(rows: DataFrame, trees: DataFrame, use: Callable[[Tree, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``use(tree, some of a leaf's rows)`` for all rows (top, id, ...), in blocks of about ``TREE_ROWS``."""
    count = rows.groupBy("top").agg((F.count(F.lit(1)) / TREE_ROWS + 1).cast("int").alias("blocks"))
    blocks = F.broadcast(count)  # a row for each leaf of the upper tree, MAX_LEAVES at most
    dealt = rows.join(blocks, "top").withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) as int)")).drop("blocks")
    states = trees.join(blocks, "top").select("top", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "state")

    def run(some: pa.Table, state: pa.Table) -> pa.Table:
        return use(pickle.loads(state.column("state")[0].as_py()), some)

    return dealt.groupBy("top", "block").cogroup(states.groupBy("top", "block")).applyInArrow(run, schema)


def _true_neighbours(placed: DataFrame, probes: list, k: int) -> DataFrame:
    """(id, y, x, top): the ``k`` true neighbours x of each probe y, found among all vectors."""
    ids, y = np.array([p["id"] for p in probes]), unit(np.array([p["x"] for p in probes], np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = np.full((len(y), 0), -2.0)
        at, x, top = np.zeros((len(y), 0), np.int64), np.zeros((0, y.shape[1])), np.zeros(0, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                more = _matrix(part.column("x"))
                found = y @ unit(more).T
                found[ids[:, None] == part.column("id").to_numpy()[None, :]] = -2
                near = np.hstack([near, found])
                at = np.hstack([at, np.broadcast_to(len(x) + np.arange(len(more)), found.shape)])
                x, top = np.vstack([x, more]), np.concatenate([top, part.column("top").to_numpy()])
                if near.shape[1] > k:
                    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
                    near, at = np.take_along_axis(near, best, 1), np.take_along_axis(at, best, 1)
                used, at = np.unique(at, return_inverse=True)
                at, x, top = at.reshape(near.shape), x[used], top[used]
        probe, place = np.nonzero(near > -2)
        at = at[probe, place]
        yield pa.RecordBatch.from_pydict({
            "id": pa.array(ids[probe], pa.int64()), "near": near[probe, place], "y": _lists(y[probe]), "x": _lists(x[at]), "top": pa.array(top[at], pa.int32()),
        })

    found = placed.select("id", "x", "top").mapInArrow(run, "id long, near double, y array<double>, x array<double>, top int")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("near"), "x"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("id", "y", "x", "top")


def _lists(vectors: np.ndarray) -> pa.Array:
    starts = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(np.ascontiguousarray(vectors).ravel(), pa.float64()))


def _apart(tree: Tree, rows: pa.Table | pa.RecordBatch) -> np.ndarray:
    """The angles between probes and the centres of the leaves that hold their neighbours."""
    y, x = _matrix(rows.column("y")), unit(_matrix(rows.column("x")))
    return np.arccos(np.clip((y * tree.centres[tree.assign(x)]).sum(axis=1), -1, 1))


def _angles(tree: Tree, rows: pa.Table) -> pa.Table:
    return pa.table({"angle": pa.array(_apart(tree, rows) if len(rows) else [], pa.float64())})


def _within(angles: list[float], recall: float) -> float:
    """The angle that holds the wanted share; with nothing to learn from, every leaf."""
    return float(np.quantile(angles, recall, method="higher")) + 1e-7 if angles else float(np.pi)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, recall: float = 0.97, vec_id: str = "vec_id", vector: str = "embedding",
    sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS, max_leaves: int = MAX_LEAVES, split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` vectors found nearest to each query other than its own row, by cosine
    in double precision, ties to the smaller id; fewer if there are fewer.

    ``queries`` has the same two columns. Vectors that are null, zero, or hold null or non-finite components, rows
    with a null id and vectors of another length than most take no part; rows with one id and one vector are one row. Other columns aren't read.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        return df.filter(_usable(vector) & F.col(f"`{vec_id}`").isNotNull()).select(
            F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("x")
        )

    out = "query_id long, rank int, vec_id long, score double"
    usable = clean(vectors)
    size = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if size is None:
        return spark.createDataFrame([], out)
    usable = usable.filter(F.size("x") == size["d"]).distinct()
    asked = clean(queries).filter(F.size("x") == size["d"]).distinct()

    # of equal vectors only the k + 1 smallest ids can be among a query's nearest; the limit also holds before the shuffle
    place = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    few = usable.withColumn("place", place).filter(F.col("place") <= k + 1)
    once = few.groupBy("x").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("id", F.col("ids")[0])
    once = written(once, "vectors")
    rows = once.count()
    shared = spark.sparkContext.broadcast(fit_tree(once.select("id", "x"), rows, sample_rows, leaf_rows, max_leaves))  # centres only
    kind = once.schema["x"].dataType.simpleString()

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = _load(shared.value).assign(unit(_matrix(b.column("x")))) if b.num_rows else np.zeros(0, np.int64)
            yield b.append_column("top", pa.array(leaf, pa.int32()))

    placed = written(once.select("id", "ids", "x").mapInArrow(put, f"id long, ids array<long>, x {kind}, top int"), "placed")
    counted = placed.groupBy("top").count().filter(F.col("count") > split_rows)
    split = {top: n for top, n in counted.collect()}  # max_leaves rows at most
    trees = written(_own_trees(placed, split, sample_rows, leaf_rows, max_leaves), "trees") if split else None
    in_split = F.col("top").isin(list(split)) if split else F.lit(False)

    def located(df: DataFrame, use: Callable[[Tree, pa.Table], pa.Table], schema: str) -> DataFrame:
        """Rows of upper leaves with the leaf's number; those of split ones as ``use`` gives them."""
        fields = [f.split()[0] for f in schema.split(", ")]
        whole = df.filter(~in_split).withColumn("leaf", F.col("top").cast("long") * LEAF_SPACE).select(*fields)
        return whole.union(_with_own_trees(df.filter(in_split), trees, use, schema)) if split else whole

    # how far the leaves of true neighbours are, in the upper tree and in the leaves' own
    probes = once.select("id", "x").orderBy(F.xxhash64("id"), "id").limit(CALIBRATION).collect()
    truth = written(_true_neighbours(placed, probes, k), "truth")

    def upper_angle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_pydict({"angle": _apart(_load(shared.value), b)})

    share = recall ** 0.5 if split else recall  # of each of two steps
    angle = _within([r[0] for r in truth.mapInArrow(upper_angle, "angle double").collect()], share)
    inner = np.pi
    if split:
        inner = _within([r[0] for r in _with_own_trees(truth.filter(in_split), trees, _angles, "angle double").collect()], share)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 256):
                yield _visits(_load(shared.value), b.slice(start, 256), angle, "top", pa.int32())

    def put_below(tree: Tree, some: pa.Table) -> pa.Table:
        leaf = tree.assign(unit(_matrix(some.column("x")))) if len(some) else np.zeros(0, np.int64)
        numbers = some.column("top").to_numpy().astype(np.int64) * LEAF_SPACE + leaf
        return some.select(["id", "ids", "x"]).append_column("leaf", pa.array(numbers, pa.int64()))

    def walk_below(tree: Tree, some: pa.Table) -> pa.Table:
        parts = [_visits(tree, b.slice(start, 256), inner, "leaf", pa.int64()) for b in some.combine_chunks().to_batches() for start in range(0, b.num_rows, 256)]
        if not parts:
            return some.select(["id", "x"]).append_column("leaf", pa.array([], pa.int64()))
        found = pa.Table.from_batches(parts)
        numbers = found.column("top").to_numpy().astype(np.int64) * LEAF_SPACE + found.column("leaf").to_numpy()
        return found.select(["id", "x"]).append_column("leaf", pa.array(numbers, pa.int64()))

    stored = placed
    if split:
        stored = written(located(placed, put_below, f"id long, ids array<long>, x {kind}, leaf long"), "leaves")
    else:
        stored = located(placed, put_below, f"id long, ids array<long>, x {kind}, leaf long")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    upper = asked.repartition(tasks, "id").mapInArrow(walk, f"id long, x {kind}, top int")
    asked = written(located(written(upper, "visits") if split else upper, walk_below, f"id long, x {kind}, leaf long"), "visits")

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("leaf").agg((F.count(F.lit(1)) / BLOCK_ROWS + 1).cast("int").alias(name))

    # leaves that are visited, with the blocks of either side
    met = written(blocks(stored, "vs").join(blocks(asked, "qs"), "leaf"), "met")

    def dealt(df: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        """Each row in its block, once for each block of the other side."""
        return df.join(met, "leaf").withColumns({
            mine: F.expr(f"cast(pmod(xxhash64(id), {own}) as int)"), theirs: F.explode(F.expr(f"sequence(0, {other} - 1)")),
        })

    left = dealt(stored, "vs", "qs", "v", "q").withColumn("is_vector", F.lit(True))
    right = dealt(asked, "qs", "vs", "q", "v").withColumns({"is_vector": F.lit(False), "ids": F.lit(None).cast("array<long>")})
    columns = ["leaf", "v", "q", "is_vector", "id", "ids", "x"]
    both = left.select(*columns).union(right.select(*columns)).repartition("leaf", "v", "q").sortWithinPartitions("leaf", "v", "q", "is_vector")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries come before their block's vectors. A task keeps the best of each query over all its blocks."""
        best: dict[int, list[tuple[float, int]]] = {}
        now, asking = None, []
        for batch in batches:
            group = np.stack([batch.column(i).to_numpy() for i in range(3)] + [batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)])
            cuts = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                block, part = tuple(group[:3, a].tolist()), batch.slice(a, b - a)
                if block != now:
                    now, asking = block, []
                if not group[3, a]:
                    asking.append(part.select(["id", "x"]))
                else:
                    for queries in asking:
                        _keep_nearest(part, queries, k, best)
            if len(best) > QUERIES_KEPT:
                yield _found(best)
                best = {}
        yield _found(best)

    found = both.mapInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _visits(tree: Tree, some: pa.RecordBatch, angle: float, name: str, kind: pa.DataType) -> pa.RecordBatch:
    """Each query once for each leaf that it visits."""
    leaves = list(tree.visits(unit(_matrix(some.column("x"))), angle))
    at = pa.array(np.repeat(np.arange(some.num_rows), [len(x) for x in leaves]))
    return some.take(at).append_column(name, pa.array([x for seen in leaves for x in seen], kind))


def _keep_nearest(some: pa.RecordBatch, asking: pa.RecordBatch, k: int, best: dict[int, list[tuple[float, int]]]) -> None:
    """Merges the ``k`` nearest of some vectors, by cosine, into the best (-score, id) of each query."""
    x, y = _matrix(some.column("x")), _matrix(asking.column("x"))
    first, copies = some.column("id").to_numpy(), some.column("ids").to_pylist()
    norms, most = np.linalg.norm(x, axis=1), min(k + 1, len(x))
    for start in range(0, len(y), 256):
        part = y[start:start + 256]
        near = (part @ x.T) / (np.linalg.norm(part, axis=1)[:, None] * norms)
        bound = np.partition(near, len(x) - most, axis=1)[:, len(x) - most]
        for q, row, least in zip(asking.column("id")[start:start + 256].to_pylist(), near, bound):
            before = best.get(q, [])
            at = np.flatnonzero(row >= (max(least, -before[-1][0]) if len(before) == k else least))
            if len(at):
                at = at[np.lexsort((first[at], -row[at]))][:most]
                best[q] = sorted(before + [(-float(row[i]), c) for i in at.tolist() for c in copies[i] if c != q])[:k]


def _found(best: dict[int, list[tuple[float, int]]]) -> pa.RecordBatch:
    rows = [(q, i, -s) for q, near in best.items() for s, i in near]
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])
