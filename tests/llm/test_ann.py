"""Nearest neighbours against all vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest

from telefold.llm import ann
from telefold.llm.shipping import ship


def plain(rows, queries, k):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in usable:
        if q in queries:
            near = sorted((-float(x @ y) / (np.linalg.norm(x) * np.linalg.norm(y)), i) for i, y in usable if i != q)
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 16))
    vectors = [(i, (centres[i % 12] + 0.4 * rng.standard_normal(16)).tolist()) for i in range(3000)]
    same = vectors[7][1]
    vectors += [(3000 + i, same) for i in range(900)]
    bad = [None, [], [0.0] * 16, [math.nan] + [1.0] * 15, [math.inf] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 3]
    return vectors + [(5000 + i, v) for i, v in enumerate(bad)] + [(None, same), (7, same)]


def test_recall_scores_and_order(spark, rows):
    ship(spark)
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, leaf string").repartition(4)
    found = ann.nearest(table, table.filter("vec_id % 50 = 0"), 5)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    got: dict = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = plain(rows, {i for i, _ in rows if i is not None and i % 50 == 0}, 5)
    assert got.keys() == want.keys()
    hits = 0
    exact = {i: dict(x) for i, x in want.items()}
    for q, near in got.items():
        assert [n for n, _, _ in near] == [1, 2, 3, 4, 5]
        assert [(-s, i) for _, i, s in near] == sorted((-s, i) for _, i, s in near)
        hits += len({i for _, i, _ in near} & exact[q].keys())
        for _, i, s in near:
            assert i != q and (i not in exact[q] or abs(s - exact[q][i]) < 1e-12)
    assert hits >= 0.9 * 5 * len(want)


def test_few_vectors(spark):
    ship(spark)
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, -1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in ann.nearest(table, table.filter("vec_id = 0"), 5).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 0.0)]
    assert ann.nearest(table.limit(0), table, 5).collect() == []
    assert ann.nearest(table, table.limit(0), 5).collect() == []


def test_leaves_with_trees_of_their_own(spark, rows):
    """A small upper tree, so that most leaves are split; every vector is still in one leaf."""
    ship(spark)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    found = ann.nearest(table, table.filter("vec_id % 50 = 0"), 5, leaf_rows=50, max_leaves=12, split_rows=100)
    got: dict = {}
    for r in found.collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    single = [(i, np.array(v, np.float32).tolist() if v and None not in v else v) for i, v in rows]
    want = plain(single, {i for i, _ in rows if i is not None and i % 50 == 0}, 5)
    assert got.keys() == want.keys() and all(len(x) == 5 for x in got.values())
    assert sum(len(got[q] & {i for i, _ in near}) for q, near in want.items()) >= 0.9 * 5 * len(want)


def test_the_walk_visits_every_leaf_once_nearest_first():
    rng = np.random.default_rng(3)
    sample = ann.unit(rng.standard_normal((2000, 8)))
    tree = ann.Tree(sample, 2000, leaf_rows=40)
    leaves = {i for i, below in enumerate(tree.children) if not below}
    assert len(leaves) > 30
    walk = list(tree.leaves_by_nearness(sample[0]))
    assert sorted(walk) == sorted(leaves)
    near = sample[0] @ tree.centres[walk].T
    assert (np.diff(near) <= 1e-9).all()
    assert set(tree.assign(sample).tolist()) <= leaves


def test_visits_are_the_leaves_within_the_angle():
    rng = np.random.default_rng(4)
    sample = ann.unit(rng.standard_normal((2000, 8)))
    tree = ann.Tree(sample, 2000, leaf_rows=20)
    leaves = np.array([i for i, below in enumerate(tree.children) if not below])
    tree.least = 2
    for vector, seen in zip(sample[:50], tree.visits(sample[:50], 0.6)):
        apart = np.arccos(np.clip(tree.centres[leaves] @ vector, -1, 1))
        near = set(leaves[apart <= 0.6].tolist())
        assert set(seen) == near or (len(near) < 2 and len(seen) == 2 and near <= set(seen))
