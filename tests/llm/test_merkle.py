"""The Merkle manifest against a plain version that holds whole trees."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from telefold.llm import merkle

NAMES = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def plain(rows, tampered):
    """By row: leaf, subroot, root, siblings, folded root."""
    trees = {}
    for r in rows:
        trees.setdefault("0" if r[1] is None else "1" + r[1], []).append(r)
    names = sorted(trees, key=str.encode)
    for members in trees.values():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    built = {t: levels_of([leaf_of(r) for r in trees[t]]) for t in names}
    top = levels_of([built[t][-1][0] for t in names])
    out = []
    for nth, t in enumerate(names):
        for i, r in enumerate(trees[t]):
            node = leaf_of((*r[:4], r[4].replace("\n", "")) if tampered(r[0]) and r[4] is not None else r)
            proof = []
            for place, levels in ((i, built[t]), (nth, top)):
                for nodes in levels[:-1]:
                    first = place - place % 3
                    run = nodes[first:first + 3]
                    proof += [n for k, n in enumerate(run) if k != place % 3]
                    run[place % 3] = node
                    node = H(*run)
                    place //= 3
            out.append((r[0], r[1], i, leaf_of(r), built[t][-1][0], top[-1][0], H(*proof), node, node == top[-1][0]))
    return out


def found(docs, **options):
    out = merkle.manifest(
        docs,
        {c: F.col(c) for c in NAMES},
        tree="source",
        key="doc_id",
        changed={"text": F.replace("text", F.lit("\n"), F.lit(""))},
        when=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0,
        **options,
    )
    rows = out.select("doc_id", "source", "place", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")), "folded_root", "verified", "version", "changed_leaf").collect()
    tampered = lambda d: d is not None and zlib.crc32(str(d).encode()) % 2 == 0
    return [tuple(r) for r in rows], tampered


def by_text(rows):
    return sorted(rows, key=repr)


def same(spark, rows, extra="", **options):
    got, tampered = found(spark.createDataFrame(rows, SCHEMA + extra), **options)
    assert by_text(r[:9] for r in got) == by_text(plain([r[:5] for r in rows], tampered))
    return got


def documents(n, sources, seed=1):
    rnd = random.Random(seed)
    return [(i, rnd.choice(sources), rnd.choice(["en", None]), rnd.choice([None, i]), "a\nb" * rnd.randrange(3) + "é" * (i % 4)) for i in rnd.sample(range(10 * n), n)]


def test_small_trees(spark):
    for n in (1, 2, 3, 4, 28):
        same(spark, documents(n, ["x"]))


def test_many_sources_and_nulls(spark):
    rows = documents(60, [None, "", "0", "1", "b", "B", "é", "長"])
    rows += [(None, "b", None, None, None), (None, None, None, None, "\n"), rows[0], rows[0], (7, "b", "en", 1, ""), (7, "b", "en", 1, "other\n")]
    got = same(spark, rows)
    unverified = {r[0] for r in got if not r[8]}
    assert unverified and all(r[10] != r[3] for r in got if not r[8])


def test_blocks_upon_blocks(spark):
    """Blocks of 9 and one hot source: three tables above the leaves, two above the sources."""
    got = same(spark, documents(1000, ["hot"] * 20 + [f"s{i}" for i in range(30)]), levels=2)
    depth = merkle.height(len({r[1] for r in got}))
    hot = [r for r in got if r[1] == "hot"]
    assert {len(r[9]) for r in hot} == {merkle.height(len(hot)) + depth}
    # a version copies the nodes above its leaf and nothing else
    roots = {r[9][-1] for r in hot if r[8]}
    assert roots == {hot[0][5]}


def test_versions_share_all_but_their_ancestors():
    nodes = [H(str(i)) for i in range(100)]
    block = merkle.Block(nodes, merkle.height(100))
    new = H("new")
    version = merkle.copied(new, block.path(42))
    changed = merkle.Block([*nodes[:42], new, *nodes[43:]], merkle.height(100))
    differ = [{i for i, (a, b) in enumerate(zip(x, y)) if a != b} for x, y in zip(block.levels, changed.levels)]
    assert differ == [{42 // 3**k} for k in range(len(differ))]
    assert version == [changed.levels[k][42 // 3**k] for k in range(1, len(differ))]


def test_equal_rows_only(spark):
    same(spark, [(5, "s", "en", 3, "a\nb")] * 40)


def test_names_that_clash_and_long_texts(spark):
    rows = [(i, "s", "en", 1, "x\n" * (400_000 if i == 3 else 2), 1, 2, 3, 4) for i in range(8)]
    same(spark, rows, ", tree int, place int, digest int, changed int")


def test_no_rows(spark):
    assert found(spark.createDataFrame([], SCHEMA))[0] == []


@pytest.mark.parametrize("n, levels", [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2), (9, 2), (10, 3), (2187, 7), (2188, 8)])
def test_height(n, levels):
    assert merkle.height(n) == levels
