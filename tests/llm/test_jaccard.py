"""The Jaccard join against counting every shared shingle."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from telefold.llm import hashing, jaccard
from telefold.llm.shipping import ship


def plain(rows, percent=75, words=5):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in where[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[top(i)] = top(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(d)
    return sorted((d, len(sets[i]), min(groups[top(i)])) for i, (d, _) in enumerate(rows))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    pool = [f"w{i}" for i in range(3000)]

    def some(n):
        return [rnd.choice(pool) for _ in range(n)]

    passage, base = some(60), some(200)
    texts = [None, "", "a b", "A b", "a b c d e f", "a b c d e f g", " \n "]
    texts += [[w if rnd.random() > 0.02 else rnd.choice(pool) for w in base] for _ in range(40)]
    texts += [some(rnd.randrange(60)) + passage + some(rnd.randrange(40)) for _ in range(40)]
    for _ in range(100):
        text = some(rnd.choice([3, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 60]))
        for copy in range(rnd.choice([1, 2, 3])):
            text = list(text)
            if copy:
                text[rnd.choice([0, len(text) - 1, rnd.randrange(len(text))])] = rnd.choice(pool)
                text += some(rnd.choice([0, 1]))
            texts.append(text)
    return [(i, t if t is None or isinstance(t, str) else " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("frequent", [48, 2])
def test_against_all_pairs(spark, rows, frequent):
    ship(spark)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int").repartition(4)
    got = jaccard.jaccard_components(docs, frequent=frequent).drop("text_hash")
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_neighbours_of_very_frequent_subsets(spark, monkeypatch):
    """Sets that lack single elements of subsets known in advance to be very frequent still find their owners."""
    ship(spark)
    monkeypatch.setattr(jaccard, "SAMPLE_DOCS", 60)
    bands, texts = jaccard.Bands(75), []
    for size, lack in ((250, 45), (253, 48), (256, 51)):
        base = [f"b{size}_{i}" for i in range(size)]
        texts += [[*base, f"y{size}_{i}"] for i in range(60)]
        ((scheme, segments, _),) = bands.roles(size - lack)
        hashes = np.array([jaccard.shingle_sets([w], 1).shingles[0] for w in base])
        of = jaccard.mix(hashes + jaccard.mix(np.array([scheme], np.uint64) + jaccard._P)) % np.uint64(segments)
        largest = np.argsort(-np.bincount(of.astype(int), minlength=segments), kind="stable")[:lack]
        texts.append([w for i, w in enumerate(base) if i not in {int(np.flatnonzero(of == s)[0]) for s in largest}])
    rows = list(enumerate(" ".join(t) for t in texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert len(jaccard.Join(docs, 75, 1, 4, "doc_id", "text").very_frequent(len(rows)))
    got = jaccard.jaccard_components(docs, words=1, frequent=4).drop("text_hash")
    assert sorted(map(tuple, got.collect())) == plain(rows, words=1)


def test_the_bound_on_differences_is_exact():
    bands = jaccard.Bands(75)
    for s in range(1, 60):
        for t in range(s, 80):
            possible = [s + t - 2 * n for n in range(s + 1) if 100 * n >= 75 * (s + t - n)]
            if possible:
                assert max(possible) <= bands.differences(s + t)


def test_linked_sizes_share_the_scheme_of_the_smaller():
    bands = jaccard.Bands(75)
    for s in range(1, 400):
        scheme = bands.roles(s)[0][0]
        for t in range(s, s * 100 // 75 + 1):
            most = s + t - 2 * -(-75 * (s + t) // 175)
            if s != t and most <= 0:
                continue
            for size in (s, t):
                (segments, need), = (r[1:] for r in bands.roles(size) if r[0] == scheme)
                assert segments >= need > most or most <= 0


def test_sketches_never_exceed_the_difference():
    import pyarrow as pa

    rng = np.random.default_rng(0)
    a = [np.unique(rng.integers(0, 500, n)).astype(np.uint64) for n in rng.integers(1, 300, 200)]
    b = [np.unique(rng.integers(0, 500, n)).astype(np.uint64) for n in rng.integers(1, 300, 200)]
    one, other = (jaccard.Sketches(pa.array(map(jaccard._sketch, x), pa.binary())) for x in (a, b))
    least = one.differ_at_least(np.arange(200), other, np.arange(200))
    assert all(n <= len(np.setxor1d(x, y)) for n, x, y in zip(least, a, b))


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 9)] + [(300, 200), (7, 3)]
    got = jaccard.components(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == {(i, 0) for i in range(21)} | {(100 + i, 100) for i in range(9)} | {(200, 200), (300, 200)}


def test_one_stays_of_each_component(spark):
    ship(spark)
    text = "one two three four five six seven eight"
    rows = [(3, text), (1, text.upper()), (2, "other words than those of the one before"), (None, text), (None, None), (4, None), (5, ""), (2, "other words than those of the one before")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string")
    kept = jaccard.one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=repr) == [1, 2, 4, 5, None, None]
    assert jaccard.one_per_component(docs.limit(0)).collect() == []


def test_words_of_two_letters_in_a_self_similar_order(spark):
    """Such words have one polynomial hash modulo a power of two, whatever its base; their sets stay apart."""
    one, other = "a", "b"
    for _ in range(11):
        one, other = one + other, other + one
    ship(spark)
    docs = spark.createDataFrame([(1, one), (2, other), (3, one.upper()), (4, f"{one} x y z w"), (5, f"{other} x y z w")], "doc_id long, text string")
    got = jaccard.jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1), (2, 1, 2), (3, 1, 1), (4, 1, 4), (5, 1, 5)]


def test_hashes_of_runs():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("ab\0\xff") for _ in range(rnd.randint(1, 30))).encode() for _ in range(20_000)]
    size = np.array([len(w) for w in words])
    start = np.cumsum(size + 1) - size - 1
    hashes = hashing.hash_runs(b" ".join(words), start, start + size).tolist()
    assert len(set(hashes)) == len(set(words)) == len(set(zip(words, hashes)))
    assert len(hashing.hash_runs(b"", start[:0], start[:0])) == 0
