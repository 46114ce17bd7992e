"""Removal of repeated strings against counting every string."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from telefold.llm import repeats
from telefold.llm.shipping import ship


def plain(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    counts = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, raw):
        covered = {x for i in range(len(b) - length + 1) if counts[b[i:i + length]] > 1 for x in range(i, i + length)}
        kept = bytes(x for i, x in enumerate(b) if i not in covered)
        out.append((d, len(b), len(covered), sum(i - 1 not in covered for i in covered), kept))
    return sorted(out)


@pytest.mark.parametrize(("length", "seed", "group"), [(12, 5, 1000), (20, 8, 3)])
def test_against_all_strings(spark, monkeypatch, length, seed, group):
    ship(spark)
    rnd = random.Random(length)
    passage = "".join(rnd.choice("abcd") for _ in range(30))
    rows = [(0, None), (1, ""), (2, "a" * 50), (3, "é" * 30), (4, "ab" * 40), (5, passage[:length])]
    for i in range(6, 120):
        text = "".join(rnd.choice("abcdefgh é") for _ in range(rnd.randrange(60)))
        if rnd.random() < 0.5:
            k = rnd.randrange(20)
            text += passage[k:k + rnd.randrange(5, 30)] + "".join(rnd.choice("abc") for _ in range(rnd.randrange(30)))
        if rnd.random() < 0.3:
            text = text[:rnd.randrange(len(text) + 1)] + (rows[rnd.randrange(2, i)][1] or "")
        rows.append((i, text))
    rows += [(7, rows[7][1]), (200, rows[9][1])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, spans string").repartition(3)
    got = repeats.remove_repeats(docs, length, seed, group=group)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got.collect()) == plain(rows, length)


def test_contexts_against_all_pairs():
    rnd = random.Random(6)
    for _ in range(200):
        length, contexts = 8, {}
        for _ in range(rnd.randrange(2, 9)):
            left, right = ("".join(rnd.choice("ab") for _ in range(rnd.randrange(n))) for n in (6, 7))
            contexts[(left + "xyz" + right).encode(), len(left)] = None
        listed = list(contexts)
        for i, got in enumerate(repeats.repeated_windows(listed, length)):
            raw, at = listed[i]
            own = {at - s for s in range(max(0, at + 3 - length), min(at, len(raw) - length) + 1)}
            found = {x for x in own for j, (other, b) in enumerate(listed) if j != i and b >= x and b - x + length <= len(other) and other[b - x:b - x + length] == raw[at - x:at - x + length]}
            assert got == ((min(found), max(found)) if found else None)


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
