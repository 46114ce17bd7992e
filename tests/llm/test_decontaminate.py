"""The suffix automaton and decontamination against a search of every window."""

from __future__ import annotations

import random

import pytest

from telefold.llm import decontaminate
from telefold.llm.decontaminate import Automaton, words_of
from telefold.llm.shipping import ship


def plain(doc, items, window):
    hit, names = set(), set()
    for name, w in items:
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for p in range(len(doc) - n + 1):
                if doc[p:p + n] == w[k:k + n]:
                    hit |= set(range(p, p + n))
                    names.add(name)
    return hit, names


def test_automaton_against_all_windows():
    rnd = random.Random(3)
    for _ in range(300):
        words, window = [b"a", b"b", b"c", b"d"][:rnd.choice([2, 3, 4])], rnd.choice([1, 2, 3, 4, 5])
        items = [(str(i), [rnd.choice(words) for _ in range(rnd.randrange(0, 8))]) for i in range(rnd.randrange(0, 6))]
        doc = [rnd.choice([*words, b"z"]) for _ in range(rnd.randrange(0, 40))]
        spans, names = Automaton(items, window).hits(doc)
        assert ({x for a, b in spans for x in range(a, b)}, names) == plain(doc, items, window)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_words():
    assert words_of("It's x-2 a_b") == [b"it", b"s", b"x", b"2", b"a", b"b"]
    assert words_of(None) == words_of("") == words_of("-- !") == []


@pytest.mark.parametrize(("block_words", "at_once", "portion"), [(200_000, 16, 1_000), (20, 16, 16_000_000), (20, 16, 50), (10, 2, 50)])
def test_hits_on_spark(spark, monkeypatch, block_words, at_once, portion):
    """One block, several of them over one portion and over many, and several rounds."""
    ship(spark)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(decontaminate, "BLOCKS_AT_ONCE", at_once)
    monkeypatch.setattr(decontaminate, "PORTION_CHARS", portion)
    rnd = random.Random(8)
    items = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randrange(0, 9)))) for i in range(9)] + [(9, None), (None, "a b"), (10, "!!"), (3, "c c c c")]
    docs = [(i, " ".join(rnd.choice("abcd") for _ in range(rnd.randrange(0, 50)))) for i in range(40)] + [(40, None), (41, ""), (1, "a a a a")]
    got = decontaminate.benchmark_hits(
        spark.createDataFrame([(*d, "s") for d in docs], "doc_id long, text string, spans string").repartition(3),
        spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int"),
        window=4,
    )
    rows = sorted((r.doc_id, r.text, r.n_words, r.n_hit, tuple(r.items)) for r in got.fillna("~", ["text"]).collect())
    listed = [(str(i), words_of(t)) for i, t in items if i is not None and t]
    want = []
    for d, t in docs:
        hit, names = plain(words_of(t), listed, 4)
        want.append((d, "~" if t is None else t, len(words_of(t)), len(hit), tuple(sorted(names))))
    assert rows == sorted(want)


def test_spans_go_and_clean_documents_stay(spark):
    ship(spark)
    leak = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Before, {leak.upper()}! After it all and much more than that, really, so that most of it stays: a b c."), (2, leak), (3, "clean\ntext"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(0, leak)], "item_id long, text string")
    kept = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items).collect()}
    assert kept == {1: rows[0][1].replace(leak.upper(), ""), 3: "clean\ntext", 4: None, 5: ""}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs, none).count() == 5
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
