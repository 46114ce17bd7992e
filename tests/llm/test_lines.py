"""Line dedup against plain Python."""

from __future__ import annotations

import random

import pytest

from telefold.llm import lines


def plain(rows, min_docs, keep_first=False):
    blank = " \t\n\x0b\f\r"

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(blank))

    where = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            where.setdefault(key(line), set()).add(d)
    lost = {k for k, docs in where.items() if k and len(docs) >= min_docs}
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        kept = []
        for line in (t or "").split("\n"):
            k = key(line)
            if k not in lost or (keep_first and k not in seen):
                kept.append(line)
            if k in lost:
                seen.add(k)
        n = len((t or "").split("\n"))
        out.append((d, n, n - len(kept), t if len(kept) == n else "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_keys", [1_000, 4])  # all frequent keys are hot; some are
@pytest.mark.parametrize("keep_first", [False, True])
def test_against_plain_python(spark, keep_first, hot_keys, monkeypatch):
    monkeypatch.setattr(lines, "HOT_KEYS", hot_keys)
    rnd = random.Random(4)
    pool = ["Hot line", " hot LINE\t", "", "a", "A ", "É", "é", "x\r", "\x0bb", "long " * 200]
    rows = [(0, None), (1, ""), (2, "\n\n"), (3, "a\n" * 300 + "Hot line")]
    rows += [(i, "\n".join(rnd.choice([*pool, f"own {i}"]) for _ in range(rnd.randrange(1, 90)))) for i in range(4, 60)]
    docs = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id long, text string, n_lines int, words int").repartition(5)
    got = lines.drop_frequent_lines(docs, 10, keep_first)
    assert got.columns == ["doc_id", "text", "n_lines", "words", "n_dropped"]
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()], key=repr) == plain(rows, 10, keep_first)


def test_equal_rows_and_ids(spark):
    rows = [(1, "a\nb"), (1, "a\nb"), (1, "c\na"), (2, "a"), (None, "a\nz"), (None, "y")]
    got = lines.drop_frequent_lines(spark.createDataFrame(rows, "doc_id long, text string"), 3)
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=repr) == sorted([(1, "b"), (1, "b"), (1, "c"), (2, ""), (None, "z"), (None, "y")], key=repr)


def test_empty_table(spark):
    assert lines.drop_frequent_lines(spark.createDataFrame([], "doc_id long, text string"), 2).collect() == []
