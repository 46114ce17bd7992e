"""Fill-in-the-middle against a plain version on lists of units."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from telefold.llm import fim
from telefold.llm.shipping import ship

OUTPUTS = ("n", "form", "prefix_chars", "middle_chars", "output")


def plain(key, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(p) for p in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts(n, seed=1):
    rnd = random.Random(seed)
    shared = "".join(rnd.choice("abc def\n") for _ in range(3000))
    alphabets = ["ab", "a1", " a", "é漢a ", "<P>S", "Az\n\t\x00", "😀é x"]
    out = ["", None, "<", "<<S", "a<P>b", "<S><M>", "word", "A" * 5000, "\n" * 3000, "a" * 63 + "1" * 2, shared, shared]
    for _ in range(n):
        own = "".join(rnd.choice(rnd.choice(alphabets)) for _ in range(rnd.choice([1, 60, 700])))
        cut = rnd.randrange(len(shared))
        out += [own, own + shared[cut:cut + 1500] + own]
    return out


def check(rows, docs):
    made = fim.fill_in_middle(docs)
    got = made.withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    want = sorted(((k, *plain(k, t), t or "") for k, t in rows), key=repr)
    assert sorted(((r.doc_id, *(r[c] for c in OUTPUTS), r.back) for r in got), key=repr) == want
    return {r.form for r in got}


def test_documents(spark):
    ship(spark)
    rows = [(i, t) for i, t in enumerate(texts(120))] + [(None, "no key here"), (3, "twice"), (3, "twice")]
    assert check(rows, spark.createDataFrame(rows, "doc_id long, text string")) == {"plain", "psm", "spm"}


def test_very_long_texts(spark):
    ship(spark)
    part = "".join(random.Random(3).choice("abcde .\n") for _ in range(5000))
    rows = [(i, t) for i, t in enumerate(["x" * 700_000, part * 120, "ab " * 200_000 + "z" * 100_000])]
    check(rows, spark.createDataFrame(rows, "doc_id long, text string"))


def test_names_that_clash(spark):
    ship(spark)
    docs = spark.createDataFrame([(i, f"a b {i}", 1, 2, 3, 4) for i in range(20)], "doc_id long, text string, cut int, cut_ int, n int, `a.b``c` int")
    out = fim.fill_in_middle(docs)
    assert out.columns == ["doc_id", "text", "cut", "cut_", "a.b`c", *OUTPUTS]
    assert {(r.cut, r.cut_, r["a.b`c"]) for r in out.collect()} == {(1, 2, 4)}
    check([(i, f"a b {i}") for i in range(20)], docs.drop("n"))


def test_no_rows(spark):
    ship(spark)
    assert fim.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_chunks_are_found_again_after_an_edit():
    rnd = random.Random(5)
    text = "".join(rnd.choice("abcdefg hij\n") for _ in range(20_000))

    def chunks(t):
        ends = fim.chunk_ends(t)
        return [t[a:b] for a, b in zip([0, *ends], ends)]

    first, second = chunks(text), chunks("some words before " + text)
    assert "".join(second) == "some words before " + text
    assert len(set(first) - set(second)) <= 3 < len(first) / 4
    assert all(len(c) <= fim.MOST for c in first) and all(len(c) >= fim.LEAST for c in first[:-1])


def test_hash_blocks_meet(monkeypatch):
    text = "".join(random.Random(6).choice("abcdefg hij\n") for _ in range(9000))
    whole = fim.chunk_ends(text)
    monkeypatch.setattr(fim, "AT_ONCE", 1000)
    assert fim.chunk_ends(text) == whole


@pytest.mark.parametrize("seed", range(3))
def test_places_by_chunk_sums(seed):
    rnd = random.Random(seed)
    text = "".join(rnd.choice("aaaaaaaaaaaab1 ") for _ in range(4000))
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    class Summaries(dict):
        def __missing__(self, chunk):
            return fim.summary(chunk)

    counted = fim.Units(text, Summaries())
    assert counted.n == len(units) and len(counted.ends) > 5
    assert [counted.place(c) for c in range(counted.n + 1)] == [len("".join(units[:c])) for c in range(counted.n + 1)]
