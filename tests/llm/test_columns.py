"""Columns of any names beside an operator's own, and very long texts, through every operator on rows of texts."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from telefold.llm import bpe, byte_bpe, decontaminate, fim, html, jaccard, lines, quality, repeats, secrets, token_count
from telefold.llm.columns import aside, unused
from telefold.llm.shipping import ship

INNER = ["__doc", "__ver", "__words", "__dense", "__spans", "__cut", "__host", "__path", "__runs", "__between", "__one", "__hits0", "__row", "__hash", "__score", "__DOC2"]
OTHERS = ["doc", "ver", "node", "key", "run_", "cut", "coded", "score_", "tree", "x y", "a.b"]
WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def items(docs):
    return docs.sparkSession.createDataFrame([("i", "one two three four five six seven eight nine ten eleven")], "item_id string, text string")


OPERATORS = {
    "bpe": lambda d: bpe.round_trip(d, WORD_BPE, out="out"),
    "byte_bpe": lambda d: byte_bpe.round_trip(d, BYTE_BPE, public_tokenizers.PATTERN, out="out"),
    "token_count": lambda d: token_count.token_counts(d, WORD_BPE),
    "quality": lambda d: quality.score(d, quality.fit(["a b", "c d"], [0, 1]), out="out"),
    "repeats": lambda d: repeats.remove_repeats(d, length=60, seed=30),
    "lines": lambda d: lines.drop_frequent_lines(d, 2),
    "html": lambda d: html.main_text(d, url="doc_url", html="text", out="out"),
    "secrets": secrets.findings,
    "decontaminate": lambda d: decontaminate.decontaminate(d, items(d)),
    "hits": lambda d: decontaminate.benchmark_hits(d, items(d)),
    "jaccard": jaccard.one_per_component,
    "fim": fim.fill_in_middle,
}


def documents(spark, names):
    text = 'password = "hunter2 abc"\nsame line here\none two three four five six seven eight nine ten eleven and more words of one\n'
    rows = [(i, f"<p>{text}{'x' if i else ''} number {i} of these", "http://h/p") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, doc_url string")
    return docs.select("*", *(F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in names))


def plain(rows, columns):
    return sorted(repr([(c, r[c]) for c in sorted(columns)]) for r in rows)


@pytest.mark.parametrize("name", OPERATORS)
def test_any_other_columns(spark, name):
    ship(spark)
    names = INNER + OTHERS
    bare = OPERATORS[name](documents(spark, []))
    full = OPERATORS[name](documents(spark, names))
    assert {*full.columns} == {*bare.columns, *names}
    rows = full.collect()
    assert plain(rows, bare.columns) == plain(bare.collect(), bare.columns)
    assert rows and all(r[n] == f"{n}-{r.doc_id}" for r in rows for n in names)


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_any_other_columns(spark, sf_dir, stage):
    docs = documents(spark, INNER).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1)})
    found = corpus_pipeline.STAGES[stage][1](spark, docs, sf_dir)
    assert found.columns == docs.columns
    assert all(r[n] == f"{n}-{r.doc_id}" for r in found.collect() for n in INNER)


def test_stages_on_no_rows(spark, sf_dir):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, sf_dir)
        assert (out.columns, out.collect()) == (docs.columns, [])


def test_very_long_texts(spark):
    """A text of a few million characters, one of them a single word, beside short ones."""
    ship(spark)
    words = " ".join(f"w{i}" for i in range(200_000)) + "\n"
    texts = [words + "end", "y" * 1_000_000, words + "end", "short"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def by_id(df):
        return {r.doc_id: r for r in df.collect()}

    coded = by_id(bpe.round_trip(docs, WORD_BPE))
    counts = by_id(token_count.token_counts(docs, WORD_BPE))
    assert all(len(coded[i].coded.ids) == counts[i].n_tokens and counts[i].n_bytes == len(t) for i, t in enumerate(texts))
    assert {i: r.n_removed for i, r in by_id(repeats.remove_repeats(docs, length=400)).items()} == {0: len(texts[0]), 1: 1_000_000, 2: len(texts[0]), 3: 0}
    assert {i: r.text for i, r in by_id(lines.drop_frequent_lines(docs, 2)).items()} == {0: "", 1: texts[1], 2: "", 3: "short"}
    linked = by_id(jaccard.jaccard_components(docs))
    assert {i: r.component_id for i, r in linked.items()} == {0: 0, 1: 1, 2: 0, 3: 3}
    assert linked[0].n_shingles == 200_001 - 4
    item = spark.createDataFrame([("i", " ".join(f"w{i}" for i in range(150_000, 150_020)))], "item_id string, text string")
    assert {i: r.n_hit for i, r in by_id(decontaminate.benchmark_hits(docs, item)).items()} == {0: 20, 1: 0, 2: 20, 3: 0}
    scores = quality.score(docs, quality.fit(["a b", "c d"], [0, 1]))
    assert all(0 <= r.score <= 1 for r in scores.collect())


def test_unused_and_aside(spark):
    docs = spark.createDataFrame([(1, 2, 3)], "Cut int, cut_ int, __t int")
    assert unused(docs, "cut") == "cut__" and unused(docs, "other") == "other"
    out = aside(lambda df, column: df.withColumn("__t", F.lit(9)).withColumn("twice", F.col(column) * 2).drop("__t"))(docs, "__t")
    assert [r.asDict() for r in out.collect()] == [{"Cut": 1, "cut_": 2, "__t": 3, "twice": 6}]
