"""The pipeline's stages, each on its own input, and all in a row."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import pytest
from test_jaccard import plain as components
from test_lines import plain as line_dedup
from tokenizers import Tokenizer

from telefold.llm import decontaminate


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage got and gave."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet").cache(), {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf_dir).cache()
        out[name] = docs.collect(), made.collect(), made.columns
        docs = made
    return out


def test_names_and_columns(stages):
    assert list(stages) == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "BPE encoding and decoding"]
    for name, (_, _, columns) in stages.items():
        assert name == "BPE encoding and decoding" or columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_keeps_good_documents(spark, sf_dir, stages):
    before, after, _ = stages["quality classifier"]
    kept = {r.doc_id for r in after}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert kept <= {r.doc_id for r in before}
    assert sum(d in kept for d, q in labels.items() if q == 1) >= 0.95 * sum(q == 1 for q in labels.values())
    assert sum(d in kept for d, q in labels.items() if q == 0) <= 0.2 * max(5, sum(q == 0 for q in labels.values()))


def test_line_dedup(stages):
    before, after, _ = stages["line dedup"]
    want = {d: t for d, _, n, t in line_dedup([(r.doc_id, r.text) for r in before], 10, True) if n == 0 or t}
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)


def test_documents_left_with_white_space_go(spark):
    texts = ["one\n\ntwo\n \t\nthree\n"] * 11 + ["one\n\nown", "\n\n", None]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, docs, "").collect()}
    assert got == {0: texts[0], 11: "\nown", 12: "\n\n", 13: None}


def test_near_copies(stages):
    before, after, _ = stages["n-gram Jaccard join"]
    assert sorted(r.doc_id for r in after) == [d for d, _, c in components([(r.doc_id, r.text) for r in before]) if c == d]


def test_leaks(spark, sf_dir, stages):
    before, after, _ = stages["benchmark decontamination"]
    items = [(str(r.item_id), decontaminate.words_of(r.text)) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    automaton = decontaminate.Automaton(items, 10)
    texts = {r.doc_id: r.text for r in after}
    for r in before:
        words = decontaminate.words_of(r.text)
        hit = sum(b - a for a, b in automaton.hits(words)[0])
        assert (r.doc_id in texts) == (hit <= len(words) / 2)
        if not hit:
            assert texts[r.doc_id] == r.text
        elif r.doc_id in texts:
            assert len(decontaminate.words_of(texts[r.doc_id])) == len(words) - hit


def test_encoding(stages):
    before, after, _ = stages["BPE encoding and decoding"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert {r.doc_id: list(r.ids) for r in after} == {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in before}


def test_run(spark, sf_dir, stages):
    assert {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, sf_dir).collect()} == {r.doc_id: r.n_tokens for r in stages["BPE encoding and decoding"][1]}
