"""BPE encoding, decoding and counts against the tokenizers library."""

from __future__ import annotations

import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from telefold.llm import bpe, token_count, vocab
from telefold.llm.shipping import ship

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "a", " \n\t ", "<|endoftext|>", "x<|endoftext|><|startoftext|>y <|endoftext", "ΣΑΣ Οδυσσεύς ΟΔΥΣΣΕΥΣ", "İstanbul I'M they'll 'super's",
    "a\x1cb\x85c d\x1fe", "ａｂｃ½²٣४", "é 각", "a" * 3000, "😀😀🏳️‍🌈 x", "﻿ab​cd", "ǅ ẞ ŉ", "\x00\x01a", "don't 'tis 'RE 'T",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(1)
    ranges = [(32, 127), (0xA0, 0x250), (0x370, 0x377), (0x3041, 0x3090), (0x1F300, 0x1F600)]
    return ODD + ["".join(chr(rnd.randrange(*rnd.choice(ranges))) for _ in range(60)) for _ in range(400)]


def test_ids_and_counts_equal_the_library(library, texts):
    encoder, counter = bpe.Encoder(vocab.load(PATH)), token_count.Counter(vocab.load(PATH))
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(t), np.int32).tolist() == want, t
        assert counter.count(t) == len(want), t


def test_no_token_spans_a_forced_boundary():
    encoder = bpe.Encoder(vocab.load(PATH))
    for word in ("xqzjvk", "hello", "qqqq"):
        parts = list(encoder.fragments(encoder.v.symbols(word)))
        assert "".join(sum(parts, [])) == word + "</w>"
        whole = encoder.merge(encoder.v.symbols(word))
        assert [t for p in parts for t in encoder.merge(list(p))] == whole


def test_long_fragments_merge_like_short_ones():
    encoder = bpe.Encoder(vocab.load(PATH))
    for word in ("ab" * 200, "the" * 90, "a" * 301):
        symbols = encoder.v.symbols(word)
        assert len(encoder._merge_long(list(symbols))) == token_count.merged_size(symbols, encoder.v.ranks)


def test_long_words_take_little_time(library):
    encoder, rnd = bpe.Encoder(vocab.load(PATH)), random.Random(3)
    for word in ("a" * 232_397, "".join(rnd.choice("etaoinshrdlu") for _ in range(232_397)), "".join(map(chr, rnd.choices(range(0x4E00, 0x9FFF), k=60_000)))):
        began = time.perf_counter()
        got = np.frombuffer(encoder.encode(word), np.int32).tolist()
        assert time.perf_counter() - began < 10
        assert got == library.encode(word, add_special_tokens=False).ids


def test_remembered_keeps_two_generations():
    asked = []
    kept = vocab.Remembered(lambda k: asked.append(k) or k * 2, 2)
    assert [kept[k] for k in "abcab"] == ["aa", "bb", "cc", "aa", "bb"]
    assert asked == ["a", "b", "c"]


def test_round_trip_on_spark(spark, library, texts):
    ship(spark)
    rows = [(i, t, "x") for i, t in enumerate([*texts[:60], None, texts[3], texts[3]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    for i, t, _ in rows:
        want = library.encode(t or "", add_special_tokens=False).ids
        assert (out[i].ids or []) == want
        assert out[i].decoded == library.decode(want, skip_special_tokens=False)
    at_once = bpe.round_trip(docs, PATH).collect()
    assert sorted((r.doc_id, r.coded.ids, r.coded.decoded, r.ids) for r in at_once) == sorted((i, o.ids, o.decoded, "x") for i, o in out.items())
    counts = {r.doc_id: r for r in token_count.token_counts(docs, PATH, limit=5).collect()}
    for i, t, _ in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (counts[i].n_tokens, counts[i].n_bytes, counts[i].over_limit) == (n, len((t or "").encode()), n > 5)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, PATH), PATH).collect() == []
    assert token_count.token_counts(docs, PATH).collect() == []
