"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from telefold.llm import byte_bpe
from telefold.llm.shipping import ship

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(byte_bpe.Ranks(PATH), PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.transducer.ranks.ids, special_tokens={})


@pytest.fixture(scope="module")
def texts(codec):
    rnd, tokens = random.Random(1), codec.tokens
    ranges = [(32, 127), (0xA0, 0x250), (0x370, 0x377), (0x3041, 0x3090), (0x4E00, 0x9FFF), (0x1F300, 0x1F600)]
    out = ["", "a", " ", "  \n\t x", "a\x1cb\x85c d\x1fe", "it's I'LL they'll 's", "<|endoftext|>", "ａｂｃ½²٣४", "각 é", "👩‍👩‍👧", "﻿\x00", "ab" * 300]
    out += ["".join(chr(rnd.randrange(*rnd.choice(ranges))) for _ in range(40)) for _ in range(300)]
    return out + ["".join(tokens[rnd.randrange(len(tokens))].decode(errors="ignore") for _ in range(9)) for _ in range(300)]


def ids(codec, text):
    return np.frombuffer(codec.encode(text), np.int32).tolist()


def test_ids_equal_the_library(codec, library, texts):
    for t in texts:
        assert ids(codec, t) == library.encode_ordinary(t), t


def test_every_code_point_in_a_text(codec, library):
    for first in range(0, 0x110000, 64):
        t = "".join(f"a{chr(c)}1{chr(c)}{chr(c)} " for c in range(first, first + 64) if not 0xD800 <= c < 0xE000)
        assert ids(codec, t) == library.encode_ordinary(t), hex(first)


def test_pieces_of_any_bytes(codec, library):
    rnd, tokens = random.Random(2), codec.tokens
    for _ in range(2000):
        raw = b"".join(tokens[rnd.randrange(len(tokens))] for _ in range(rnd.choice([2, 3, 7])))
        assert codec.transducer.run(raw) == library._encode_single_piece(raw)


def test_full_tables_are_emptied(codec, library, texts):
    small = byte_bpe.Transducer(codec.transducer.ranks, states=50)
    for t in texts[-100:]:
        raw = t.encode()
        if raw:
            assert small.run(raw) == library._encode_single_piece(raw)
        assert len(small.keys) <= 51


def test_output_lags_by_little(codec):
    """Tokens are certain soon after their last byte, however long the piece."""
    run, rnd = codec.transducer, random.Random(4)
    raw, state, out = bytes(rnd.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(20_000)), 0, []
    for i, b in enumerate(raw):
        state, found = run._step(state, b)
        out += found
        if i % 100 == 0:
            assert i + 1 - sum(len(codec.tokens[t]) for t in out) <= 40


def test_long_words_take_time_by_length(codec, library):
    for word in ("a" * 200_000, "".join(random.Random(3).choice("etaoinshrdlu") for _ in range(200_000))):
        began = time.perf_counter()
        got = codec.transducer.run(word.encode())
        assert time.perf_counter() - began < 20
        assert got == library.encode_ordinary(word)


def test_decoding_streams_any_bytes(codec):
    rnd = random.Random(5)
    for k in range(3000):
        raw = bytes(rnd.choice([rnd.randrange(256), rnd.choice(b"\xe2\x82\xac\xf0\x9f\xed\xa0a")]) for _ in range(12))
        stream, cut = byte_bpe.Utf8Stream(), sorted(rnd.randrange(13) for _ in range(3))
        parts = [raw[a:b] for a, b in zip([0, *cut], [*cut, 12])]
        assert "".join([*map(stream.feed, parts), stream.end()]) == raw.decode(errors="replace")
        assert (stream.missing, len(stream.held)) == (0, 0)


def test_decode_equals_the_library(codec, library):
    rnd = random.Random(6)
    for _ in range(2000):
        many = np.array([rnd.randrange(len(codec.tokens)) for _ in range(10)], np.int32)
        assert codec.decode(many) == library.decode(many.tolist(), errors="replace")


def test_on_spark(spark, library, texts):
    ship(spark)
    rows = [(i, t, 1, "x") for i, t in enumerate([*texts[:80], None, texts[3], texts[3], "long " * 100_000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded int, `ids.x` string")
    apart = byte_bpe.decode(byte_bpe.encode(docs, PATH, PATTERN), PATH, PATTERN).collect()
    at_once = byte_bpe.round_trip(docs, PATH, PATTERN).collect()
    want = [(i, library.encode_ordinary(t or ""), t or "") for i, t, *_ in rows]
    assert sorted((r.doc_id, r.ids, r.decoded) for r in apart) == want
    assert sorted((r.doc_id, r.coded.ids, r.coded.decoded) for r in at_once) == want
    assert {(r.decoded, r["ids.x"]) for r in at_once} == {(1, "x")}


def test_null_ids_and_no_rows(spark):
    ship(spark)
    some = spark.createDataFrame([(1, None), (2, []), (3, [104, 105])], "doc_id long, ids array<int>")
    assert sorted((r.doc_id, r.decoded) for r in byte_bpe.decode(some, PATH, PATTERN).collect())[:2] == [(1, ""), (2, "")]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.round_trip(empty, PATH, PATTERN).collect() == []


def test_a_file_without_all_bytes(tmp_path):
    (tmp_path / "few").write_text("YQ== 0\n")
    with pytest.raises(ValueError, match="without a token"):
        byte_bpe.Ranks(str(tmp_path / "few"))
