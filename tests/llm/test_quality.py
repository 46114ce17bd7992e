"""The quality classifier: held-out accuracy, edge cases, and scores against the averages they stand for."""

from __future__ import annotations

import zlib

import numpy as np

from telefold.llm import quality
from telefold.llm.shipping import ship

GOOD = ["the quiet river runs along the old stone wall", "a letter came in the morning and she read it twice"] * 20
BAD = ["BUY!! NOW!! CHEAP!! CLICK!!", "the the the the the the the"] * 20


def test_scores_are_the_softmax_of_averaged_vectors():
    model = quality.fit(GOOD + BAD, [1] * len(GOOD) + [0] * len(BAD))
    scorer = quality.Scorer(model.weights(), float(model.bias[1] - model.bias[0]))
    texts = ["the old river", "BUY!! the the", "", None, "x"]
    for text, got in zip(texts, scorer.scores(texts)):
        found, share = quality._features(text)
        logits = (share @ model.vectors[found] if len(found) else np.zeros(quality.WIDTH)) @ model.layer + model.bias
        assert abs(got - 1 / (1 + np.exp(logits[0] - logits[1]))) < 1e-4


def test_forgetting_words_changes_nothing(monkeypatch):
    model = quality.fit(GOOD + BAD, [1] * len(GOOD) + [0] * len(BAD))
    state = model.weights(), float(model.bias[1] - model.bias[0])
    want = quality.Scorer(*state).scores(GOOD + BAD)
    monkeypatch.setattr(quality, "WORDS_KEPT", 5)
    few = quality.Scorer(*state)
    assert np.allclose([few.scores([t])[0] for t in GOOD + BAD], want)


def test_on_spark(spark):
    ship(spark)
    rows = [(i, t, "x") for i, t in enumerate([*GOOD, *BAD, None, ""])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string")
    labels = spark.createDataFrame([(i, int(i < len(GOOD))) for i in range(len(GOOD + BAD))] + [(0, None), (None, 1), (3, 7)], "doc_id long, label int")
    model = quality.train(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert all((got[i] > 0.5) == (i < len(GOOD)) for i in range(len(GOOD + BAD)))
    assert got[len(rows) - 1] == got[len(rows) - 2]
    assert all(0 <= s <= 1 for s in got.values())


def test_without_labels_every_score_is_a_half(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = quality.train(docs, spark.createDataFrame([], "doc_id long, label int"))
    assert all(abs(r.score - 0.5) < 0.2 for r in quality.score(docs, model).collect())
    assert quality.score(docs.limit(0), model).collect() == []


def test_held_out_accuracy(spark, sf_dir):
    ship(spark)
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    from telefold.llm.queries import op2_quality

    scores = {r.doc_id: r for r in op2_quality(spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    held_out = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(scores[r.doc_id].held_out for r in held_out)
    assert np.mean([scores[r.doc_id].predicted == r.quality for r in held_out]) >= 0.9
