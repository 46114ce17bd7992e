"""A supervised classifier over subword embeddings.

A text's features are its words and their character n-grams, hashed into a table of learned vectors, and one
word-pair feature, a word said twice in a row. The vectors' average goes through a softmax layer; vectors and
layer are trained together by stochastic gradient descent in numpy, on a bounded sample of labelled rows.

With two classes a score depends on each vector only through its product with the layer, so scoring adds up one
number for each word; those of recent words are remembered.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .held import held, only, tidy

SAMPLE_ROWS = 4_000  # labelled rows that training reads at most
BUCKETS = 1 << 16
WIDTH = 12
GRAMS = (2, 3, 4)
EPOCHS = 6
WORDS_KEPT = 300_000
CHARS_AT_ONCE = 1_000_000


def _word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words' features, one word after the other per n, each feature's word, features per word."""
    raw = np.frombuffer(b"".join(b"<%b>" % w for w in words), np.uint8).astype(np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(size)
    owner = np.repeat(np.arange(len(words)), size)
    end = np.repeat(ends, size)
    whole = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    buckets, owners, counts = [_bucket(whole, 0)], [np.arange(len(words))], np.ones(len(words), np.int64)
    h = raw.copy()
    for n in range(2, max(GRAMS) + 1):
        h = h[:-1] * np.uint32(0x01000193) ^ raw[n - 1:]
        if n in GRAMS and len(h):
            inside = np.arange(len(h)) + n <= end[:len(h)]
            buckets.append(_bucket(h[inside], n))
            owners.append(owner[:len(h)][inside])
            counts += np.maximum(size - n + 1, 0)
    return np.concatenate(buckets), np.concatenate(owners), counts


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    """Buckets from 1; bucket 0 is the repeated word's."""
    mixed = (h + np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
    return (mixed >> np.uint32(8)).astype(np.int64) % (BUCKETS - 1) + 1


@dataclass
class Model:
    vectors: np.ndarray  # BUCKETS x WIDTH
    layer: np.ndarray  # WIDTH x 2
    bias: np.ndarray

    def weights(self) -> np.ndarray:
        """Each vector's part in the difference of the two classes."""
        return (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float64)


def _features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    words = text.encode().split() if text else []
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    place: dict[bytes, int] = {}
    codes = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, len(words))
    times = np.bincount(codes, minlength=len(place))
    buckets, owners, _ = _word_grams(list(place))
    total = np.bincount(buckets, times[owners], minlength=1)
    total[0] += np.count_nonzero(codes[1:] == codes[:-1])
    found = np.flatnonzero(total)
    return found, (total[found] / total.sum()).astype(np.float32)


def fit(texts: list[str | None], labels: list[int], seed: int = 7, rate: float = 0.5) -> Model:
    """Trains on all rows given, in an order fixed by ``seed``. Without rows every score is a half."""
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((BUCKETS, WIDTH)) - 0.5) / WIDTH).astype(np.float32)
    layer, bias = (rng.standard_normal((WIDTH, 2)) * 0.5).astype(np.float32), np.zeros(2, np.float32)
    rows = [(*_features(t), y) for t, y in zip(texts, labels)]
    steps, step = max(1, EPOCHS * len(rows)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            found, share, y = rows[i]
            now = rate * (1 - step / steps)
            step += 1
            mean = share @ vectors[found]
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1
            back = layer @ p
            layer -= now * np.outer(mean, p)
            bias -= 0.1 * now * p
            # a feature's share is tiny, so its step is taken relative to an even share
            vectors[found] -= (now * len(found) ** 0.5 * 4) * np.outer(share, back)
    return Model(vectors, layer, bias)


class Scorer:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.sums, self.counts = np.zeros(0), np.zeros(0)

    def _learn(self, words: list[bytes]) -> None:
        buckets, owners, counts = _word_grams(words)
        for w in words:
            self.place[w] = len(self.place)
        self.sums = np.concatenate([self.sums, np.bincount(owners, self.weights[buckets], minlength=len(words))])
        self.counts = np.concatenate([self.counts, counts])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of class 1; a text without words has the bias alone."""
        many = [t.encode().split() if t else [] for t in texts]
        new = {w for words in many for w in words if w not in self.place}
        if new:
            if len(self.place) + len(new) > WORDS_KEPT:
                self._forget()
                new = {w for words in many for w in words}
            self._learn(list(new))
        z = np.full(len(texts), self.bias)
        for i, words in enumerate(many):
            if words:
                at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
                twice = np.count_nonzero(at[1:] == at[:-1])
                z[i] += (self.sums[at].sum() + twice * self.weights[0]) / (self.counts[at].sum() + twice)
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "label", text: str = "text", rows: int = SAMPLE_ROWS) -> Model:
    """Fits on the texts of the ``rows`` labels whose hashed ``key`` is smallest, all if there are fewer. Labels other
    than 0 and 1 and null keys take no part; of equal keys, ``rows`` rows at most. The texts of the sample meet in
    one task, never in the driver; the driver gets the model, whose size is fixed."""
    wanted = labels.filter(F.col(f"`{label}`").isin(0, 1) & F.col(f"`{key}`").isNotNull()).select(
        F.xxhash64(F.col(f"`{key}`").cast("string")).alias("h"), F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").cast("int").alias("y")
    )
    sample = wanted.orderBy("h", "k", "y").limit(rows)
    texts = docs.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    found = texts.join(sample, "k").select("h", "y", "t").orderBy("h", "y", "t").limit(rows)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(__name__)
        rows = sorted((x["h"], x["y"], x["t"]) for b in batches for x in b.to_pylist())
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(fit([t for _, _, t in rows], [y for _, y, _ in rows]))]})

    models = found.coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(bytes(models[0][0])) if models else fit([], [])


@held
def _scorer(model: bytes) -> Scorer:
    return Scorer(*pickle.loads(model))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Adds ``out double``: the probability of class 1 from the text alone; null counts as empty. Map-only."""
    state = pickle.dumps((model.weights(), float(model.bias[1] - model.bias[0])))
    shared = docs.sparkSession.sparkContext.broadcast(state)  # one number for each bucket

    @F.arrow_udf("double")
    @tidy
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _scorer(shared.value)
        for texts in batches:
            found, some, chars = [], [], 0
            for t in texts:
                some.append(t.as_py())
                chars += len(some[-1] or "")
                if chars >= CHARS_AT_ONCE:
                    found.append(scorer.scores(some))
                    some, chars = [], 0
            yield pa.array(np.concatenate([*found, scorer.scores(some)]), pa.float64())

    return docs.withColumn(out, run(F.col(f"`{text}`")))
