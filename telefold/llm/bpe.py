"""BPE encoding and decoding with forced boundaries.

Two neighbouring symbols that stand side by side in no token can never end up in one token, so there a word
may be cut for certain. The fragments between such cuts are encoded by themselves and joined again.

Null and empty texts give no ids and decode to the empty text; equal rows give equal ids. Texts and words may be very
long: a long fragment is merged by a heap over a linked list, so its time grows with n log n. Other columns are kept; a
column that already has an output's name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .held import held, tidy
from .vocab import Remembered, Vocabulary, load, read_tokens


class Encoder:
    """Encodes texts; remembers the ids of recent words."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        #: pairs that stand side by side in some token; all others are forced boundaries
        self.inside = {pair for s in map(self._split, vocabulary.ids) for pair in zip(s, s[1:])}
        self.known = Remembered(lambda word: np.array(self.word_ids(word), np.int32).tobytes(), 150_000)

    def _split(self, token: str) -> list[str]:
        """A token's symbols; the end-of-word mark belongs to the last."""
        end = self.v.suffix
        if end and token.endswith(end) and len(token) > len(end):
            head = list(token[: -len(end)])
            head[-1] += end
            return head
        return list(token)

    def fragments(self, symbols: list[str]) -> Iterator[list[str]]:
        """Runs of symbols between forced boundaries."""
        if all(map(self.inside.__contains__, zip(symbols, symbols[1:]))):
            yield symbols
            return
        at = 0
        for i in range(1, len(symbols)):
            if (symbols[i - 1], symbols[i]) not in self.inside:
                yield symbols[at:i]
                at = i
        yield symbols[at:]

    def merge(self, part: list[str]) -> list[str]:
        """Merges the pair of lowest rank, the leftmost first, until none has a rank."""
        if len(part) > 100:
            return self._merge_long(part)
        ranks, never = self.v.ranks, len(self.v.ranks)
        rank = [ranks.get(pair, never) for pair in zip(part, part[1:])]
        while rank and (low := min(rank)) < never:
            i = rank.index(low)
            part[i:i + 2] = [part[i] + part[i + 1]]
            del rank[i]
            if i:
                rank[i - 1] = ranks.get((part[i - 1], part[i]), never)
            if i < len(rank):
                rank[i] = ranks.get((part[i], part[i + 1]), never)
        return part

    def _merge_long(self, part: list[str]) -> list[str]:
        """The same for long fragments: adjacent pairs wait in a heap by rank, then place; symbols are linked by the
        places of their neighbours."""
        ranks, n = self.v.ranks, len(part)
        part, before, after = list(part), list(range(-1, n - 1)), list(range(1, n + 1))
        waiting = [(ranks[pair], i) for i, pair in enumerate(zip(part, part[1:])) if pair in ranks]
        heapify(waiting)
        while waiting:
            rank, i = heappop(waiting)
            j = after[i]
            if part[i] is None or j == n or ranks.get((part[i], part[j])) != rank:
                continue  # the pair is no more
            part[i], part[j], after[i] = part[i] + part[j], None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (part[left], part[right]) in ranks:
                    heappush(waiting, (ranks[part[left], part[right]], left))
        return [symbol for symbol in part if symbol is not None]

    def word_ids(self, word: str) -> list[int]:
        ids = self.v.ids
        return [ids[t] for part in self.fragments(self.v.symbols(word)) for t in self.merge(part)]

    def encode(self, text: str | None) -> bytes:
        """The text's ids, four bytes each."""
        out = []
        for words, special in self.v.words(text):
            out += map(self.known.__getitem__, words)
            if special is not None:
                out.append(np.int32(special).tobytes())
        return b"".join(out)


@held
def _encoder(path: str) -> Encoder:
    return Encoder(load(path))


@held
def _names(path: str) -> np.ndarray:
    return np.array(read_tokens(path), dtype=object)


def _slices(batches: Iterator[pa.Array], rows: int = 200) -> Iterator[pa.Array]:
    """Batches in small parts, so that results don't pile up."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _listed(found: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) // 4 for x in found)], dtype=np.int32)
    flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(found))])
    return pa.ListArray.from_arrays(pa.array(ends), flat)


def _spelled(names: np.ndarray, ids: np.ndarray) -> str:
    return " ".join(names[ids].tolist())


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds ``ids array<int>``: the text's token ids by the vocabulary file at ``path``. Map-only."""

    @F.arrow_udf("array<int>")
    @tidy
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path)
        for texts in _slices(batches):
            yield _listed([encoder.encode(t.as_py()) for t in texts])

    return docs.withColumn(ids, run(F.col(f"`{text}`")))


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds ``decoded string``: the tokens of ``ids`` joined by spaces, as a file without a decoder has it.
    Special tokens are kept; null ids give the empty text. Map-only."""

    @F.arrow_udf("string")
    @tidy
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = _names(path)
        for many in _slices(batches):
            texts = (_spelled(names, row.values.to_numpy()) if row.is_valid and len(row.values) else "" for row in many)
            yield pa.array(texts, pa.string(), size=len(many))

    return encoded.withColumn(text, run(F.col(f"`{ids}`")))


def round_trip(docs: DataFrame, path: str, text: str = "text", out: str = "coded") -> DataFrame:
    """Adds ``coded struct<ids array<int>, decoded string>``: both of the above in one pass, so a task has one Python
    worker and the ids cross to Spark once."""

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    @tidy
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, names = _encoder(path), _names(path)
        for texts in _slices(batches):
            found = [encoder.encode(t.as_py()) for t in texts]
            back = pa.array((_spelled(names, np.frombuffer(ids, np.int32)) for ids in found), pa.string(), size=len(found))
            yield pa.StructArray.from_arrays([_listed(found), back], ["ids", "decoded"])

    return docs.withColumn(out, run(F.col(f"`{text}`")))
