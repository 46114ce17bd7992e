"""Token counts by heap and linked list, without ids.

A word's symbols form a linked list; a heap holds its adjacent pairs by merge rank, then place. The lowest
pair is popped and merged as long as there is one, so the count is the number of symbols minus the number of
merges. Counts of words are remembered, so most words cost one lookup.

Null and empty texts have 0 bytes and 0 tokens. Other columns are kept; a column that already has an output's
name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .held import held
from .vocab import Remembered, Vocabulary, load


def merged_size(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left after all merges."""
    n = len(symbols)
    left, right, part = list(range(-1, n - 1)), list(range(1, n + 1)), list(symbols)
    heap = [(ranks[pair], i) for i, pair in enumerate(zip(part, part[1:])) if pair in ranks]
    heapify(heap)
    merges = 0
    while heap:
        rank, i = heappop(heap)
        j = right[i]
        if part[i] is None or j >= n or ranks.get((part[i], part[j])) != rank:
            continue  # one of the pair has been merged since
        part[i] += part[j]
        part[j] = None
        right[i] = right[j]
        if right[j] < n:
            left[right[j]] = i
        merges += 1
        before, after = left[i], right[i]
        if before >= 0 and (r := ranks.get((part[before], part[i]))) is not None:
            heappush(heap, (r, before))
        if after < n and (r := ranks.get((part[i], part[after]))) is not None:
            heappush(heap, (r, i))
    return n - merges


class Counter:
    """Counts texts; remembers the counts of recent words."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.known = Remembered(lambda word: merged_size(vocabulary.symbols(word), vocabulary.ranks), 400_000)

    def count(self, text: str | None) -> int:
        return sum(sum(map(self.known.__getitem__, words)) + (special is not None) for words, special in self.v.words(text))


@held
def _counter(path: str) -> Counter:
    return Counter(load(path))


def token_counts(docs: DataFrame, path: str, limit: int = 2048, text: str = "text") -> DataFrame:
    """Adds ``n_bytes long`` (UTF-8), ``n_tokens long`` and ``over_limit boolean`` (n_tokens > limit). Map-only."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(path)
        for texts in batches:
            yield pd.Series([counter.count(t) for t in texts], index=texts.index, dtype="int64")

    source = F.col(f"`{text}`")
    n_bytes = F.coalesce(F.octet_length(source), F.lit(0)).cast("long")
    return docs.withColumns({"n_tokens": run(source), "n_bytes": n_bytes}).withColumn("over_limit", F.col("n_tokens") > limit)
