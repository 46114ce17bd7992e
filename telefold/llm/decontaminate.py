"""Benchmark decontamination with a suffix automaton of the test items.

All items go into one generalised suffix automaton over words. A document's words are streamed through it; the
automaton keeps the longest run of words, ending here, that some item holds. Runs of at least ``window`` words,
and whole items that are shorter, are hits.

The items are read in blocks of bounded size, each with an automaton of its own. A task holds a portion of its
documents while the automata pass over it, one after the other, so that it has one of them at a time. The driver
hands on a bounded number of blocks at once; with more of them the documents go through further rounds, with the hits
so far written between them. So neither a task nor the driver meets an unbounded automaton.
"""

from __future__ import annotations

import itertools
import pickle
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .columns import aside
from .held import held, only, tidy

BLOCK_WORDS = 200_000  # item words in one automaton
BLOCKS_AT_ONCE = 16  # blocks that the driver hands on together
PORTION_CHARS = 16_000_000  # text that a task holds while several automata pass over it

#: bytes to word bytes: A-Z lower-cased; every other ASCII character but a-z and 0-9 becomes a space
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words: runs of a-z, 0-9 and every character beyond ASCII, A-Z lower-cased. Null has none."""
    return text.encode().translate(WORD_BYTES).split() if text else []


class Automaton:
    """A generalised suffix automaton of the items; says which words of a text lie in a window of an item."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.length, self.link, self.next = [0], [-1], [{}]
        self.number: dict[bytes, int] = {}
        coded = [(item, [self.number.setdefault(w, len(self.number)) for w in words]) for item, words in items]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        n = len(self.length)
        #: the state of the last ``window`` words, for states of at least so many
        self.window_state = [-1] * n
        order = sorted(range(1, n), key=self.length.__getitem__)
        for s in order:
            if self.length[s] >= window:
                up = self.link[s]
                self.window_state[s] = self.window_state[up] if self.length[up] >= window else s
        #: items by state of a window; whole items shorter than a window by state and length
        self.windows: dict[int, set[str]] = {}
        self.whole: dict[int, dict[int, set[str]]] = {}
        for item, codes in coded:
            s = 0
            for i, c in enumerate(codes):
                s = self.next[s][c]
                if i + 1 >= window:
                    self.windows.setdefault(self.window_state[s], set()).add(item)
            if 0 < len(codes) < window:
                # a prefix of an item may share its state with longer strings; the length tells them apart
                self.whole.setdefault(s, {}).setdefault(len(codes), set()).add(item)
        #: the nearest state with whole items, the state itself or above
        self.marked = [-1] * n
        for s in order:
            self.marked[s] = s if s in self.whole else self.marked[self.link[s]]
        self.shortest = min([window, *(len(c) for _, c in coded if c)])

    def _extend(self, last: int, c: int) -> int:
        length, link, nxt = self.length, self.link, self.next
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(length)
        length.append(length[last] + 1)
        link.append(0)
        nxt.append({})
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        new = len(self.length)
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.next.append(dict(self.next[q]))
        self.link[q] = new
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal spans [from, to) of words in some window, and the items whose windows occur."""
        number, shortest = self.number, self.shortest
        codes = np.fromiter((number.get(w, -1) for w in words), np.int64, len(words))
        known = np.flatnonzero(np.diff(np.concatenate([[0], (codes >= 0).view(np.int8), [0]])))
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for a, b in zip(known[::2].tolist(), known[1::2].tolist()):
            if b - a >= shortest:
                self._stream(codes[a:b].tolist(), a, spans, items)
        return _joined(spans), items

    def _stream(self, codes: list[int], at: int, spans: list, items: set) -> None:
        nxt, link, length, window = self.next, self.link, self.length, self.window
        window_state, marked = self.window_state, self.marked
        s = run = 0
        for i, c in enumerate(codes):
            while c not in nxt[s]:
                s = link[s]
                if s < 0:
                    break
                run = length[s]
            if s < 0:
                s = run = 0
                continue
            s = nxt[s][c]
            run += 1
            if run >= window:
                spans.append((at + i + 1 - run, at + i + 1))
                items |= self.windows[window_state[s]]
            m = marked[s]
            while m > 0:
                for size, found in self.whole[m].items():
                    if size <= run:
                        spans.append((at + i + 1 - size, at + i + 1))
                        items |= found
                m = marked[link[m]]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


@held
def _automaton(items: bytes, window: int) -> Automaton:
    return Automaton([(item, words_of(text)) for item, text in pickle.loads(items)], window)


def _blocks(items: DataFrame, item_id: str, text: str) -> tuple[int, Iterator[bytes]]:
    """How many blocks there are; their items as pickled lists of (id as text, text), each of about ``BLOCK_WORDS``
    words, read one block at a time."""
    listed = items.select(F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{text}`").alias("t")).filter("id IS NOT NULL AND t IS NOT NULL")
    words = listed.agg(F.sum(F.octet_length("t") / 2 + 1)).first()[0] or 0  # at most so many
    blocks = int(words // BLOCK_WORDS) + 1

    def block(b: int) -> bytes:
        mine = listed.filter(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == b) if blocks > 1 else listed
        return pickle.dumps(sorted(map(tuple, mine.collect())))

    return blocks, map(block, range(blocks))


HITS = "struct<n_words:bigint, spans:array<struct<first:int, last:int>>, items:array<string>>"


Hits = tuple[int, list[tuple[int, int]], list[str]]


def _hits(texts: Iterable[str | None], automaton: Automaton) -> Iterator[Hits]:
    """Number of words, spans and sorted items of each text."""
    for text in texts:
        words = words_of(text)
        spans, items = automaton.hits(words)
        yield len(words), spans, sorted(items)


def _hits_arrow(hits: Iterable[Hits]) -> pa.Array:
    counts, offsets, first, last, item_offsets, names = [], [0], [], [], [0], []
    for count, spans, items in hits:
        counts.append(count)
        first += [a for a, _ in spans]
        last += [b - 1 for _, b in spans]
        offsets.append(len(first))
        names += items
        item_offsets.append(len(names))
    span = pa.StructArray.from_arrays([pa.array(first, pa.int32()), pa.array(last, pa.int32())], ["first", "last"])
    return pa.StructArray.from_arrays(
        [
            pa.array(counts, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), span),
            pa.ListArray.from_arrays(pa.array(item_offsets, pa.int32()), pa.array(names, pa.string())),
        ],
        ["n_words", "spans", "items"],
    )


def _portions(batches: Iterator[pa.Array]) -> Iterator[list[str | None]]:
    """Texts of so many batches that a portion is worth the making of the automata."""
    some, chars = [], 0
    for texts in batches:
        for t in texts:
            some.append(t.as_py())
            chars += len(some[-1] or "")
        if chars >= PORTION_CHARS:
            yield some
            some, chars = [], 0
    if some:
        yield some


def _both(x: Hits, y: Hits) -> Hits:
    return (x[0], _joined(x[1] + y[1]), sorted({*x[2], *y[2]})) if y[1] else x


def _finder(blocks: list[Broadcast], window: int) -> Callable[[Column], Column]:
    """A column of HITS in the items of the blocks."""

    @F.arrow_udf(HITS)
    @tidy
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if len(blocks) == 1:
            automaton = _automaton(blocks[0].value, window)
            for texts in batches:
                yield _hits_arrow(_hits((t.as_py() for t in texts), automaton))
            return
        only(__name__)
        order, now, automaton = list(range(len(blocks))), -1, None
        for texts in _portions(batches):
            found: list[Hits] = []
            for b in order:
                if b != now:
                    automaton = None  # one goes before the next is made
                    now, automaton = b, Automaton([(item, words_of(text)) for item, text in pickle.loads(blocks[b].value)], window)
                more = _hits(texts, automaton)
                found = [_both(x, y) for x, y in zip(found, more)] if found else list(more)
            order.reverse()  # the last one is at hand
            yield _hits_arrow(found)

    return run


@aside
def benchmark_hits(
    docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Adds ``n_words long``, ``n_hit long``, ``spans array<struct<first,last>>`` (maximal spans of hit words, by
    number from 0) and ``items array<string>`` (ids as text, sorted).

    Null, empty and wordless texts have no words and no hits; items without an id or words are left out; equal
    items each count. Map-only over the documents; a column named like an output is replaced.
    """
    spark, source = docs.sparkSession, F.col(f"`{text}`")
    count, blocks = _blocks(items, item_id, item_text)
    for done in range(0, count, BLOCKS_AT_ONCE):
        sent = [spark.sparkContext.broadcast(b) for b in itertools.islice(blocks, BLOCKS_AT_ONCE)]  # each bounded by BLOCK_WORDS
        docs = docs.withColumn("__hits", _finder(sent, window)(source))
        if done:
            together = F.struct(
                F.col("__hits.n_words").alias("n_words"),
                _merged(F.array_sort(F.concat("__before.spans", "__hits.spans"))).alias("spans"),
                F.array_sort(F.array_union("__before.items", "__hits.items")).alias("items"),
            )
            docs = docs.withColumn("__hits", together).drop("__before")
        if done + BLOCKS_AT_ONCE < count:
            docs = written(docs, "hits").withColumnRenamed("__hits", "__before")
            for b in sent:
                b.destroy()
    docs = docs.withColumns({c: F.col(f"__hits.{c}") for c in ("n_words", "spans", "items")}).drop("__hits")
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return docs.withColumn("n_hit", covered)


def _merged(spans: Column) -> Column:
    """Sorted spans with overlapping ones joined."""
    kind = "array<struct<first:int,last:int>>"
    return F.aggregate(
        spans,
        F.expr(f"cast(array() as {kind})"),
        lambda out, s: F.when(
            (F.size(out) > 0) & (s["first"] <= F.element_at(out, -1)["last"] + 1),
            F.concat(
                F.slice(out, F.lit(1), F.size(out) - 1),
                F.array(F.struct(F.element_at(out, -1)["first"].alias("first"), F.greatest(F.element_at(out, -1)["last"], s["last"]).alias("last"))),
            ),
        ).otherwise(F.concat(out, F.array(s))),
    )


WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters from each span's first word to its last."""
    raw = text.encode()
    ends = [m.span() for m in WORD.finditer(raw.translate(WORD_BYTES))]
    out, at = [], 0
    for first, last in spans:
        out.append(raw[at:ends[first][0]])
        at = ends[last][1]
    return b"".join([*out, raw[at:]]).decode()


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The documents without hit spans; those with more than ``max_coverage`` of their words hit go altogether.
    Documents without hits stay as they are. Columns are those of ``docs``."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([without_spans(t.as_py(), [(s["first"], s["last"]) for s in many.as_py()]) if len(many) else None for t, many in zip(texts, spans)], pa.string())

    hit = benchmark_hits(docs.withColumn("__row", F.struct(*(F.col(f"`{c}`") for c in docs.columns))), items, window, text, item_id, item_text)
    hit = hit.filter(F.col("n_hit") <= F.col("n_words") * max_coverage)
    row = F.col("__row")
    body = F.when(F.col("n_hit") > 0, cut(row[text], F.col("spans"))).otherwise(row[text])
    return hit.select(*(body.alias(c) if c == text else row[c].alias(c) for c in docs.columns))
