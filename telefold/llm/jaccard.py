"""Documents linked by the Jaccard similarity of their word shingles, exactly, by partitioning the universe.

Two sets that are similar enough differ in at most H elements, a bound that follows from their sizes. Sizes fall
into bands; each band has a scheme that hashes the universe into more than H segments, so similar sets agree on
some segment (pigeonhole). A set is indexed by the subset it has in each segment, in the scheme of its own band
and, as a larger partner, in that of the band below.

Some segments are worth nothing for a set: empty ones, and those whose subset is so frequent that its bucket would
give all pairs of a large group. Each segment has a weight: 0 if skipped, 1 if its subset is indexed, 2 if also
the subsets with one element deleted are, since then a single difference is found too. A set whose weights sum up
to more than its H is safe: whatever it is linked with is found. So costs are allocated in three rounds:

1. all sets, subsets only; frequent ones are skipped;
2. sets that are not safe by that, one-deletion neighbourhoods too, those of frequent subsets as well; frequent
   subsets and neighbours are skipped;
3. sets still not safe (those made mostly of frequent content), all subsets.

Buckets propose links, an exact bound on sketches drops most false ones, the others are verified on the whole
sets. Only connectivity is asked for, so a bucket first proposes links with one of its members, and then, once
those are joined, only links between members that are still apart. Equal sets are one node throughout; nodes are
64-bit hashes of sets, shingles 64-bit hashes of words.
"""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .columns import aside, named
from .hashing import hash_runs, mix
from .held import tidy

CHARS_AT_ONCE = 800_000
FREQUENT = 48  # a bucket of more sets is skipped in rounds 1 and 2
ENTRIES = 1_000_000  # index entries that one task groups
SAMPLE_DOCS = 20_000  # documents whose subsets tell in advance which are very frequent
FILTER_BITS = 1 << 23
BLOCK = 1_000  # members of a bucket that one task compares with each other
PAIRS_AT_ONCE = 250_000
TURNS = 8  # tasks that share the buckets of a neighbourhood

_P = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.isin(np.arange(256), (0x20, *range(0x09, 0x0E)))


@dataclass(frozen=True)
class Bands:
    """Size bands and schemes for links of at least ``percent`` percent similarity."""

    percent: int

    @functools.lru_cache(200_000)  # noqa: B019
    def differences(self, total: int) -> int:
        """The most elements in which two linked sets of at most ``total`` elements together can differ."""
        p = self.percent
        return max(0, *(t - 2 * -(-p * t // (100 + p)) for t in range(max(2, total - 250), total + 1)))

    def edges(self, size: int) -> np.ndarray:
        edges = [1]
        while edges[-1] <= size:
            edges.append(max(edges[-1] + 1, -(-edges[-1] * 100 // self.percent)))
        return np.array(edges)

    @functools.lru_cache(200_000)  # noqa: B019
    def roles(self, size: int) -> tuple[tuple[int, int, int], ...]:
        """(scheme, segments, weight needed) in the scheme of the set's band and in that of the band below; a scheme
        without segments has nothing to link but equal sets."""
        edges = self.edges(size)
        band = int(np.searchsorted(edges, size, "right")) - 1
        out = [(band, self._segments(int(edges[band + 1])), 1 + self.differences(size + size * 100 // self.percent))]
        if band and size <= (int(edges[band]) - 1) * 100 // self.percent:
            out.append((band - 1, self._segments(int(edges[band])), 1 + self.differences(size + int(edges[band]) - 1)))
        return tuple(out)

    def _segments(self, end: int) -> int:
        most = self.differences(end - 1 + (end - 1) * 100 // self.percent)
        return most + 1 + -(-(most + 1) // 10) + 1 if most else 0


@dataclass
class Sets:
    """Distinct shingles of some texts, one text after the other, ascending."""

    shingles: np.ndarray
    start: np.ndarray  # of each text, and the end

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.start)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.start) - 1), self.sizes)

    def sums(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return total[self.start[1:]] - total[self.start[:-1]]

    def nodes(self) -> np.ndarray:
        """A hash of each set."""
        return mix(self.sums(mix(self.shingles ^ _P)) + self.sizes.astype(np.uint64) * _P).view(np.int64)


def shingle_sets(texts: list[str | None], words: int) -> Sets:
    """Words are runs without ASCII white space, A-Z lower-cased. Fewer than ``words`` of them are one shingle."""
    parts = [t.encode().lower() if t else b"" for t in texts]
    raw = b" ".join(parts)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[np.frombuffer(raw, np.uint8)], [True]])))
    first, end = edges[::2], edges[1::2]
    word = hash_runs(raw, first, end)
    n, k = len(word), words
    of = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), first, "right")
    count = np.bincount(of, minlength=len(texts))
    rolled = word[:max(n - k + 1, 0)].copy()
    for i in range(1, k):
        rolled = rolled * _P + word[i:n - k + 1 + i]
    inside = of[:len(rolled)] == of[k - 1:][:len(rolled)]
    hashes, owner = mix(rolled[inside]), of[:len(rolled)][inside]
    few = np.flatnonzero((count > 0) & (count < k))
    if len(few):
        begin = np.cumsum(count) - count
        whole = count[few].astype(np.uint64)
        for i in range(k - 1):
            more = count[few] > i
            whole[more] = mix(whole[more] * _P + word[begin[few[more]] + i])
        hashes, owner = np.concatenate([hashes, whole]), np.concatenate([owner, few])
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
    a = 0
    for b in ends.tolist():
        hashes[a:b].sort()
        a = b
    if len(hashes):
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
        hashes, owner = hashes[new], owner[new]
    return Sets(hashes, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]))


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Rows of a batch and their texts, so many that memory stays bounded. The text is the last column."""
    texts, chars, at = [], 0, 0
    for i, t in enumerate(batch.column(batch.num_columns - 1)):
        texts.append(t.as_py())
        chars += len(texts[-1] or "")
        if chars >= CHARS_AT_ONCE:
            yield batch.slice(at, i + 1 - at), texts
            texts, chars, at = [], 0, i + 1
    if texts:
        yield batch.slice(at), texts


def _texts(batches: Iterator[pa.RecordBatch], cells: Broadcast | None) -> Iterator[list[str | None]]:
    """Portions of the texts of rows (cell, text) whose cell is chosen."""
    for batch in batches:
        kept = batch if cells is None else batch.filter(pa.array(cells.value[batch.column(0).to_numpy()]))
        for _, texts in _portions(kept):
            yield texts


def _cell(doc: str) -> Column:
    return F.pmod(F.xxhash64(doc), F.lit(FILTER_BITS)).cast("int")


def _sketch(shingles: np.ndarray) -> bytes:
    """The parity of the shingles in each of at least twice as many cells as shingles, a power of two."""
    cells = max(64, 2 << int(len(shingles) - 1).bit_length() if len(shingles) else 64)
    at = (shingles & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=cells) & 1).astype(np.uint8), bitorder="little").tobytes()


class Sketches:
    """Sketches of a column, side by side."""

    def __init__(self, column: pa.Array):
        self.size = pc.binary_length(column).to_numpy()
        offsets, data = column.buffers()[1:]
        self.start = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column)].astype(np.int64)
        self.data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)

    def differ_at_least(self, i: np.ndarray, other: Sketches, j: np.ndarray) -> np.ndarray:
        """A lower bound of the elements in which sets differ, pair by pair: cells of unlike parity."""
        out = np.zeros(len(i), np.int64)
        x, y = self.size[i], other.size[j]
        kinds = x.astype(np.int64) << 32 | y
        for kind in np.unique(kinds).tolist():
            for at in np.array_split(np.flatnonzero(kinds == kind), int((kinds == kind).sum()) * ((kind >> 32) + (kind & 0xFFFFFFFF)) // 2_000_000 + 1):
                one = self.data[self.start[i[at], None] + np.arange(kind >> 32)]
                two = other.data[other.start[j[at], None] + np.arange(kind & 0xFFFFFFFF)]
                if one.shape[1] > two.shape[1]:
                    one, two = two, one
                folded = np.bitwise_xor.reduce(two.reshape(len(at), -1, one.shape[1]), axis=1)
                out[at] = np.bitwise_count((folded ^ one).view(np.uint64)).sum(axis=1, dtype=np.int64)
        return out


def segmented(sets: Sets, bands: Bands, role: int) -> tuple[np.ndarray, ...]:
    """For one role of each set: the set, number and hash of each segment that isn't empty, its elements, each
    element's segment and hash, and the segments and the weight needed of each set."""
    plan = [(bands.roles(int(n)) if n else ()) for n in sets.sizes]
    plan = [r[role] if len(r) > role else (0, 0, 0) for r in plan]
    scheme, segments, need = (np.array(x, np.int64) for x in zip(*plan)) if plan else (np.zeros(0, np.int64),) * 3
    owner = sets.owner
    here = segments[owner] > 0
    owner, h = owner[here], sets.shingles[here]
    salt = mix(scheme[owner].astype(np.uint64) + _P)
    segment = (mix(h + salt) % np.maximum(segments[owner], 1).astype(np.uint64)).astype(np.int64)
    order = np.argsort(owner * (int(segments.max(initial=0)) + 1) + segment)
    owner, segment, value = owner[order], segment[order], mix(h[order] * _P + np.uint64(1))
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (segment[1:] != segment[:-1])])) if len(owner) else np.zeros(0, np.int64)
    size = np.diff(np.concatenate([first, [len(owner)]]))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    sums = total[first + size] - total[first]
    return owner[first], scheme[owner[first]], segment[first], sums, size, value, segments, need


def _key(scheme: np.ndarray, segment: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The index key of a segment's subset; its two lowest bits are free."""
    return mix(sums + mix(scheme.astype(np.uint64) * np.uint64(1 << 32) + segment.astype(np.uint64) + _P)) & ~np.uint64(3)


def index_entries(sets: Sets, nodes: np.ndarray, bands: Bands, deletions: bool, frequent: np.ndarray) -> tuple[np.ndarray, ...]:
    """Keys (lowest bit: the role; the next: the segment has no weight) and nodes of all entries, then node and role,
    weight lost and weight to spare, of every set and role that has a scheme. Segments whose subset is frequent have
    no weight for their own set, but their one-deletion subsets are indexed all the same: sets that lack one element
    there count on meeting them."""
    keys, whose, lost_by, lost, spare = [], [], [], [], []
    for role in (0, 1):
        owner, scheme, segment, sums, size, value, segments, need = segmented(sets, bands, role)
        full = _key(scheme, segment, sums)
        skip = np.isin(full, frequent) if len(frequent) else np.zeros(len(full), bool)
        weight = 1 + deletions
        used = np.bincount(owner, minlength=len(nodes))
        gone = weight * (segments - used) + weight * np.bincount(owner[skip], minlength=len(nodes))
        parts, of = [full[~skip]], [owner[~skip]]
        if deletions:
            gone += np.bincount(owner[(size == 1) & ~skip], minlength=len(nodes))
            at = np.repeat(np.arange(len(full)), size)
            with_one = size[at] > 1
            at = at[with_one]
            less = _key(scheme[at], segment[at], sums[at] - value[with_one])
            ours = ~np.isin(less, frequent) if len(frequent) else np.ones(len(less), bool)
            gone += np.bincount(owner[at[~ours & ~skip[at]]], minlength=len(nodes))
            parts.append(less[ours] | skip[at[ours]].astype(np.uint64) << np.uint64(1))
            of.append(owner[at[ours]])
        keys.append(np.concatenate(parts) | np.uint64(role))
        whose.append(nodes[np.concatenate(of)])
        some = np.flatnonzero(segments)
        lost_by.append(np.stack([nodes[some], np.full(len(some), role)]))
        lost.append(gone[some])
        spare.append(weight * segments[some] - need[some])
    return np.concatenate(keys), np.concatenate(whose), np.concatenate(lost_by, 1), np.concatenate(lost), np.concatenate(spare)


def group_entries(keys: np.ndarray, nodes: np.ndarray, most: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of 2 to ``most`` nodes, equal ones once; (node, role, weight lost) of larger buckets' nodes, but for
    entries of segments without weight."""
    order = np.argsort(keys)
    bucket = keys[order] >> np.uint64(2)
    many = np.concatenate([[False], bucket[1:] == bucket[:-1]]) if len(bucket) else np.zeros(0, bool)
    many[:-1] |= many[1:]
    keys, nodes, bucket = keys[order[many]], nodes[order[many]], bucket[many]
    order = np.lexsort((nodes, bucket))
    keys, nodes, bucket = keys[order], nodes[order], bucket[order]
    new = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (nodes[1:] != nodes[:-1])]) if len(bucket) else np.zeros(0, bool)
    keys, nodes, bucket = keys[new], nodes[new], bucket[new]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    size = np.diff(np.concatenate([first, [len(bucket)]]))
    lists, seen = [], set()
    for a, n in zip(first[(size > 1) & (size <= most)].tolist(), size[(size > 1) & (size <= most)].tolist()):
        members = nodes[a:a + n]
        if (same := members.tobytes()) not in seen:
            seen.add(same)
            lists.append(members)
    hot = np.repeat(size > most, size) & (keys & np.uint64(2) == 0)
    which, times = np.unique(np.stack([nodes[hot], (keys[hot] & np.uint64(1)).astype(np.int64)]), axis=1, return_counts=True)
    return lists, np.concatenate([which, times[None]])


def _records(kind: str, **columns) -> pa.RecordBatch:
    """Rows of one kind of the mixed output of a task; columns not given are null."""
    n = len(next(iter(columns.values())))
    made = {"kind": pa.array([kind] * n, pa.string())}
    for name, type_ in (("key", pa.int64()), ("node", pa.int64()), ("role", pa.int32()), ("lost", pa.int64()), ("spare", pa.int64()), ("members", pa.list_(pa.int64()))):
        made[name] = pa.array(columns[name], type_) if name in columns else pa.nulls(n, type_)
    return pa.RecordBatch.from_pydict(made)


FOUND = "kind string, key bigint, node bigint, role int, lost bigint, spare bigint, members array<bigint>"
ENTRY = "bucket int, keys binary, nodes binary, lost binary"


class Join:
    """The steps of one join; every step is a DataFrame, what is used more than once is written to the shared folder."""

    def __init__(self, docs: DataFrame, percent: int, words: int, most: int, doc_id: str, text: str):
        self.spark = docs.sparkSession
        self.docs = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("ver"), F.col(f"`{text}`").alias("text"))
        self.bands, self.words, self.most = Bands(percent), words, most

    def sets(self) -> DataFrame:
        """(doc, ver, n, node, sketch) of each document; node is null without words."""
        words = self.words

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, texts in _portions(batch):
                    sets = shingle_sets(texts, words)
                    has = sets.sizes > 0
                    sketches = [_sketch(sets.shingles[a:b]) for a, b in zip(sets.start, sets.start[1:])]
                    yield pa.RecordBatch.from_pydict({
                        "doc": rows.column(0), "ver": rows.column(1), "n": pa.array(sets.sizes), "node": pa.array(sets.nodes(), mask=~has), "sketch": pa.array(sketches, pa.binary()),
                    })

        kind = self.docs.schema["doc"].dataType.simpleString()
        return self.docs.mapInArrow(run, f"doc {kind}, ver bigint, n bigint, node bigint, sketch binary")

    def chosen(self, ids: DataFrame) -> tuple[DataFrame, Broadcast]:
        """(cell, text) of each document, and the cells that hold all documents of ``ids`` and, by chance, few others."""
        words = ids.select(_cell("doc").alias("at")).groupBy(F.expr("at div 64").cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, at % 64)")).alias("bits"))
        bits = np.zeros(FILTER_BITS // 64, np.int64)
        for word, value in words.collect():  # at most FILTER_BITS / 64 rows
            bits[word] = value
        cells = np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool)
        return self.texts(), self.spark.sparkContext.broadcast(cells)

    def texts(self) -> DataFrame:
        return self.docs.filter("doc IS NOT NULL").select(_cell("doc").alias("cell"), "text")

    def entries(self, docs: DataFrame, cells: Broadcast | None, buckets: int, deletions: bool, frequent: np.ndarray) -> DataFrame:
        """Index entries packed by bucket; per portion one row more with what sets and roles lose."""
        words, bands = self.words, self.bands
        shared = self.spark.sparkContext.broadcast(frequent)  # bounded by the sample

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for texts in _texts(batches, cells):
                sets, nodes = _unseen(shingle_sets(texts, words), seen)
                keys, whose, lost_by, lost, spare = index_entries(sets, nodes, bands, deletions, shared.value)
                bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
                ends = np.cumsum(np.bincount(bucket, minlength=buckets))
                keys, whose = keys[order], whose[order]
                some = [b for b in range(buckets) if ends[b] > (ends[b - 1] if b else 0)]
                cut = [slice(ends[b - 1] if b else 0, ends[b]) for b in some]
                state = np.concatenate([lost_by, lost[None], spare[None]]).tobytes()
                some.append(int(nodes[0] % buckets) if len(nodes) else 0)
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(some, pa.int32()),
                    "keys": pa.array([*(keys[c].tobytes() for c in cut), None], pa.binary()),
                    "nodes": pa.array([*(whose[c].tobytes() for c in cut), None], pa.binary()),
                    "lost": pa.array([*([None] * len(cut)), state], pa.binary()),
                })

        return docs.mapInArrow(run, ENTRY)

    def buckets(self, entries: DataFrame, tasks: int) -> DataFrame:
        """Rows of kind ``list`` (members of a bucket) and ``lost`` (node, role, weight lost, weight to spare)."""
        most = self.most

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, nodes = [], []
            for batch in batches:
                for k, n, state in zip(*(batch.column(i) for i in (1, 2, 3))):
                    if state.is_valid:
                        node, role, lost, spare = np.frombuffer(state.as_py(), np.int64).reshape(4, -1)
                        yield _records("lost", node=node, role=role, lost=lost, spare=spare)
                    else:
                        keys.append(np.frombuffer(k.as_py(), np.uint64))
                        nodes.append(np.frombuffer(n.as_py(), np.int64))
            if keys:
                lists, hot = group_entries(np.concatenate(keys), np.concatenate(nodes), most)
                yield _records("list", members=lists, key=[int(_list_id(x)) for x in lists])
                yield _records("lost", node=hot[0], role=hot[1], lost=hot[2])

        return entries.repartition(tasks, "bucket").mapInArrow(run, FOUND)

    def very_frequent(self, docs: int) -> np.ndarray:
        """Keys of subsets that more than ``frequent`` sets of a sample of about SAMPLE_DOCS documents have in common, if
        there are more documents than that. Skipping them changes costs, never results."""
        if docs <= SAMPLE_DOCS:
            return np.zeros(0, np.uint64)
        sample = self.texts().filter(F.pmod(F.xxhash64("text"), F.lit(docs // SAMPLE_DOCS + 1)) == 0)
        tasks, most = max(1, self.spark.sparkContext.defaultParallelism), self.most

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, nodes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for batch in batches:
                for k, n in zip(batch.column(1), batch.column(2)):
                    if k.is_valid:
                        keys.append(np.frombuffer(k.as_py(), np.uint64) >> np.uint64(2))
                        nodes.append(np.frombuffer(n.as_py(), np.int64))
            pairs = np.unique(np.stack([np.concatenate(keys).view(np.int64), np.concatenate(nodes)]), axis=1)
            found, times = np.unique(pairs[0], return_counts=True)
            yield pa.RecordBatch.from_pydict({"key": pa.array(found[times > most] << 2, pa.int64())})

        found = self.entries(sample, None, tasks * 4, False, np.zeros(0, np.uint64)).repartition(tasks, "bucket").mapInArrow(run, "key bigint")
        return np.sort(np.array([r[0] for r in found.collect()], np.int64).view(np.uint64))

    def last_round(self, docs: DataFrame, cells: Broadcast, only: DataFrame) -> DataFrame:
        """(key, node) of all subsets, empty ones too, of the nodes of ``only``."""
        words, bands = self.words, self.bands

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for texts in _texts(batches, cells):
                sets, nodes = _unseen(shingle_sets(texts, words), seen)
                for role in (0, 1):
                    owner, scheme, segment, sums, _, _, segments, _ = segmented(sets, bands, role)
                    full = _key(scheme, segment, sums)
                    yield pa.RecordBatch.from_pydict({"key": full.view(np.int64), "node": nodes[owner]})
                    schemes = [bands.roles(int(n))[role][0] if n and len(bands.roles(int(n))) > role else 0 for n in sets.sizes]
                    for i in range(len(nodes)):
                        empty = np.setdiff1d(np.arange(segments[i]), segment[owner == i])
                        key = _key(np.full(len(empty), schemes[i]), empty, np.zeros(len(empty), np.uint64))
                        yield pa.RecordBatch.from_pydict({"key": key.view(np.int64), "node": np.full(len(empty), nodes[i])})

        return docs.mapInArrow(run, "key bigint, node bigint").join(only.select("node"), "node", "left_semi").distinct()

    def linked(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) of nodes that are linked, verified on whole sets."""
        bands, words, percent = self.bands, self.words, self.bands.percent

        @F.arrow_udf("boolean")
        def near(n: pa.Array, m: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
            most = np.array([bands.differences(t) for t in (n.to_numpy() + m.to_numpy()).tolist()], np.int64)
            rows = np.arange(len(x))
            return pa.array(Sketches(x).differ_at_least(rows, Sketches(y), rows) <= most)

        def of(side: str) -> DataFrame:
            return nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))

        sized = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
        likely = pairs.join(of("a"), "a").join(of("b"), "b").filter(sized).filter(near("n_a", "n_b", "sketch_a", "sketch_b"))
        likely = written(likely.select("a", "b"), "likely")
        ends = likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))).distinct()
        docs, cells = self.chosen(nodes.join(ends, "node").select("doc"))

        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for texts in _texts(batches, cells):
                sets, found = _unseen(shingle_sets(texts, words), seen)
                each = [sets.shingles[a:b].tobytes() for a, b in zip(sets.start, sets.start[1:])]
                yield pa.RecordBatch.from_pydict({"node": pa.array(found, pa.int64()), "shingles": pa.array(each, pa.binary())})

        whole = docs.mapInArrow(run, "node bigint, shingles binary")

        @F.arrow_udf("boolean")
        def similar(x: pa.Array, y: pa.Array) -> pa.Array:
            return pa.array([_similar(s.as_py(), t.as_py(), percent) for s, t in zip(x, y)], pa.bool_())

        with small_batches(self.spark):
            return self._verified(likely, whole, similar)

    @staticmethod
    def _verified(likely: DataFrame, whole: DataFrame, similar: Callable[..., Column]) -> DataFrame:
        with_a = likely.join(whole.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
        with_both = with_a.join(whole.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
        return written(with_both.filter(similar("x", "y")).select("a", "b").distinct(), "links")


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While it holds, Python gets few rows at once: they carry whole sets."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "200")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _unseen(sets: Sets, seen: set[int]) -> tuple[Sets, np.ndarray]:
    """Sets with elements that this task hasn't met yet, and their nodes."""
    nodes = sets.nodes()
    keep = np.zeros(len(nodes), bool)
    for i, (n, node) in enumerate(zip(sets.sizes.tolist(), nodes.tolist())):
        if n and node not in seen:
            seen.add(node)
            keep[i] = True
    return Sets(sets.shingles[keep[sets.owner]], np.concatenate([[0], np.cumsum(sets.sizes[keep])])), nodes[keep]


def _list_id(members: np.ndarray) -> np.int64:
    return mix(np.cumsum(mix(members.view(np.uint64) ^ _P) * np.arange(1, len(members) + 1, dtype=np.uint64))[-1:]).view(np.int64)[0]


def _similar(a: bytes, b: bytes, percent: int) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable by ``links`` (a, b), for nodes with links. Alternates two steps that
    tie each node's neighbours to the smallest of them, until nothing changes; nothing is gathered by node."""

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "edges")
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.union(down.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(tops)


def jaccard_components(
    docs: DataFrame, percent: int = 75, words: int = 5, frequent: int = FREQUENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash long`` (Spark's of the text), ``n_shingles long`` and
    ``component_id``, the smallest id reachable by links.

    Two documents link when 100 * |both| >= percent * |either| for their sets of distinct shingles of ``words``
    words. A text of fewer words is one shingle; one without words, or null, has none and links with nothing.
    Documents of equal sets link. Rows with a null id link with nothing and have a null component; rows with one id
    each have the component of their own text. Other columns aren't read. Subsets that more than ``frequent`` sets have
    are skipped where that is safe; it changes costs, never results.
    """
    join = Join(docs, percent, words, frequent, doc_id, text)
    spark = join.spark
    sets = written(join.sets(), "sets")
    nodes = sets.filter("node IS NOT NULL AND doc IS NOT NULL").groupBy("node").agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = written(nodes, "nodes")
    count, total = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    skipped = join.very_frequent(count)

    def grouped(docs: DataFrame, cells: Broadcast | None, entries: int, deletions: bool) -> DataFrame:
        tasks = max(partitions, entries // ENTRIES + 1)
        return written(join.buckets(join.entries(docs, cells, 4 * tasks, deletions, skipped), tasks), "buckets")

    def losses(found: DataFrame) -> DataFrame:
        # a set says the same in every task that meets a copy of it; buckets each count once
        told = F.col("spare").isNotNull()
        return found.filter("kind = 'lost'").groupBy("node", "role").agg(
            F.max(F.when(told, F.col("lost"))).alias("told"), F.max("spare").alias("spare"), F.coalesce(F.sum(F.when(~told, F.col("lost"))), F.lit(0)).alias("hot")
        )

    def lists(found: DataFrame) -> DataFrame:
        return found.filter("kind = 'list'").select("members")

    def first_of(unsafe: DataFrame) -> DataFrame:
        return nodes.join(unsafe.select("node").distinct(), "node").select("doc", "n")

    first = grouped(join.texts(), None, int(total), False)
    unsafe = written(losses(first).filter("told + hot > spare").select("node", "role", "hot"), "unsafe")
    candidates, keys = lists(first), None
    again = first_of(unsafe)
    size = again.agg(F.sum("n")).first()[0]
    if size:
        second = grouped(*join.chosen(again), 3 * int(size), True)
        candidates = candidates.union(lists(second))
        late = losses(second).join(unsafe.withColumnRenamed("hot", "before"), ["node", "role"]).filter("told + hot + 2 * before > spare")
        late = written(late.select("node").distinct(), "unsafe")
        if not late.isEmpty():
            keys = written(join.last_round(*join.chosen(first_of(late)), late), "keys")
    candidates = written(candidates.distinct(), "candidates")

    pairs = candidates.select(F.col("members")[0].alias("a"), F.explode(F.slice("members", F.lit(2), F.size("members"))).alias("b"))
    if keys is not None:
        pairs = pairs.union(keys.join(keys.groupBy("key").agg(F.min("node").alias("a")), "key").filter("a <> node").select("a", F.col("node").alias("b")))
    pairs = written(pairs.distinct(), "pairs")
    links = join.linked(pairs, nodes)
    labels = components(links)
    for forest in (True, False):
        apart = written(_apart(join, candidates, keys, labels, nodes, pairs, forest), "pairs")
        if not apart.isEmpty():
            links = links.union(join.linked(apart, nodes))
            pairs, labels = pairs.union(apart), components(links)
    smallest = labels.join(nodes, "node").groupBy("label").agg(F.min("doc").alias("component_id"))
    named = nodes.select("node", "doc").join(labels.join(smallest, "label"), "node", "left")
    named = named.select("node", F.coalesce("component_id", "doc").alias("component_id"))
    return sets.join(named, "node", "left").select(
        F.col("doc").alias(doc_id),
        F.col("ver").alias("text_hash"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc")).when(F.col("doc").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def _apart(
    join: Join, lists: DataFrame, keys: DataFrame | None, labels: DataFrame, nodes: DataFrame, tried: DataFrame, forest: bool
) -> DataFrame:
    """Pairs of a bucket's members that are still in different components and may be linked by their sketches, without
    those tried before. Pairs are formed and compared inside a task; only those left become rows. A large bucket is
    cut into blocks, and each two of them meet in a task.

    With ``forest`` a task gives only the closest pairs that would join all components it sees joined by close pairs,
    and a quarter of the buckets is looked at: near copies share many. What that leaves apart is for the last call,
    which sees every bucket and gives every pair."""
    bands = join.bands
    long = lists.filter(F.size("members") > 2).select(F.xxhash64("members").alias("bucket"), F.explode("members").alias("node"))
    if keys is not None:
        long = long.union(keys.select(F.col("key").alias("bucket"), "node"))
    if forest:
        long = long.filter(F.pmod(F.xxhash64("bucket"), F.lit(4)) == 0)
    named = long.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = named.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y")
    blocks = mixed.select("bucket", F.col("x").alias("least"), F.expr(f"cast(size div {BLOCK} as int) + 1").alias("blocks"))
    dealt = named.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.join(nodes.select("node", "n", "sketch"), "node").select(
        "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "label", "n", "sketch", "least"
    )

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        given: set[int] = set()
        pairs = 0
        for batch in batches:
            group = np.stack([batch.column(i).to_numpy() for i in range(3)])
            cuts = [0, *(np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                same = held and all(held[-1].column(i)[-1].as_py() == part.column(i)[0].as_py() for i in range(3))
                if pairs >= PAIRS_AT_ONCE and not same:
                    yield _not_given(_close(held, bands, forest), given)
                    held, pairs = [], 0
                held.append(part)
                pairs += (b - a) ** 2 // 2
        if held:
            yield _not_given(_close(held, bands, forest), given)

    order = ["bucket", "low", "high"]
    # buckets of one neighbourhood go to a few tasks, where a pair that several of them hold is given once
    turn = F.pmod(F.xxhash64("bucket"), F.lit(TURNS))
    close = dealt.repartition("least", turn, "low", "high").drop("least").sortWithinPartitions(*order).mapInArrow(compare, "a bigint, b bigint")
    return close.distinct().join(tried, ["a", "b"], "left_anti")


def _close(parts: list[pa.RecordBatch], bands: Bands, forest: bool) -> pa.RecordBatch:
    """Pairs of nodes of unlike label in a bucket whose sizes and sketches allow a link, all or a forest of labels."""
    rows = pa.Table.from_batches(parts).combine_chunks()
    bucket, low, high, block, node, label, n = (rows.column(i).to_numpy() for i in range(7))
    sketch = rows.column(7).combine_chunks()
    new = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
    end = np.concatenate([np.flatnonzero(new)[1:], [len(bucket)]])[np.cumsum(new) - 1]
    later = end - np.arange(len(bucket)) - 1  # members of the bucket that come after each
    i = np.repeat(np.arange(len(bucket)), later)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)
    allowed = (label[i] != label[j]) & ((block[i] != block[j]) | (low[i] == high[i])) & (node[i] != node[j])
    allowed &= np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * bands.percent
    i, j = i[allowed], j[allowed]
    ends = np.sort(np.stack([node[i], node[j]]), axis=0)
    _, once = np.unique(mix(ends[0].view(np.uint64)) * _P + ends[1].view(np.uint64), return_index=True)
    i, j, ends = i[once], j[once], ends[:, once]
    sums, back = np.unique(n[i] + n[j], return_inverse=True)
    most = np.array([bands.differences(int(t)) for t in sums], np.float64)[back]
    sketches = Sketches(sketch)
    margin = sketches.differ_at_least(i, sketches, j) / np.maximum(most, 0.5)
    near = np.flatnonzero(margin <= 1)
    if forest:
        near = near[np.argsort(margin[near], kind="stable")]
        near = near[_joining(label[i[near]], label[j[near]])]
    return pa.RecordBatch.from_arrays([pa.array(ends[0][near]), pa.array(ends[1][near])], ["a", "b"])


def _not_given(pairs: pa.RecordBatch, given: set[int]) -> pa.RecordBatch:
    """Pairs that this task hasn't given yet."""
    a, b = (pairs.column(i).to_numpy().view(np.uint64) for i in (0, 1))
    names = (mix(a) * _P + b).tolist()
    new = np.array([name not in given for name in names], bool)
    given.update(names)
    return pairs.filter(pa.array(new, pa.bool_()))


def _joining(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Those of the edges (a, b) that join what edges before them haven't joined."""
    _, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(int(flat.max(initial=-1)) + 1))
    kept = np.zeros(len(a), bool)

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for k, (x, y) in enumerate(zip(flat[:len(a)].tolist(), flat[len(a):].tolist())):
        x, y = top(x), top(y)
        if x != y:
            parent[x] = y
            kept[k] = True
    return kept


@aside
def one_per_component(docs: DataFrame, percent: int = 75, words: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each component's documents that of smallest id. Documents that link with nothing stay, also those without an
    id or words; equal rows are one. Columns are those of ``docs``."""
    found = jaccard_components(docs, percent, words, doc_id=doc_id, text=text).filter(f"component_id IS NULL OR component_id = `{doc_id}`")
    kept = written(found.select(F.col(f"`{doc_id}`").alias("__doc"), F.col("text_hash").alias("__ver")).distinct(), "kept")
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__ver"))
    hashed = docs.withColumn("__hash", F.xxhash64(F.col(f"`{text}`")))
    return hashed.join(kept, same, "left_semi").dropDuplicates([doc_id, "__hash"]).select(*map(named, docs.columns))
