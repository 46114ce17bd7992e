"""Exact removal of long repeated strings with a suffix array of anchors.

Every string of ``length`` bytes has an anchor: of its substrings of ``SEED`` bytes the one of smallest hash. Equal
strings have equal anchors at equal places, so only places of one anchor need to be compared, and only by the
bytes around them that a string of that length can reach (the context). Places of equal context are one class;
two places of a class repeat the whole context.

The classes of an anchor are compared by an enhanced suffix array: their suffixes from the anchor on, sorted, with
common prefix lengths. A stack scan gives the tree of common-prefix intervals; in each interval the classes are
ranked by what stands before the anchor, and where extensions to the left are long enough, all occurrences of the
repeat are reported, not just neighbours in the array. Windows of a class that repeat all hold the anchor, so what
they cover is one run, and the first and last of them are all that is kept.

An anchor with a large share of all classes isn't gathered in one task: the windows around its places are counted
by hash instead, packed and combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .columns import aside
from .hashing import Bytes, mix

SEED = 128
BYTES_AT_ONCE = 800_000
GROUP = 20_000  # classes of an anchor that one task may gather, about 40 MB, or
SHARE = 1_000_000  # this fraction of all classes, if that is more
FILTER_BITS = 1 << 23
PIECE = 1 << 18  # bytes searched for anchors at once

class Text(Bytes):
    """Bytes of some texts, one after the other."""

    def anchors(self, starts: np.ndarray, ends: np.ndarray, length: int, seed: int) -> np.ndarray:
        """Places of the anchors of all strings of ``length`` bytes within the texts [starts, ends)."""
        found = np.zeros(len(self.raw), bool)
        n, width = len(self.raw) - seed + 1, length - seed + 1
        usable = np.zeros(len(self.raw) + 1, np.int8)
        long = ends - starts >= length
        np.add.at(usable, starts[long], 1)
        np.add.at(usable, ends[long] - length + 1, -1)
        usable = np.cumsum(usable[:-1]).astype(bool)
        for a in range(0, max(n - width + 1, 0), PIECE):
            b = min(n, a + PIECE + width - 1)
            value = self.sums[a + seed:b + seed] - self.sums[a:b]
            value *= self.inverse[a:b]
            value = mix(value)
            # 40 bits of hash, then the place, so the first of equals is the smallest
            value &= ~np.uint64(0xFFFFFF)
            value |= np.arange(b - a, dtype=np.uint64)
            least = _sliding_least(value, width)[usable[a:b - width + 1]]
            found[a + (least & np.uint64(0xFFFFFF)).astype(np.int64)] = True
        return np.flatnonzero(found)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours: blocks' running minima from the left and from the right."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def _joined(texts: list[str | None]) -> tuple[Text, np.ndarray, np.ndarray]:
    parts = [t.encode() if t else b"" for t in texts]
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if parts else ends
    return Text(b"".join(parts)), starts, ends


def _portions(batch: pa.RecordBatch, text: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    texts, size, at = [], 0, 0
    for i, t in enumerate(batch.column(text)):
        texts.append(t.as_py())
        size += len(texts[-1] or "")
        if size >= BYTES_AT_ONCE:
            yield batch.slice(at, i + 1 - at), texts
            texts, size, at = [], 0, i + 1
    if texts:
        yield batch.slice(at), texts


class Places:
    """Anchors of some texts with their contexts."""

    def __init__(self, texts: list[str | None], length: int, seed: int):
        self.bytes, starts, ends = _joined(texts)
        self.at = self.bytes.anchors(starts, ends, length, seed)
        self.row = np.searchsorted(ends, self.at, "right")
        self.start = np.maximum(starts[self.row], self.at + seed - length) if len(self.at) else self.at
        self.end = np.minimum(ends[self.row], self.at + length) if len(self.at) else self.at
        self.within = self.at - starts[self.row] if len(self.at) else self.at
        self.left, self.right = self.at - self.start, self.end - self.at
        self.anchor = self.bytes.hash(self.at, self.at + seed).view(np.int64)
        self.context = mix(self.bytes.hash(self.start, self.end) + self.left.astype(np.uint64)).view(np.int64)


def repeated_windows(contexts: list[tuple[bytes, int]], length: int) -> list[tuple[int, int] | None]:
    """For contexts (bytes, place of the anchor in them), all different, of one anchor: how many bytes before the
    anchor the last and the first window of ``length`` bytes start that another context holds too; None if none does.
    """
    n = len(contexts)
    rights = [c[a:] for c, a in contexts]
    lefts = [c[:a][::-1] for c, a in contexts]
    best: list[tuple[int, int] | None] = [None] * n
    if n < 2:
        return best

    def note(i: int, left: int, right: int) -> None:
        low, high = max(0, length - right), left
        if low <= high:
            old = best[i]
            best[i] = (low, high) if old is None else (min(old[0], low), max(old[1], high))

    if n == 2:
        left, right = _common(lefts[0], lefts[1]), _common(rights[0], rights[1])
        for i in (0, 1):
            note(i, left, right)
        return best
    order = sorted(range(n), key=rights.__getitem__)
    prefix = [0] + [_common(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    by_left = sorted(range(n), key=lefts.__getitem__)
    rank = np.empty(n, np.int64)
    rank[by_left] = np.arange(n)
    before = np.array([0] + [_common(lefts[a], lefts[b]) for a, b in zip(by_left, by_left[1:])] + [0], np.int64)
    most = max(map(len, lefts))

    def interval(right: int, i: int, j: int) -> None:
        """Members i to j of the array share ``right`` bytes from the anchor on."""
        if right + most < length:
            return
        ranks = np.sort(rank[order[i:j + 1]])
        # what two neighbours by left context share: the least of all steps between them
        shared = np.minimum.reduceat(before, np.stack([ranks[:-1] + 1, ranks[1:] + 1], 1).ravel())[::2] if len(ranks) > 1 else ranks[:0]
        left = np.zeros(len(ranks), np.int64)
        left[1:] = shared
        left[:-1] = np.maximum(left[:-1], shared)
        for r, x in zip(ranks[left + right >= length].tolist(), left[left + right >= length].tolist()):
            note(by_left[r], x, right)

    stack: list[tuple[int, int]] = [(0, 0)]  # common prefix, first member
    for k in range(1, n + 1):
        now, first = prefix[k] if k < n else -1, k - 1
        while stack and stack[-1][0] > now:
            right, first = stack.pop()
            interval(right, first, k - 1)
        if k < n and (not stack or stack[-1][0] < now):
            stack.append((now, first))
    return best


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is common, a[:high] isn't
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


RESULT = "context long, low int, high int"


def _results(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())], ["context", "low", "high"])


def _filter_bits(hashes: DataFrame) -> np.ndarray:
    """Which of FILTER_BITS cells hold a hash ``h``; of fixed size, however many hashes there are."""
    at = F.pmod("h", F.lit(FILTER_BITS)).cast("int")
    words = hashes.select(at.alias("at")).groupBy(F.expr("at div 64").cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, at % 64)")).alias("bits"))
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for word, value in words.collect():
        bits[word] = value
    return np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool)


def repeated_spans(docs: DataFrame, length: int, seed: int, doc_id: str, text: str, group: int = GROUP) -> DataFrame:
    """(doc, ver, spans): for texts with repeats, unmerged runs of bytes that a repeated string of ``length`` covers."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.hash(F.col(f"`{text}`")).alias("ver"), F.col(f"`{text}`").alias("text"))
    kind = docs.schema["doc"].dataType.simpleString()

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in _portions(batch, 2):
                p = Places(texts, length, seed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p.anchor), pa.array(p.context), rows.column(0).take(pa.array(p.row)), rows.column(1).take(pa.array(p.row)),
                     pa.array(p.within, pa.int64()), pa.array(p.left << 16 | p.right, pa.int32())],
                    ["anchor", "context", "doc", "ver", "at", "reach"],
                )

    found = written(docs.mapInArrow(places, f"anchor long, context long, doc {kind}, ver int, at long, reach int"), "places")
    classes = found.groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("times"), F.first("reach").alias("reach"), F.min(F.xxhash64("doc", "ver")).alias("held")
    )
    classes = written(classes, "classes")
    whole = classes.filter("times > 1").selectExpr("context", f"cast(greatest(0, {length} - reach % 65536) as int) AS low", "cast(reach div 65536 as int) AS high")
    counts = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("times").alias("least")).filter("n > 1 AND least = 1")
    counts = written(counts, "anchors")
    total = counts.agg(F.sum("n")).first()[0] or 0
    results = whole
    if total:
        open_ = classes.join(counts, "anchor")
        bounds = max(group, total // SHARE)
        large = np.sort(np.array([r[0] for r in counts.filter(F.col("n") > bounds).select("anchor").collect()], np.int64))  # SHARE at most, or few
        shared = spark.sparkContext.broadcast((_filter_bits(open_.select(F.col("held").alias("h"))), _filter_bits(open_.select(F.col("context").alias("h"))), large))
        chosen = docs.withColumn("cell", F.pmod(F.xxhash64("doc", "ver"), F.lit(FILTER_BITS)).cast("int")).select("cell", "text")

        def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Places, np.ndarray]]:
            """Places whose context is a class's that is asked for, each class once in a task."""
            in_docs, in_classes, _ = shared.value
            seen: set[int] = set()
            for batch in batches:
                kept = batch.filter(pa.array(in_docs[batch.column(0).to_numpy()]))
                for _, texts in _portions(kept, 1):
                    p = Places(texts, length, seed)
                    wanted = np.flatnonzero(in_classes[p.context % FILTER_BITS])
                    _, first = np.unique(p.context[wanted], return_index=True)
                    wanted = np.array([i for i in wanted[first].tolist() if p.context[i] not in seen], np.int64)
                    seen.update(p.context[wanted].tolist())
                    yield p, wanted

        def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for p, wanted in picked(batches):
                wanted = wanted[~np.isin(p.anchor[wanted], shared.value[2])]
                raw = p.bytes.raw.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p.anchor[wanted]), pa.array(p.context[wanted]), pa.array(p.left[wanted], pa.int32()),
                     pa.array([raw[a:b] for a, b in zip(p.start[wanted].tolist(), p.end[wanted].tolist())], pa.binary())],
                    ["anchor", "context", "left", "bytes"],
                )

        around = chosen.mapInArrow(contexts, "anchor long, context long, left int, bytes binary")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows: list[tuple[int, int, int]] = []
            now, members = None, {}

            def finish() -> None:
                if len(members) > 1:
                    for c, window in zip(members, repeated_windows(list(members.values()), length)):
                        if window:
                            rows.append((c, *window))

            for batch in batches:
                for anchor, c, left, raw in zip(*(column.to_pylist() for column in batch.columns)):
                    if anchor != now:
                        finish()
                        now, members = anchor, {}
                    members[c] = (raw, left)
                if len(rows) > 10_000:
                    yield _results(rows)
                    rows = []
            finish()
            yield _results(rows)

        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total) // 40_000 + 1)
        results = results.union(around.repartition(tasks, "anchor").sortWithinPartitions("anchor").mapInArrow(compare, RESULT))
        if len(large):
            results = results.union(_by_windows(chosen, picked, shared, tasks, length, seed))
    reach = written(results.groupBy("context").agg(F.min("low").alias("low"), F.max("high").alias("high")), "reach")
    cells = spark.sparkContext.broadcast(_filter_bits(reach.select(F.col("context").alias("h"))))

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places of contexts with repeats and, by chance, few others: most places need not be shuffled."""
        for batch in batches:
            yield batch.filter(pa.array(cells.value[batch.column(0).to_numpy() % FILTER_BITS]))

    runs = found.drop("anchor", "reach").mapInArrow(reached, f"context long, doc {kind}, ver int, at long").join(reach, "context").select("doc", "ver", (F.col("at") - F.col("high")).alias("first"), (F.col("at") - F.col("low") + length).alias("end"))
    return runs.groupBy("doc", "ver").agg(F.collect_list(F.struct("first", "end")).alias("spans"))


def _by_windows(chosen: DataFrame, picked, shared, tasks: int, length: int, seed: int) -> DataFrame:
    """The same for anchors with very many classes: windows around their places are counted by hash. A task reports
    itself the windows it meets in two classes and sends each window once."""
    buckets = 4 * tasks

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, wanted in picked(batches):
            wanted = wanted[np.isin(p.anchor[wanted], shared.value[2])]
            if not len(wanted):
                continue
            before = np.arange(length - seed + 1)
            start = p.at[wanted][:, None] - before
            inside = (start >= p.start[wanted][:, None]) & (start + length <= p.end[wanted][:, None])
            which, back = np.nonzero(inside)
            start = start[inside]
            # with the anchor and its place, for a window may hold several
            value = mix(mix(p.bytes.hash(start, start + length) + p.anchor[wanted][which].view(np.uint64)) + back.astype(np.uint64))
            order = np.argsort(value, kind="stable")
            value, context, back = value[order], p.context[wanted][which[order]], back[order]
            new = np.concatenate([[True], value[1:] != value[:-1]])
            first = np.flatnonzero(new)
            several = np.diff(np.concatenate([first, [len(value)]])) > 1
            bucket = (value[first] >> np.uint64(32)).astype(np.int64) % buckets
            by = np.argsort(bucket, kind="stable")
            ends = np.cumsum(np.bincount(bucket, minlength=buckets))
            packed = np.stack([value[first].view(np.int64), context[first], back[first] * 2 + several], 1)[by]
            cut = [(b, slice(ends[b - 1] if b else 0, ends[b])) for b in range(buckets)]
            cut = [(b, s) for b, s in cut if s.start < s.stop]
            repeated = np.repeat(several, np.diff(np.concatenate([first, [len(value)]])))
            low, high = _extremes(context[repeated], back[repeated])
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in cut] + [0], pa.int32()), pa.array([packed[s].tobytes() for _, s in cut] + [None], pa.binary()),
                 pa.array([None] * len(cut) + [np.concatenate([low, high]).tobytes()], pa.binary())],
                ["bucket", "windows", "known"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for packed, known in zip(batch.column(1), batch.column(2)):
                if known.is_valid:
                    yield _results(list(map(tuple, _pairs(np.frombuffer(known.as_py(), np.int64)))))
                else:
                    parts.append(np.frombuffer(packed.as_py(), np.int64).reshape(-1, 3))
        if parts:
            rows = np.concatenate(parts)
            rows = rows[np.argsort(rows[:, 0], kind="stable")]
            first = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
            size = np.diff(np.concatenate([first, [len(rows)]]))
            # one class may have come from several tasks
            apart = np.minimum.reduceat(rows[:, 1], first) != np.maximum.reduceat(rows[:, 1], first)
            told = np.maximum.reduceat(rows[:, 2] % 2, first) > 0
            repeated = np.repeat(apart | told, size)
            low, high = _extremes(rows[repeated, 1], rows[repeated, 2] // 2)
            yield _results(list(map(tuple, _pairs(np.concatenate([low, high])))))

    packed = chosen.mapInArrow(windows, "bucket int, windows binary, known binary")
    return packed.repartition(tasks, "bucket").mapInArrow(count, RESULT)


def _extremes(context: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each context, ascending, (context, least) and (context, most) of ``back``, flat."""
    order = np.lexsort((back, context))
    context, back = context[order], back[order]
    if not len(context):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = context[1:] != context[:-1]
    first, last = np.flatnonzero(np.concatenate([[True], new])), np.flatnonzero(np.concatenate([new, [True]]))
    return np.stack([context[first], back[first]], 1).ravel(), np.stack([context[last], back[last]], 1).ravel()


def _pairs(flat: np.ndarray) -> list[tuple[int, int, int]]:
    low, high = flat.reshape(2, -1, 2)
    return [(c, a, b) for (c, a), (_, b) in zip(low.tolist(), high.tolist())]


@aside
def remove_repeats(docs: DataFrame, length: int = 400, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """Adds ``n_bytes long``, ``spans array<struct<first,end>>`` (maximal removed runs of bytes), ``n_removed long`` and
    ``kept binary``: the text's UTF-8 bytes without each byte that a string of ``length`` bytes covers which also
    starts anywhere else, in the same text too.

    Null and empty texts have no bytes. Every row is a text of its own, so equal rows repeat each other. A string
    shorter than ``length`` is never a repeat. Other columns are kept; one named like an output is replaced.
    """
    if not 0 < seed <= length < 1 << 15:
        raise ValueError("seed must be between 1 and length, length below 32768")
    spans = repeated_spans(docs, length, seed, doc_id, text, group).toDF("__doc", "__ver", "__spans")
    body = F.col(f"`{text}`")

    @F.arrow_udf("struct<spans:array<struct<first:bigint,end:bigint>>,kept:binary>")
    def cut(texts: pa.Array, many: pa.Array) -> pa.Array:
        out = []
        for t, runs in zip(texts, many):
            if not runs.is_valid:
                out.append({"spans": [], "kept": None})
                continue
            raw, merged = t.as_py().encode(), []
            for s in sorted((r["first"], r["end"]) for r in runs.as_py()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append([*s])
            edges = [0, *(x for s in merged for x in s), len(raw)]
            out.append({"spans": [{"first": a, "end": b} for a, b in merged], "kept": b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))})
        return pa.array(out, pa.struct([("spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]))

    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__doc")) & (F.hash(body) == F.col("__ver"))
    joined = docs.join(spans, same, "left").withColumn("__cut", cut(F.when(F.col("__spans").isNotNull(), body), F.col("__spans")))
    raw = F.coalesce(body, F.lit("")).cast("binary")
    joined = joined.withColumns({"n_bytes": F.octet_length(raw).cast("long"), "spans": F.col("__cut.spans"), "kept": F.coalesce("__cut.kept", raw)})
    return joined.withColumn("n_removed", F.col("n_bytes") - F.octet_length("kept")).drop("__doc", "__ver", "__spans", "__cut")
