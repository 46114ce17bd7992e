"""Line dedup over compressed per-document bitmaps, with DataFrame functions only.

Each line becomes two hashes of its key (the line without white space at both ends, A-Z lower-cased). They
are written once, then range-partitioned together with the document and sorted by text and position too, so
equal keys lie side by side and a key that a third of all lines share still spreads over many tasks. From that
order come the number of documents per key and its first occurrence. Lines find a key of more than a thousandth of all lines,
of which there are under a thousand, without a shuffle; the others meet theirs by a join, no key of which is large. What goes
back to a document is a bitmap of the lines it loses: 64 lines to a word, words without a bit left out. Text is read again only to
apply it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .columns import aside

HOT_KEYS = 1_000  # a key of more than this part of all lines is hot, so fewer than so many are
BLANK = " \t\n\x0b\f\r"  # fixed values: U+0020 and U+0009 to U+000D
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(BLANK)), UPPER, LOWER)


def split_lines(text: Column) -> Column:
    """Lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _occurrences(docs: DataFrame, min_chars: int, doc_id: str, text: str) -> DataFrame:
    """One row for each line with a key. ``ver`` tells texts of equal ids apart."""
    body = F.col(f"`{text}`")
    keyed = F.transform(split_lines(body), lambda line, i: F.struct(i.alias("pos"), line_key(line).alias("key")))
    hashed = F.transform(
        F.filter(keyed, lambda x: F.char_length(x["key"]) >= min_chars),
        lambda x: F.struct(F.xxhash64(x["key"]).alias("a"), F.hash(x["key"]).alias("b"), x["pos"].alias("pos")),
    )
    return docs.select(F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(body).alias("ver"), F.inline(hashed))


def dropped_lines(
    docs: DataFrame, min_docs: int, keep_first: bool = False, min_chars: int = 1, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc, ver, words): the lines each document loses, as ``words map<int,long>``; line ``p`` is bit ``p % 64`` of
    word ``p div 64``. Documents that lose nothing have no row.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` documents loses all its lines; with
    ``keep_first`` its first line by (document, text, place) stays. Rows with one id are one document.
    """
    lines = written(_occurrences(docs, min_chars, doc_id, text), "lines")
    ordered = lines.repartitionByRange("a", "b", "doc").sortWithinPartitions("a", "b", "doc", "ver", "pos")
    # equal keys of a document lie side by side, so this needs no shuffle of its own
    by_doc = ordered.groupBy("a", "b", "doc").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ver", "pos")).alias("first"))
    frequent = written(
        by_doc.groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n"), F.min(F.struct("doc", "first")).alias("kept"))
        .filter(F.col("docs") >= min_docs),
        "frequent",
    )
    is_hot = F.col("n") * HOT_KEYS > lines.count()
    hot = F.broadcast(frequent.filter(is_hot))  # fewer than HOT_KEYS rows
    others = lines.join(hot, ["a", "b"], "left_anti").join(frequent.filter(~is_hot), ["a", "b"])
    lost = lines.join(hot, ["a", "b"]).union(others)
    if keep_first:
        stays = F.col("doc").eqNullSafe(F.col("kept.doc")) & (F.struct("ver", "pos") == F.col("kept.first"))
        lost = lost.filter(~stays)
    bits = lost.groupBy("doc", "ver", F.expr("cast(pos div 64 as int)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits")
    )
    return bits.groupBy("doc", "ver").agg(F.map_from_entries(F.array_agg(F.struct("word", "bits"))).alias("words"))


@aside
def drop_frequent_lines(
    docs: DataFrame, min_docs: int, keep_first: bool = False, min_chars: int = 1, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents with the text that is left, ``n_lines long`` (before) and ``n_dropped long``.

    A text all of whose lines go becomes empty; one that loses nothing, null too, stays as it is. Equal rows lose
    equal lines (with ``keep_first`` the first line stays in each). Null ids are one document. Other columns are
    kept; one named like an output is replaced.
    """
    lost = dropped_lines(docs, min_docs, keep_first, min_chars, doc_id, text).toDF("__doc", "__ver", "__words")
    body = F.col(f"`{text}`")
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__doc")) & (F.xxhash64(body) == F.col("__ver"))
    # a dense array of words, so each line is looked up in one step
    dense = F.expr("transform(sequence(0, array_max(map_keys(__words))), w -> coalesce(__words[w], 0L))")
    kept = F.expr(
        f"filter(split(coalesce(`{text}`, ''), '\n', -1),"
        " (line, i) -> (shiftright(coalesce(get(__dense, cast(i div 64 as int)), 0L), i % 64) & 1L) = 0L)"
    )
    return (
        docs.join(lost, same, "left")
        .withColumn("__dense", F.when(F.col("__words").isNotNull(), dense))
        .withColumns({
            "n_lines": F.size(split_lines(body)).cast("long"),
            "n_dropped": F.expr("coalesce(aggregate(__dense, 0L, (n, bits) -> n + bit_count(bits)), 0L)"),
            text: F.when(F.col("__dense").isNull(), body).otherwise(F.array_join(kept, "\n")),
        })
        .drop("__doc", "__ver", "__words", "__dense")
    )
