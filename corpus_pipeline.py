"""A corpus pipeline of the training-data operators: each stage works on all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telefold.llm import bpe, decontaminate, jaccard, lines, quality
from telefold.llm.columns import named, unused
from telefold.llm.queries import KEEP_SCORE, LINE_DOCS, WORD_BPE, train_quality
from telefold.llm.shipping import ship
from telefold.session import work_path


def _as_documents(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    length = F.char_length("text").cast("long")
    return docs.select(*(length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship(spark)
    score = unused(docs, "score")
    scored = quality.score(docs, train_quality(spark, docs, sf_dir), out=score)
    return scored.filter(F.col(score) >= KEEP_SCORE).select(*map(named, docs.columns))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines found in many documents only the first stays; documents that lose all but white space go."""
    ship(spark)
    kept = lines.drop_frequent_lines(docs, LINE_DOCS, keep_first=True)
    return _as_documents(kept.filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"(?U)\S")), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents that of smallest id stays."""
    ship(spark)
    return jaccard.one_per_component(docs, percent=75, words=5)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of test items go, and documents made mostly of them."""
    ship(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _as_documents(decontaminate.decontaminate(docs, items, window=10), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and a digest of what they decode to."""
    ship(spark)
    path = public_tokenizers.path(WORD_BPE)
    both = bpe.round_trip(docs.select("doc_id", "text"), path)
    return both.select("doc_id", F.size("coded.ids").cast("long").alias("n_tokens"), "coded.ids", F.sha2("coded.decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("BPE encoding and decoding", encode),
]

#: SQL can express neither the classifier nor the encoding; the tests hold the stages against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = work_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
