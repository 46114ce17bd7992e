"""The registered queries of these operators, and the same results in SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, byte_bpe, decontaminate, fim, html, jaccard, lines, merkle, quality, repeats, secret_forms, secrets, token_count
from ..session import written
from .shipping import ship

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
LINE_DOCS = 10
KEEP_SCORE = 0.7
SECRET_SCORE = 0.5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.round_trip(docs, path)
    return both.select(
        "doc_id",
        F.size("coded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("coded.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


def _held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def train_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """Fitted on ``docs`` that have a label and aren't held out."""
    labels = _table(spark, sf_dir, "labels").filter(~_held_out()).select("doc_id", F.col("quality").alias("label"))
    return quality.train(docs, labels)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, train_quality(spark, docs, sf_dir))
    return scored.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def op3_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = repeats.remove_repeats(docs, length=400)
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_removed") > 0).alias("has_repeats"),
    )


def op4_frequent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.drop_frequent_lines(docs, LINE_DOCS)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.main_text(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_count.token_counts(docs, public_tokenizers.path(WORD_BPE), limit=2048)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = written(secrets.findings(docs), "findings")
    labelled = found.withColumn("label", secrets.rule_label(F.col("run"), F.col("before")))
    forest = secrets.train(labelled, path="source", always=secret_forms.known_findings(spark))
    scored = secrets.score(found, forest, path="source")
    return scored.select(
        "doc_id",
        F.col("nth").cast("long").alias("nth"),
        F.char_length("run").cast("long").alias("n_chars"),
        F.sha2("run", 256).alias("run_sha256"),
        "score",
        (F.col("score") >= SECRET_SCORE).alias("is_secret"),
    )


def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op9_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.jaccard_components(docs, percent=75, words=5).select("doc_id", "n_shingles", "component_id")


def op10_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    hit = decontaminate.benchmark_hits(docs, _table(spark, sf_dir, "benchmark"), window=10)
    return hit.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = merkle.manifest(
        _table(spark, sf_dir, "documents").select(*names),
        values={c: F.col(c) for c in names},
        tree="source",
        key="doc_id",
        changed={"text": F.replace("text", F.lit("\n"), F.lit(""))},
        when=tampered,
    )
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_chars").cast("long").alias("prefix_chars"),
        F.col("middle_chars").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = byte_bpe.round_trip(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)
    return both.select(
        "doc_id",
        F.size("coded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("coded.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {f.__name__: f for f in (op1_bpe_roundtrip, op2_quality, op3_remove_repeats, op4_frequent_lines, op5_main_text, op6_token_counts, op7_secrets, op8_nearest_vectors, op9_jaccard_components, op10_benchmark_hits, op11_merkle_manifest, op12_fill_in_middle, op13_byte_bpe)}

_SPLIT_LINES = """
    SELECT doc_id, line, pos,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(all_lines) AS line, unnest(range(1, len(all_lines) + 1)) AS pos
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM {docs}))"""

_FREQUENT = """
    SELECT key FROM (SELECT DISTINCT doc_id, key FROM {lines}) WHERE length(key) >= 1
    GROUP BY key HAVING count(*) >= 10"""

#: unsigned CRC-32 of the decimal doc_id, bit by bit; 3988292384 is its reversed polynomial
_CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda crc, c: list_reduce(list_concat([xor(crc, c)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

_LEAF = "sha256(" + " || ".join(
    f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in ("doc_id", "source", "lang", "n_chars", "{text}")
) + ")"

SQL = {
    "op11_merkle_manifest": f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, coalesce('1' || source, '0') AS tree, {_LEAF.format(text="text")} AS leaf,
           CASE WHEN {_CRC32} % 2 = 0 THEN {_LEAF.format(text="replace(text, chr(10), '')")} END AS changed
    FROM documents),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes AS (
    SELECT tree, 0 AS level, place, leaf AS digest, n FROM placed
    UNION ALL
    SELECT tree, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (n + 2) // 3
    FROM nodes WHERE n > 1 GROUP BY tree, level, place // 3, n),
subroots AS (
    SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
    SELECT 0 AS level, place, digest, n FROM subroots
    UNION ALL
    SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (n + 2) // 3
    FROM tops WHERE n > 1 GROUP BY level, place // 3, n),
inside AS (
    SELECT tree, place AS leaf_place, 0 AS level, place, n, coalesce(changed, leaf) AS digest, '' AS proof FROM placed
    UNION ALL
    SELECT f.tree, f.leaf_place, f.level + 1, f.place // 3, (f.n + 2) // 3,
           sha256(string_agg(CASE WHEN o.place = f.place THEN f.digest ELSE o.digest END, '' ORDER BY o.place)),
           f.proof || coalesce(string_agg(CASE WHEN o.place <> f.place THEN o.digest END, '' ORDER BY o.place), '')
    FROM inside f JOIN nodes o ON o.tree = f.tree AND o.level = f.level AND o.place // 3 = f.place // 3
    WHERE f.n > 1 GROUP BY f.tree, f.leaf_place, f.level, f.place, f.n, f.proof),
above AS (
    SELECT i.tree, i.leaf_place, 0 AS level, s.place, s.n, i.digest, i.proof
    FROM inside i JOIN subroots s ON s.tree = i.tree WHERE i.n = 1
    UNION ALL
    SELECT f.tree, f.leaf_place, f.level + 1, f.place // 3, (f.n + 2) // 3,
           sha256(string_agg(CASE WHEN o.place = f.place THEN f.digest ELSE o.digest END, '' ORDER BY o.place)),
           f.proof || coalesce(string_agg(CASE WHEN o.place <> f.place THEN o.digest END, '' ORDER BY o.place), '')
    FROM above f JOIN tops o ON o.level = f.level AND o.place // 3 = f.place // 3
    WHERE f.n > 1 GROUP BY f.tree, f.leaf_place, f.level, f.place, f.n, f.proof)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, sha256(a.proof) AS proof_sha256,
       a.digest AS folded_root, a.digest = r.digest AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree
JOIN above a ON a.tree = p.tree AND a.leaf_place = p.place AND a.n = 1
JOIN (SELECT digest FROM tops WHERE n = 1) r ON true""",
    "op12_fill_in_middle": """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
cut AS (
    SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
           CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
                     OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
    SELECT *, array_to_string(u[1:least(a, b)], '') AS prefix, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle,
           array_to_string(u[greatest(a, b) + 1:], '') AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts""",
    "op4_frequent_lines": f"""
WITH lines AS ({_SPLIT_LINES.format(docs="documents")}),
frequent AS ({_FREQUENT.format(lines="lines")})
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN frequent f USING (key) GROUP BY doc_id""",
    "op10_benchmark_hits": r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size,
           unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS gram
    FROM item_words WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
    SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS start_at,
           unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS gram
    FROM doc_words, sizes WHERE len(w) >= size),
found AS (SELECT doc_id, g.size, start_at, item_id FROM grams g JOIN windows USING (size, gram)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(start_at, start_at + size)) AS pos FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS names
          FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
       sha256(coalesce(i.names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h USING (doc_id) LEFT JOIN named i USING (doc_id)""",
}
