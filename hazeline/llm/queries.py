"""The operators over the test tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm import (
    impact_index, importance, jaccard_groups, lexicon, merkle, packing, pseudonyms, quality_rules,
    secret_scan, suffix_dedup, token_blocks, warc_zip, whitening,
)

Query = Callable[[SparkSession, str], DataFrame]

KEY = "one key for each release of the corpus"


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE strlen(h) >= 100 GROUP BY h)
SELECT p.page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, sha256(p.h) AS payload_digest,
  CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON f.h = p.h
"""

_STOP_SQL = ", ".join(f"'{word}'" for word in quality_rules.STOP_WORDS)
OP9_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t,
    list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM w WHERE len(w) >= 5),
h AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS gram FROM g),
r AS (SELECT doc_id, gram FROM h GROUP BY doc_id, gram HAVING count(*) > 1),
c AS (SELECT DISTINCT h.doc_id, unnest(range(h.i, h.i + 5)) AS place FROM h JOIN r ON h.doc_id = r.doc_id AND h.gram = r.gram),
n AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
    length(t) - length(replace(t, '!', '')) AS n_shouts,
    length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) AS n_upper,
    len(list_filter(w, lambda x: list_contains([{_STOP_SQL}], regexp_replace(lower(x), '[.,;:!?"''()]', '', 'g')))) AS n_stop,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echoes
  FROM w LEFT JOIN n ON n.doc_id = w.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words <= 200000 AND word_chars BETWEEN 2 * n_words AND 14 * n_words
    AND n_symbols / n_words <= 0.1 AND n_shouts / n_words <= 0.2 AND n_upper / word_chars <= 0.3
    AND (n_words < 50 OR n_stop / n_words >= 0.02) AND n_dup_lines / n_lines <= 0.4
    AND n_echoes / n_words <= 0.2 AND n_repeat_words / n_words <= 0.2 AS kept
FROM b
"""

OP11_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, least(len(q.x), len(c.x)) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = warc_zip.write_packages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    read = warc_zip.read_packages(spark, report)
    revisit = F.col("record_type") == "revisit"
    return read.select(
        "page_id",
        F.when(revisit, F.col("size")).otherwise(F.octet_length("payload")).cast("bigint").alias("payload_bytes"),
        F.when(revisit, F.col("digest")).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op2_group_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups.linked(documents(spark, sf_dir), words=4, percent=85)


def op3_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compared(documents(spark, sf_dir))


def op4_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = token_blocks.write_tokens(documents(spark, sf_dir), BYTE_BPE)
    return token_blocks.read_tokens(spark, report).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
        F.col("_cut.n_removed").alias("n_removed"),
        F.col("_cut.n_spans").alias("n_spans"),
        F.sha2(F.col("_cut.kept"), 256).alias("kept_sha256"),
    )


def op6_differencing_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), BYTE_BPE).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)

    def number(kind: str) -> Column:
        return F.size(F.filter("_found", lambda m: m["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    kinds = [number(kind) for kind in pseudonyms.KINDS]
    return pseudonyms.pseudonymised(docs, KEY, found_as="_found").select(*docs.columns, *kinds)


def op8_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scanned(documents(spark, sf_dir)))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op10_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return lexicon.encode(docs, BYTE_BPE, lexicon.build_lexicon(docs, BYTE_BPE)).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return impact_index.nearest(rows, rows.filter("vec_id % 50 = 0"), k=5)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def queries() -> dict[str, Query]:
    return {
        query.__name__: query
        for query in (
            op1_warc_zip, op2_group_jaccard, op3_merkle_fingerprints, op4_token_blocks,
            op5_suffix_dedup, op6_differencing_packs, op7_feistel_pseudonyms, op8_entropy_secrets,
            op9_quality_rules, op10_lexicon_bpe, op11_impact_search, op12_importance_resampling,
            op13_bit_sliced_whitening,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_zip": OP1_SQL, "op9_quality_rules": OP9_SQL, "op11_impact_search": OP11_SQL}
