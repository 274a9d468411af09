"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from citymarts.llm import (bpe, decontaminate, embeddings, fertility, hardnegatives, licenses, linededup, ngrams, pii, prefixtrie,
                           quality, secrets, warc)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op3_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.98)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                               spark.read.parquet(f"{sf_dir}/benchmark.parquet"), valued=True)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), everywhere=True))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_recurring(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return bpe.digests(bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.mine(rows.withColumn("label", label), anchors=F.col("id") % 100 == 0)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixtrie.ordered(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefixtrie.trie(*prefixtrie.rebuilt(turns)).drop("digest")


def op13_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.rules(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                           public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                           public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_warc": op2_warc,
    "op3_embedding_neardup": op3_embedding_neardup,
    "op4_decontamination": op4_decontamination,
    "op5_pii": op5_pii,
    "op6_line_dedup": op6_line_dedup,
    "op7_secrets": op7_secrets,
    "op8_licenses": op8_licenses,
    "op9_quality": op9_quality,
    "op10_bpe": op10_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_fertility": op13_fertility,
}

ORACLE: dict[str, str] = {
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
             k AS (SELECT h, max(page_id) AS m FROM p WHERE strlen(h) >= 1000 GROUP BY h)
        SELECT p.page_id, strlen(p.h) AS payload_bytes, sha1(p.h) AS payload_digest,
               CASE WHEN k.m <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN k.m <> p.page_id THEN k.m END AS refers_to, TRUE AS verified
        FROM p LEFT JOIN k ON p.h = k.h""",
    "op6_line_dedup": linededup.SQL,
    "op11_hard_negatives": hardnegatives.SQL,
    "op12_prefix_trie": prefixtrie.SQL,
}
