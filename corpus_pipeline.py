"""The corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept. All but the last return the columns of ``documents``:

1. quality: documents that the classifier rejects go;
2. lines: recurring lines go, and documents that lose most of their text with them
   (what is left of a copy no longer resembles it);
3. near_duplicates: one document of each group of near copies stays;
4. decontaminate: documents with a benchmark passage go;
5. encode: token ids and decoded text of what is left.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from citymarts.llm import bpe, decontaminate, linededup, ngrams, quality
from citymarts.llm.components import written

TOKENIZER = "word_bpe_49k.json"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps. Rows of one id and text are judged alike."""
    key = F.xxhash64("text")
    marked = docs.withColumn("_same", key)
    # the text itself is the classifier's input; id and digest bring its decision back
    scored = quality.classify(marked.select(F.struct("doc_id", "_same").alias("row"), "text"), id_col="row")
    bad = scored.where(~F.col("keep")).select(F.col("row.doc_id").alias("_id"), F.col("row._same").alias("_bad")).distinct()
    rejected = marked["doc_id"].eqNullSafe(bad["_id"]) & marked["_same"].eqNullSafe(bad["_bad"])
    return marked.join(bad, rejected, "left_anti").drop("_same")


LEAST_LEFT = 0.3   # share of its characters that a document must keep when it loses lines


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; those that keep under ``LEAST_LEFT`` of their text go.

    Documents that lose no line stay as they are, NULL and blank texts, too.
    ``n_chars`` is that of the remaining text.
    """
    out = linededup.remaining(docs, least_left=LEAST_LEFT)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngrams.representatives(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), valued=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text."""
    encoded = bpe.encode_decode(docs, public_tokenizers.path(TOKENIZER))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("lines", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("encode", encode),
]

#: SQL cannot express the classifier and the tokenizer; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
