"""From raw documents to token counts: filter, dedup, decontaminate, encode.

Each stage works on every row that the one before kept; all but the last return the columns of
documents. What a stage does with nulls, empty texts, repeated rows and empty tables is what its
operator does.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_file
from pyspark.sql import DataFrame, SparkSession

from martwright.llm import bpe, decontaminate, exact_dedup, quality, simhash
from martwright.llm.common import documents, on_workers, stored


@on_workers
def quality_filter(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, scores below its threshold go."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


@on_workers
def exact_dedup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


@on_workers
def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays."""
    return simhash.drop_near_duplicates(docs, words=3, bits=3)


@on_workers
def decontaminate_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents go of whose words at least a twentieth lies in passages of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


@on_workers
def encode_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what is left."""
    return bpe.digests(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_filter),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate_stage),
    ("bpe", encode_stage),
]
ORACLE_SQL = None  # a fitted model, XXH64 and a tokenizer are beyond the SQL engine


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
