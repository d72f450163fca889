"""A corpus pipeline: every stage works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import bpe, decontaminate, language, ngram_join, quality
from tallyloom.llm.common import fold_of
from tallyloom.plans.scratch import run_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_quality(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs, fold_of(docs["doc_id"], 4) != 2)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_per_class(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    keep = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    # smaller caches than by default: the workers share an executor's memory with what the stages before left in its heap
    encoded = bpe.encode_documents(docs, path, public_tokenizers.PATTERN, keep=keep, with_ids=True, most_transitions=200_000, most_pieces=120_000)
    return encoded.select("row.*", *bpe.ENCODED_IDS.names)


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("bpe_encoding", encoding_stage),
]

#: Compression ratios, a trained classifier and BPE are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; each result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = run_dir(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
