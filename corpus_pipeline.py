"""The corpus pipeline: quality classifier, near-dedup, benchmark decontamination, mixing, token files.

Each stage works on all rows that its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glossa.llm import decontaminate, minhash_dedup, mixing, quality, token_files
from glossa.llm.common import read_table, stage
from glossa.llm.queries import END_ID, tokenizer_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for each serving of a document."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files, read back: doc_id, start, n_tokens, ids_crc32 of every document."""
    return token_files.token_digests(docs, tokenizer_path(), END_ID)


STAGES = [("quality_classifier", quality_filter), ("minhash_near_dedup", near_dedup), ("benchmark_decontamination", decontamination),
          ("source_mixing", source_mix), ("token_output", token_output)]
#: The classifier, the sketches and the encoder can't be said in SQL: tests/llm holds each stage to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
