"""Registered queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.llm import (decontaminate, html_extract, lexical_search, lz_fingerprint, minhash_dedup, mixing, quality, repetition, site_lines,
                        substring_dedup, token_files, toxicity, whitening)
from glossa.llm.oracle import ORACLE_SQL  # noqa: F401
from glossa.llm.common import read_table

#: The vocabulary of the token files: a parameter, never copied into the repository.
TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents at 75 % of common five-word shingles."""
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed at weights 3, 1, 2 to 150 % of their words: what the fair queue takes of each."""
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("source")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality.score(docs, labels).drop("row")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by the clause grammar, learned from the labels that are not held out."""
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return toxicity.score(docs, labels)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as token files and read back: start, n_tokens and CRC-32 of the ids."""
    return token_files.token_digests(read_table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


def op6_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's phrase fingerprint, next to its edited text's and its successor's."""
    return lz_fingerprint.fingerprints(read_table(spark, sf_dir, "documents"))


def op7_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page without the lines that are boilerplate of its host."""
    return site_lines.dedup_lines(read_table(spark, sf_dir, "pages"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by a block labeller trained on a bounded sample of the pages."""
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that 13-word windows repeat from documents with smaller ids."""
    return substring_dedup.dedup_substrings(read_table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold passages of the benchmark, found by spaced seeds and verified around the hits."""
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document by the base rules and by the repeats that its sorted suffixes show."""
    return repetition.repetition_rules(read_table(spark, sf_dir, "documents")).drop("n_repeats", "longest_repeat")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of all for each benchmark item."""
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on up to 32 whitened components."""
    out = whitening.whitened_components(read_table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


QUERIES = {f.__name__: f for f in (op1_minhash_dedup, op2_mix_sources, op3_quality, op4_toxicity, op5_token_files,
                                  op6_lz_fingerprint, op7_site_lines, op8_html_extract,
                                  op9_substring_dedup, op10_decontaminate, op11_quality_rules, op12_lexical_search,
                                  op13_whitening)}
