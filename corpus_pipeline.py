"""Corpus preparation: quality, line dedup, near-duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet into the cluster's shared folder and read back as the next
one's documents.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import bpe, line_dedup, mix_sources, quality, simhash
from rankforge.llm.common import read, shared_table


def _measured(docs: DataFrame, names: list[str]) -> DataFrame:
    """The columns ``names``, with n_chars, where there is one, of the text as it is now."""
    if "n_chars" in names:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*names)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.classify_documents(docs, read(spark, sf_dir, "labels")).filter("_kept").select(*docs.columns)


def line_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated blocks of lines go; every document stays, with what is left of its text."""
    return _measured(line_dedup.dedup_lines(docs), docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for every pass over a document, with the part of its text that was taken."""
    return mix_sources.mixed_documents(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix, with the digests of ids and decoded text."""
    return bpe.tokenize(docs, bpe.default_vocabulary(), ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_chunks),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", source_mix),
    ("bpe", bpe_tokens),
]

#: Near-duplicate detection and tokenizing cannot be written as SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
