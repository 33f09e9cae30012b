"""Corpus pipeline: stages applied to ``documents`` one after another.

Every stage works on all that its predecessor kept; the result of a stage is
written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import byte_bpe, decontaminate, line_dedup, minhash_dedup, tables, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal toxicity model rejects go."""
    tables.prepare(spark)
    return toxicity.without_toxic(docs, toxicity.train(docs, tables.table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, and documents of which nothing but blanks is left by that.

    ``n_chars`` is the length of the remaining text."""
    tables.prepare(spark)
    return line_dedup.without_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, stays of each class of near duplicates."""
    tables.prepare(spark)
    classes = minhash_dedup.near_duplicates(docs)
    repeated = classes.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(repeated, "doc_id", "left_anti").select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    tables.prepare(spark)
    return decontaminate.without_passages(docs, tables.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level ids of every remaining document, decoded again as a check."""
    tables.prepare(spark)
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark),
    ("byte_bpe", encode),
]

#: A fitted model and tokenisation have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result over the ``documents`` of ``sf_dir``."""
    tables.prepare(spark)
    docs = tables.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = tables.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
