"""Corpus pipeline: quality, near copies, repeated passages, mixing, token ids.

``STAGES`` lists (name, function) in order. A function takes
(spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns
they got; the last returns what ``op2_sentencepiece`` returns, per row.

A stage reads what it needs besides ``docs`` (labels) from ``sf_dir``. Each
judges its own input: statistics, groups and rates are those of the rows its
predecessor kept. Empty input gives empty output at every stage; cases of
single rows are those of the operator a stage calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandcast.llm import mixing, quality_classifier, sentencepiece_bpe, simhash, substring_dedup
from demandcast.llm.common import Scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"), Scratch(spark, "quality"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that of the smallest id."""
    return simhash.one_of_each(docs, Scratch(spark, "simhash"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document are cut from the later ones;
    n_chars follows the text, and documents left without a word go."""
    return substring_dedup.without_repeats(docs, Scratch(spark, "substring"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated by Poisson counts to their target weights."""
    return mixing.mix(docs, Scratch(spark, "mix"), copy_col=None, key_col=None)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return sentencepiece_bpe.encode_digests(docs)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("mixed", mixed),
    ("token_ids", token_ids),
]

# A fitted model, SimHash groups and merges by piece scores are beyond SQL;
# the stages are held against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return scratch.write(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
