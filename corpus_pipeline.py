"""From raw documents to token ids: each stage calls one operator of farespark.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from farespark.llm import bpe, mixing, passages, simhash, toxicity
from farespark.llm.common import land, table

#: The pipeline takes each document once at most.
MIX = replace(mixing.PLAN, fraction=0.8, max_epochs=1)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group: four-word shingles, at most four bits."""
    return simhash.keep_first(docs, shingle=4, max_bits=4)


def passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 400 bytes and more that occur more than once, and of 50 words and more that several documents hold."""
    return passages.cut_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents to the target weights."""
    return mixing.take_mix(docs, MIX)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes the texts and decodes the ids again: digests of both."""
    return bpe.digests(docs, bpe.multi_ranks_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("simhash", simhash_stage),
    ("passages", passages_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
