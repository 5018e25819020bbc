"""A corpus pipeline: quality rules, toxicity, near-duplicates, mixing and packing, one stage after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes every stage's result to the folder that executors
share and reads it again as the next stage's docs. All stages but the last return the columns of documents.

Defined cases, for every stage. A null id: the row is judged like any other; near-duplicates among such rows keep one (of a component with
ids, the one with the smallest id), and mixing places them all in one block. A null text is an empty one: quality rules reject it; the stages
after them, called by themselves, keep it (no evidence of toxicity, linked with nothing, one token in mixing, one piece with the end token).
Null languages and sources change nothing but mixing, where a null source is a source of its own. Very long texts are handled whole. Rows
that repeat (id and text) are judged alike; near-duplicates keep one of them. Ties: near-duplicates keep the smallest id; elsewhere nothing is
ranked. An empty table gives an empty one. Extra columns pass through all stages but packing, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketloom.llm import mixing, near_dedup, packing, quality_rules, toxicity
from marketloom.llm.common import staged, table
from marketloom.session import ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every quality rule of the current policy passes."""
    return quality_rules.keep(docs)


def ordinary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't toxic; the models learn from the labelled ones among docs."""
    return toxicity.keep_ordinary(docs, table(ship(spark), sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship(spark)
    return near_dedup.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture reads them: the largest source once, others up to the repetition limit."""
    return mixing.mix(docs).select("__row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths, one row each."""
    ship(spark)
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("toxicity", ordinary), ("near-duplicates", distinct), ("mixing", mixed), ("packing", packed)]

#: Tokenization, near-duplicates and trained models can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ship(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
