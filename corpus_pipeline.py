"""A corpus of documents through five of the operators: language ID, near-duplicate removal,
benchmark decontamination, mixing to target weights, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it has kept; its
result is written as Parquet to the shared folder and read again as the next one's input. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from conceptnorm.llm import decontaminate, language, mixing, near_dup
from conceptnorm.llm.common import intermediates, small_batches, stage
from conceptnorm.llm.queries import language_prototypes, sharded


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, no letter) go. Learned from the stage's own input."""
    small_batches(spark)
    return language.identified(docs, language_prototypes(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one of least id."""
    small_batches(spark)
    return near_dup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule clears stay, as they are."""
    small_batches(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken, so some go and some are repeated."""
    return mixing.mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each row of the mix: its shard and its slot there."""
    return sharded(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_to_weights),
    ("sharding", sharding),
]

#: Hypervectors, random rounding and a flow are not SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has staged on its way is deleted once it is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage_of in STAGES:
        with intermediates(spark):
            docs = stage(stage_of(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return docs
