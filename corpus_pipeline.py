"""From raw documents to packed training windows, in four stages.

Quality rules drop documents, then the quality classifier does; of each group of SimHash neighbours one document stays;
what is left is packed. Every stage reads what the one before wrote. All but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import packing, quality, rules, simhash
from ebbtide.llm.text import shielded
from ebbtide.session import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule, or a rule that their host fails often, go."""
    inner, at = shielded(docs)  # a column called like one that the operator makes keeps its own values
    return rules.judge(inner, at["text"], at["source"]).where("kept").select(*inner.columns).toDF(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below the threshold go; it learns from the labelled ones among ``docs``."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    inner, at = shielded(docs)
    return quality.score(inner, model, at["text"]).where("predicted = 1").select(*inner.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the windows that the rest is packed into."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("quality_classifier", quality_classifier), ("near_duplicates", near_duplicates), ("packing", pack)]

#: Hashes, trained weights and tokenizers can't be said in SQL; tests hold the rows against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
