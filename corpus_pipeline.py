"""Corpus pipeline: five filtering and rewriting stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared folder
of ``spark.checkpoint.dir`` and gives the reread table to the next one. All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from odflow.llm.decontaminate import remove_contaminated
from odflow.llm.mixing import mix
from odflow.llm.near_duplicates import drop_near_duplicates
from odflow.llm.pii import pseudonymise
from odflow.store import Store
from odflow.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (shingles of five words, similarity 0.8 or more)."""
    return drop_near_duplicates(docs, size=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of the benchmark; mostly copied documents go altogether."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal numbers, dates and addresses replaced by pseudonyms of their format."""
    return pseudonymise(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the words that the mix takes of each (``taken``); what it takes nothing of is out."""
    return mix(docs).filter("taken > 0")


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pii", pii),
          ("mix_sources", mix_sources)]

#: A trained classifier and signatures are not for SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, docs = Store(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, store.cut(stage(spark, docs, sf_dir))
        if i:  # the last stage's input only
            store.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
