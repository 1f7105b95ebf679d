"""A corpus pipeline: documents without toxic ones, one of each group of near duplicates, without benchmark
passages, mixed to source weights, dealt to shards.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs; its rows are written as Parquet and read again as
the docs of the next. Null texts are clean, belong to no group, hold no passage and have no words, so the mix leaves them
out; rows without a doc_id are judged by their text, except that no group can name them, so they stay in stage two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import decontamination, mixing, ngram_join, sharding, toxicity
from leafmill.llm.scratch import keep
from leafmill.session import configure


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, trained on the labels of docs outside the held-out fold, does not call toxic."""
    configure(spark)
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id; a repeated row stays once."""
    configure(spark)
    first = ngram_join.join(docs).where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    named = docs.join(first, F.col("doc_id") == F.col("kept_id"), "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id is null"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item."""
    configure(spark)
    return decontamination.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources takes them."""
    configure(spark)
    return mixing.take(docs)


def deal_to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    configure(spark)
    return sharding.shard(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", deal_to_shards),
]

# Classifier, hashes and edit distance are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
