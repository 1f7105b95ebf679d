"""The numbered operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafmill.llm import decontamination, main_text, manifest, mixing, negatives, ngram_join, quality, sharding, substrings, token_output, toxicity, url_filter, warc
from leafmill.llm.checks import CHECKS  # noqa: F401
from leafmill.llm.scratch import new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(_table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), path)
    rows = warc.captures(warc.read(spark, path))
    return rows.select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents")).drop("set_id")


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "token-files")
    token_output.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_output.positions(token_output.write_index(spark, path, new_path(spark, "token-index")))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove(_table(spark, sf_dir, "documents")).drop("kept")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(_table(spark, sf_dir, "documents"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(_table(spark, sf_dir, "embeddings"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents")).drop("host_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_decontamination": op2_decontamination,
    "op3_quality": op3_quality,
    "op4_mixing": op4_mixing,
    "op5_main_text": op5_main_text,
    "op6_toxicity": op6_toxicity,
    "op7_warc": op7_warc,
    "op8_ngram_join": op8_ngram_join,
    "op9_token_output": op9_token_output,
    "op10_substrings": op10_substrings,
    "op11_manifest": op11_manifest,
    "op12_negatives": op12_negatives,
    "op13_url_filter": op13_url_filter,
}

