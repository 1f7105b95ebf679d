"""Totals over a parsed corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summarise(parsed: DataFrame) -> DataFrame:
    """Per type: files, bytes, words, chars, truncated and failed; summed before the shuffle."""
    return parsed.groupBy("type").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("file_size").alias("bytes"),
        F.sum(F.coalesce("meta.word_count", F.lit(0))).alias("words"),
        F.sum("total_chars").alias("chars"),
        F.count_if("truncated").alias("truncated"),
        F.count_if(F.col("type") == "error").alias("failed"),
    )
