"""The result envelope: limits, counts and metadata around a document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import truncate_note, truncate_plain, word_count
from leafmill.options import ParseOptions
from leafmill.schema import META_FIELDS, PARSED_COLUMNS, PLAIN, STATUS


def envelope(documents: DataFrame, opts: ParseOptions = ParseOptions()) -> DataFrame:
    """parsed: from path, file_name, file_size and a ``doc`` struct.

    Words are counted on the returned text, note included; plain text counts all of it.  Status
    rows carry their text with zero counts.
    """
    text = F.col("text")
    status = F.struct(
        text.alias("text"),
        F.lit(False).alias("truncated"),
        F.lit(0).cast("bigint").alias("total_chars"),
        F.lit(0).cast("bigint").alias("returned_chars"),
    )
    limited = (
        F.when(F.col("mode") == STATUS, status)
        .when(F.col("mode") == PLAIN, truncate_plain(text, opts.max_chars))
        .otherwise(truncate_note(text, opts.max_chars))
    )
    counted = F.when(F.col("mode") == PLAIN, text).otherwise(F.col("limited.text"))
    words = F.when(F.col("mode") != STATUS, word_count(counted))
    meta = F.struct(*[F.col(f) for f in META_FIELDS], words.alias("word_count"))
    return (
        documents.select("path", "file_name", "file_size", "doc.*")
        .withColumn("limited", limited)
        .withColumn("meta", meta)
        .select("path", "file_name", "file_size", "type", "meta", "limited.*", "tables", "structure", "archive_contents")
        .select(*PARSED_COLUMNS)
    )
