"""Files as they arrive: the corpus job over a directory stream.

The job is row-local, so the batch plan runs unchanged per micro-batch and keeps no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from leafmill.options import ParseOptions
from leafmill.plans.corpus import parse_corpus
from leafmill.sources.files import as_files

_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(spark: SparkSession, directory: str, glob: str | None = None, files_per_batch: int = 1000) -> DataFrame:
    """files of every file that appears in the directory."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return as_files(reader.load(directory))


def parse_arrivals(
    spark: SparkSession,
    directory: str,
    out: str,
    checkpoint: str,
    opts: ParseOptions = ParseOptions(),
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Parse what is in the directory now and not yet parsed, then stop; restart to go on."""
    parsed = parse_corpus(stream_files(spark, directory, files_per_batch=files_per_batch), opts)
    return (
        parsed.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
