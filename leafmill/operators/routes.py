"""Jobs for corpora of one format: files to parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.core import let
from leafmill.functions.text import decode_text
from leafmill.operators import documents as D
from leafmill.operators.envelope import envelope
from leafmill.options import ParseOptions
from leafmill.plans import corpus


def _job(files: DataFrame, doc: Column, opts: ParseOptions) -> DataFrame:
    return envelope(files.select("path", "file_name", "file_size", doc.alias("doc")), opts)


def _text_job(files: DataFrame, build, opts: ParseOptions) -> DataFrame:
    return _job(files, let(decode_text(F.col("content")), build), opts)


def html_documents(files: DataFrame, opts: ParseOptions = ParseOptions()) -> DataFrame:
    return _text_job(files, D.html_document, opts)


def xml_documents(files: DataFrame, opts: ParseOptions = ParseOptions()) -> DataFrame:
    return _text_job(files, D.xml_document, opts)


def markdown_documents(files: DataFrame, opts: ParseOptions = ParseOptions()) -> DataFrame:
    return _text_job(files, D.markdown_document, opts)


def plain_documents(files: DataFrame, opts: ParseOptions = ParseOptions()) -> DataFrame:
    """Plain and configuration text; the type comes from the file name."""
    found = corpus.detect(files)
    return _text_job(found, lambda raw: D.plain_document(F.col("type"), raw), opts)


def notebook_documents(files: DataFrame, opts: ParseOptions = ParseOptions()) -> DataFrame:
    return _text_job(files, lambda raw: D.notebook_document(raw, opts), opts)


def sheet_documents(files: DataFrame, delimiter: str = ",", opts: ParseOptions = ParseOptions()) -> DataFrame:
    return _text_job(files, lambda raw: D.delimited_document(raw, delimiter, F.col("file_name"), opts), opts)


def container_documents(files: DataFrame, kind: str, opts: ParseOptions = ParseOptions()) -> DataFrame:
    """Archives, decks, word documents, workbooks or e-books, all of the given type."""
    found = corpus.with_members(files.withColumn("type", F.lit(kind)), opts)
    doc = corpus.container_document((kind,), F.lit(kind), F.col("members"), opts)
    return _job(found, F.when(F.col("file_size") == 0, D.empty_document()).otherwise(doc), opts)


def notices(detected: DataFrame, opts: ParseOptions = ParseOptions()) -> DataFrame:
    """Files of formats that are named but not extracted."""
    found = detected.filter(F.col("type").isin(D.NOTICE_TYPES))
    return _job(found, D.notice_document(F.col("type"), F.col("file_name"), F.col("file_size"), opts), opts)


def unknowns(detected: DataFrame) -> DataFrame:
    """The notice rows of files whose type has no handler."""
    known = [*corpus.TEXT_TYPES, *corpus.member_plans(ParseOptions()), *D.NOTICE_TYPES, "xls"]
    found = detected.filter(~F.col("type").isin(known) & (F.col("file_size") > 0))
    return _job(found, D.unknown_document(F.col("type"), F.col("ext"), F.col("file_size")), ParseOptions())


def empty_files(files: DataFrame) -> DataFrame:
    """The rows of empty files; over a file scan the size condition is pushed down."""
    return _job(files.filter(F.col("file_size") == 0), D.empty_document(), ParseOptions())


def read_failures(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Error rows for requested paths that the scan did not deliver.

    ``manifest`` has one column, path.  Only paths are compared, so the scan reads no content, and
    the planner broadcasts the scanned side only when its measured size allows.
    """
    missing = manifest.join(files.select("path"), "path", "left_anti")
    message = F.concat(F.lit("ENOENT: no such file or directory, open '"), F.col("path"), F.lit("'"))
    rows = missing.select(
        "path", corpus.file_name(F.col("path")).alias("file_name"), F.lit(0).cast("bigint").alias("file_size")
    )
    return _job(rows, D.read_failure_document(message), ParseOptions())
