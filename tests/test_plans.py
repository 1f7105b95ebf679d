"""What the physical plans must and must not contain."""

import pytest

from corpora import build as B
from leafmill import parse_corpus, render_report, scan_files, summarise
from leafmill.operators import long_tables as L
from leafmill.operators import routes as R
from leafmill.operators.paged import assemble_pages
from leafmill.options import ParseOptions
from leafmill.sources.files import files_from_table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Documents as a files table on storage."""
    path = str(tmp_path_factory.mktemp("files") / "t")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    files_from_table(docs, F.col("doc_id").cast("string"), F.col("text")).write.parquet(path)
    return spark.read.parquet(path)


ROW_LOCAL = {
    "html": R.html_documents,
    "xml": R.xml_documents,
    "markdown": R.markdown_documents,
    "plain": R.plain_documents,
    "notebook": R.notebook_documents,
    "sheet": R.sheet_documents,
    "blocks": L.blocks,
    "headings": L.headings,
    "cells": L.cells,
}


@pytest.mark.parametrize("name", ROW_LOCAL)
def test_text_formats_stay_in_the_jvm_and_in_place(stored, name):
    text = plan(ROW_LOCAL[name](stored))
    assert "Exchange" not in text and "Python" not in text and text.count("Scan parquet") > 0


@pytest.mark.parametrize("kind", ["zip", "tar", "pptx", "docx", "xlsx", "epub"])
def test_containers_visit_python_once_and_are_not_shuffled(stored, kind):
    text = plan(R.container_documents(stored, kind), "simple")
    assert "Exchange" not in text and text.count("ArrowEvalPython") == 1


def test_corpus_is_one_pass(stored):
    text = plan(render_report(parse_corpus(stored)), "simple")
    assert "Exchange" not in text and text.count("ArrowEvalPython") == 1 and text.count("FileScan") == 1


def test_summary_shuffles_only_totals(stored):
    text = plan(summarise(parse_corpus(stored)), "simple")
    assert text.count("Exchange hashpartitioning(type") == 1 and text.count("HashAggregate") == 2


def test_scan_prunes_content_and_pushes_sizes(spark):
    scan = scan_files(spark, SF, "*.parquet")
    assert "content" not in plan(scan.select("path", "file_size")).split("ReadSchema")[1].splitlines()[0]
    assert "EqualTo(length,0)" in plan(R.empty_files(scan))


def test_manifest_reads_no_content(spark):
    manifest = spark.createDataFrame([("x",)], "path string")
    text = plan(R.read_failures(manifest, scan_files(spark, SF)))
    assert "content" not in text.split("ReadSchema")[1].splitlines()[0] and "LeftAnti" in text


def test_page_limit_trims_before_the_shuffle(spark):
    pages = B.paged(spark, SF)
    text = plan(assemble_pages(pages, ParseOptions(max_pages=3)), "simple")
    assert text.count("WindowGroupLimit") == 2
    whole = plan(assemble_pages(pages), "simple")
    assert "WindowGroupLimit" not in whole and "Join" not in whole and whole.count("FileScan") + whole.count("Scan ExistingRDD") <= 1


def test_expensive_steps_are_not_repeated(stored):
    text = plan(R.html_documents(stored), "simple")
    assert text.count("make_valid_utf8") <= 1 and text.count("<style") == 1
