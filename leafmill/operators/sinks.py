"""Report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.report import export_name, report_text
from leafmill.options import ParseOptions
from leafmill.plans.corpus import parse_corpus


def render_report(parsed: DataFrame) -> DataFrame:
    """path, file_name, report."""
    return parsed.select("path", "file_name", report_text().alias("report"))


def export_reports(files: DataFrame, opts: ParseOptions = ParseOptions()) -> DataFrame:
    """path, export_name, report: untruncated reports, from one parse."""
    parsed = parse_corpus(files, opts.untruncated())
    return parsed.select("path", export_name(F.col("file_name")).alias("export_name"), report_text().alias("report"))


def write_reports(
    files: DataFrame, directory: str, opts: ParseOptions = ParseOptions(), one_file_each: bool = False
) -> None:
    """Write untruncated reports, as Parquet or as one text file per report.

    Parquet is the form for large corpora; a file per report suits small ones.
    """
    reports = export_reports(files, opts)
    if one_file_each:
        reports.select("export_name", "report").write.partitionBy("export_name").option("lineSep", "\n").text(directory)
    else:
        reports.write.parquet(directory)
