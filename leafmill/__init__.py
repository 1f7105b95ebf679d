"""Document-corpus extraction on Spark: files in, result tables and reports out."""

from leafmill.operators.envelope import envelope
from leafmill.operators.sinks import export_reports, render_report, write_reports
from leafmill.operators.summary import summarise
from leafmill.options import ParseOptions
from leafmill.plans.corpus import detect, parse_corpus
from leafmill.sources.files import files_from_table, scan_files
from leafmill.sources.members import explode_members

__all__ = [
    "ParseOptions",
    "detect",
    "envelope",
    "explode_members",
    "export_reports",
    "files_from_table",
    "parse_corpus",
    "render_report",
    "scan_files",
    "summarise",
    "write_reports",
]
