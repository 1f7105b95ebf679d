"""Report columns: the Markdown rendering of one parsed file.

Every section is an array of lines, so a report is one join over concatenated arrays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.core import string_array
from leafmill.functions.text import int_label, size_label, word_count
from leafmill.options import REPORT_MAX_ENTRIES, REPORT_MAX_TABLE_ROWS, REPORT_MAX_TABLES


def _when_lines(condition: Column, lines: Column) -> Column:
    return F.when(condition, lines).otherwise(string_array())


def report_heading(name: Column, kind: Column, size: Column) -> Column:
    return F.concat(F.lit("## "), name, F.lit(" ("), F.upper(kind), F.lit(", "), size_label(size), F.lit(")"))


def meta_lines(kind: Column, meta: Column) -> Column:
    """One line per metadata value, null and empty values left out."""

    def line(label: str, value: Column) -> Column:
        text = value.cast("string")
        return F.when(text != "", F.concat(F.lit(f"- **{label}**: "), text))

    epub = kind == "epub"
    return F.array_compact(
        F.array(
            line("Title", meta["title"]),
            line("Author", meta["author"]),
            line("Created", meta["created"]),
            line("Modified", meta["modified"]),
            line("Pages", F.when(~epub, meta["pages"])),
            line("Sheets", meta["sheets"]),
            line("Slides", meta["slides"]),
            line("Format", meta["format"]),
            # E-books state their format before their pages.
            line("Pages", F.when(epub, meta["pages"])),
            line("Entries", meta["entries"]),
            line("Word Count", meta["word_count"]),
        )
    )


def counts_line(meta: Column, text: Column) -> Column:
    words = F.coalesce(meta["word_count"], word_count(text), F.lit(0))
    pages = F.when(meta["pages"] > 0, F.concat(F.lit(" | Pages: "), meta["pages"].cast("string"))).otherwise("")
    chars = int_label(F.coalesce(F.length(text), F.lit(0)))
    return F.concat(F.lit("- Words: "), words.cast("string"), F.lit(" | Chars: "), chars, pages)


def truncation_line(truncated: Column, returned: Column, total: Column) -> Column:
    """Null when nothing was cut."""
    return F.when(
        truncated,
        F.concat(
            F.lit("> **Note:** Content was truncated ("),
            int_label(returned),
            F.lit(" of "),
            int_label(total),
            F.lit(" chars returned). Use maxChars for a higher limit."),
        ),
    )


def _row_line(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def table_lines(tables: Column) -> Column:
    """Lines of the first tables and the first rows of each; none without tables."""

    def one(table: Column) -> Column:
        headers, rows = table["headers"], table["rows"]
        more = F.size(rows) - REPORT_MAX_TABLE_ROWS
        return F.concat(
            _when_lines(table["name"] != "", F.array(F.concat(F.lit("**"), table["name"], F.lit(":**")))),
            _when_lines(
                F.size(headers) > 0,
                F.array(_row_line(headers), _row_line(F.transform(headers, lambda _: F.lit("---")))),
            ),
            F.transform(F.slice(rows, 1, REPORT_MAX_TABLE_ROWS), _row_line),
            _when_lines(more > 0, F.array(F.concat(F.lit("| _... "), more.cast("string"), F.lit(" more rows_ |")))),
            string_array(""),
        )

    more = F.size(tables) - REPORT_MAX_TABLES
    lines = F.concat(
        F.array(F.concat(F.lit("### Tables ("), F.size(tables).cast("string"), F.lit(")")), F.lit("")),
        F.flatten(F.transform(F.slice(tables, 1, REPORT_MAX_TABLES), one)),
        _when_lines(
            more > 0,
            F.array(F.concat(F.lit("_... "), more.cast("string"), F.lit(" more tables available_")), F.lit("")),
        ),
    )
    return _when_lines(F.coalesce(F.size(tables) > 0, F.lit(False)), lines)


def tables_md(tables: Column) -> Column:
    return F.array_join(table_lines(tables), "\n")


def archive_lines(entries: Column) -> Column:
    more = F.size(entries) - REPORT_MAX_ENTRIES
    lines = F.concat(
        F.array(F.concat(F.lit("### Archive Contents ("), F.size(entries).cast("string"), F.lit(" entries)")), F.lit("")),
        F.transform(F.slice(entries, 1, REPORT_MAX_ENTRIES), lambda e: F.concat(F.lit("- "), e)),
        _when_lines(more > 0, F.array(F.concat(F.lit("- _... "), more.cast("string"), F.lit(" more entries_")))),
        string_array(""),
    )
    return _when_lines(F.coalesce(F.size(entries) > 0, F.lit(False)), lines)


def report_text() -> Column:
    """The whole report of one row of the parsed table."""
    c = F.col
    meta = meta_lines(c("type"), c("meta"))
    note = truncation_line(c("truncated"), c("returned_chars"), c("total_chars"))
    return F.array_join(
        F.concat(
            F.array(report_heading(c("file_name"), c("type"), c("file_size")), F.lit("")),
            _when_lines(F.size(meta) > 0, F.concat(meta, string_array(""))),
            F.array(counts_line(c("meta"), c("text")), F.lit("")),
            _when_lines(note.isNotNull(), F.array(note, F.lit(""))),
            table_lines(c("tables")),
            archive_lines(c("archive_contents")),
            _when_lines(
                F.coalesce(c("text") != "", F.lit(False)), F.array(F.lit("### Content"), F.lit(""), c("text"))
            ),
        ),
        "\n",
    )


def export_name(name: Column) -> Column:
    """The file name with its last suffix replaced by ``.md``."""
    return F.concat(F.regexp_replace(name, r"\.[^.]+$", ""), F.lit(".md"))
