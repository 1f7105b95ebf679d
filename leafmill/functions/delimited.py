"""Delimited text columns: records, fields, header promotion and sheet text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.core import as_parts, let, limit_parts, skip_note, string_array
from leafmill.functions.text import clean_text

# Fixed value: the name of the only sheet of a delimited file.
SHEET_NAME = "Sheet1"


def _field(delimiter: str) -> str:
    """One field: quoted with doubled quotes (an unclosed quote runs to the end), or bare.

    Possessive, so that long fields do not exhaust the matcher's stack.
    """
    rest = f"[^{delimiter}\\r\\n]*+"
    return f'(?:"(?:[^"]++|"")*+(?:"{rest}|\\z)|[^"{delimiter}\\r\\n]{rest}|)'


def delimited_rows(text: Column, delimiter: str = ",") -> Column:
    """ARRAY<ARRAY<STRING>>: all records with verbatim fields; a blank line has no fields."""
    d = "\\t" if delimiter == "\t" else delimiter
    field = _field(d)
    record_rx = f"(?:\\r\\n|\\r|\\n)({field}(?:{d}{field})*+)"
    field_rx = f"{d}({field})"

    def unquote(raw: Column) -> Column:
        quoted = F.startswith(raw, F.lit('"')) & F.endswith(raw, F.lit('"')) & (F.length(raw) > 1)
        inner = F.replace(F.substring(raw, F.lit(2), F.length(raw) - 2), F.lit('""'), F.lit('"'))
        return F.when(quoted, inner).otherwise(raw)

    def fields(record: Column) -> Column:
        found = F.regexp_extract_all(F.concat(F.lit(delimiter), record), F.lit(field_rx), 1)
        return F.when(record == "", string_array()).otherwise(F.transform(found, unquote))

    def drop_trailing(records: Column) -> Column:
        n = F.size(records)
        ends_empty = F.coalesce(F.get(records, n - 1) == "", F.lit(False))
        return F.when(ends_empty, F.slice(records, 1, n - 1)).otherwise(records)

    records = F.regexp_extract_all(F.concat(F.lit("\n"), text), F.lit(record_rx), 1)
    return F.transform(let(records, drop_trailing), fields)


def promote_header(rows: Column, name: Column) -> Column:
    """STRUCT<name, headers, rows>: the first row with a value heads the table."""
    filled = F.transform(rows, lambda r: F.exists(r, lambda c: c != ""))
    return let(
        F.array_position(filled, True).cast("int"),
        lambda at: F.struct(
            name.alias("name"),
            F.coalesce(F.get(rows, at - 1), string_array()).alias("headers"),
            F.filter(rows, lambda _, i: i != at - 1).alias("rows"),
        ),
    )


def sheet_tables(sheets: Column, limit: int) -> Column:
    """Tables of the first sheets; a sheet without rows gives none."""
    shown = F.filter(limit_parts(sheets, limit), lambda s: F.size(s["rows"]) > 0)
    return F.transform(shown, lambda s: promote_header(s["rows"], s["name"]))


def sheet_text(sheets: Column, limit: int) -> Column:
    def parts(sheet: Column) -> Column:
        head = F.concat(F.lit("=== Sheet: "), sheet["name"], F.lit(" ==="))
        lines = F.transform(sheet["rows"], lambda r: F.array_join(r, "\t"))
        return F.concat(F.array(head), lines, string_array(""))

    body = F.flatten(F.transform(limit_parts(sheets, limit), parts))
    note = as_parts(skip_note(F.size(sheets), limit, "sheet(s)"))
    return clean_text(F.array_join(F.concat(body, note), "\n"))
