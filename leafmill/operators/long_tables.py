"""Long result tables: headings, blocks, cells, sheet cells, slides, chapters and table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill import options as O
from leafmill.functions import delimited, html, notebook, office
from leafmill.functions.text import decode_text
from leafmill.operators import documents as D
from leafmill.options import ParseOptions
from leafmill.plans.corpus import member_plans
from leafmill.schema import TABLES
from leafmill.sources.members import MemberPlan, Selection, read_members


def _raw() -> Column:
    return decode_text(F.col("content"))


def headings(pages: DataFrame) -> DataFrame:
    """path, pos, level, heading of web pages."""
    found = html.headings(html.visible_html(_raw()))
    return pages.select("path", F.posexplode(found).alias("pos", "_h")).select("path", "pos", "_h.*")


def blocks(pages: DataFrame) -> DataFrame:
    """path, pos, text of web pages."""
    return pages.select("path", F.posexplode(html.blocks(html.visible_html(_raw()))).alias("pos", "text"))


def cells(notebooks: DataFrame) -> DataFrame:
    """path, pos, cell_type, source, outputs of notebooks."""
    found = notebook.notebook_cells(notebook.raw_cells(notebook.notebook_json(_raw())))
    return notebooks.select("path", F.posexplode(found).alias("pos", "_c")).select("path", "pos", "_c.*")


def _members_of(files: DataFrame, kind: str, opts: ParseOptions) -> DataFrame:
    plans = member_plans(opts)
    members = read_members(F.lit(kind), F.col("content"), plans)
    return files.withColumn("members", members)


def workbook_cells(books: DataFrame, opts: ParseOptions = ParseOptions()) -> DataFrame:
    """path, sheet_pos, sheet_name, row, col, value of every stored cell; rows and columns from 1."""
    return (
        _members_of(books, "xlsx", opts)
        .select("path", F.posexplode(office.workbook_grids(F.col("members"))).alias("sheet_pos", "_s"))
        .select("path", "sheet_pos", F.col("_s.name").alias("sheet_name"), F.explode("_s.grid").alias("_r"))
        .select("path", "sheet_pos", "sheet_name", F.col("_r.row").alias("row"), F.explode("_r.cells").alias("_c"))
        .select("path", "sheet_pos", "sheet_name", "row", "_c.col", "_c.value")
    )


# Every slide and note, without the limit of documents.
_ALL_SLIDES = {"pptx": MemberPlan("zip", (Selection(D.SLIDE_PART), Selection(D.NOTES_PART)))}


def slides(decks: DataFrame) -> DataFrame:
    """path, slide, text, notes: every slide with the notes part of its number, if any."""

    def text(data: Column) -> Column:
        return office.slide_text(decode_text(data))

    def slide(s: Column) -> Column:
        note = F.get(F.filter(F.col("_notes"), lambda n: n["number"] == s["number"]), F.lit(0))
        return F.struct(
            s["number"].alias("slide"), text(s["data"]).alias("text"), text(note["data"]).alias("notes")
        )

    return (
        decks.withColumn("members", read_members(F.lit("pptx"), F.col("content"), _ALL_SLIDES))
        .select(
            "path",
            D.numbered_parts(F.col("members"), D.SLIDE_PART).alias("_slides"),
            D.numbered_parts(F.col("members"), D.NOTES_PART).alias("_notes"),
        )
        .select("path", F.inline(F.transform("_slides", slide)))
    )


def chapters(books: DataFrame, opts: ParseOptions = ParseOptions()) -> DataFrame:
    """path, pos, name, chapters: the first chapters by name, and how many there are in all."""
    limit = opts.limit(O.DEFAULT_MAX_CHAPTERS)
    return (
        _members_of(books, "epub", opts)
        .select("path", F.filter("members", lambda m: F.rlike(m["name"], F.lit(D.CHAPTER_PART))).alias("_m"))
        .select("path", F.size("_m").alias("chapters"), F.posexplode(F.slice("_m", 1, limit)).alias("pos", "_c"))
        .select("path", "pos", F.col("_c.name").alias("name"), "chapters")
    )


def word_tables(documents: DataFrame, opts: ParseOptions = ParseOptions()) -> DataFrame:
    """table_rows of word documents."""
    xml = office.part_text(F.col("members"), D.WORD_PART)
    found = _members_of(documents, "docx", opts).select("path", xml.alias("_xml"))
    return table_rows(found.select("path", office.word_tables(F.col("_xml")).cast(TABLES).alias("tables")))


def delimited_rows(files: DataFrame, delimiter: str = ",") -> DataFrame:
    """path, row_pos, cells of delimited files."""
    return files.select(
        "path", F.posexplode(delimited.delimited_rows(_raw(), delimiter)).alias("row_pos", "cells")
    )


def table_rows(parsed: DataFrame) -> DataFrame:
    """path, table_pos, table_name, row_pos, is_header, cells: one row per table row.

    The header counts as row 0; a table without one starts with its rows.
    """

    def lines(t: Column) -> Column:
        def line(header: bool):
            return lambda r: F.struct(F.lit(header).alias("is_header"), r.alias("cells"))

        head = F.when(F.size(t["headers"]) > 0, F.array(t["headers"])).otherwise(F.array().cast("array<array<string>>"))
        return F.concat(F.transform(head, line(True)), F.transform(t["rows"], line(False)))

    return (
        parsed.select("path", F.posexplode("tables").alias("table_pos", "_t"))
        .select("path", "table_pos", F.col("_t.name").alias("table_name"), F.posexplode(lines(F.col("_t"))).alias("row_pos", "_r"))
        .select("path", "table_pos", "table_name", "row_pos", "_r.is_header", "_r.cells")
    )
