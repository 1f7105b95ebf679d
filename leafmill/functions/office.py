"""Columns over the XML parts of slide decks, word documents and workbooks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.core import let, string_array, trim_ws
from leafmill.functions.references import expand_references, unescape
from leafmill.functions.text import decode_text

# --- slide decks -------------------------------------------------------------------------------


def slide_text(xml: Column) -> Column:
    """Text runs joined by a space; entities stay as they are."""
    return F.array_join(F.regexp_extract_all(xml, F.lit(r"<a:t[^>]*>([^<]+)</a:t>"), 1), " ")


# --- word documents ----------------------------------------------------------------------------

_WORD_TOKEN = r"<w:t(?: [^>]*)?>[^<]*</w:t>|<w:tab\s*/>|</w:p>|<w:p\s*/>"


def _word_runs(xml: Column) -> Column:
    return F.regexp_extract_all(xml, F.lit(r"<w:t(?: [^>]*)?>([^<]*)</w:t>"), 1)


def word_text(xml: Column) -> Column:
    """Paragraph text, each paragraph followed by a blank line."""
    tokens = F.regexp_extract_all(xml, F.lit(_WORD_TOKEN), 0)
    texts = F.transform(
        tokens,
        lambda t: F.when(F.startswith(t, F.lit("<w:tab")), "\t")
        .when(F.startswith(t, F.lit("<w:t")), F.regexp_extract(t, ">([^<]*)<", 1))
        .otherwise("\n\n"),
    )
    return unescape(F.array_join(texts, ""))


def _table_markup(xml: Column) -> Column:
    """Markup of every table in the order of their start tags, each without the tables nested in it.

    Start tags are numbered with a mark that no XML holds, so tables without nested ones are those without
    a further mark; they are taken out level by level, as many times as tables are nested.
    """
    innermost = "<w:tbl\x01[^\x01]*\x01[^\x01]*?</w:tbl>"
    pieces = F.split(F.replace(xml, F.lit("\x01"), F.lit("")), "<w:tbl(?=[ >])")
    marked = F.array_join(
        F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit("<w:tbl\x01"), i.cast("string"), F.lit("\x01"), p))), ""
    )
    steps = F.transform(
        F.regexp_extract_all(xml, F.lit("<w:tbl(?=[ >])|</w:tbl>"), 0), lambda t: F.when(F.startswith(t, F.lit("</")), -1).otherwise(1)
    )
    nesting = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda a, d: F.struct((a["now"] + d).alias("now"), F.greatest(a["most"], a["now"] + d).alias("most")),
        lambda a: a["most"],
    )

    def peel(state: Column, _: Column) -> Column:
        return F.struct(
            F.regexp_replace(state["rest"], innermost, "").alias("rest"),
            F.concat(state["tables"], F.regexp_extract_all(state["rest"], F.lit(innermost), 0)).alias("tables"),
        )

    def tables(depth: Column) -> Column:
        start = F.struct(marked.alias("rest"), string_array().alias("tables"))
        taken = F.aggregate(F.sequence(F.lit(1), depth), start, peel, lambda a: a["tables"])
        numbered = F.transform(taken, lambda t: F.struct(F.regexp_extract(t, "\x01([0-9]+)\x01", 1).cast("int").alias("at"), t.alias("xml")))
        return F.when(depth > 0, F.transform(F.sort_array(numbered), lambda t: t["xml"])).otherwise(string_array())

    return let(nesting, tables)


def word_tables(xml: Column) -> Column:
    """ARRAY<STRUCT<name, headers, rows>>: a row marked as header heads its table.

    A nested table is a table of its own, after the one that holds it, and its text belongs to it alone.
    """

    def cell_text(cell: Column) -> Column:
        return trim_ws(unescape(F.array_join(_word_runs(cell), "")))

    def row(markup: Column) -> Column:
        cells = F.regexp_extract_all(markup, F.lit(r"(?s)<w:tc[ >].*?</w:tc>"), 0)
        # Cells that continue a vertical merge belong to the cell above.
        own = F.filter(cells, lambda c: ~F.rlike(c, F.lit(r'<w:vMerge(?: w:val="continue")?\s*/>')))
        return F.struct(
            F.rlike(markup, F.lit(r'<w:tblHeader(?:\s*/>| w:val="(?:1|true|on)")')).alias("marked"),
            F.transform(own, cell_text).alias("cells"),
        )

    def table(markup: Column) -> Column:
        rows = F.transform(F.regexp_extract_all(markup, F.lit(r"(?s)<w:tr[ >].*?</w:tr>"), 0), row)

        def split_header(filled: Column) -> Column:
            at = F.array_position(F.transform(filled, lambda r: r["marked"]), True).cast("int") - 1
            return let(
                at,
                lambda i: F.struct(
                    F.lit(None).cast("string").alias("name"),
                    F.when(i >= 0, F.get(filled, i)["cells"]).otherwise(string_array()).alias("headers"),
                    F.transform(F.filter(filled, lambda _, k: k != i), lambda r: r["cells"]).alias("rows"),
                ),
            )

        return let(F.filter(rows, lambda r: F.size(r["cells"]) > 0), split_header)

    found = F.transform(_table_markup(xml), table)
    return F.filter(found, lambda t: (F.size(t["headers"]) > 0) | (F.size(t["rows"]) > 0))


# --- workbooks ---------------------------------------------------------------------------------

WORKBOOK_PART = "xl/workbook.xml"
RELATIONS_PART = "xl/_rels/workbook.xml.rels"
STRINGS_PART = "xl/sharedStrings.xml"

# Elements may carry a namespace prefix.
_NS = r"(?:\w+:)?"
# A row or cell reference beyond the last row (1048576) or column (XFD) of the format.
_BEYOND_ROW = (
    r"[0-9]{8,}|[2-9][0-9]{6}|1[1-9][0-9]{5}|10[5-9][0-9]{4}|1049[0-9]{3}|1048[6-9][0-9]{2}|10485[89][0-9]|104857[7-9]"
)
_BEYOND = (
    rf"(?s)<{_NS}(?:row|c)\s(?:[^>]*?\s)?r=[\"'](?:(?:[A-Z]{{4,}}|[YZ][A-Z]{{2}}|X[G-Z][A-Z]|XF[E-Z])[0-9]+|[A-Z]{{0,3}}(?:{_BEYOND_ROW}))[\"']"
)


def part_text(members: Column, name: Column | str) -> Column:
    """Decoded text of the named XML member, references expanded; null when there is none."""
    name = F.lit(name) if isinstance(name, str) else name
    data = F.get(F.filter(members, lambda m: m["name"] == name), F.lit(0))["data"]
    return expand_references(decode_text(data), named=False)


def _attribute(attributes: Column, name: str) -> Column:
    return F.regexp_extract(attributes, rf"""(?:^|\s){name}=["']([^"']*)["']""", 1)


def _shared_strings(xml: Column) -> Column:
    """Texts of the shared string table; runs joined, phonetic hints left out."""
    items = F.regexp_extract_all(
        F.regexp_replace(xml, rf"(?s)<{_NS}rPh\b.*?</{_NS}rPh>", ""),
        F.lit(rf"(?s)<{_NS}si\s*/>|<{_NS}si\b[^>]*>.*?</{_NS}si>"),
        0,
    )
    return F.coalesce(F.transform(items, _runs), string_array())


def _runs(markup: Column) -> Column:
    return unescape(
        F.array_join(F.regexp_extract_all(markup, F.lit(rf"<{_NS}t(?:\s[^>]*)?>([^<]*)</{_NS}t>"), 1), "")
    )


def number_label(raw: Column) -> Column:
    """A stored number as its shortest plain decimal."""
    value = raw.try_cast("double")
    whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
    plain = F.regexp_replace(value.try_cast("decimal(38,15)").cast("string"), r"\.?0+$", "")
    return (
        F.when(F.rlike(raw, F.lit(r"^-?(?:0|[1-9][0-9]{0,14})$")), raw)
        .when(value.isNull(), raw)
        .when(whole, value.cast("bigint").cast("string"))
        .when(F.abs(value).between(1e-3, 1e7), value.cast("string"))
        .when(F.abs(value).between(1e-6, 1e20), plain)
        .otherwise(
            F.regexp_replace(F.regexp_replace(value.cast("string"), r"\.0E|E", "e"), "e(?=[0-9])", "e+")
        )
    )


def _column_number(letters: Column) -> Column:
    """1 for A; null for more letters than any column of the format has."""
    number = F.aggregate(F.split(letters, ""), F.lit(0), lambda acc, c: acc * 26 + F.ascii(c) - 64)
    return F.when(F.length(letters) <= 3, number)


def beyond_grid(members: Column) -> Column:
    """Whether a sheet refers to rows or columns that the format does not have."""
    return F.exists(
        members, lambda m: F.startswith(m["name"], F.lit("xl/worksheets/")) & F.coalesce(F.rlike(decode_text(m["data"]), F.lit(_BEYOND)), F.lit(False))
    )


def _cell_value(attributes: Column, cell: Column, strings: Column) -> Column:
    raw = F.regexp_extract(cell, rf"<{_NS}v(?:\s[^>]*)?>([^<]*)</{_NS}v>", 1)

    def value(kind: Column) -> Column:
        return (
            F.when(kind == "s", F.get(strings, raw.try_cast("int")))
            .when(kind == "inlineStr", _runs(cell))
            .when(~F.rlike(cell, F.lit(rf"<{_NS}v")), F.lit(None))
            .when(kind == "b", F.when(trim_ws(raw).isin("1", "true"), "true").otherwise("false"))
            .when(kind == "str", unescape(raw))
            .when(kind == "e", F.lit(None))
            .when(kind == "d", raw)
            .otherwise(let(trim_ws(raw), number_label))
        )

    return F.nullif(let(_attribute(attributes, "t"), value), F.lit(""))


def sheet_grid(xml: Column, strings: Column) -> Column:
    """ARRAY<STRUCT<row, cells ARRAY<STRUCT<col, value>>>>: rows and cells with a value, 1-based."""

    def cell(markup: Column, i: Column) -> Column:
        attributes = F.regexp_extract(markup, rf"^<{_NS}c\b([^>]*)>", 1)
        letters = F.regexp_extract(_attribute(attributes, "r"), "^([A-Z]+)", 1)
        return F.struct(
            F.when(letters == "", i + 1).otherwise(_column_number(letters)).cast("int").alias("col"),
            _cell_value(attributes, markup, strings).alias("value"),
        )

    def row(markup: Column, i: Column) -> Column:
        attributes = F.regexp_extract(markup, rf"^<{_NS}row\b([^>]*)>", 1)
        cells = F.transform(
            F.regexp_extract_all(markup, F.lit(rf"(?s)<{_NS}c(?=[\s/>])[^>]*?(?:/>|>.*?</{_NS}c>)"), 0), cell
        )
        return F.struct(
            F.coalesce(_attribute(attributes, "r").try_cast("int"), i + 1).alias("row"),
            F.sort_array(F.filter(cells, lambda c: c["value"].isNotNull() & c["col"].isNotNull())).alias("cells"),
        )

    rows = F.regexp_extract_all(xml, F.lit(rf"(?s)<{_NS}row(?=[\s/>])[^>]*?(?:/>|>.*?</{_NS}row>)"), 0)
    return F.sort_array(F.filter(F.transform(rows, row), lambda r: F.size(r["cells"]) > 0))


def _first_corner(xml: Column, grid: Column) -> Column:
    """STRUCT<row, col>: where the used range starts."""
    ref = F.regexp_extract(xml, rf'<{_NS}dimension\s+ref="([A-Z]+[0-9]+)', 1)
    stated_row = F.regexp_extract(ref, "([0-9]+)$", 1).try_cast("int")
    letters = F.regexp_extract(ref, "^([A-Z]+)", 1)
    stated_col = F.when(letters != "", _column_number(letters))
    used_row = F.get(grid, F.lit(0))["row"]
    used_col = F.array_min(F.transform(grid, lambda r: F.get(r["cells"], F.lit(0))["col"]))
    return F.struct(F.least(stated_row, used_row).alias("row"), F.least(stated_col, used_col).alias("col"))


# A filled grid of more slots than this cannot be a row's value (each slot takes at least 8 bytes of a 2 GiB row).
MOST_SLOTS = (1 << 31) // 8


def grid_slots(corner: Column, grid: Column) -> Column:
    """How many slots filling the grid from its corner takes: rows, and cells up to the last of each row."""
    cells = F.aggregate(
        grid, F.lit(0).cast("bigint"), lambda acc, r: acc + F.greatest(F.try_element_at(r["cells"], F.lit(-1))["col"] - corner["col"] + 1, F.lit(0))
    )
    rows = F.coalesce(F.try_element_at(grid, F.lit(-1))["row"] - corner["row"] + 1, F.lit(0))
    return cells + rows


def _dense(xml: Column, grid: Column) -> Column:
    """ARRAY<ARRAY<STRING>>: gaps between stored rows and cells filled, one step per stored item; null when the filled
    grid could not be a row's value (counted before anything is filled)."""

    def fill(corner: Column) -> Column:
        def values(cells: Column) -> Column:
            def step(c: Column, i: Column) -> Column:
                before = F.when(i == 0, corner["col"] - 1).otherwise(F.get(cells, i - 1)["col"])
                gap = F.greatest(c["col"] - before - 1, F.lit(0))
                return F.concat(F.array_repeat(F.lit(""), gap), F.array(c["value"]))

            return F.flatten(F.transform(cells, step))

        def lines(r: Column, i: Column) -> Column:
            before = F.when(i == 0, corner["row"] - 1).otherwise(F.get(grid, i - 1)["row"])
            gap = F.greatest(r["row"] - before - 1, F.lit(0))
            return F.concat(F.array_repeat(string_array(), gap), F.array(values(r["cells"])))

        return F.when(grid_slots(corner, grid) <= MOST_SLOTS, F.flatten(F.transform(grid, lines)))

    return let(_first_corner(xml, grid), fill)


def workbook_grids(members: Column) -> Column:
    """ARRAY<STRUCT<name, xml, grid>> in workbook order."""
    relations = F.transform(
        F.regexp_extract_all(part_text(members, RELATIONS_PART), F.lit(r"<(?:\w+:)?Relationship\s([^>]*)>"), 1),
        lambda a: F.struct(_attribute(a, "Id").alias("id"), _attribute(a, "Target").alias("target")),
    )
    listed = F.regexp_extract_all(part_text(members, WORKBOOK_PART), F.lit(r"<(?:\w+:)?sheet\s([^>]*)>"), 1)

    def sheets(shared: Column) -> Column:
        def sheet(attributes: Column) -> Column:
            rel = F.filter(shared["relations"], lambda r: r["id"] == _attribute(attributes, r"\w+:id"))
            target = F.get(rel, F.lit(0))["target"]
            part = F.when(F.startswith(target, F.lit("/")), F.substring(target, F.lit(2), F.length(target))).otherwise(
                F.concat(F.lit("xl/"), target)
            )
            return let(
                F.coalesce(part_text(members, part), F.lit("")),
                lambda xml: F.struct(
                    unescape(_attribute(attributes, "name")).alias("name"),
                    xml.alias("xml"),
                    sheet_grid(xml, shared["strings"]).alias("grid"),
                ),
            )

        return F.transform(listed, sheet)

    return let(
        F.struct(
            F.coalesce(_shared_strings(part_text(members, STRINGS_PART)), string_array()).alias("strings"),
            relations.alias("relations"),
        ),
        sheets,
    )


def workbook_sheets(members: Column) -> Column:
    """ARRAY<STRUCT<name, rows>> with every gap filled."""
    return F.transform(
        workbook_grids(members),
        lambda s: F.struct(s["name"].alias("name"), _dense(s["xml"], s["grid"]).alias("rows")),
    )
