"""One document column per format.

Each builder turns the decoded text or the members of a file into a STRUCT of
``schema.DOCUMENT_FIELDS``.  All of them are row-local.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill import options as O
from leafmill.functions import archive, delimited, html, notebook, office
from leafmill.functions.core import as_parts, let, limit_parts, skip_note, string_array, trim_ws
from leafmill.functions.text import clean_text, decode_text, size_label, strip_markup
from leafmill.options import ParseOptions
from leafmill.schema import DOCUMENT_FIELDS, NOTE, PLAIN, STATUS


@lru_cache(maxsize=None)
def _null_field(name: str) -> Column:
    return F.expr(f"CAST(NULL AS {DOCUMENT_FIELDS[name]})").alias(name)


def document(kind: Column | str, text: Column, mode: str = NOTE, **fields: Column | str | None) -> Column:
    """A document struct; fields that are not given are null."""
    given = {"type": kind, "mode": mode, "text": text, **fields}

    def value(name: str, spark_type: str) -> Column:
        v = given.get(name)
        if v is None:
            return _null_field(name)
        return (v.cast(spark_type) if isinstance(v, Column) else F.lit(v)).alias(name)

    return F.struct(*[value(n, t) for n, t in DOCUMENT_FIELDS.items()])


def null_if_empty(items: Column) -> Column:
    return F.when(F.size(items) > 0, items)


# --- text formats ------------------------------------------------------------------------------


def html_document(raw: Column) -> Column:
    def build(visible: Column) -> Column:
        head = html.title(visible)
        return let(
            F.struct(head.alias("title"), html.headings(visible).alias("outline"), html.blocks(visible).alias("blocks")),
            lambda p: document(
                "html",
                clean_text(
                    F.concat(
                        F.when(p["title"].isNotNull(), F.concat(F.lit("# "), p["title"], F.lit("\n\n"))).otherwise(""),
                        F.array_join(p["blocks"], "\n\n"),
                    )
                ),
                title=p["title"],
                format="HTML",
                structure=null_if_empty(p["outline"]),
            ),
        )

    return let(html.visible_html(raw), build)


def xml_document(raw: Column) -> Column:
    return document("xml", strip_markup(raw), format="XML")


def markdown_document(raw: Column) -> Column:
    return document("markdown", clean_text(raw), format="Markdown")


def plain_document(kind: Column, raw: Column) -> Column:
    return document(kind, raw, mode=PLAIN, format=F.upper(kind))


def notebook_document(raw: Column, opts: ParseOptions) -> Column:
    limit = opts.limit(O.DEFAULT_MAX_CELLS)

    def build(notebook_json: Column) -> Column:
        valid = notebook_json.isNotNull()
        text = notebook.notebook_text(notebook.raw_cells(notebook_json), limit)
        return document(
            "ipynb",
            F.when(valid, text).otherwise(F.lit(notebook.INVALID_TEXT)),
            format=F.when(valid, F.lit("Jupyter Notebook")).otherwise(F.lit("IPYNB")),
        )

    return let(notebook.notebook_json(raw), build)


def _sheets_document(sheets: Column, file_name: Column, opts: ParseOptions) -> Column:
    limit = opts.limit(O.DEFAULT_MAX_SHEETS)
    return let(
        sheets,
        lambda s: document(
            "xlsx",
            delimited.sheet_text(s, limit),
            sheets=F.size(s),
            format=F.when(F.endswith(file_name, F.lit(".csv")), F.lit("CSV")).otherwise(F.lit("XLSX")),
            tables=delimited.sheet_tables(s, limit) if opts.extract_tables else None,
        ),
    )


def delimited_document(raw: Column, delimiter: str, file_name: Column, opts: ParseOptions) -> Column:
    rows = delimited.delimited_rows(raw, delimiter)
    sheets = F.array(F.struct(F.lit(delimited.SHEET_NAME).alias("name"), rows.alias("rows")))
    return _sheets_document(sheets, file_name, opts)


# --- containers --------------------------------------------------------------------------------


TOO_LARGE_GRID = "a sheet's filled grid is larger than one row can hold"


def workbook_document(members: Column, file_name: Column, opts: ParseOptions) -> Column:
    """The sheets' document; an error document when a sheet's gaps would fill beyond what a row holds."""

    def build(sheets: Column) -> Column:
        too_large = F.exists(sheets, lambda s: s["rows"].isNull())
        return F.when(too_large, error_document(F.lit("xlsx"), F.lit(TOO_LARGE_GRID))).otherwise(_sheets_document(sheets, file_name, opts))

    return let(office.workbook_sheets(members), build)


def listing_document(kind: str, members: Column, file_name: Column, file_size: Column, opts: ParseOptions) -> Column:
    return document(
        kind,
        archive.listing_text(kind, members, file_name, file_size, opts.limit(O.DEFAULT_MAX_ENTRIES)),
        format=kind.upper(),
        entries=F.size(members),
        archive_contents=F.transform(members, lambda m: m["name"]),
    )


def numbered_parts(members: Column, pattern: str) -> Column:
    """ARRAY<STRUCT<number, data>> of the members the pattern numbers, in numeric order."""
    found = F.filter(members, lambda m: F.rlike(m["name"], F.lit(pattern)))
    return F.transform(
        found,
        lambda m: F.struct(
            F.regexp_extract(m["name"], pattern, 1).try_cast("bigint").alias("number"), m["data"].alias("data")
        ),
    )


SLIDE_PART = r"^ppt/slides/slide(\d+)\.xml$"
NOTES_PART = r"^ppt/notesSlides/notesSlide(\d+)\.xml$"


def deck_document(members: Column, opts: ParseOptions) -> Column:
    limit = opts.limit(O.DEFAULT_MAX_SLIDES)

    def build(deck: Column) -> Column:
        def slide(s: Column) -> Column:
            head = F.concat(F.lit("--- Slide "), s["number"].cast("string"), F.lit(" ---"))
            return string_array(head, office.slide_text(decode_text(s["data"])), "")

        def note(s: Column) -> Column:
            part = F.get(F.filter(deck["notes"], lambda n: n["number"] == s["number"]), F.lit(0))
            text = trim_ws(office.slide_text(decode_text(part["data"])))
            label = F.concat(F.lit("[Speaker Notes - Slide "), s["number"].cast("string"), F.lit("]: "), text)
            return F.when(text != "", label)

        shown = F.flatten(F.transform(limit_parts(deck["slides"], limit), slide))
        notes = F.array_compact(F.transform(deck["slides"], note))
        skipped = as_parts(skip_note(F.size(deck["slides"]), limit, "slide(s)"))
        return document(
            "pptx",
            clean_text(F.array_join(F.concat(shown, notes, skipped), "\n")),
            slides=F.size(deck["slides"]),
            format="PPTX",
        )

    return let(
        F.struct(
            numbered_parts(members, SLIDE_PART).alias("slides"), numbered_parts(members, NOTES_PART).alias("notes")
        ),
        build,
    )


WORD_PART = "word/document.xml"


def word_document(members: Column, opts: ParseOptions) -> Column:
    return let(
        office.part_text(members, WORD_PART),
        lambda xml: document(
            "docx",
            clean_text(office.word_text(xml)),
            format="DOCX",
            tables=null_if_empty(office.word_tables(xml)) if opts.extract_tables else None,
        ),
    )


CHAPTER_PART = r"(?i)\.(?:xhtml|html|htm)$"


def chapter_parts(page: Column) -> Column:
    """STRUCT<lines, outline> of one chapter: titles, then headings, then blocks."""

    def build(visible: Column) -> Column:
        return let(
            F.struct(
                F.concat(
                    F.transform(
                        html.titles(visible), lambda t: F.struct(F.lit(1).alias("level"), t.alias("heading"))
                    ),
                    html.headings(visible),
                ).alias("outline"),
                html.blocks(visible, html.CHAPTER_BLOCKS).alias("blocks"),
            ),
            lambda c: F.struct(
                F.concat(
                    F.transform(
                        c["outline"], lambda h: F.concat(F.repeat(F.lit("#"), h["level"]), F.lit(" "), h["heading"])
                    ),
                    c["blocks"],
                ).alias("lines"),
                c["outline"].alias("outline"),
            ),
        )

    return let(html.visible_html(page), build)


def epub_document(members: Column, opts: ParseOptions) -> Column:
    limit = opts.limit(O.DEFAULT_MAX_CHAPTERS)

    def build(chapters: Column) -> Column:
        parts = F.transform(limit_parts(chapters, limit), lambda m: chapter_parts(decode_text(m["data"])))
        note = as_parts(skip_note(F.size(chapters), limit, "file(s)"))
        return let(
            parts,
            lambda p: document(
                "epub",
                clean_text(F.array_join(F.concat(F.flatten(F.transform(p, lambda c: c["lines"])), note), "\n")),
                format="EPUB",
                pages=F.size(chapters),
                structure=null_if_empty(F.flatten(F.transform(p, lambda c: c["outline"]))),
            ),
        )

    return let(F.filter(members, lambda m: F.rlike(m["name"], F.lit(CHAPTER_PART))), build)


# --- notices and status rows -------------------------------------------------------------------

IMAGE_TYPES = ["png", "jpeg", "webp", "gif", "bmp", "tiff"]

# What is said about formats that are named but not extracted.
NOTICE_TAILS = {
    "rar": "RAR extraction requires external tool (e.g., unrar/7z).",
    "7z": "7z extraction requires external tool (e.g., 7-Zip).",
    "gz": "Use external tools to decompress.",
}
NOTICE_LABELS = {"rar": "RAR", "7z": "7z", "gz": "GZip"}
MOBI_TAIL = "MOBI parsing is not natively supported. Convert to EPUB for parsing."
IMAGE_TAIL = "Enable extractImages: true to perform OCR."
UNKNOWN_TAIL = (
    "The parser supports: PDF, DOCX, XLSX, CSV, PPTX, images (OCR), EPUB, HTML, XML, Markdown, "
    "Jupyter Notebooks, ZIP, RAR, 7z, TAR, GZip, JSON, YAML, TOML, INI, and plain text."
)
EMPTY_TEXT = "File is empty."

# Notices of this engine: formats whose bytes it does not decode.
PDF_TAIL = "Text is not extracted here; run a PDF extractor and assemble its pages."
OCR_TAIL = "OCR is not performed here; run an OCR extractor upstream."

NOTICE_TYPES = [*NOTICE_TAILS, "mobi", "pdf", *IMAGE_TYPES]


def notice_document(kind: Column, file_name: Column, file_size: Column, opts: ParseOptions) -> Column:
    """Named but not extracted: archives without a reader, MOBI, PDF bytes and images."""

    def sized(label: str, size: Column, tail: str) -> Column:
        return F.concat(F.lit(f"{label} file: "), file_name, F.lit(" ("), size, F.lit(f"). {tail}"))

    kib = F.format_string("%.1f KB", file_size / F.lit(1024.0))
    out = F
    for name, tail in NOTICE_TAILS.items():
        label = NOTICE_LABELS[name]
        out = out.when(kind == name, document(name, sized(label, size_label(file_size), tail), format=label))
    mobi = F.concat(F.lit("MOBI file: "), file_name, F.lit(f". {MOBI_TAIL}"))
    pdf = document("pdf", sized("PDF", size_label(file_size), PDF_TAIL), format="PDF")
    image_tail = OCR_TAIL if opts.extract_images else IMAGE_TAIL
    # A name without a dot gives its whole self as the image format.
    suffix = F.substring_index(file_name, ".", -1)
    image = document("image", sized("Image", kib, image_tail), format=F.upper(suffix))
    return (
        out.when(kind == "mobi", document("mobi", mobi, format="MOBI")).when(kind == "pdf", pdf).otherwise(image)
    )


def unknown_document(kind: Column, ext: Column, file_size: Column) -> Column:
    text = F.concat(
        F.lit("Unrecognized file type: "),
        kind,
        F.lit(" (extension: "),
        ext,
        F.lit(").\nFile size: "),
        file_size.cast("string"),
        F.lit(f" bytes.\n{UNKNOWN_TAIL}"),
    )
    return document("unknown", text, mode=STATUS, format=F.when(kind != "unknown", F.upper(kind)))


def empty_document() -> Column:
    return document("empty", F.lit(EMPTY_TEXT), mode=STATUS)


def error_document(kind: Column, message: Column) -> Column:
    text = F.concat(F.lit("Error parsing "), kind, F.lit(" file: "), message)
    return document("error", text, mode=STATUS)


def read_failure_document(message: Column) -> Column:
    return document("error", F.concat(F.lit("Failed to read file: "), message), mode=STATUS)
