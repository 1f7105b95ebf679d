"""The corpus job: detect, route and extract every file in one pass over the bytes."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill import options as O
from leafmill.functions import office
from leafmill.functions.core import let
from leafmill.functions.detect import detect_type, file_name
from leafmill.functions.text import decode_text
from leafmill.operators import documents as D
from leafmill.operators.envelope import envelope
from leafmill.options import ParseOptions
from leafmill.sources.members import MemberPlan, Selection, listing_plan, read_members

PLAIN_TYPES = ["text", "json", "yaml", "toml", "ini"]
TEXT_TYPES = ["html", "htm", "xml", "markdown", "ipynb", "csv", "tsv", *PLAIN_TYPES]

# Messages of packages that lack their main part, or that no reader here decodes.
NO_WORD_PART = "Could not find main document part. Are you sure this is a docx file?"
NO_WORKBOOK_PART = "Could not find workbook"
BAD_REFERENCE = "a cell reference lies outside the sheet"
TOO_LARGE = "the file is larger than the row limit of the scan"
NO_XLS_READER = "legacy binary workbooks are not decoded"


def member_plans(opts: ParseOptions) -> dict[str, MemberPlan]:
    """What each container format needs inflated; parts beyond the limits are only listed."""
    deck = MemberPlan(
        "zip", (Selection(D.SLIDE_PART, opts.limit(O.DEFAULT_MAX_SLIDES)), Selection(D.NOTES_PART))
    )
    workbook = MemberPlan(
        "zip", (Selection(r"^xl/(?:workbook\.xml|_rels/workbook\.xml\.rels|sharedStrings\.xml|worksheets/.*\.xml)$"),)
    )
    return {
        "zip": listing_plan("zip"),
        "tar": listing_plan("tar"),
        "pptx": deck,
        "ppt": deck,
        "docx": MemberPlan("zip", (Selection(r"^word/document\.xml$"),)),
        "xlsx": workbook,
        "epub": MemberPlan("zip", (Selection(D.CHAPTER_PART, opts.limit(O.DEFAULT_MAX_CHAPTERS)),)),
    }


def detect(files: DataFrame) -> DataFrame:
    """detected: files plus type, ext and confidence."""
    return files.withColumn("_found", detect_type(F.col("content"), F.col("file_name"))).select(
        *files.columns, "_found.*"
    )


def with_members(detected: DataFrame, opts: ParseOptions) -> DataFrame:
    """Adds the members of the container rows; other rows get null and send nothing to Python."""
    plans = member_plans(opts)
    kind = F.col("type")
    content = F.when(kind.isin(list(plans)) & (F.col("file_size") > 0), F.col("content"))
    return detected.withColumn("members", read_members(kind, content, plans))


def _text_document(kind: Column, raw: Column, opts: ParseOptions) -> Column:
    name = F.col("file_name")
    return (
        F.when(kind.isin("html", "htm"), D.html_document(raw))
        .when(kind == "xml", D.xml_document(raw))
        .when(kind == "markdown", D.markdown_document(raw))
        .when(kind == "ipynb", D.notebook_document(raw, opts))
        .when(kind == "csv", D.delimited_document(raw, ",", name, opts))
        .when(kind == "tsv", D.delimited_document(raw, "\t", name, opts))
        .otherwise(D.plain_document(kind, raw))
    )


# Types that one reader serves.
CONTAINER_FAMILIES = [("zip",), ("tar",), ("pptx", "ppt"), ("docx",), ("xlsx",), ("epub",)]


def container_document(family: tuple[str, ...], kind: Column, members: Column, opts: ParseOptions) -> Column:
    """The document of a container of the given family; an error document when it cannot be read."""
    name, size = F.col("file_name"), F.col("file_size")
    failure = F.get(members, F.lit(0))["error"]
    out = F.when(failure.isNotNull(), D.error_document(kind, failure))

    def needs(part: str, message: str, build: Column) -> Column:
        lacking = ~F.exists(members, lambda m: m["name"] == part)
        return out.when(lacking, D.error_document(kind, F.lit(message))).otherwise(build)

    reader = family[0]
    if reader in ("zip", "tar"):
        return out.otherwise(D.listing_document(reader, members, name, size, opts))
    if reader == "pptx":
        return out.otherwise(D.deck_document(members, opts))
    if reader == "epub":
        return out.otherwise(D.epub_document(members, opts))
    if reader == "docx":
        return needs(D.WORD_PART, NO_WORD_PART, D.word_document(members, opts))
    out = out.when(office.beyond_grid(members), D.error_document(kind, F.lit(BAD_REFERENCE)))
    return needs(office.WORKBOOK_PART, NO_WORKBOOK_PART, D.workbook_document(members, name, opts))


def _any_container_document(kind: Column, members: Column, opts: ParseOptions) -> Column:
    out = F
    for family in CONTAINER_FAMILIES:
        out = out.when(kind.isin(*family), container_document(family, kind, members, opts))
    return out


@lru_cache(maxsize=16)
def corpus_document(opts: ParseOptions) -> Column:
    """The document of a detected file of any type, over type, ext, content, members and the file columns.

    Built once per set of options: the expression is large and names no particular table.
    """
    kind, size = F.col("type"), F.col("file_size")
    return (
        F.when(F.col("read_error").isNotNull(), D.read_failure_document(F.col("read_error")))
        .when(size == 0, D.empty_document())
        .when(F.col("content").isNull(), D.read_failure_document(F.lit(TOO_LARGE)))
        .when(
            kind.isin(TEXT_TYPES),
            let(decode_text(F.col("content")), lambda raw: _text_document(kind, raw, opts)),
        )
        .when(F.col("members").isNotNull(), _any_container_document(kind, F.col("members"), opts))
        .when(kind == "xls", D.error_document(kind, F.lit(NO_XLS_READER)))
        .when(kind.isin(D.NOTICE_TYPES), D.notice_document(kind, F.col("file_name"), size, opts))
        .otherwise(D.unknown_document(kind, F.col("ext"), size))
    )


def extract(detected: DataFrame, opts: ParseOptions) -> DataFrame:
    """path, file_name, file_size and the ``doc`` struct of every file."""
    # The text limit is the envelope's business.
    doc = corpus_document(opts.untruncated())
    if "read_error" not in detected.columns:  # only a guarded scan reports files it could not open
        detected = detected.withColumn("read_error", F.lit(None).cast("string"))
    return with_members(detected, opts).select("path", "file_name", "file_size", doc.alias("doc"))


def parse_corpus(files: DataFrame, opts: ParseOptions = ParseOptions()) -> DataFrame:
    """parsed: one row per file of any format.

    One pass: bytes are scanned once, only containers visit Python, and nothing is shuffled.
    """
    return envelope(extract(detect(files), opts), opts)
