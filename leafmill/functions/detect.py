"""Format detection from leading bytes and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.core import let
from leafmill.options import TEXT_SNIFF_BYTES

# Leading bytes (hexadecimal) and the type they stand for, in test order.
SIGNATURES = [
    ("25504446", "pdf"),
    ("504B0304", "zip"),
    ("52617221", "rar"),
    ("1F8B", "gz"),
    ("89504E47", "png"),
    ("FFD8FF", "jpeg"),
    ("52494646", "webp"),
    ("47494638", "gif"),
    ("424D", "bmp"),
]

# File name suffix and canonical type; a suffix that is not here stands for itself.
EXTENSION_TYPES = {
    "pdf": "pdf",
    "docx": "docx",
    "xlsx": "xlsx",
    "xls": "xls",
    "csv": "csv",
    "tsv": "tsv",
    "pptx": "pptx",
    "ppt": "ppt",
    "png": "png",
    "jpg": "jpeg",
    "jpeg": "jpeg",
    "webp": "webp",
    "gif": "gif",
    "bmp": "bmp",
    "tiff": "tiff",
    "epub": "epub",
    "html": "html",
    "htm": "html",
    "xml": "xml",
    "ipynb": "ipynb",
    "zip": "zip",
    "rar": "rar",
    "7z": "7z",
    "tar": "tar",
    "gz": "gz",
    "md": "markdown",
    "txt": "text",
    "json": "json",
    "yaml": "yaml",
    "yml": "yaml",
    "toml": "toml",
    "ini": "ini",
    "cfg": "ini",
    "log": "text",
}

# Package formats that share the zip signature and are told apart by suffix.
ZIP_BASED = ["xlsx", "docx", "pptx", "epub"]


def file_name(path: Column) -> Column:
    """Last path segment; slashes of both kinds separate. A path that ends in one is its own name."""
    return F.coalesce(F.nullif(F.substring_index(F.substring_index(path, "/", -1), "\\", -1), F.lit("")), path)


def extension(name: Column) -> Column:
    """Lower-cased suffix, empty when the name has no dot."""
    return F.when(F.contains(name, F.lit(".")), F.substring_index(F.lower(name), ".", -1)).otherwise(F.lit(""))


def ext_type(ext: Column) -> Column:
    """Canonical type of a suffix."""
    # Only the renamed suffixes need a branch; all others stand for themselves.
    by_type: dict[str, list[str]] = {}
    for suffix, kind in EXTENSION_TYPES.items():
        if suffix != kind:
            by_type.setdefault(kind, []).append(suffix)
    out = F
    for kind, suffixes in by_type.items():
        out = out.when(ext.isin(suffixes), F.lit(kind))
    return out.otherwise(ext)


def magic_type(content: Column) -> Column:
    """Type by leading bytes, null when none fits."""
    head = F.hex(F.substring(content, 1, 4))
    out = F
    for signature, kind in SIGNATURES:
        out = out.when(F.startswith(head, F.lit(signature)), F.lit(kind))
    return out.otherwise(F.lit(None).cast("string"))


def zip_refine(magic: Column, ext: Column) -> Column:
    """A zip whose suffix names a package format is that format."""
    return F.when((magic == "zip") & ext.isin(ZIP_BASED), ext).otherwise(magic)


# Every byte that is not text, by itself: a class of single Latin-1 characters is one look-up per character, while one of
# ranges, or a negated one, tests them in turn, which took most of the time of a corpus of texts.
_NOT_TEXT = "[" + "".join(f"\\x{b:02x}" for b in range(256) if b not in b"\t\n\r" and not 0x20 <= b <= 0x7E and not 0x80 <= b <= 0xF7) + "]+"


def is_text(content: Column) -> Column:
    """More than four fifths of the leading bytes look like text."""
    head = F.decode(F.substring(content, 1, TEXT_SNIFF_BYTES), "ISO-8859-1")
    size = F.least(F.octet_length(content), F.lit(TEXT_SNIFF_BYTES))
    kept = F.length(F.regexp_replace(head, _NOT_TEXT, ""))
    return F.when(size == 0, F.lit(False)).otherwise(kept / size > 0.8)


def detect_type(content: Column, name: Column) -> Column:
    """STRUCT<type, ext, confidence>: signature, then suffix, then text sniff, then unknown."""
    def found(kind: Column, suffix: Column, confidence: str) -> Column:
        return F.struct(kind.alias("type"), suffix.alias("ext"), F.lit(confidence).alias("confidence"))

    def by_evidence(e: Column) -> Column:
        return (
            F.when(e["sure"].isNotNull(), found(e["sure"], e["sure"], "high"))
            .when((e["mapped"] != "") & (e["mapped"] != "zip"), found(e["mapped"], e["ext"], "medium"))
            .when(is_text(content), found(F.lit("text"), F.lit("txt"), "medium"))
            .otherwise(found(F.lit("unknown"), e["ext"], "low"))
        )

    def evidence(ext: Column) -> Column:
        return F.struct(
            ext.alias("ext"),
            ext_type(ext).alias("mapped"),
            let(magic_type(content), lambda magic: zip_refine(magic, ext)).alias("sure"),
        )

    return let(let(extension(name), evidence), by_evidence)
