"""What the checks expect of the engine, stated on its own: nothing here is taken from it.

All are fixed values of the extraction contract.
"""

# White space that is trimmed.
WS = (
    "\t\n\u000b\f\r \u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
    "\ufeff"
)

# Leading bytes and type, in the order in which they are tried.
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

# Suffix and type.
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

# Packages with the zip signature.
ZIP_BASED = ["xlsx", "docx", "pptx", "epub"]

IMAGE_TYPES = ["png", "jpeg", "webp", "gif", "bmp", "tiff"]

# Last sentences of notices.
NOTICE_TAILS = {
    "rar": "RAR extraction requires external tool (e.g., unrar/7z).",
    "7z": "7z extraction requires external tool (e.g., 7-Zip).",
    "gz": "Use external tools to decompress.",
}

NOTICE_LABELS = {"rar": "RAR", "7z": "7z", "gz": "GZip"}

MOBI_TAIL = "MOBI parsing is not natively supported. Convert to EPUB for parsing."

IMAGE_TAIL = "Enable extractImages: true to perform OCR."

PDF_TAIL = "Text is not extracted here; run a PDF extractor and assemble its pages."

UNKNOWN_TAIL = (
    "The parser supports: PDF, DOCX, XLSX, CSV, PPTX, images (OCR), EPUB, HTML, XML, Markdown, "
    "Jupyter Notebooks, ZIP, RAR, 7z, TAR, GZip, JSON, YAML, TOML, INI, and plain text."
)

INVALID_NOTEBOOK = "Invalid JSON: Could not parse notebook file."

NOTICE_TYPES = ["rar", "7z", "gz", "mobi", "pdf", "png", "jpeg", "webp", "gif", "bmp", "tiff"]

# Types that a handler or a notice serves.
KNOWN_TYPES = (
    "html htm xml markdown ipynb csv tsv text json yaml toml ini "
    "zip tar pptx ppt docx xlsx epub rar 7z gz mobi pdf png jpeg webp gif bmp tiff xls"
).split()
