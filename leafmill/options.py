"""Job-wide extraction options and the default limits."""

from __future__ import annotations

from dataclasses import dataclass, replace

# The default limits of the extraction contract.
DEFAULT_MAX_CHARS = 50_000
DEFAULT_MAX_SHEETS = 20
DEFAULT_MAX_SLIDES = 100
DEFAULT_MAX_CHAPTERS = 50
DEFAULT_MAX_CELLS = 200
DEFAULT_MAX_ENTRIES = 200
TEXT_SNIFF_BYTES = 4096
REPORT_MAX_TABLES = 5
REPORT_MAX_TABLE_ROWS = 20
REPORT_MAX_ENTRIES = 50


@dataclass(frozen=True)
class ParseOptions:
    """Options of one extraction job; constant for every file in it.

    ``max_chars`` of zero or below means unlimited.  ``max_pages`` overrides the per-format
    default for slides, sheets, chapters, cells and listed archive entries; paged text takes
    every page unless it is set above zero.
    """

    max_chars: int = DEFAULT_MAX_CHARS
    max_pages: int | None = None
    extract_tables: bool = True
    extract_images: bool = False
    ocr_lang: str = "eng"

    def limit(self, default: int) -> int:
        return default if self.max_pages is None else max(self.max_pages, 0)

    def untruncated(self) -> "ParseOptions":
        return replace(self, max_chars=-1)
