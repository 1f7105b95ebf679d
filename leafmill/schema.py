"""Schemas of the result tables."""

from __future__ import annotations

TABLES = "array<struct<name:string,headers:array<string>,rows:array<array<string>>>>"
STRUCTURE = "array<struct<level:int,heading:string>>"
META = (
    "struct<title:string,author:string,created:string,modified:string,pages:int,sheets:int,slides:int,"
    "format:string,entries:int,word_count:bigint>"
)

# How the text of a document is limited and counted.
NOTE, PLAIN, STATUS = "note", "plain", "status"

# Fields of one extracted document before limiting, with their types.
DOCUMENT_FIELDS = {
    "type": "string",
    "mode": "string",
    "text": "string",
    "title": "string",
    "author": "string",
    "created": "string",
    "modified": "string",
    "pages": "int",
    "sheets": "int",
    "slides": "int",
    "format": "string",
    "entries": "int",
    "tables": TABLES,
    "structure": STRUCTURE,
    "archive_contents": "array<string>",
}
META_FIELDS = ["title", "author", "created", "modified", "pages", "sheets", "slides", "format", "entries"]
PARSED_COLUMNS = [
    "path",
    "file_name",
    "file_size",
    "type",
    "meta",
    "text",
    "truncated",
    "total_chars",
    "returned_chars",
    "tables",
    "structure",
    "archive_contents",
]
