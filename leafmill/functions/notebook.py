"""Notebook columns over VARIANT: cells, sources, outputs and the assembled text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.core import as_parts, let, limit_parts, skip_note, string_array, trim_ws
from leafmill.functions.text import clean_text

# Fixed value: the text of a notebook that is not JSON.
INVALID_TEXT = "Invalid JSON: Could not parse notebook file."


# A JSON string, and the value of an output's binary media type (a string or an array of strings). Possessive, so that
# strings of any length are matched in one linear pass.
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_PAYLOAD = r'("(?:image|application|audio|video|font|model)/[^"\\]*+"\s*+:\s*+)(?:' + _STRING + r'|\[\s*+(?:' + _STRING + r'\s*+,?\s*+)*+\])'


def notebook_json(text: Column) -> Column:
    """The JSON value that is the whole text, as VARIANT; null when it is none or more follows it.

    The parser stops after the first value, so the text is read as the only item of an array. Repeated keys are allowed by
    the session settings; the last one counts. A text that VARIANT cannot hold (a string beyond its limit, as an inline
    image gives, or a notebook beyond 128 MiB) is parsed again with the payloads of binary media types (image, audio,
    video, application, ...) emptied by one linear pattern pass: they are never part of the text, and JSON outside
    strings has no quotes, so the pass cannot mistake a string's inside for a key. Such payloads are then not validated.
    """
    return F.coalesce(_json(text), _json(F.regexp_replace(text, _PAYLOAD, '$1""')))


def _json(text: Column) -> Column:
    return let(
        F.try_parse_json(F.concat(F.lit("["), text, F.lit("\n]"))),
        lambda v: F.when(
            F.try_variant_get(v, "$[1]", "variant").isNull(), F.try_variant_get(v, "$[0]", "variant")
        ),
    )


def ml_string(value: Column, path: str = "$") -> Column:
    """A string, or an array of strings joined without separator; empty when missing."""
    joined = F.array_join(F.try_variant_get(value, path, "array<string>"), "")
    return F.coalesce(joined, F.try_variant_get(value, path, "string"), F.lit(""))


def cell_outputs(cell: Column) -> Column:
    """Output texts of a cell: plain streams first, else the text/plain form; blanks dropped."""

    def text_of(output: Column) -> Column:
        stream = F.nullif(ml_string(output, "$.text"), F.lit(""))
        plain = ml_string(output, "$.data['text/plain']")
        return trim_ws(F.coalesce(stream, plain))

    outputs = F.try_variant_get(cell, "$.outputs", "array<variant>")
    texts = F.filter(F.transform(outputs, text_of), lambda t: t != "")
    return F.coalesce(texts, string_array())


def raw_cells(notebook: Column) -> Column:
    """The cells as ARRAY<VARIANT>; none when missing."""
    cells = F.try_variant_get(notebook, "$.cells", "array<variant>")
    return F.coalesce(cells, F.array().cast("array<variant>"))


def notebook_cells(cells: Column) -> Column:
    """ARRAY<STRUCT<cell_type, source, outputs>>."""

    def cell(v: Column) -> Column:
        kind = F.nullif(F.try_variant_get(v, "$.cell_type", "string"), F.lit(""))
        return F.struct(
            F.coalesce(kind, F.lit("unknown")).alias("cell_type"),
            ml_string(v, "$.source").alias("source"),
            cell_outputs(v).alias("outputs"),
        )

    return F.transform(cells, cell)


def notebook_text(cells: Column, limit: int) -> Column:
    """Markdown as it is, code and outputs fenced, other cells left out, then cleaned."""

    def fence(lang: str, body: Column) -> Column:
        return string_array(f"```{lang}", body, "```")

    def parts(cell: Column) -> Column:
        source = trim_ws(cell["source"])
        outputs = F.flatten(F.transform(cell["outputs"], lambda o: fence("output", o)))
        return (
            F.when(cell["cell_type"] == "markdown", string_array(source, ""))
            .when(cell["cell_type"] == "code", F.concat(fence("python", source), outputs, string_array("")))
            .otherwise(string_array())
        )

    shown = notebook_cells(limit_parts(cells, limit))
    note = as_parts(skip_note(F.size(cells), limit, "cell(s)"))
    return clean_text(F.array_join(F.concat(F.flatten(F.transform(shown, parts)), note), "\n"))
