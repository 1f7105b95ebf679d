"""Character references of HTML and XML, each decoded once.

``expand_references`` runs once over a whole page or part and expands everything but the
characters that mark up text; ``unescape`` turns those back where text has been cut out of it.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.core import let, literal_map, tail

# References that stand for mark-up characters and stay until text is cut out.
MARKUP = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'"}
# The other references that pages use most.
FREQUENT = {"&nbsp;": "\u00a0", "&copy;": "\u00a9", "&middot;": "\u00b7", "&#39;": "'"}

_OTHER = r"&(?!(?:lt|gt|quot|apos|amp);)[#A-Za-z]"


def unescape(text: Column) -> Column:
    for reference, char in MARKUP.items():
        text = F.replace(text, F.lit(reference), F.lit(char))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def _named() -> Column:
    """Reference name to characters; the HTML 4 names come first because look-up is a scan."""
    names = {name: chr(code) for name, code in name2codepoint.items()}
    names.update({k[:-1]: v for k, v in html5.items() if k.endswith(";") and k[:-1] not in names})
    return literal_map({k: v for k, v in names.items() if v not in "<>&"})


def expand_references(text: Column, named: bool = True) -> Column:
    """Numeric references, and named ones unless the text is XML, to characters."""

    def one(piece: Column) -> Column:
        name = F.substring_index(piece, ";", 1)
        rest = F.substring(piece, F.length(name) + 2, F.length(piece))
        decimal, hexadecimal = "^#0*([0-9]{1,7})$", "^#[xX]0*([0-9a-fA-F]{1,6})$"
        code = F.when(F.rlike(name, F.lit(decimal)), F.regexp_extract(name, decimal, 1).try_cast("int")).when(
            F.rlike(name, F.lit(hexadecimal)), F.conv(F.regexp_extract(name, hexadecimal, 1), 16, 10).try_cast("int")
        )
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        kept = F.when(code == ord("<"), "&lt;").when(code == ord(">"), "&gt;").when(code == ord("&"), "&amp;")
        char = F.when(valid, F.coalesce(kept, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))
        if named:
            char = F.coalesce(char, F.try_element_at(_named(), name))
        found = F.contains(piece, F.lit(";")) & char.isNotNull()
        return F.when(found, F.concat(char, rest)).otherwise(F.concat(F.lit("&"), piece))

    def full(t: Column) -> Column:
        return let(
            F.split(t, "&"),
            lambda pieces: F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(tail(pieces), one), "")),
        )

    if named:
        for reference, char in FREQUENT.items():
            text = F.replace(text, F.lit(reference), F.lit(char))
    return let(text, lambda t: F.when(F.rlike(t, F.lit(_OTHER)), full(t)).otherwise(t))
