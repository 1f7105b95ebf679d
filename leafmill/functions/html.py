"""Web page columns: title, heading outline and block text, without a DOM.

Block membership needs the nesting of the page, because end tags may be missing and wrappers may
sit inside list items and cells.  The page is cut at its structural tags; one fold over the tags
keeps the open elements as a short string and says for every stretch of text whether a block is
open around it.  Text is kept once, in reading order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.core import let, literal_map, non_empty, split_at_last_tag, tail, trim_ws
from leafmill.functions.references import expand_references, unescape

# An element that is never closed runs to the end of the page.
_HIDDEN = (
    r"(?is)<script\b[^>]*(?:>.*?(?:</script\s*>|\z)|\z)|<style\b[^>]*(?:>.*?(?:</style\s*>|\z)|\z)|<!--.*?(?:-->|\z)"
)
_TAG = r"</?[A-Za-z!?][^>]*>"
_TITLE = r"(?is)<title(?:\s[^>]*)?>(.*?)(?:</title\s*>|\z)"
_HEADING = r"(?is)<h([1-6])(?:\s[^>]*)?>(.*?)(?:</h[1-6]\s*>|(?=<h[1-6][\s>])|\z)"
_MARK = "\x01"

# One letter per kind of open element.
PAGE_BLOCKS = "PLBCRKE"  # p, li, blockquote, td/th, pre, code, dt/dd
CHAPTER_BLOCKS = "PLBC"  # p, li, blockquote, td/th

_WRAPPERS = (
    "address article aside body details div fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header html main nav section summary"
).split()


def _tag_effects() -> dict[str, tuple[str, str]]:
    """Tag to (what it closes, as a pattern on the open elements; what it opens)."""
    nothing, open_p = "(?!)", "PK*$"
    effects = {"p": (open_p, "P"), "/p": (open_p, ""), "hr": (open_p, ""), "code": (nothing, "K"), "/code": ("K$", "")}
    for tag in _WRAPPERS:
        effects[tag] = (open_p, "W")
        effects["/" + tag] = ("W[^WTC]*$", "")
    for tag, letter in (("ul", "U"), ("ol", "U"), ("dl", "D"), ("blockquote", "B"), ("pre", "R")):
        effects[tag] = (open_p, letter)
        effects["/" + tag] = (f"{letter}[^{letter}TC]*$", "")
    effects["table"] = (open_p, "T")
    effects["/table"] = ("T[^T]*$", "")
    effects["li"] = ("(?:L[^LUTCEB]*|PK*)$", "L")
    effects["/li"] = ("L[^LUTC]*$", "")
    for tag in ("dt", "dd"):
        effects[tag] = ("(?:E[^EDUTCB]*|PK*)$", "E")
        effects["/" + tag] = ("E[^EDTC]*$", "")
    for tag in ("td", "th"):
        effects[tag] = ("(?<=T)[^T]*$", "C")
        effects["/" + tag] = ("C[^CT]*$", "")
    for tag in ("tr", "thead", "tbody", "tfoot"):
        effects[tag] = effects["/" + tag] = ("(?<=T)[^T]*$", "")
    effects["title"] = effects["/title"] = (nothing, "")
    return effects


_EFFECTS = _tag_effects()
_STRUCTURE = (
    r"(?i)<(/?(?:" + "|".join(sorted({t.lstrip("/") for t in _EFFECTS}, key=len, reverse=True)) + r"))(?=[\s/>])[^>]*>"
)
_CHUNK = 256
# Wrappers nested deeper than this are only counted, so that their end tags close nothing else.
_MAX_DEPTH = 512


def visible_html(html: Column) -> Column:
    """The page without scripts, styles and comments, references expanded, marker removed.

    A ``<`` that no tag end follows is text and is kept as a reference.
    """
    shown = let(
        split_at_last_tag(F.regexp_replace(html, _HIDDEN, "")),
        lambda t: F.concat(t["head"], F.replace(t["tail"], F.lit("<"), F.lit("&lt;"))),
    )
    return F.replace(expand_references(shown), F.lit(_MARK), F.lit(""))


def inner_text(markup: Column) -> Column:
    """Text of a fragment: tags removed, entities decoded, trimmed."""
    return trim_ws(unescape(F.regexp_replace(markup, _TAG, "")))


def titles(visible: Column) -> Column:
    """All non-empty titles."""
    found = F.regexp_extract_all(visible, F.lit(_TITLE), 1)
    return non_empty(F.transform(found, lambda t: trim_ws(unescape(t))))


def title(visible: Column) -> Column:
    """Text of the first title; null when there is none or it is empty."""
    found = F.regexp_extract(visible, _TITLE, 1)
    return F.nullif(trim_ws(unescape(found)), F.lit(""))


def headings(visible: Column) -> Column:
    """ARRAY<STRUCT<level, heading>> in document order, empty headings dropped."""
    found = F.transform(
        F.regexp_extract_all(visible, F.lit(_HEADING), 0),
        lambda h: F.struct(
            F.substring(h, 3, 1).cast("int").alias("level"),
            inner_text(h).alias("heading"),
        ),
    )
    return F.filter(found, lambda h: h["heading"] != "")


def _open_flags(tags: Column, block_letters: str) -> Column:
    """Per tag: b when the text after it is block text, j when it goes on from the text before
    it, o when it is outside all blocks.

    Flags are folded in chunks so that the work grows with the number of tags, not its square.
    """
    inside = f"[{block_letters}]"
    cuts = literal_map({tag: cut for tag, (cut, _) in _EFFECTS.items()})
    pushes = literal_map({tag: push for tag, (_, push) in _EFFECTS.items()})

    def step(acc: Column, tag: Column) -> Column:
        name = F.lower(tag)
        after = F.concat(
            F.regexp_replace(acc["open"], F.try_element_at(cuts, name), F.lit("")), F.try_element_at(pushes, name)
        )
        wrapper_end = F.startswith(name, F.lit("/")) & (F.try_element_at(pushes, F.substring(name, F.lit(2), F.length(name))) == "W")
        too_deep = (F.length(after) > _MAX_DEPTH) & F.endswith(after, F.lit("W"))
        swallowed = (acc["uncounted"] > 0) & wrapper_end
        return let(
            F.when(swallowed, acc["open"]).when(too_deep, F.left(after, F.length(after) - 1)).otherwise(after),
            lambda now: F.struct(
                now.alias("open"),
                (acc["uncounted"] + F.when(swallowed, -1).when(too_deep, 1).otherwise(0)).alias("uncounted"),
                F.concat(
                    acc["flags"],
                    F.when(~F.rlike(now, F.lit(inside)), "o")
                    .when(F.endswith(name, F.lit("code")) & F.rlike(acc["open"], F.lit(inside)), "j")
                    .otherwise("b"),
                ).alias("flags"),
            ),
        )

    def chunk(acc: Column, k: Column) -> Column:
        start = F.struct(acc["open"].alias("open"), acc["uncounted"].alias("uncounted"), F.lit("").alias("flags"))
        return let(
            F.aggregate(F.slice(tags, k * _CHUNK + 1, F.lit(_CHUNK)), start, step),
            lambda part: F.struct(
                part["open"].alias("open"),
                part["uncounted"].alias("uncounted"),
                F.concat(acc["flags"], F.split(part["flags"], "(?!^)(?=.)")).alias("flags"),
            ),
        )

    empty = F.struct(F.lit("").alias("open"), F.lit(0).alias("uncounted"), F.array().cast("array<string>").alias("flags"))
    last = F.floor((F.size(tags) - 1) / _CHUNK).cast("int")
    return F.when(F.size(tags) == 0, F.array().cast("array<string>")).otherwise(
        F.aggregate(F.sequence(F.lit(0), last), empty, chunk, lambda acc: acc["flags"])
    )


def blocks(visible: Column, block_letters: str = PAGE_BLOCKS) -> Column:
    """Block texts in reading order, each text once; empty ones dropped."""

    def join(page: Column) -> Column:
        marked = F.zip_with(
            page["flags"],
            tail(page["texts"]),
            lambda flag, text: F.when(flag == "b", F.concat(F.lit(_MARK), text)).when(flag == "j", text).otherwise(F.lit("")),
        )
        text = unescape(F.regexp_replace(F.array_join(marked, ""), _TAG, ""))
        return non_empty(F.transform(F.split(text, _MARK), trim_ws))

    return let(
        visible,
        lambda html: let(
            F.regexp_extract_all(html, F.lit(_STRUCTURE), 1),
            lambda tags: let(
                F.struct(_open_flags(tags, block_letters).alias("flags"), F.split(html, _STRUCTURE).alias("texts")),
                join,
            ),
        ),
    )
