"""Text scalars: decoding, cleaning, counting, limiting and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.core import WS, let, split_at_last_tag, trim_ws

_BOM = bytes([0xEF, 0xBB, 0xBF])
_CONTROLS = "".join(map(chr, range(0x20)))
_WIDE_SPACE = r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
_WORD_RUN = r"[\x21-\x9f\xa1-\u167f]++"


def decode_text(content: Column) -> Column:
    """Lenient UTF-8: bad bytes become U+FFFD and a byte order mark is dropped."""
    body = F.when(F.startswith(content, F.lit(_BOM)), F.substring(content, 4, 2147483647)).otherwise(content)
    return F.make_valid_utf8(body.cast("string"))


def clean_text(text: Column) -> Column:
    """Unify line ends, squeeze tab runs and blank lines, drop trailing blanks, trim."""
    text = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    text = F.regexp_replace(text, "\t+", " ")
    text = F.regexp_replace(text, "(?<! ) ++(?=[\\n\\u2028\\u2029]|\\z)", "")
    text = F.regexp_replace(text, "\n{3,}", "\n\n")
    return trim_ws(text)


def word_count(text: Column) -> Column:
    """White-space separated words; control characters separate too.

    Every word shrinks, with the space after it, to one character, so the length is the count and
    no array of words is built.  Text without wide white space takes the cheaper pattern.
    """
    body = F.btrim(text, F.lit(_CONTROLS + WS))
    common = F.regexp_replace(body, f"{_WORD_RUN}[\\x00-\\x20]*+", ".")
    wide = F.regexp_replace(
        body, f"(?:{_WORD_RUN}|[^\\x00-\\xa0{_WIDE_SPACE}])++(?:[\\x00-\\x20]++|[\\xa0{_WIDE_SPACE}])*+", "."
    )
    has_wide = F.rlike(text, F.lit("[\\xa0\\u1680-\\x{10ffff}]"))
    return F.length(F.when(has_wide, wide).otherwise(common)).cast("bigint")


def int_label(number: Column) -> Column:
    return F.format_number(number, 0)


def size_label(size: Column) -> Column:
    kib = F.format_string("%.1f KB", size / F.lit(1024.0))
    mib = F.format_string("%.1f MB", size / F.lit(1048576.0))
    return (
        F.when(size < 1024, F.concat(size.cast("string"), F.lit(" B")))
        .when(size < 1048576, kib)
        .otherwise(mib)
    )


def truncate_note(text: Column, max_chars: int) -> Column:
    """Limit with a note; ``returned_chars`` counts the note."""
    total = F.length(text)
    if max_chars <= 0:
        cut, body = F.lit(False), text
    else:
        cut = F.coalesce(total > max_chars, F.lit(False))
        note = F.concat(
            F.lit(f"\n\n[... truncated at {max_chars:,} chars. Total available: "),
            int_label(total),
            F.lit(" chars]"),
        )
        body = F.when(cut, F.concat(F.left(text, F.lit(max_chars)), note)).otherwise(text)
    return _limited(body, cut, total)


def truncate_plain(text: Column, max_chars: int) -> Column:
    """Limit without a note."""
    total = F.length(text)
    if max_chars <= 0:
        return _limited(text, F.lit(False), total)
    return _limited(F.left(text, F.lit(max_chars)), total > max_chars, total)


def _limited(body: Column, cut: Column, total: Column) -> Column:
    return F.struct(
        body.alias("text"),
        cut.alias("truncated"),
        total.cast("bigint").alias("total_chars"),
        F.length(body).cast("bigint").alias("returned_chars"),
    )


def strip_markup(text: Column) -> Column:
    """Tags to spaces, blanks squeezed, blank lines dropped, then cleaned; no entity decoding."""
    text = let(
        split_at_last_tag(text), lambda t: F.concat(F.regexp_replace(t["head"], "<[^>]+>", " "), t["tail"])
    )
    text = F.regexp_replace(text, "[ \t]+", " ")
    text = F.regexp_replace(text, f"\n[{WS}]*\n", "\n")
    return clean_text(text)
