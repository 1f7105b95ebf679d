"""Small building blocks shared by all column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white space that trimming and word splitting recognise.
# Java's \s is ASCII only, so the characters are always spelled out.
WS = (
    "\t\n\x0b\x0c\r \u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and bind it for every use inside ``body``.

    The optimizer inlines a projected expression into a lambda when it is named there once,
    which would evaluate it per element; a lambda variable cannot be inlined.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trim_ws(text: Column) -> Column:
    return F.btrim(text, F.lit(WS))


def string_array(*items: Column | str) -> Column:
    if not items:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(i) if isinstance(i, str) else i for i in items])


def non_empty(texts: Column) -> Column:
    return F.filter(texts, lambda t: t != F.lit(""))


def tail(parts: Column) -> Column:
    """All parts but the first."""
    return F.slice(parts, 2, F.size(parts))


def limit_parts(parts: Column, limit: int) -> Column:
    """The first ``limit`` parts of an ordered array."""
    return F.slice(parts, 1, limit)


def skip_note(total: Column, limit: int, what: str) -> Column:
    """The note on parts beyond the limit; null when nothing was skipped."""
    skipped = total - F.lit(limit)
    return F.when(
        skipped > 0,
        F.concat(
            F.lit("\n[... "),
            skipped.cast("string"),
            F.lit(f" more {what} not processed. Use maxPages to increase limit.]"),
        ),
    )


def as_parts(note: Column) -> Column:
    """An array of zero or one strings from a nullable string."""
    return F.when(note.isNull(), string_array()).otherwise(F.array(note))


def literal_map(entries: dict[str, str]) -> Column:
    """A constant MAP<STRING, STRING>, shipped as one literal and folded at planning time."""
    pairs = "\x02".join(f"{k}\x03{v}" for k, v in entries.items())
    return F.str_to_map(F.lit(pairs), F.lit("\x02"), F.lit("\x03"))


def split_at_last_tag(text: Column) -> Column:
    """STRUCT<head, tail>: up to and including the last ``>``, and the rest.

    Behind the last ``>`` no tag can end.  Tag patterns run over the head only, where every ``<``
    finds its end, so stray ``<`` cannot make them rescan the rest of the text.
    """
    return let(
        text,
        lambda t: let(
            F.substring_index(t, ">", -1),
            lambda tail: F.struct(F.left(t, F.length(t) - F.length(tail)).alias("head"), tail.alias("tail")),
        ),
    )
