"""Archive listing columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.core import as_parts, let, limit_parts
from leafmill.functions.text import clean_text, size_label


def compression_ratio(usize: Column, csize: Column) -> Column:
    """Saved share in whole percent, halves up; zero when either size is zero."""
    percent = F.floor((F.lit(1.0) - csize / usize) * 100 + 0.5)
    return F.when((csize > 0) & (usize > 0), percent).otherwise(F.lit(0)).cast("bigint")


def entry_note(total: Column, limit: int) -> Column:
    """The note on entries beyond the limit; null when all are listed."""
    skipped = total - F.lit(limit)
    return F.when(
        skipped > 0,
        F.concat(
            F.lit("\n[... "), skipped.cast("string"), F.lit(" more entries. Use maxPages to increase limit.]")
        ),
    )


def _zip_line(entry: Column) -> Column:
    ratio = compression_ratio(entry["usize"], entry["csize"]).cast("string")
    return F.when(entry["is_dir"], F.concat(F.lit("   "), entry["name"], F.lit("/"))).otherwise(
        F.concat(
            F.lit("   "), entry["name"], F.lit(" ("), size_label(entry["usize"]), F.lit(", "), ratio, F.lit("% compressed)")
        )
    )


def _tar_line(entry: Column) -> Column:
    return F.concat(F.lit("  "), entry["name"], F.lit(" ("), size_label(entry["usize"]), F.lit(")"))


def listing_text(kind: str, members: Column, file_name: Column, file_size: Column, limit: int) -> Column:
    """Archive heading, entry count and one line per entry up to the limit."""
    line = _zip_line if kind == "zip" else _tar_line

    def lines(entries: Column) -> Column:
        head = F.array(
            F.concat(F.lit("Archive: "), file_name, F.lit(" ("), size_label(file_size), F.lit(")")),
            F.concat(F.size(entries).cast("string"), F.lit(" entries")),
            F.lit(""),
        )
        shown = F.transform(limit_parts(entries, limit), line)
        return F.array_join(F.concat(head, shown, as_parts(entry_note(F.size(entries), limit))), "\n")

    return clean_text(let(members, lines))
