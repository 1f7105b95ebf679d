import pytest
from pyspark.sql import functions as F

from leafmill.functions import report as R
from leafmill.operators.long_tables import table_rows
from leafmill.operators.sinks import render_report
from leafmill.schema import META, PARSED_COLUMNS, STRUCTURE, TABLES

SCHEMA = (
    f"path string, file_name string, file_size bigint, type string, meta {META}, text string, truncated boolean, "
    f"total_chars bigint, returned_chars bigint, tables {TABLES}, structure {STRUCTURE}, archive_contents array<string>"
)
NO_META = (None,) * 10


def parsed(spark, **fields):
    row = {
        "path": "d/a.x", "file_name": "a.x", "file_size": 10, "type": "x", "meta": NO_META, "text": "", "truncated": False,
        "total_chars": 0, "returned_chars": 0, "tables": None, "structure": None, "archive_contents": None, **fields,
    }
    return spark.createDataFrame([tuple(row[c] for c in PARSED_COLUMNS)], SCHEMA)


def rendered(spark, **fields):
    (row,) = render_report(parsed(spark, **fields)).collect()
    return row.report


def test_full_report(spark):
    got = rendered(
        spark,
        file_name="b.pdf", type="pdf", file_size=2048,
        meta=("T", "", None, "D:1", 3, None, None, "PDF", None, 7),
        text="Hello world", truncated=True, total_chars=12345, returned_chars=1100,
        tables=[("S", ["a", "b"], [["1", "2"]]), (None, [], [["x"]])],
        structure=[(1, "H")],
        archive_contents=["m/", "m/f"],
    )
    assert got == (
        "## b.pdf (PDF, 2.0 KB)\n\n- **Title**: T\n- **Modified**: D:1\n- **Pages**: 3\n- **Format**: PDF\n- **Word Count**: 7\n\n"
        "- Words: 7 | Chars: 11 | Pages: 3\n\n"
        "> **Note:** Content was truncated (1,100 of 12,345 chars returned). Use maxChars for a higher limit.\n\n"
        "### Tables (2)\n\n**S:**\n| a | b |\n| --- | --- |\n| 1 | 2 |\n\n| x |\n\n"
        "### Archive Contents (2 entries)\n\n- m/\n- m/f\n\n### Content\n\nHello world"
    )


def test_status_row(spark):
    assert rendered(spark, type="empty", file_size=0, text="File is empty.") == (
        "## a.x (EMPTY, 0 B)\n\n- Words: 3 | Chars: 14\n\n### Content\n\nFile is empty."
    )
    assert rendered(spark) == "## a.x (X, 10 B)\n\n- Words: 0 | Chars: 0\n"


def test_epub_meta_order(spark):
    got = rendered(spark, type="epub", meta=(None, None, None, None, 0, None, None, "EPUB", None, 0), text="x")
    assert "- **Format**: EPUB\n- **Pages**: 0\n- **Word Count**: 0\n\n- Words: 0 | Chars: 1\n" in got


@pytest.mark.parametrize("tables", [5, 6])
@pytest.mark.parametrize("rows", [20, 21])
def test_table_caps(spark, tables, rows):
    got = rendered(spark, tables=[(f"t{i}", ["h"], [[str(r)] for r in range(rows)]) for i in range(tables)])
    assert got.count("| h |") == 5
    assert got.count("| 19 |") == 5 and "| 20 |" not in got
    assert got.count("| _... 1 more rows_ |") == (5 if rows == 21 else 0)
    assert ("_... 1 more tables available_" in got) == (tables == 6)


@pytest.mark.parametrize("entries", [50, 51])
def test_entry_cap(spark, entries):
    got = rendered(spark, archive_contents=[f"e{i}" for i in range(entries)])
    assert got.count("- e") == 50 and ("- _... 1 more entries_" in got) == (entries == 51)


def test_table_rows(spark):
    df = parsed(spark, tables=[("S", ["a"], [["1"], []]), (None, [], [["x", "y"]])])
    rows = sorted(table_rows(df).collect(), key=lambda r: (r.table_pos, r.row_pos))
    assert [(r.table_pos, r.table_name, r.row_pos, r.is_header, r.cells) for r in rows] == [
        (0, "S", 0, True, ["a"]), (0, "S", 1, False, ["1"]), (0, "S", 2, False, []), (1, None, 0, False, ["x", "y"]),
    ]


def test_export_name(column):
    names = ["a.txt", "a.tar.gz", "noext", ".hidden", "a.", "d.e/f"]
    assert column(names, "string", R.export_name) == ["a.md", "a.tar.md", "noext.md", ".md", "a..md", "d.md"]
    assert R.export_name(F.lit("x")) is not None
