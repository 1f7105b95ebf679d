import csv
import io

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from leafmill.functions.delimited import delimited_rows
from leafmill.operators.routes import sheet_documents
from leafmill.options import ParseOptions

CASES = {
    'a,b\n"x ""y""",2\n': [["a", "b"], ['x "y"', "2"]],
    'a,"line1\nline2",c\r\nd,e,f': [["a", "line1\nline2", "c"], ["d", "e", "f"]],
    ",x,\n,,": [["", "x", ""], ["", "", ""]],
    "\n\na": [[], [], ["a"]],
    "a\rb\r": [["a"], ["b"]],
    '5" pipe,z\nnext,"q"x': [['5" pipe', "z"], ["next", '"q"x']],
    'open,"never closed\nrow': [["open", '"never closed\nrow']],
    '"","a"': [["", "a"]],
    "": [],
}


def test_rows(column):
    assert column(list(CASES), "string", delimited_rows) == list(CASES.values())


def test_long_fields(column):
    long_quoted = '"' + 'a""' * 60_000 + '"'
    rows = column(["x," + "y" * 200_000, long_quoted, "a," * 50_000], "string", delimited_rows)
    assert rows[0] == [["x", "y" * 200_000]]
    assert rows[1] == [['a"' * 60_000]]
    assert len(rows[2][0]) == 50_001


def test_tabs(column):
    assert column(['a\t"b\tc"\td,e'], "string", lambda c: delimited_rows(c, "\t")) == [[["a", "b\tc", "d,e"]]]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.lists(st.lists(st.text(st.sampled_from(list('ab",\n é')), max_size=6), min_size=2, max_size=4), min_size=1, max_size=5),
        min_size=20,
        max_size=20,
    )
)
def test_round_trip(column, tables):
    texts = []
    for table in tables:
        out = io.StringIO()
        csv.writer(out, quoting=csv.QUOTE_ALL).writerows(table)
        texts.append(out.getvalue())
    assert column(texts, "string", delimited_rows) == tables


def test_document(files):
    f = files(("a.csv", b"\n,,\nk,v\n1,\n\n2,x\ty\n"), ("b.CSV", b"h\n"), ("c.csv", b"\n"))
    a, b, c = sorted(sheet_documents(f).collect(), key=lambda r: r.path)
    assert a.type == "xlsx" and a.meta.format == "CSV" and a.meta.sheets == 1
    assert a.text == "=== Sheet: Sheet1 ===\n\n\nk v\n1\n\n2 x y".replace("\n\n\n", "\n\n")
    (t,) = a.tables
    assert (t.name, t.headers) == ("Sheet1", ["k", "v"])
    assert t.rows == [[], ["", "", ""], ["1", ""], [], ["2", "x\ty"]]
    assert b.meta.format == "XLSX" and b.tables[0].headers == ["h"] and b.tables[0].rows == []
    assert c.tables[0].headers == [] and c.tables[0].rows == [[]]
    (off,) = sheet_documents(files(("a.csv", b"a")), opts=ParseOptions(extract_tables=False)).collect()
    assert off.tables is None
