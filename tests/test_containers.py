import io
import tarfile
import zipfile

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from corpora.pack import tar_bytes, zip_bytes
from leafmill.functions.archive import compression_ratio
from leafmill.functions.office import number_label
from leafmill.operators import long_tables as L
from leafmill.operators.routes import container_documents
from leafmill.options import ParseOptions
from leafmill.sources import members as member_source
from leafmill.sources.members import MemberPlan, Selection, explode_members, listing_plan, read_container


def _one(files, name, data, kind, **opts):
    (row,) = container_documents(files((name, data)), kind, ParseOptions(**opts)).collect()
    return row


# --- members -----------------------------------------------------------------------------------


def test_members(files):
    data = zip_bytes([("d/", b""), ("d/b.txt", b"bb" * 500), ("a.txt", b"a")], deflate=True)
    rows = sorted(explode_members(files(("x.zip", data), ("bad.zip", b"nope")), "zip").collect(), key=lambda r: (r.path, r.name or ""))
    assert [(r.path, r.name, r.is_dir, r.usize, bytes(r.data) if r.data is not None else None) for r in rows] == [
        ("bad.zip", None, None, None, None),
        ("x.zip", "a.txt", False, 1, b"a"),
        ("x.zip", "d/", True, 0, None),
        ("x.zip", "d/b.txt", False, 1000, b"bb" * 500),
    ]
    assert rows[0].error and rows[3].csize < 100
    some = explode_members(files(("x.zip", data)), "zip", name_rx=r"b\.txt$", with_data=False).collect()
    assert [(r.name, r.data) for r in some] == [("d/b.txt", None)]


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.text("abc/é ", min_size=1, max_size=8).filter(lambda n: not n.endswith("/")), st.binary(max_size=40), max_size=6))
def test_zip_round_trip(members):
    plan = MemberPlan("zip", (Selection(""),))
    got = read_container(zip_bytes(list(members.items()), deflate=True), plan)
    assert {name: data for name, _, _, _, data, _ in got} == members
    assert [g[0] for g in got] == sorted(members)


def test_readers(monkeypatch):
    data = zip_bytes([("p10.xml", b"x"), ("p2.xml", b"y"), ("p1.xml", b"z"), ("q", b"")])
    plan = MemberPlan("zip", (Selection(r"^p(\d+)\.xml$", 2),))
    got = read_container(data, plan)
    assert [(g[0], g[4]) for g in got] == [("p1.xml", b"z"), ("p2.xml", b"y"), ("p10.xml", None)]
    with monkeypatch.context() as patch:
        patch.setattr(member_source, "_ROW_BYTES", 2)
        assert "inflate beyond" in read_container(data, MemberPlan("zip", (Selection(""),)))[0][5]
    assert read_container(data[:-10], listing_plan("zip"))[0][5]
    twice = io.BytesIO()
    with pytest.warns(UserWarning), zipfile.ZipFile(twice, "w") as z:
        z.writestr("n", b"old")
        z.writestr("n", b"new")
    assert [g[4] for g in read_container(twice.getvalue(), MemberPlan("zip", (Selection(""),)))] == [b"new"]


def test_reader_hands_on_little_at_a_time(monkeypatch):
    """What a reader holds is bounded by its output size and one container, not by the containers of a task."""
    taken = []

    class Udf:
        def __init__(self, function, returnType):
            taken.append(function)

        def asNondeterministic(self):
            return lambda *columns: None

    monkeypatch.setattr(member_source.F, "arrow_udf", Udf)
    member_source.read_members(None, None, {"zip": MemberPlan("zip", (Selection(""),))})
    one = zip_bytes([("a", b"x" * 500_000)])
    batches = [(pa.array(["zip"] * 10), pa.array([one] * 9 + [None], pa.binary())) for _ in range(3)]
    out = list(taken[0](iter(batches)))
    assert max(a.nbytes for a in out) < 4 << 20
    got = [None if m is None else len(m[0]["data"]) for a in out for m in a.to_pylist()]
    assert got == ([500_000] * 9 + [None]) * 3


# --- archives ----------------------------------------------------------------------------------


def test_zip_listing(files):
    data = zip_bytes([("d/", b""), ("d/a.txt", b"x" * 2000), ("b", b"")], deflate=True)
    row = _one(files, "x.zip", data, "zip")
    csize = zipfile.ZipFile(io.BytesIO(data)).getinfo("d/a.txt").compress_size
    ratio = int((1 - csize / 2000) * 100 + 0.5)
    assert row.text == f"Archive: x.zip ({len(data)} B)\n3 entries\n\n   b (0 B, 0% compressed)\n   d//\n   d/a.txt (2.0 KB, {ratio}% compressed)"
    assert row.meta.entries == 3 and row.meta.format == "ZIP" and row.archive_contents == ["b", "d/", "d/a.txt"]


@pytest.mark.parametrize("entries", [0, 200, 201])
def test_entry_limit(files, entries):
    row = _one(files, "x.zip", zip_bytes([(f"f{i:03}", b"") for i in range(entries)]), "zip")
    assert row.meta.entries == entries == len(row.archive_contents)
    assert ("[... 1 more entries. Use maxPages to increase limit.]" in row.text) == (entries == 201)
    assert row.text.count("% compressed") == min(entries, 200)


def test_tar_listing(files):
    data = tar_bytes([("d/", b""), ("d/x (1).txt", b"y" * 1500)])
    row = _one(files, "x.tar", data, "tar")
    assert row.text == "Archive: x.tar (10.0 KB)\n2 entries\n\n  d/ (0 B)\n  d/x (1).txt (1.5 KB)"
    assert row.archive_contents == ["d/", "d/x (1).txt"] and row.meta.format == "TAR"
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=tarfile.GNU_FORMAT) as t:
        info = tarfile.TarInfo("long/" * 40 + "n")
        t.addfile(info, io.BytesIO())
    assert _one(files, "y.tar", out.getvalue(), "tar").archive_contents == ["long/" * 40 + "n"]


def test_ratio(spark):
    rows = spark.createDataFrame([(0, 0), (0, 5), (100, 0), (200, 100), (8, 7), (3, 4)], "u long, c long")
    from pyspark.sql import functions as F

    got = [r[0] for r in rows.coalesce(1).select(compression_ratio(F.col("u"), F.col("c"))).collect()]
    assert got == [0, 0, 0, 50, 13, -33]


# --- decks -------------------------------------------------------------------------------------


def _slide(text):
    return "".join(f"<a:r><a:t>{t}</a:t></a:r>" for t in text).encode()


def test_deck(files):
    parts = [(f"ppt/slides/slide{n}.xml", _slide([f"s{n}", "&amp;"])) for n in (10, 2, 1)]
    parts += [("ppt/notesSlides/notesSlide2.xml", _slide([" n2 "])), ("ppt/notesSlides/notesSlide1.xml", _slide([" "]))]
    parts += [("ppt/notesSlides/notesSlide7.xml", _slide(["stray"])), ("ppt/slides/_rels/slide1.xml.rels", b"")]
    data = zip_bytes(parts)
    row = _one(files, "d.pptx", data, "pptx")
    assert row.text == (
        "--- Slide 1 ---\ns1 &amp;\n\n--- Slide 2 ---\ns2 &amp;\n\n--- Slide 10 ---\ns10 &amp;\n\n[Speaker Notes - Slide 2]: n2"
    )
    assert row.meta.slides == 3 and row.meta.format == "PPTX"
    one = _one(files, "d.pptx", data, "pptx", max_pages=1).text
    assert one == (
        "--- Slide 1 ---\ns1 &amp;\n\n[Speaker Notes - Slide 2]: n2\n\n[... 2 more slide(s) not processed. Use maxPages to increase limit.]"
    )
    many = _one(files, "m.pptx", zip_bytes([(f"ppt/slides/slide{n}.xml", _slide(["x"])) for n in range(1, 102)]), "pptx")
    assert many.meta.slides == 101 and "--- Slide 100 ---" in many.text and "--- Slide 101 ---" not in many.text


# --- word documents ----------------------------------------------------------------------------


def _word(body):
    return zip_bytes([("word/document.xml", f"<w:document><w:body>{body}</w:body></w:document>".encode())])


def _p(text):
    return f"<w:p><w:r><w:t>{text}</w:t></w:r></w:p>"


def test_word(files):
    body = (
        '<w:p w:x="1"><w:pPr><w:tabs><w:tab w:val="left"/></w:tabs></w:pPr><w:r><w:t xml:space="preserve">a &lt; </w:t></w:r>'
        "<w:r><w:tab/><w:t>b &#233;</w:t><w:delText>gone</w:delText></w:r></w:p><w:p/>"
        f"<w:tbl><w:tr><w:trPr><w:tblHeader/></w:trPr><w:tc>{_p('h1')}</w:tc><w:tc>{_p('h2')}</w:tc></w:tr>"
        f"<w:tr><w:tc>{_p('x')}{_p('y')}</w:tc><w:tc><w:tcPr><w:vMerge/></w:tcPr>{_p('')}</w:tc></w:tr></w:tbl>"
        f"<w:tbl><w:tr><w:tc>{_p(' only ')}</w:tc></w:tr></w:tbl>"
    )
    row = _one(files, "w.docx", _word(body), "docx")
    assert row.text == "a <  b é\n\nh1\n\nh2\n\nx\n\ny\n\n only" and row.meta.format == "DOCX" and row.meta.pages is None
    assert [(t.name, t.headers, t.rows) for t in row.tables] == [(None, ["h1", "h2"], [["xy"]]), (None, [], [["only"]])]
    assert _one(files, "w.docx", _word(body), "docx", extract_tables=False).tables is None
    assert _one(files, "w.docx", _word(_p("t")), "docx").tables is None
    bad = _one(files, "w.docx", zip_bytes([("other", b"")]), "docx")
    assert bad.type == "error" and bad.text.startswith("Error parsing docx file: Could not find main document part")


# --- workbooks ---------------------------------------------------------------------------------


def _book(sheets, strings=""):
    names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, (n, _) in enumerate(sheets))
    rels = "".join(f'<Relationship Id="r{i}" Target="/xl/worksheets/s{i}.xml"/>' for i, _ in enumerate(sheets))
    parts = [
        ("xl/workbook.xml", f"<workbook><sheets>{names}</sheets></workbook>"),
        ("xl/_rels/workbook.xml.rels", f"<Relationships>{rels}</Relationships>"),
        *[(f"xl/worksheets/s{i}.xml", f"<worksheet>{x}</worksheet>") for i, (_, x) in enumerate(sheets)],
    ]
    if strings:
        parts.append(("xl/sharedStrings.xml", f"<sst>{strings}</sst>"))
    return zip_bytes([(n, x.encode()) for n, x in parts])


SHEET = (
    '<dimension ref="B2:E6"/><sheetData><row r="3"><c r="C3" t="s"><v>0</v></c><c r="E3" t="s"><v>1</v></c></row>'
    '<row r="4" spans="1:2"/><row r="6"><c r="B6"><v>1.50</v></c><c r="C6" s="1"/><c r="D6" t="b"><v>1</v></c>'
    '<c r="E6" t="inlineStr"><is><t>in &amp; out</t></is></c></row></sheetData>'
)
STRINGS = '<si><t>one</t></si><si><r><t xml:space="preserve">t </t></r><r><t>wo</t></r><rPh><t>no</t></rPh></si>'


def test_workbook(files):
    data = _book([("S &amp; 1", SHEET), ("Empty", "<sheetData/>")], STRINGS)
    row = _one(files, "b.xlsx", data, "xlsx")
    assert row.meta.sheets == 2 and row.meta.format == "XLSX" and row.type == "xlsx"
    (t,) = row.tables
    assert (t.name, t.headers) == ("S & 1", ["", "one", "", "t wo"])
    assert t.rows == [[], [], [], ["1.5", "", "true", "in & out"]]
    assert row.text == "=== Sheet: S & 1 ===\n\n one t wo\n\n1.5 true in & out\n\n=== Sheet: Empty ==="
    cells = {(r.row, r.col): r.value for r in L.workbook_cells(files(("b.xlsx", data))).collect()}
    assert cells == {(3, 3): "one", (3, 5): "t wo", (6, 2): "1.5", (6, 4): "true", (6, 5): "in & out"}


@pytest.mark.parametrize("sheets", [20, 21])
def test_sheet_limit(files, sheets):
    one = '<sheetData><row r="1"><c r="A1"><v>1</v></c></row></sheetData>'
    row = _one(files, "b.xlsx", _book([(f"s{i}", one) for i in range(sheets)]), "xlsx")
    assert row.meta.sheets == sheets and len(row.tables) == 20
    assert ("[... 1 more sheet(s) not processed." in row.text) == (sheets == 21)


def test_numbers(column):
    cases = {"1": "1", "-7": "-7", "1.50": "1.5", "100.0": "100", "0.1": "0.1", "1E3": "1000", "12345678.25": "12345678.25",
             "0.0001": "0.0001", "1.1000000000000001": "1.1", "text": "text", "-0.5": "-0.5", "36526": "36526", "1e21": "1e+21", "2.5E-7": "2.5e-7"}
    assert column(list(cases), "string", number_label) == list(cases.values())


# --- e-books -----------------------------------------------------------------------------------


def test_epub(files):
    chapters = [
        ("OEBPS/b.xhtml", b"<title>Two</title><h2>H</h2><p>x<pre>no</pre>"),
        ("OEBPS/a.HTML", b"<title>One</title><svg><title>Pic</title></svg><p>p</p><h1>A</h1><li>l"),
        ("OEBPS/c.htm", b"<p>last"),
        ("mimetype", b"application/epub+zip"),
    ]
    row = _one(files, "e.epub", zip_bytes(chapters), "epub")
    assert row.text == "# One\n# Pic\n# A\np\nl\n# Two\n## H\nx\nlast"
    assert row.meta.pages == 3 and [tuple(s) for s in row.structure] == [(1, "One"), (1, "Pic"), (1, "A"), (1, "Two"), (2, "H")]
    two = _one(files, "e.epub", zip_bytes(chapters), "epub", max_pages=2)
    assert two.meta.pages == 3 and two.text.endswith("x\n\n[... 1 more file(s) not processed. Use maxPages to increase limit.]")
