"""Files that must become rows, whatever is wrong with them, and text that must not get lost."""

import io
import tarfile

import pytest

from corpora.pack import zip_bytes
from leafmill import parse_corpus, scan_files
from leafmill.functions import html, notebook, office
from leafmill.functions.references import expand_references
from leafmill.operators import long_tables as L
from leafmill.operators.routes import container_documents
from leafmill.sources.members import explode_members

BOOK = '<workbook><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>'
RELS = '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>'


def book(sheet: str, strings: str = "") -> bytes:
    parts = [("xl/workbook.xml", BOOK), ("xl/_rels/workbook.xml.rels", RELS), ("xl/worksheets/sheet1.xml", sheet)]
    if strings:
        parts.append(("xl/sharedStrings.xml", strings))
    return zip_bytes([(n, x.encode()) for n, x in parts])


def latin_tar(cut: int | None = None) -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=tarfile.USTAR_FORMAT, encoding="latin-1") as t:
        for name in ("caf\xe9.txt", "b.txt"):
            info = tarfile.TarInfo(name)
            info.size = 600
            t.addfile(info, io.BytesIO(b"x" * 600))
    return out.getvalue()[:cut]


def test_every_bad_file_is_a_row(spark, tmp_path):
    good = {"a.txt": b"plain words", "ok.zip": zip_bytes([("m.txt", b"m")])}
    bad = {
        "latin.tar": latin_tar(),
        "wide.xlsx": book('<row r="1"><c r="AAAAAAAAAA1"><v>1</v></c></row>'),
        "tall.xlsx": book('<row r="1"><c r="A1"><v>1</v></c></row><row r="2147483647"><c r="A2147483647"><v>1</v></c></row>'),
        "beyond.xlsx": book('<row r="1"><c r="XFE1"><v>1</v></c></row>'),
        "broken.pptx": b"PK\x03\x04 broken",
        "big.bin": b"0" * 50_000,
    }
    for name, data in (good | bad).items():
        (tmp_path / name).write_bytes(data)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "20000")
    try:
        rows = {r.file_name: r for r in parse_corpus(scan_files(spark, str(tmp_path))).collect()}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert set(rows) == set(good | bad)
    assert rows["a.txt"].text == "plain words"
    assert rows["latin.tar"].type == "tar" and "caf\ufffd.txt" in rows["latin.tar"].text
    for name in ("wide.xlsx", "tall.xlsx", "beyond.xlsx", "broken.pptx", "big.bin"):
        assert rows[name].type == "error", name
    assert rows["big.bin"].file_size == 50_000


def test_last_cell_of_the_grid_is_no_error(files):
    sheet = '<row r="1048576"><c r="XFD1048576"><v>7</v></c></row>'
    (row,) = container_documents(files(("x.xlsx", book(sheet))), "xlsx").collect()
    assert row.type == "xlsx" and row.tables[0].headers == ["7"]


def test_prefixed_sheets(files):
    sheet = (
        '<x:worksheet><x:dimension ref="A1:B1"/><x:row r="1"><x:c r="A1" t="s"><x:v>0</x:v></x:c>'
        '<x:c r="B1" t="inlineStr"><x:is><x:t>in</x:t></x:is></x:c></x:row></x:worksheet>'
    )
    strings = "<x:sst><x:si><x:t>shared</x:t><x:rPh><x:t>no</x:t></x:rPh></x:si></x:sst>"
    cells = L.workbook_cells(files(("x.xlsx", book(sheet, strings)))).collect()
    assert [(r.row, r.col, r.value) for r in cells] == [(1, 1, "shared"), (1, 2, "in")]


def test_cut_off_tar_lists_what_it_has(files):
    rows = explode_members(files(("x.tar", latin_tar(1024 + 512 + 700))), "tar", with_data=False).collect()
    assert [r.name for r in rows] == ["caf\ufffd.txt"] or [r.name for r in rows] == ["b.txt", "caf\ufffd.txt"]


def test_all_slides_have_text(files):
    deck = zip_bytes([(f"ppt/slides/slide{n}.xml", f"<a:t>text {n}</a:t>".encode()) for n in range(1, 104)])
    rows = L.slides(files(("x.pptx", deck))).collect()
    assert [(r.slide, r.text) for r in rows] == [(n, f"text {n}") for n in range(1, 104)]


@pytest.mark.parametrize("depth", [10, 511, 512, 600, 3000])
def test_text_survives_any_depth(column, depth):
    page = "<div>" * depth + "<ul><li>one<div>two</div>three</li></ul>" + "</div>" * depth + "<p>end</p>"
    assert column([page], "string", lambda v: html.blocks(html.visible_html(v))) == [["one", "two", "three", "end"]] or column(
        [page], "string", lambda v: html.blocks(html.visible_html(v))
    ) == [["onetwothree", "end"]]


def test_json_as_a_whole(column):
    texts = ['{"cells":[],"cells":[1]}', '{"cells":[]} junk', "{}, {}", "", "[1", ' {"cells":[]} \n', "null"]
    assert column(texts, "string", lambda v: notebook.notebook_json(v).isNotNull()) == [True, False, False, False, False, True, True]


def test_references_with_leading_zeros(column):
    assert column(["&#00000065;&#x000000042;&#0;"], "string", expand_references) == ["AB&#0;"]


def test_nested_word_tables(column):
    def table(*rows):
        cells = lambda r: "".join(f"<w:tc><w:p><w:t>{c}</w:t></w:p></w:tc>" for c in r)
        return "<w:tbl>" + "".join(f"<w:tr>{cells(r)}</w:tr>" for r in rows) + "</w:tbl>"

    inner = table(["i1"], ["i2"]).replace("<w:t>i2</w:t></w:p>", "<w:t>i2</w:t></w:p>" + table(["deep"]))
    outer = table(["a"], ["b"], ["last"]).replace("<w:t>b</w:t></w:p>", "<w:t>b</w:t></w:p>" + inner)
    (got,) = column([outer + table(["x" * 200_000])], "string", lambda v: office.word_tables(v))
    assert [t.rows for t in got] == [[["a"], ["b"], ["last"]], [["i1"], ["i2"]], [["deep"]], [["x" * 200_000]]]
    assert column(["no table", "<w:tbl><w:tr>", "</w:tbl>"], "string", lambda v: office.word_tables(v)) == [[], [], []]


def zero_zip(name: str, size: int) -> bytes:
    """A deflated zip with one member of size zero bytes, written in pieces."""
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z, z.open(name, "w", force_zip64=True) as member:
        block = bytes(16 << 20)
        for start in range(0, size, len(block)):
            member.write(block[: min(len(block), size - start)])
    return out.getvalue()


def test_bomb_is_refused_before_inflating():
    """A zip of a few MB whose member inflates to 2.4 GB: an error row, without holding the inflated bytes."""
    import tracemalloc

    from leafmill.sources.members import MemberPlan, Selection, read_container

    data = zero_zip("word/document.xml", 2_400_000_000)
    assert len(data) < 12 << 20
    tracemalloc.start()
    got = read_container(data, MemberPlan("zip", (Selection(""),)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0][5] == "the wanted members inflate beyond what one row can hold"
    assert peak < 300 << 20


def test_long_member_as_pieces(files, monkeypatch):
    """A member beyond a piece comes out as numbered pieces whose lengths add up to it."""
    from pyspark.sql import functions as F

    from leafmill.sources import members as M

    monkeypatch.setattr(M, "_PIECE_BYTES", 8 << 20)
    size = 150_000_001
    rows = (
        explode_members(files(("big.zip", zero_zip("big.bin", size)), ("small.zip", zip_bytes([("a", b"xy"), ("e", b"")]))), "zip")
        .select("path", "name", "piece", "usize", F.length("data").alias("n"), "error")
        .collect()
    )
    big = sorted((r.piece, r.n) for r in rows if r.path.endswith("big.zip"))
    assert [p for p, _ in big] == list(range(len(big))) and len(big) == 18
    assert sum(n for _, n in big) == size and all(n <= 8 << 20 for _, n in big)
    small = sorted((r.name, r.piece, r.n) for r in rows if r.path.endswith("small.zip"))
    assert small == [("a", 0, 2), ("e", 0, 0)]


def test_guarded_scan_keeps_every_file(spark, tmp_path):
    """Files that cannot be opened are error rows beside all others; the job does not end."""
    from leafmill.sources.files import read_guarded

    (tmp_path / "a.txt").write_text("alpha words")
    (tmp_path / "b.md").write_text("# Title\n\ntext")
    (tmp_path / "empty.txt").write_bytes(b"")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.txt").write_text("gamma")
    base = "file:" + str(tmp_path)
    listed = [f"{base}/a.txt", f"{base}/b.md", f"{base}/empty.txt", f"{base}/sub/c.txt", f"{base}/gone.txt", f"{base}/sub"]
    inventory = spark.createDataFrame([(p,) for p in listed], "path string")
    files = scan_files(spark, str(tmp_path), inventory=inventory, guarded=True)
    rows = {r.path.rsplit("/", 1)[1]: r for r in parse_corpus(files).select("path", "type", "text").collect()}
    assert set(rows) == {"a.txt", "b.md", "empty.txt", "c.txt", "gone.txt", "sub"}
    assert rows["gone.txt"].type == "error" and "ENOENT: no such file or directory, open '" in rows["gone.txt"].text
    assert rows["sub"].type == "error" and "EISDIR" in rows["sub"].text
    assert rows["empty.txt"].type == "empty" and rows["a.txt"].text.startswith("alpha") or "alpha" in rows["a.txt"].text
    assert read_guarded(str(tmp_path / "a.txt"), 5) == (6, None, None)  # beyond the limit: no content, no error
    assert read_guarded(str(tmp_path / "a.txt"), 100)[1] == b"alpha words"


def test_notebook_beyond_variant_keeps_its_cells(files):
    """A notebook with a 25-million-character inline image gives its cells; a broken one stays invalid."""
    import json

    image = ("QUJD" * 19 + "\n") * 330_000
    cells = [
        {"cell_type": "markdown", "source": ["# Plot\n", "of data"]},
        {"cell_type": "code", "source": "plot()", "outputs": [
            {"output_type": "display_data", "data": {"image/png": image, "text/plain": ["<Figure size 640x480>"]}},
            {"output_type": "execute_result", "data": {"image/jpeg": [image[:500], image[:700]], "text/plain": "done"}},
        ]},
    ]
    good = json.dumps({"cells": cells, "metadata": {}}).encode()
    broken = good[:-1]
    rows = {r.file_name: r for r in parse_corpus(files(("big.ipynb", good), ("broken.ipynb", broken))).select("file_name", "type", "text").collect()}
    text = rows["big.ipynb"].text
    assert "# Plot" in text and "plot()" in text and "<Figure size 640x480>" in text and "done" in text and "QUJD" not in text
    assert "Invalid JSON" in rows["broken.ipynb"].text


def test_sparse_sheet_is_counted_before_it_is_filled(files):
    """200,000 rows with one cell in the last column would fill 3.3 billion slots: an error row, not a lost executor."""
    rows = "".join(f'<row r="{i}"><c r="XFD{i}" t="inlineStr"><is><t>v</t></is></c></row>' for i in range(2, 200_002))
    sheet = f'<worksheet><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>a</t></is></c></row>{rows}</sheetData></worksheet>'
    small = '<worksheet><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>a</t></is></c><c r="C1" t="inlineStr"><is><t>c</t></is></c></row></sheetData></worksheet>'
    got = {r.file_name: r for r in parse_corpus(files(("wide.xlsx", book(sheet)), ("small.xlsx", book(small)))).select("file_name", "type", "text").collect()}
    assert got["wide.xlsx"].type == "error" and "larger than one row can hold" in got["wide.xlsx"].text
    assert got["small.xlsx"].type != "error" and got["small.xlsx"].text.endswith("a c")
