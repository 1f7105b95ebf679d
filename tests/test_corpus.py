import json
import os

import pytest

from corpora.pack import tar_bytes, zip_bytes
from corpora import queries
from leafmill import ParseOptions, parse_corpus, scan_files, summarise, write_reports
from leafmill.operators.paged import PAGES_PER_GROUP, assemble_pages
from leafmill.operators.routes import read_failures
from corpora.build import spread
from leafmill.streaming.arrivals import parse_arrivals

CORPUS = {
    "a.txt": b"plain  text\r\n",
    "b.md": b"# md\r\n",
    "c.html": b"<p>page",
    "d.xml": b"<r>xml</r>",
    "e.json": b'{"a": 1}',
    "f.ipynb": json.dumps({"cells": [{"cell_type": "markdown", "source": "nb"}]}).encode(),
    "g.csv": b"k,v\n1,2\n",
    "h.tsv": b"k\tv\n",
    "i.zip": zip_bytes([("m", b"x")]),
    "j.tar": tar_bytes([("m", b"x")]),
    "k.pptx": zip_bytes([("ppt/slides/slide1.xml", b"<a:t>s</a:t>")]),
    "l.epub": zip_bytes([("c.html", b"<p>ch")]),
    "m.docx": zip_bytes([("word/document.xml", b"<w:p><w:t>w</w:t></w:p>")]),
    "n.xlsx": zip_bytes([("other", b"")]),
    "o.pptx": b"not a zip",
    "p.ppt": b"\xd0\xcf\x11\xe0",
    "q.xls": b"\xd0\xcf\x11\xe0",
    "r.rar": b"Rar!x",
    "s.7z": b"7z",
    "t.gz": b"\x1f\x8b",
    "u.mobi": b"m",
    "v.pdf": b"%PDF-1.4",
    "w.png": b"\x89PNG" + b"\0" * 1276,
    "x.py": b"print()",
    "y": b"\0\1\2",
    "z.md": b"",
    "sub/dir/plain": b"dotless text",
}
WANT = {
    "a.txt": ("text", "TEXT", "plain  text\r\n"),
    "b.md": ("markdown", "Markdown", "# md"),
    "c.html": ("html", "HTML", "page"),
    "d.xml": ("xml", "XML", "xml"),
    "e.json": ("json", "JSON", '{"a": 1}'),
    "f.ipynb": ("ipynb", "Jupyter Notebook", "nb"),
    "g.csv": ("xlsx", "CSV", "=== Sheet: Sheet1 ===\nk v\n1 2"),
    "h.tsv": ("xlsx", "XLSX", "=== Sheet: Sheet1 ===\nk v"),
    "k.pptx": ("pptx", "PPTX", "--- Slide 1 ---\ns"),
    "l.epub": ("epub", "EPUB", "ch"),
    "m.docx": ("docx", "DOCX", "w"),
    "n.xlsx": ("error", None, "Error parsing xlsx file: Could not find workbook"),
    "o.pptx": ("error", None, "Error parsing pptx file: File is not a zip file"),
    "p.ppt": ("error", None, "Error parsing ppt file: File is not a zip file"),
    "q.xls": ("error", None, "Error parsing xls file: legacy binary workbooks are not decoded"),
    "r.rar": ("rar", "RAR", "RAR file: r.rar (5 B). RAR extraction requires external tool (e.g., unrar/7z)."),
    "s.7z": ("7z", "7z", "7z file: s.7z (2 B). 7z extraction requires external tool (e.g., 7-Zip)."),
    "t.gz": ("gz", "GZip", "GZip file: t.gz (2 B). Use external tools to decompress."),
    "u.mobi": ("mobi", "MOBI", "MOBI file: u.mobi. MOBI parsing is not natively supported. Convert to EPUB for parsing."),
    "w.png": ("image", "PNG", "Image file: w.png (1.3 KB). Enable extractImages: true to perform OCR."),
    "z.md": ("empty", None, "File is empty."),
    "plain": ("text", "TEXT", "dotless text"),
}


@pytest.fixture(scope="module")
def directory(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    for name, data in CORPUS.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return str(root)


def test_every_route(spark, directory):
    rows = {r.file_name: r for r in parse_corpus(scan_files(spark, directory, keep_empty=True)).collect()}
    assert len(rows) == len(CORPUS)
    got = {name: (rows[name].type, rows[name].meta.format, rows[name].text) for name in WANT}
    assert got == WANT
    assert rows["i.zip"].archive_contents == ["m"] and rows["j.tar"].meta.entries == 1
    assert rows["v.pdf"].type == "pdf" and rows["v.pdf"].text.startswith("PDF file: v.pdf (8 B).")
    for name, kind in (("x.py", "PY"), ("y", None)):
        assert rows[name].type == "unknown" and rows[name].meta.format == kind
    assert rows["x.py"].text.startswith("Unrecognized file type: py (extension: py).\nFile size: 7 bytes.\nThe parser supports: PDF, DOCX,")
    for name in ("n.xlsx", "o.pptx", "x.py", "y", "z.md"):
        r = rows[name]
        assert (r.truncated, r.total_chars, r.returned_chars, r.meta.word_count) == (False, 0, 0, None)
    assert rows["a.txt"].total_chars == 13 and rows["a.txt"].meta.word_count == 2


def test_limits(spark, files):
    f = files(("a.txt", b"one two three"), ("b.md", b"one two three"))
    a, b = sorted(parse_corpus(f, ParseOptions(max_chars=5)).collect(), key=lambda r: r.path)
    assert (a.text, a.truncated, a.total_chars, a.returned_chars, a.meta.word_count) == ("one t", True, 13, 5, 3)
    note = "one t\n\n[... truncated at 5 chars. Total available: 13 chars]"
    assert (b.text, b.truncated, b.total_chars, b.returned_chars) == (note, True, 13, len(note))
    assert b.meta.word_count == len(note.split())


def test_image_with_ocr(files):
    (row,) = parse_corpus(files(("i.png", b"\x89PNG")), ParseOptions(extract_images=True)).collect()
    assert row.type == "image" and "OCR is not performed here" in row.text


def test_read_failures(spark, directory):
    manifest = spark.createDataFrame([("a.txt",), ("gone/missing.txt",), ("gone/missing.txt",)], "path string")
    found = scan_files(spark, directory, keep_empty=True).selectExpr("file_name AS path")
    rows = read_failures(manifest, found).collect()
    assert len(rows) == 2
    r = rows[0]
    assert (r.file_name, r.file_size, r.type, r.total_chars) == ("missing.txt", 0, "error", 0)
    assert r.text == "Failed to read file: ENOENT: no such file or directory, open 'gone/missing.txt'"


def test_summary(spark, directory):
    rows = {r.type: r for r in summarise(parse_corpus(scan_files(spark, directory, keep_empty=True))).collect()}
    assert rows["error"].files == rows["error"].failed == 4 and rows["error"].words == 0
    assert rows["text"].files == 2 and rows["text"].words == 4 and rows["text"].chars == 25


def test_sinks(spark, directory, tmp_path):
    source = scan_files(spark, directory, keep_empty=True)
    write_reports(source, str(tmp_path / "table"), ParseOptions(max_chars=1))
    rows = {r.export_name: r.report for r in spark.read.parquet(str(tmp_path / "table")).collect()}
    assert rows["a.md"].endswith("### Content\n\nplain  text\r\n") and "truncated" not in rows["a.md"]
    few = source.filter("file_name in ('a.txt', 'b.md')")
    write_reports(few, str(tmp_path / "each"), one_file_each=True)
    parts = os.listdir(tmp_path / "each" / "export_name=b.md")
    (name,) = [p for p in parts if p.endswith(".txt")]
    assert (tmp_path / "each" / "export_name=b.md" / name).read_text() == rows["b.md"] + "\n"


def test_streaming(spark, directory, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for _ in range(2):
        query = parse_arrivals(spark, directory, out, check, files_per_batch=10)
        query.awaitTermination(120)
        assert query.exception() is None
    got = {r.file_name: r.type for r in spark.read.parquet(out).select("file_name", "type").collect()}
    # A directory stream does not deliver empty files.
    source = scan_files(spark, directory, keep_empty=False)
    want = {r.file_name: r.type for r in parse_corpus(source).select("file_name", "type").collect()}
    assert got == want and spark.read.parquet(out).count() == len(CORPUS) - 1


def test_scan_keeps_empty_files(spark, tmp_path):
    names = {"a b%20+\u00e9.txt": b"", "c d%20+\u00e9.txt": b"x", "plain": b"", "sub/e.md": b""}
    for name, data in names.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    rows = scan_files(spark, str(tmp_path), keep_empty=True).collect()
    assert {r.path: bytes(r.content) for r in rows} == {f"file:{tmp_path}/{n}": d for n, d in names.items()}
    assert len(rows) == 4
    inventory = spark.createDataFrame([("file:/x/plain", 0), ("file:/x/full", 9)], "path string, length bigint")
    rows = scan_files(spark, str(tmp_path), inventory=inventory).filter("file_size = 0").collect()
    assert [(r.path, r.file_name) for r in rows] == [("file:/x/plain", "plain")]


def test_paged(spark):
    n = PAGES_PER_GROUP * 2 + 5
    rows = [("big.pdf", i, f"p{i} ", {"Title": "B", "Author": "me"}) for i in range(n)]
    rows += [("x/small.pdf", 2, "two", None), ("x/small.pdf", 1, "one ", None)]
    pages = spark.createDataFrame(rows, "path string, page_no int, text string, info map<string,string>").repartition(4)
    big, small = sorted(assemble_pages(pages, ParseOptions(max_chars=0)).collect(), key=lambda r: r.path)
    assert big.text == " ".join(f"p{i}" for i in range(n)) and big.meta.pages == n
    assert (big.meta.title, big.meta.author, big.meta.created, big.meta.format) == ("B", "me", None, "PDF")
    assert (small.text, small.file_name, small.type, small.meta.pages) == ("one two", "small.pdf", "pdf", 2)
    big, small = sorted(assemble_pages(pages, ParseOptions(max_pages=1)).collect(), key=lambda r: r.path)
    assert (big.text, big.meta.pages, small.text) == ("p0", n, "one")


def test_spread(spark):
    few = spread(spark.range(0, 100, 1, 1))
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 64)
    assert spread(many) is many


def test_split_scan(spark, tmp_path, monkeypatch):
    """A file above the limit is shared by tasks, byte for byte; what it holds does not decide how much a task reads."""
    large = b"P\nA\n\xff\x00\r\n\r" * 400_000
    (tmp_path / "a b%+.parquet").write_bytes(large)
    (tmp_path / "small.parquet").write_bytes(b"PAR1\n\nPAR1\n")
    (tmp_path / "x.parquet.gz").write_bytes(b"no gzip\n" * 500)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        rows = scan_files(spark, str(tmp_path), split_above=1000)
        kept = rows.selectExpr("*", "spark_partition_id() as task", "monotonically_increasing_id() as n").collect()
        of = lambda name: sorted((r for r in kept if r.file_name == name), key=lambda r: (r.start, r.n))
        assert b"".join(r.content for r in of("a b%+.parquet"))[:-1] == large
        assert len({r.task for r in of("a b%+.parquet")}) >= 3
        assert [bytes(r.content) for r in of("small.parquet")] == [b"PAR1\n\nPAR1\n"]
        assert [len(r.content) for r in of("x.parquet.gz")] == [4000]
        plain = {r.path for r in scan_files(spark, str(tmp_path)).select("path").collect()}
        assert plain == {r.path for r in kept}

        monkeypatch.setattr(queries, "SPLIT_ABOVE", 1000)
        got = {tuple(r) for r in queries.corpus_scan(spark, str(tmp_path)).collect()}
        assert got == {("", "500A410A", True), ("small", "50415231", True)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
