from leafmill.functions import detect as X
from leafmill.plans.corpus import detect

CASES = [
    ("a.pdf", b"%PDF-1", ("pdf", "pdf", "high")),
    ("a.txt", b"%PDF-1", ("pdf", "pdf", "high")),
    ("a.docx", b"PK\x03\x04", ("docx", "docx", "high")),
    ("a.XLSX", b"PK\x03\x04", ("xlsx", "xlsx", "high")),
    ("a.pptx", b"PK\x03\x04", ("pptx", "pptx", "high")),
    ("a.epub", b"PK\x03\x04", ("epub", "epub", "high")),
    ("a.bin", b"PK\x03\x04", ("zip", "zip", "high")),
    ("a.docx", b"plain text", ("docx", "docx", "medium")),
    ("a.rar", b"Rar!", ("rar", "rar", "high")),
    ("a.tar.gz", b"\x1f\x8b\x08", ("gz", "gz", "high")),
    ("a.png", b"\x89PNG", ("png", "png", "high")),
    ("a.x", b"\xff\xd8\xff\xe0", ("jpeg", "jpeg", "high")),
    ("a.wav", b"RIFF", ("webp", "webp", "high")),
    ("a.gif", b"GIF89a", ("gif", "gif", "high")),
    ("a.txt", b"BMW is a car", ("bmp", "bmp", "high")),
    ("a.JPG", b"x", ("jpeg", "jpg", "medium")),
    ("a.htm", b"<p>", ("html", "htm", "medium")),
    ("a.md", b"x", ("markdown", "md", "medium")),
    ("a.log", b"x", ("text", "log", "medium")),
    ("a.yml", b"x", ("yaml", "yml", "medium")),
    ("a.cfg", b"x", ("ini", "cfg", "medium")),
    ("a.tif", b"x", ("tif", "tif", "medium")),
    ("a.mobi", b"x", ("mobi", "mobi", "medium")),
    ("noext", b"hello there", ("text", "txt", "medium")),
    ("noext", b"\x00\x01\x02", ("unknown", "", "low")),
    ("dir.d/noext", b"hello", ("text", "txt", "medium")),
    ("trailing.", b"hello", ("text", "txt", "medium")),
    ("a.zip", b"just text", ("text", "txt", "medium")),
    ("a.zip", b"\x00\x00", ("unknown", "zip", "low")),
    ("a.7z", b"7z\xbc\xaf", ("7z", "7z", "medium")),
]


def test_detection(files):
    rows = detect(files(*[(f"{i}/{n}", b) for i, (n, b, _) in enumerate(CASES)])).collect()
    got = {int(r.path.split("/")[0]): (r.type, r.ext, r.confidence) for r in rows}
    assert got == {i: want for i, (_, _, want) in enumerate(CASES)}


def test_text_sniff(column):
    data = [
        b"",
        b"\x00" * 10,
        b"a" * 80 + b"\x00" * 20,
        b"a" * 81 + b"\x00" * 19,
        b"a" * 4096 + b"\x00" * 4096,
        b"\x7f" * 4,
        b"\xf7" * 4,
        b"\xf8" * 4,
        b"\t\n\r ",
        b"\x0b\x0c",
    ]
    got = column([bytearray(b) for b in data], "binary", X.is_text)
    assert got == [False, False, False, True, True, False, True, False, True, False]


def test_file_name(column):
    paths = ["/a/b.txt", "c:\\d\\e.md", "s3://x/y\\z.csv", "plain", "a/"]
    assert column(paths, "string", X.file_name) == ["b.txt", "e.md", "z.csv", "plain", "a/"]


def test_every_suffix(column):
    assert len(X.EXTENSION_TYPES) == 34
    got = column(list(X.EXTENSION_TYPES), "string", X.ext_type)
    assert got == list(X.EXTENSION_TYPES.values())


def test_sniff_looks_each_character_up(column):
    """The sniffed class lists its bytes: neither ranges nor a negation, which are tested one by one per character."""
    assert "^" not in X._NOT_TEXT and "-" not in X._NOT_TEXT
    each = [bytearray([b]) for b in range(256)]
    text = [b in (9, 10, 13) or 0x20 <= b <= 0x7E or 0x80 <= b <= 0xF7 for b in range(256)]
    assert column(each, "binary", X.is_text) == text
