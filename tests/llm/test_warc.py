import hashlib

from llm_data import clashing, rows_of

from leafmill.llm import warc
from leafmill.llm.scratch import new_path

BIG = "<p>" + "héllo\r\n\r\nWARC/1.1\r\n\r\n" * 80 + "</p>"


def pages(spark, rows):
    return clashing(spark.createDataFrame(rows, "page_id long, url string, html string")).repartition(3)


def through(spark, df):
    path = new_path(spark, "test-warc")
    warc.write(df, path)
    return path, warc.captures(warc.read(spark, path))


def test_round_trip(spark):
    rows = [
        (1, "http://a/", BIG),
        (2, "http://b/\r\nX: y", BIG),
        (7, None, BIG),
        (7, None, BIG),
        (3, "http://c/", "short"),
        (4, "http://d/", "short"),
        (5, "http://e/", None),
        (6, "http://f/", ""),
        (None, "http://g/", "x" * 1000),
        (None, "http://h/", BIG),
        (8, "http://i/", "y" * 999),
        (9, "http://j/", "y" * 999),
        (10, "http://k/", "z" * 300_000),
    ]
    _, got = through(spark, pages(spark, rows))
    expected = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = h == BIG and i != 7
        expected.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", 7 if revisit else None))
    assert rows_of(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(expected, key=repr)


def test_records_and_transactions(spark):
    path, got = through(spark, pages(spark, [(i, f"http://x/{i}", BIG if i < 3 else f"page {i}") for i in range(20)]))
    records = warc.read(spark, path).collect()
    assert len({r.record_id for r in records}) == len(records) == 60
    assert sorted({r.kind for r in records}) == ["metadata", "request", "response", "revisit"]
    for r in got.collect():
        assert r.request.record_id and r.metadata.fields["page-id"] == str(r.page_id) and r.url == f"http://x/{r.page_id}"
    files = {r.path: bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect() if "part-" in r.path}
    import gzip

    one = next(r for r in records if r.kind == "response")
    raw = gzip.decompress(next(v for k, v in files.items() if k == one.file))
    assert raw[one.offset :].startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")


def test_empty(spark):
    _, got = through(spark, pages(spark, []))
    assert got.count() == 0


def test_damaged_file_is_reported():
    import pyarrow as pa
    import pytest

    record = b"WARC/1.1\r\nWARC-Type: request\r\nWARC-Record-ID: <a>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [r[0] for r in warc._records("x", pa.py_buffer(record * 2))] == ["<a>", "<a>"]
    for cut in (10, len(record) - 5):
        with pytest.raises(ValueError, match="x: the record at byte"):
            list(warc._records("x", pa.py_buffer(record[:cut])))


def test_shared_payload_salted_like_broadcast(spark):
    """A payload that most rows share: the salted join gives the rows of the broadcast one."""
    from leafmill.llm.warc import plan_captures

    big = "<html>" + "x" * 2000 + "</html>"
    rows = [(i, f"http://h/{i}", big if i % 4 else f"<p>{i}</p>" * 200) for i in range(60)] + [(None, None, big), (7, "http://h/7", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    cols = ["page_id", "url", "bytes", "digest", "refers_to"]
    plain = sorted(map(tuple, plan_captures(pages).select(*cols).collect()), key=repr)
    salted = sorted(map(tuple, plan_captures(pages, broadcast_rows=0, salt=3).select(*cols).collect()), key=repr)
    assert plain == salted
    assert sum(r[4] == 59 for r in plain) == len([r for r in rows if r[2] == big]) - 1
