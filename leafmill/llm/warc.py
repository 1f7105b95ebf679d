"""Captures as WARC files, and their assembly from separate records.

Every capture is written as three records: the request, the response (or a revisit of an identical earlier payload) and
a metadata record; request and metadata name the capture's record in WARC-Concurrent-To. Reading parses the files by
Content-Length and joins the three back into one nested row per capture.

The files are written by Spark's text sink: a record is text (headers, blank line, block), and the sink's line
separator is the blank lines that end a record, so writes are committed per task on any store.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.scratch import keep

_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"
_CUT = _END.encode()
_CHUNK = 1 << 20
_FILE_RECORDS = 30_000

RECORDS = (
    "record_id string, kind string, concurrent_to string, target_uri string, digest string, length long, "
    "payload_sha1 string, payload_bytes long, fields map<string,string>, file string, offset long"
)


def _uuid(*parts: Column) -> Column:
    """A record id that depends on the given values only."""
    x = F.md5(F.concat_ws("\x1f", *parts))
    cut = [F.substring(x, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: str | Column, record_id: Column, block: Column, *headers: tuple[str, Column]) -> Column:
    """Header lines (null ones left out), blank line, block; the closing blank lines come from the sink."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", F.lit(_DATE)), *headers]
    lines.append(("Content-Length", F.octet_length(block).cast("string")))
    head = F.concat_ws("\r\n", F.lit("WARC/1.1"), *[F.concat(F.lit(f"{name}: "), value) for name, value in lines])
    return F.concat(head, F.lit(_END), block)


def _header_text(c: Column) -> Column:
    """A value as one header line: control characters are percent-encoded."""
    c = F.coalesce(c, F.lit(""))
    return F.when(
        c.rlike(r"[\x00-\x1f\x7f]"),
        F.array_join(
            F.transform(
                F.split(c, ""),
                lambda x: F.when(x.rlike(r"[\x00-\x1f\x7f]"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(x)), 2, "0"))).otherwise(x),
            ),
            "",
        ),
    ).otherwise(c)


def plan_captures(pages: DataFrame, least_bytes: int = 1000, broadcast_rows: int = 200_000, salt: int = 64) -> DataFrame:
    """Pages with payload (null html: empty), its size and SHA-1, and refers_to for those that are revisits.

    Among rows with equal payloads of at least least_bytes, the largest page_id is the response; the others revisit it.
    Rows that repeat that page_id are responses too. A null page_id is a revisit unless all of the group are null.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id",
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"),
        F.sha1(payload.cast("binary")).alias("digest"),
    )
    # Only payloads that occur again; partial sums meet per payload, so a very common one is no hot key here.
    shared = (
        rows.where(F.col("bytes") >= least_bytes)
        .groupBy("digest", "bytes")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("keeper"))
        .where("n > 1")
        .select("digest", "bytes", "keeper")
    )
    # Payloads never meet on one key: the repeated digests come as a broadcast table when few (counted first), else each
    # is copied to `salt` keys and the rows are spread over them, so a payload that a third of the rows share is split.
    if shared.count() <= broadcast_rows:
        joined = rows.join(F.broadcast(shared), ["digest", "bytes"], "left")
    else:
        copies = shared.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        spread = rows.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url", "digest"), F.lit(salt)).cast("int"))
        joined = spread.join(copies, ["digest", "bytes", "_salt"], "left").drop("_salt")
    return joined.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))).drop("keeper")


def write(pages: DataFrame, path: str, least_bytes: int = 1000) -> None:
    """Write page_id, url, html as WARC files of three records per row; other columns are ignored.

    Null urls become empty target URIs, null html an empty payload. Every row is a capture, repeated rows too. Files
    are compressed as whole files.
    """
    rows = plan_captures(pages, least_bytes)
    # Drawn once per row, so the three records of a capture agree; it tells repeated rows apart.
    rows = rows.withColumn("row", F.concat_ws("-", F.spark_partition_id(), F.monotonically_increasing_id()))
    uri = _header_text(F.col("url"))
    revisit = F.col("refers_to").isNotNull()
    page = F.col("page_id").cast("string")
    own = _uuid(F.lit("capture"), F.col("row"), F.coalesce(page, F.lit("null")), F.col("digest"))
    digest = F.concat(F.lit("sha1:"), F.upper(F.col("digest")))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"))
    reply = _record(
        F.when(revisit, "revisit").otherwise("response"),
        own,
        F.when(revisit, head).otherwise(F.concat(head, F.col("payload"))),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", digest),
        ("WARC-Profile", F.when(revisit, F.lit(_PROFILE))),
        ("Content-Type", F.lit("application/http;msgtype=response")),
    )
    request = _record(
        "request",
        _uuid(F.lit("request"), own),
        F.concat(F.lit("GET "), F.when(uri == "", "/").otherwise(uri), F.lit(" HTTP/1.1" + _END)),
        ("WARC-Target-URI", uri),
        ("WARC-Concurrent-To", own),
        ("Content-Type", F.lit("application/http;msgtype=request")),
    )
    fields = F.concat_ws(
        "\r\n", F.concat(F.lit("page-id: "), page), F.concat(F.lit("payload-bytes: "), F.col("bytes").cast("string")), F.lit("")
    )
    metadata = _record(
        "metadata",
        _uuid(F.lit("metadata"), own),
        fields,
        ("WARC-Target-URI", uri),
        ("WARC-Concurrent-To", own),
        ("Content-Type", F.lit("application/warc-fields")),
    )
    records = rows.select(F.explode(F.array(request, reply, metadata)).alias("value"))
    records.write.option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", _FILE_RECORDS).text(path)


_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")


class _Stream:
    """A window over a file's bytes, decompressed as it moves on."""

    def __init__(self, name: str, raw: pa.Buffer):
        source = pa.BufferReader(raw)
        self.file = gzip.GzipFile(fileobj=source) if name.endswith(".gz") else source
        self.bytes, self.at, self.dropped = bytearray(), 0, 0

    def more(self) -> bool:
        if self.at > _CHUNK:
            del self.bytes[: self.at]
            self.dropped, self.at = self.dropped + self.at, 0
        got = self.file.read(_CHUNK)
        self.bytes += got
        return bool(got)

    def holds(self, end: int) -> bool:
        """Whether that many bytes follow; a shorter rest is a damaged file."""
        while len(self.bytes) - self.at < end:
            if not self.more():
                return False
        return True


def _records(name: str, raw: pa.Buffer) -> Iterator[tuple]:
    """Records of one file, cut by Content-Length; memory is bounded by the largest record."""
    s = _Stream(name, raw)
    while True:
        seen = 0
        while (stop := s.bytes.find(_CUT, s.at + seen)) < 0:
            seen = max(0, len(s.bytes) - s.at - 3)
            if not s.more():
                if len(s.bytes) > s.at:
                    raise ValueError(f"{name}: the record at byte {s.dropped + s.at} has no end of headers")
                return
        lines = {k.lower(): v.decode() for k, v in _HEADER.findall(s.bytes, s.at, stop)}
        head, size = stop + 4 - s.at, int(lines[b"content-length"])
        if not s.holds(head + size + 4) or s.bytes[s.at + head + size : s.at + head + size + 4] != _CUT:
            raise ValueError(f"{name}: the record at byte {s.dropped + s.at} does not end where its length says")
        start = s.at + head
        kind, fields, sha, n = lines[b"warc-type"], None, None, None
        if kind == "metadata":
            fields = [(k.decode(), v.decode()) for k, v in _HEADER.findall(s.bytes, start, start + size)]
        elif kind == "response":
            body = bytes(s.bytes[s.bytes.index(_CUT, start, start + size) + 4 : start + size])
            sha, n = hashlib.sha1(body).hexdigest(), len(body)
        yield (
            lines[b"warc-record-id"],
            kind,
            lines.get(b"warc-concurrent-to"),
            lines.get(b"warc-target-uri", ""),
            lines.get(b"warc-payload-digest"),
            size,
            sha,
            n,
            fields,
            name,
            s.dropped + s.at,
        )
        s.at = start + size + 4


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the files under path."""
    types = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.string(), pa.int64()]
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = []
                for row in _records(name, content.as_buffer()):
                    rows.append(row)
                    if len(rows) == 4096:
                        yield _batch(rows, types, names)
                        rows = []
                if rows:
                    yield _batch(rows, types, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, RECORDS)


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its record, request and metadata, found through WARC-Concurrent-To.

    Give a table that is cheap to read three times. Record ids are unique, so no key of the joins is common. A revisit's payload is found by its digest among the
    responses; a capture without request or metadata keeps nulls there.
    """
    kind = F.col("kind")
    place = F.struct("record_id", "length", "file", "offset")
    requests = records.where(kind == "request").select(F.col("concurrent_to").alias("id"), place.alias("request"))
    metadata = records.where(kind == "metadata").select(
        F.col("concurrent_to").alias("id"), F.struct("record_id", "length", "file", "offset", "fields").alias("metadata")
    )
    replies = records.where(kind.isin("response", "revisit")).select(
        F.col("record_id").alias("id"),
        F.col("kind").alias("record_type"),
        "target_uri",
        F.lower(F.regexp_extract("digest", "^sha1:(.*)$", 1)).alias("payload_digest"),
        "payload_sha1",
        "payload_bytes",
        place.alias("reply"),
    )
    field = lambda name: F.col("metadata.fields")[name].cast("long")
    return (
        replies.join(requests, "id", "left")
        .join(metadata, "id", "left")
        .withColumn("page_id", field("page-id"))
    )


def captures(records: DataFrame) -> DataFrame:
    """Assembled captures with full payload sizes and digests, and the page that a revisit refers to."""
    rows = keep(assemble(keep(records, "warc-records")), "warc-captures")
    # Responses of payloads that are revisited: one row per digest.
    keepers = (
        rows.where((F.col("record_type") == "response") & F.col("page_id").isNotNull())
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("full_bytes"))
    )
    revisits = rows.where(F.col("record_type") == "revisit").join(keepers, "payload_digest", "left")
    responses = rows.where(F.col("record_type") == "response").withColumn("refers_to", F.lit(None).cast("long"))
    responses = responses.withColumn("full_bytes", F.col("payload_bytes"))
    return revisits.unionByName(responses).select(
        "page_id",
        F.col("full_bytes").alias("payload_bytes"),
        F.coalesce("payload_sha1", "payload_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
        F.col("target_uri").alias("url"),
        "reply",
        "request",
        "metadata",
    )
