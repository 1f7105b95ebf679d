"""Corpus sources: files on storage, or tables that already hold their bytes or text."""

from __future__ import annotations

import errno
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.detect import file_name


def as_files(raw: DataFrame) -> DataFrame:
    return raw.select(
        "path", file_name(F.col("path")).alias("file_name"), F.col("length").alias("file_size"), "content"
    )


def scan_files(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    recursive: bool = True,
    keep_empty: bool = False,
    inventory: DataFrame | None = None,
    guarded: bool = False,
    split_above: int | None = None,
) -> DataFrame:
    """files: path, file_name, file_size, content.

    A job that does not use ``content`` does not read it, and conditions on path and size are
    pushed into the scan.  Files beyond ``spark.sql.sources.binaryFile.maxLength``, which no row
    can hold, come without content; the corpus job makes error rows of them.  Files that vanish
    while the job runs are left to ``read_failures``.

    Spark's file scans skip files of zero bytes.  They are added from an ``inventory`` (path,
    length), as object stores provide, or, with ``keep_empty``, from the listing of the scan: its
    names then pass through the driver, so that is for folders whose names fit there.

    ``guarded``: a file that exists but cannot be opened or read (no permission, a folder in the inventory, a
    damaged disk) becomes a row with ``read_error`` instead of ending the job. The scan skips what it cannot read;
    paths of the listing (``inventory``, else the scan's own) that it did not deliver are then opened one by one in
    tasks, and each failure is kept as its message. Empty files come the same way.

    ``split_above``: files of more bytes, of any size, come as a row per line of their bytes instead (not with
    ``guarded``), so that several tasks share a file and none reads more than a split of the scan; a smaller file stays
    one row.  A row has its line end, one more than the file if that ends without; the lines of a split come in order
    and ``start`` is where their split starts.  Reading by lines drops a leading UTF-8 byte order mark.
    Files under the suffix of a compression, which that reader would inflate, are left whole.
    """
    if guarded:
        return _guarded(spark, path, glob, recursive, inventory)
    reader = spark.read.format("binaryFile").option("ignoreMissingFiles", "true")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    scan = reader.load(path)
    most = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength", str((1 << 31) - 1)))
    read = scan if split_above is None else scan.filter(~_is_split(split_above))
    found = [read.filter(F.col("length") <= most), _without_content(read.filter(F.col("length") > most))]
    if keep_empty or inventory is not None:
        empty = _listed_empty(spark, scan) if inventory is None else inventory.filter(F.col("length") == 0)
        found.append(_without_content(empty.withColumn("length", F.lit(0).cast("bigint")), F.lit(b"")))
    files = as_files(reduce(DataFrame.unionByName, found))
    if split_above is None:
        return files
    return files.withColumn("start", F.lit(0).cast("bigint")).unionByName(_lines(spark, path, glob, recursive, split_above))


# Suffixes whose files Hadoop's line reader inflates.
_COMPRESSED = r"(?i)\.(?:gz|gzip|bz2|deflate|snappy|lz4|zst|zstd|zlib|lzo|xz|bz|passthrough)$"


def _is_split(split_above: int) -> Column:
    """Over the metadata of a scan's files, so that those it does not want are not opened."""
    return (F.col("_metadata.file_size") > split_above) & ~F.rlike("_metadata.file_name", F.lit(_COMPRESSED))


def _lines(spark: SparkSession, path: str, glob: str | None, recursive: bool, split_above: int) -> DataFrame:
    """The lines of the files above the limit, as the bytes they are."""
    reader = spark.read.format("text").option("lineSep", "\n").option("ignoreMissingFiles", "true")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    where = _plain_path(F.col("_metadata.file_path"))
    return reader.load(path).filter(_is_split(split_above)).select(
        where.alias("path"),
        file_name(where).alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("content"),
        F.col("_metadata.file_block_start").alias("start"),
    )


def _guarded(spark: SparkSession, path: str, glob: str | None, recursive: bool, inventory: DataFrame | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    scan = reader.load(path)
    most = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength", str((1 << 31) - 1)))
    delivered = as_files(scan.filter(F.col("length") <= most)).withColumn("read_error", F.lit(None).cast("string"))
    large = as_files(_without_content(scan.filter(F.col("length") > most))).withColumn("read_error", F.lit(None).cast("string"))
    listed = _listed_empty(spark, scan) if inventory is None else inventory.select("path").join(scan.select("path"), "path", "left_anti")
    opened = listed.select("path").mapInArrow(_open_each(most), "path string, length bigint, content binary, read_error string")
    opened = opened.select("path", file_name(F.col("path")).alias("file_name"), F.col("length").alias("file_size"), "content", "read_error")
    return reduce(DataFrame.unionByName, [delivered, large, opened])


# Messages of failed opens, in the words of the usual file-system errors.
_MESSAGES = {
    errno.ENOENT: "ENOENT: no such file or directory, open '{}'",
    errno.EACCES: "EACCES: permission denied, open '{}'",
    errno.EPERM: "EPERM: operation not permitted, open '{}'",
    errno.EISDIR: "EISDIR: illegal operation on a directory, read",
}


def read_guarded(path: str, most: int) -> tuple[int, bytes | None, str | None]:
    """(length, content, error) of one file; content is None when it fails or holds more than most bytes."""
    local = path[len("file:") :] if path.startswith("file:") else path
    local = "/" + local.lstrip("/") if path.startswith("file:") else local
    try:
        if "://" in path and not path.startswith("file:"):
            from pyarrow import fs

            system, inner = fs.FileSystem.from_uri(path)
            with system.open_input_stream(inner) as stream:
                data = stream.read(most + 1)
        else:
            with open(local, "rb") as stream:
                data = stream.read(most + 1)
        return (len(data), None, None) if len(data) > most else (len(data), data, None)
    except OSError as exc:
        text = _MESSAGES.get(exc.errno, "{}: " + (exc.strerror or type(exc).__name__)).format(path)
        return 0, None, text.encode("utf-8", "replace").decode()
    except Exception as exc:  # any failure of one file is its row
        return 0, None, (str(exc) or type(exc).__name__).encode("utf-8", "replace").decode()


def _open_each(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            found = [read_guarded(p, most) if p is not None else (0, None, "no path") for p in paths]
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), *(pa.array(c, k) for c, k in zip(zip(*found), (pa.int64(), pa.binary(), pa.string())))]
                if found
                else [pa.array([], pa.string()), pa.array([], pa.int64()), pa.array([], pa.binary()), pa.array([], pa.string())],
                ["path", "length", "content", "read_error"],
            )

    return run


def _without_content(rows: DataFrame, content: Column | None = None) -> DataFrame:
    """Rows of a listing in the shape of the scan; bytes are not read."""
    return rows.select(
        "path",
        F.lit(None).cast("timestamp").alias("modificationTime"),
        "length",
        (F.lit(None).cast("binary") if content is None else content).alias("content"),
    )


def _plain_path(uri: Column) -> Column:
    """Listed names are percent-encoded URIs; the scan gives plain paths."""
    plain = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def _listed_empty(spark: SparkSession, scan: DataFrame) -> DataFrame:
    """Paths that the scan has listed but does not deliver, which are those of empty files."""
    uris = spark.createDataFrame([(uri,) for uri in scan.inputFiles()], "uri string")
    paths = uris.select(_plain_path(F.col("uri")).alias("path"))
    return paths.join(scan.select("path"), "path", "left_anti")


def files_from_table(table: DataFrame, path: Column, content: Column) -> DataFrame:
    """files from a table; ``content`` may be text or bytes."""
    raw = table.select(path.alias("path"), content.cast("binary").alias("content"))
    return as_files(raw.withColumn("length", F.octet_length("content").cast("bigint")))
