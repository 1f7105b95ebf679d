"""Packers for the byte corpora that queries and tests read; not part of the engine."""

from __future__ import annotations

import io
import sys
import tarfile
import zipfile

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def zip_bytes(members: list[tuple[str, bytes]], deflate: bool = False) -> bytes:
    """A zip with fixed time stamps; names that end in a slash are directories."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, data in members:
            info = zipfile.ZipInfo(name)
            info.compress_type = zipfile.ZIP_DEFLATED if deflate and data else zipfile.ZIP_STORED
            archive.writestr(info, data)
    return out.getvalue()


def tar_bytes(members: list[tuple[str, bytes]]) -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=tarfile.USTAR_FORMAT) as archive:
        for name, data in members:
            info = tarfile.TarInfo(name.rstrip("/"))
            info.type = tarfile.DIRTYPE if name.endswith("/") else tarfile.REGTYPE
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
    return out.getvalue()


def packed(members: Column, container: str = "zip") -> Column:
    """Container bytes of an ARRAY<STRUCT<name STRING, data BINARY>>."""
    write = zip_bytes if container == "zip" else tar_bytes

    def pack(rows: pa.Array) -> pa.Array:
        # Row by row, so that of a batch only one row is held as Python values.
        return pa.array((write([(m["name"], m["data"]) for m in row.as_py()]) for row in rows), pa.binary())

    pack.__annotations__ = {"rows": pa.Array, "return": pa.Array}
    return F.arrow_udf(pack, returnType="binary")(members)


def member(name: Column | str, text: Column | str) -> Column:
    name = F.lit(name) if isinstance(name, str) else name
    text = F.lit(text) if isinstance(text, str) else text
    return F.struct(name.alias("name"), text.cast("binary").alias("data"))


def xml_escape(text: Column) -> Column:
    for char, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(reference))
    return text
