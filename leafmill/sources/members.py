"""Members of zip and tar containers: the engine's only Python step.

A container is read where its row is, and its members stay in that row as an array, so a document
is put together again without a shuffle.  Rows that are no containers pass a null and cost nothing;
their bytes never leave the JVM.
"""

from __future__ import annotations

import io
import re
import sys
import tarfile
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Executors get the reader with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMBERS_TYPE = "array<struct<name:string,is_dir:boolean,usize:bigint,csize:bigint,data:binary,error:string>>"
_FIELDS = [
    ("name", pa.string()),
    ("is_dir", pa.bool_()),
    ("usize", pa.int64()),
    ("csize", pa.int64()),
    ("data", pa.binary()),
    ("error", pa.string()),
]


@dataclass(frozen=True)
class Selection:
    """Members to list, in order, and how many of them to inflate.

    The order is by name, or by the number in the pattern's first group when it has one.
    """

    pattern: str = ""
    inflate: int | None = None


@dataclass(frozen=True)
class MemberPlan:
    """What to take from one kind of container."""

    container: str
    selections: tuple[Selection, ...]


def listing_plan(container: str) -> MemberPlan:
    """All entries by name, nothing inflated."""
    return MemberPlan(container, (Selection("", 0),))


def _zip_entries(data):
    """Name to (is_dir, usize, csize, open); a later entry of the same name replaces the earlier.

    open() gives a file object that inflates as it is read; it never gives more than the declared size.
    """
    archive = zipfile.ZipFile(data)
    entries = {}
    for info in archive.infolist():
        if info.flag_bits & 0x1:
            raise zipfile.BadZipFile("Encrypted zip are not supported")
        name = info.filename
        if not info.flag_bits & 0x800:
            # Names without the UTF-8 flag are UTF-8 in practice.
            name = info.orig_filename.encode("cp437", "replace").decode("utf-8", "replace")
        entries[name] = (name.endswith("/"), info.file_size, info.compress_size, lambda i=info: archive.open(i))
    return entries


def _tar_entries(data):
    """As for zip; of an archive that is cut off or damaged, the entries before the damage."""
    archive = tarfile.open(fileobj=data, mode="r:", errors="replace")
    entries = {}
    try:
        for info in archive:
            name = info.name + "/" if info.isdir() else info.name
            opener = (lambda i=info: archive.extractfile(i)) if info.isfile() else (lambda: io.BytesIO(b""))
            entries[name] = (info.isdir(), info.size, info.size, opener)
    except (tarfile.TarError, OSError):
        if not entries:
            raise
    return entries


def _selected(entries, selection: Selection):
    rx = re.compile(selection.pattern)
    found = []
    for name in entries:
        match = rx.search(name)
        if match:
            number = int(match.group(1)) if rx.groups and match.group(1) else 0
            found.append((number, name))
    return [name for _, name in sorted(found)]


def _text(value: str) -> str:
    """A string that UTF-8 can hold; archive names and messages may carry anything."""
    return value.encode("utf-8", "replace").decode()


def _failure(exc: Exception) -> tuple:
    return (None, None, None, None, None, _text(str(exc) or type(exc).__name__))


def _wanted(data, plan: MemberPlan) -> Iterator[tuple]:
    """(name, is_dir, usize, csize, open or None) per listed member, open where it is to be inflated."""
    source = pa.BufferReader(data)
    entries = _zip_entries(source) if plan.container == "zip" else _tar_entries(source)
    for selection in plan.selections:
        for position, name in enumerate(_selected(entries, selection)):
            is_dir, usize, csize, opener = entries[name]
            wanted = not is_dir and (selection.inflate is None or position < selection.inflate)
            if max(usize, csize) >= 1 << 63:
                raise ValueError(f"the size of {name} is beyond 64 bits")
            yield _text(name), is_dir, usize, csize, opener if wanted else None


def _pieces(opener, most: int) -> Iterator[bytes]:
    """The member's bytes in pieces of at most most bytes, read a megabyte at a time."""
    with opener() as stream:
        piece = bytearray()
        while chunk := stream.read(min(_CHUNK, most - len(piece))):
            piece += chunk
            if len(piece) == most:
                yield bytes(piece)
                piece = bytearray()
        if piece:
            yield bytes(piece)


def _members(data, plan: MemberPlan) -> Iterator[tuple]:
    """Member tuples of one container whose wanted members fit one row together; raises where it cannot be read.

    Declared sizes are checked against what is left of the row before a member is inflated, and reading stops as
    soon as the bytes pass it, so a small container that would inflate beyond a row costs no memory to refuse.
    """
    left = _ROW_BYTES
    for name, is_dir, usize, csize, opener in _wanted(data, plan):
        body = None
        if opener is not None:
            if usize > left:
                raise ValueError("the wanted members inflate beyond what one row can hold")
            pieces = list(_pieces(opener, left + 1))
            body = b"".join(pieces)
            if len(body) > left:
                raise ValueError("the wanted members inflate beyond what one row can hold")
            left -= len(body)
        yield name, is_dir, usize, csize, body, None


def read_container(data, plan: MemberPlan) -> list[tuple]:
    """Member tuples of one container; one error tuple when it cannot be read."""
    try:
        found = list(_members(data, plan))
        if _bytes(found) > _ROW_BYTES:
            raise ValueError("the wanted members inflate beyond what one row can hold")
        return found
    except Exception as exc:  # a bad file is a row, never a failed task
        return [_failure(exc)]


# An Arrow or Spark row holds less than 2 GiB.
_ROW_BYTES = (1 << 31) - (1 << 20)
# Output is handed on when it reaches this size, however large the inputs of a batch inflate.  It is held several times
# over on its way out (as bytes, as arrays, as a stream), by every core's reader, and a core's share of a small corpus
# fills it already, so a reader's memory does not grow with the corpus.
_BATCH_BYTES = 2 << 20
# Members are inflated this much at a time; a row of the member table holds at most _PIECE_BYTES of one member.
_CHUNK = 1 << 20
_PIECE_BYTES = 64 << 20


def _bytes(members: list[tuple]) -> int:
    return sum(len(m[4] or b"") + len(m[0] or "") + 32 for m in members)


def _columns(members: list[tuple]) -> list[pa.Array]:
    columns = list(zip(*members)) or [()] * len(_FIELDS)
    return [pa.array(column, kind) for column, (_, kind) in zip(columns, _FIELDS)]


def read_members(kind: Column, content: Column, plans: dict[str, MemberPlan]) -> Column:
    """ARRAY<member> of a container column; null where ``content`` is null."""

    def rows(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[list[tuple] | None]:
        for kinds, contents in batches:
            for k, c in zip(kinds, contents):
                yield read_container(c.as_buffer(), plans[k.as_py()]) if c.is_valid else None

    def lists(held: list[list[tuple] | None]) -> pa.Array:
        offsets, flat = [0], []
        for members in held:
            flat.extend(members or ())
            offsets.append(len(flat))
        items = pa.StructArray.from_arrays(_columns(flat), names=[name for name, _ in _FIELDS])
        mask = pa.array([m is None for m in held], pa.bool_())
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items, mask=mask)

    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        held, size = [], 0
        for members in rows(batches):
            more = _bytes(members or [])
            if held and size + more > _BATCH_BYTES:
                yield lists(held)
                held, size = [], 0
            held.append(members)
            size += more
        if held:
            yield lists(held)

    read.__annotations__ = {
        "batches": Iterator[tuple[pa.Array, pa.Array]],
        "return": Iterator[pa.Array],
    }
    # Not deterministic to the optimizer: it must never evaluate the reader twice.
    reader = F.arrow_udf(read, returnType=MEMBERS_TYPE).asNondeterministic()
    return reader(kind, content)


def explode_members(files: DataFrame, container: str, name_rx: str = "", with_data: bool = True) -> DataFrame:
    """One row per member and piece; a container that cannot be read gives one row with its error.

    A member is inflated a megabyte at a time and handed on in pieces of at most 64 MB, numbered from 0 in `piece`
    (concatenated in that order they are the member), so a member or a container may inflate to any size while a
    task holds one batch. Members without data (folders, not wanted) have one row with piece 0 and null data; an empty
    member has one row with empty data. A container damaged midway gives the rows before the damage and an error row.
    """
    plan = MemberPlan(container, (Selection(name_rx, None if with_data else 0),))
    names = ["path", *(name for name, _ in _FIELDS), "piece"]

    def members(content) -> Iterator[tuple]:
        try:
            for name, is_dir, usize, csize, opener in _wanted(content.as_buffer(), plan):
                if opener is None:
                    yield name, is_dir, usize, csize, None, None, 0
                    continue
                count = 0
                for count, piece in enumerate(_pieces(opener, _PIECE_BYTES), 1):
                    yield name, is_dir, usize, csize, piece, None, count - 1
                if count == 0:
                    yield name, is_dir, usize, csize, b"", None, 0
        except Exception as exc:  # a bad file is a row, never a failed task
            yield (*_failure(exc), None)

    def batch_of(path, held):
        columns = _columns([m[:6] for m in held])
        return pa.RecordBatch.from_arrays([pa.array([path] * len(held)), *columns, pa.array([m[6] for m in held], pa.int32())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                held, size = [], 0
                for m in members(content) if content.is_valid else ():
                    more = _bytes([m])
                    if held and size + more > _BATCH_BYTES:
                        yield batch_of(path.as_py(), held)
                        held, size = [], 0
                    held.append(m)
                    size += more
                if held:
                    yield batch_of(path.as_py(), held)

    schema = "path string, name string, is_dir boolean, usize bigint, csize bigint, data binary, error string, piece int"
    return files.select("path", "content").mapInArrow(run, schema)
