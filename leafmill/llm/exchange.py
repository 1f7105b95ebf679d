"""Finding equal keys among many, with arrays instead of rows.

A task turns a batch of documents into entries (key, document, value) and sends them in one row per bucket of keys.
Keys that occur again within the batch are settled at once and sent only once more, so that however common a key
is, a bucket receives it at most once per batch. Whoever receives a bucket sorts its entries with numpy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: kind 0: entries of a bucket; kind 1: entries already settled, for the batch that sent them; kind 2: facts on documents.
ROW = (
    "kind int, bucket int, base long, doc array<short>, key array<long>, seal array<int>, value array<int>, "
    "doc_id array<long>, hash0 array<long>, hash1 array<long>, size array<int>"
)
BATCH_BYTES, BATCH_DOCS = 4 << 20, 32_000
_TYPES = {
    "kind": pa.int32(),
    "bucket": pa.int32(),
    "base": pa.int64(),
    "doc": pa.list_(pa.int16()),
    "key": pa.list_(pa.int64()),
    "seal": pa.list_(pa.int32()),
    "value": pa.list_(pa.int32()),
    "doc_id": pa.list_(pa.int64()),
    "hash0": pa.list_(pa.int64()),
    "hash1": pa.list_(pa.int64()),
    "size": pa.list_(pa.int32()),
}
ANYONE = -1


def rows(kind: int, bucket: np.ndarray, base: int | np.ndarray, cuts: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """One row per bucket; row i holds the entries cuts[i] to cuts[i + 1] of each column, other columns are null."""
    n = len(bucket)
    out = []
    for name, kind_of in _TYPES.items():
        if name == "kind":
            out.append(pa.array(np.full(n, kind, np.int32)))
        elif name == "bucket":
            out.append(pa.array(bucket.astype(np.int32)))
        elif name == "base":
            out.append(pa.array(np.broadcast_to(np.asarray(base, np.int64), n).copy()))
        elif name in columns:
            flat = pa.array(np.ascontiguousarray(columns[name]).astype(kind_of.value_type.to_pandas_dtype(), copy=False))
            out.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), flat))
        else:
            out.append(pa.nulls(n, kind_of))
    return pa.RecordBatch.from_arrays(out, list(_TYPES))


def facts(base: int, buckets: int, **columns: np.ndarray) -> pa.RecordBatch:
    """One row with facts on the documents of a batch."""
    n = len(next(iter(columns.values())))
    return rows(2, np.array([base % buckets]), base, np.array([0, n]), **columns)


def groups(key: np.ndarray, seal: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts equal keys together, and for each ordered entry whether it differs from the one before."""
    order = np.argsort(key, kind="stable") if seal is None else np.lexsort((seal, key))
    sorted_key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    if seal is not None:
        sorted_seal = seal[order]
        new[1:] |= sorted_seal[1:] != sorted_seal[:-1]
    return order, new


def repeated(new: np.ndarray) -> np.ndarray:
    """For each ordered entry, whether its group has another."""
    more = np.zeros(len(new), bool)
    more[:-1] = ~new[1:]
    return more | ~new


def send(base: int, buckets: int, doc: np.ndarray, key: np.ndarray, seal: np.ndarray | None, value: np.ndarray | None) -> list[pa.RecordBatch]:
    """Rows for the buckets of the entries of a batch, and rows of the entries that occur again within it.

    A key that the batch has more than once goes out once, from ANYONE.
    """
    if not len(key):
        return []
    out = []
    order, new = groups(key, seal)
    again = repeated(new)
    doc, key = doc[order].astype(np.int16), key[order].view(np.int64)
    extra = {}
    if seal is not None:
        extra["seal"] = seal[order].view(np.int32)
    if value is not None:
        extra["value"] = value[order]
    if again.any():
        settled = {"doc": doc[again], "key": key[again]} | {n: x[again] for n, x in extra.items()}
        out.append(rows(1, np.array([base % buckets]), base, np.array([0, int(again.sum())]), **settled))
    doc = np.where(again, ANYONE, doc)
    bucket = (key.view(np.uint64) % np.uint64(buckets)).astype(np.int32)[new]
    doc, key, extra = doc[new], key[new], {n: x[new] for n, x in extra.items()}
    by = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[by], return_index=True)
    cuts = np.append(first, len(by))
    out.append(rows(0, names, base, cuts, doc=doc[by], key=key[by], **{n: x[by] for n, x in extra.items()}))
    return out


def flat(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten())


def column(table: pa.Table, name: str) -> pa.Array:
    x = table.column(name).combine_chunks()
    return x.chunk(0) if isinstance(x, pa.ChunkedArray) else x


def receive(table: pa.Table) -> list[pa.RecordBatch]:
    """Rows for the sending batches with their entries whose key another entry has too."""
    if not table.num_rows:
        return []
    lists = column(table, "doc")
    sizes = np.diff(np.asarray(lists.offsets))
    base = np.repeat(np.asarray(table.column("base")), sizes)
    doc, key = flat(lists), flat(column(table, "key"))
    extra = {n: flat(column(table, n)) for n in ("seal", "value") if table.column(n).null_count < table.num_rows}
    order, new = groups(key, extra.get("seal"))
    hit = order[repeated(new) & (doc[order] != ANYONE)]
    if not len(hit):
        return []
    hit = hit[np.argsort(base[hit], kind="stable")]
    names, first = np.unique(base[hit], return_index=True)
    cuts = np.append(first, len(hit))
    return [
        rows(1, np.zeros(len(names), np.int32), names, cuts, doc=doc[hit], key=key[hit], **{n: x[hit] for n, x in extra.items()})
    ]


def answer(batches):
    """Reducer of the exchange: settled entries and facts pass, entries of buckets become answers."""
    held = []
    for batch in batches:
        kind = np.asarray(batch.column("kind"))
        if (kind == 0).any():
            held.append(batch.filter(pa.array(kind == 0)))
        if (kind != 0).any():
            yield batch.filter(pa.array(kind != 0))
    if held:
        yield from receive(pa.Table.from_batches(held))


def batch_ids():
    """Ids for the batches of this task, the same in every attempt."""
    from pyspark import TaskContext

    at = TaskContext.get().partitionId() << 24
    while True:
        yield at
        at += 1


def documents(batches, size: int = BATCH_BYTES, most: int = BATCH_DOCS):
    """Batches of about that many bytes and at most that many documents."""
    from leafmill.llm import words

    for batch in words.gathered(batches, size):
        for at in range(0, batch.num_rows, most):
            yield batch.slice(at, most)


def bucket_count(docs, per_byte: float, per_bucket: int = 1 << 19) -> int:
    """Buckets for about per_bucket entries each, given entries per byte of text; grows with the input."""
    from pyspark.sql import functions as F

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, int(size * per_byte / per_bucket) + 1)
