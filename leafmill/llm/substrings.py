"""Substring deduplication by seed and extend.

Every run of 35 words has a smallest hash among its 16-word grams: its anchor (winnowing), so equal runs have equal
anchors. Documents are first joined on anchors alone, a tenth of the grams. Only around anchors that occur again are matches extended both
ways: all runs over such an anchor are compared by 96 bits of hash, which settles how far to the left and right the
occurrences agree, and overlapping repeated runs merge to maximal repeats. Exact copies are found by the hash of
their whole word sequence; one of them takes part in the extension.

Occurrences are compared through common keys, never pair by pair, and a key that is common within a batch of
documents is sent once per batch (see exchange.py), so neither a passage nor a copy that a third of all documents
share is a hot task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm import exchange, words
from leafmill.llm.scratch import keep

GRAM = 16
_NO_ID = -(1 << 63)
_MAX = np.uint64((1 << 64) - 1)


def _sliding(x: np.ndarray, n: int, least: bool) -> np.ndarray:
    """Minimum of x[i : i + n] (least) or maximum of x[i - n + 1 : i + 1], over what exists of that range."""
    op = np.minimum if least else np.maximum
    out, width = x.copy(), 1
    while width < n:
        step = min(width, n - width)
        if step >= len(x):
            step = max(len(x) - 1, 0)
        if not step:
            break
        before = out.copy()
        if least:
            op(out[:-step], before[step:], out=out[:-step])
        else:
            op(out[step:], before[:-step], out=out[step:])
        width += step
    return out


class Anchors:
    """Grams of a batch of texts, the anchor of every run of `length` words, and which grams are anchors."""

    def __init__(self, w: words.Words, length: int):
        self.hashes = w.hashes(0)
        self.grams = w.windows(GRAM)
        self.value = words.span_hashes(self.hashes, self.grams, self.grams + GRAM, 0) | np.uint64(1)
        last = np.repeat(w.first[1:], w.counts)[self.grams]
        #: Gram positions that start a run of `length` words.
        self.runs = self.grams + length <= last
        least = _sliding(self.value, length - GRAM + 1, True)
        self.anchor = np.where(self.runs, least, np.uint64(0))
        self.chosen = _sliding(self.anchor, length - GRAM + 1, False) == self.value


def _doc_key() -> Column:
    """doc_id as the key of a row; a null doc_id becomes a key below -2**62 drawn from a hash of the text, so rows with
    null ids are as many keys as they have distinct texts (ids below -2**62 are taken for that)."""
    marker = F.lit(_NO_ID) + F.pmod(F.xxhash64(F.col("text")), F.lit(1 << 62))
    return F.coalesce(F.col("doc_id").cast("long"), marker).alias("doc_id")


def seeds(docs: DataFrame, length: int = 35) -> DataFrame:
    """Per document doc_id, hash0, hash1 (of its word sequence), size (words) and those of its anchors that occur again."""
    buckets = exchange.bucket_count(docs, 0.02)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for base, batch in zip(exchange.batch_ids(), exchange.documents(batches), strict=False):
            w = words.split(batch.column("text"))
            found, row = Anchors(w, length), w.rows()
            whole = [words.span_hashes(w.hashes(s), w.first[:-1], w.first[1:], s).view(np.int64) for s in (0, 1)]
            yield exchange.facts(
                base, buckets, doc_id=np.asarray(batch.column("doc_id")), hash0=whole[0], hash1=whole[1], size=w.counts
            )
            yield from exchange.send(base, buckets, row[found.grams[found.chosen]], found.value[found.chosen], None, None)

    def gather(table: pa.Table) -> pa.Table:
        fact, docs_of, keys = _per_document(table, "key")
        n = len(fact["doc_id"])
        return pa.table(
            {
                **{c: pa.array(fact[c]) for c in ("doc_id", "hash0", "hash1", "size")},
                "anchors": _lists(docs_of, n, keys),
            }
        )

    sent = docs.select(_doc_key(), "text").mapInArrow(run, exchange.ROW)
    answers = sent.repartition(buckets, "bucket").mapInArrow(exchange.answer, exchange.ROW)
    return answers.groupBy("base").applyInArrow(gather, "doc_id long, hash0 long, hash1 long, size int, anchors array<long>")


def _lists(docs_of: np.ndarray, n: int, values: np.ndarray) -> pa.Array:
    order = np.argsort(docs_of, kind="stable")
    cuts = np.searchsorted(docs_of[order], np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values[order]))


def _per_document(table: pa.Table, name: str) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Facts of a batch, and the entries that came back to it: their documents and the named column."""
    kind = np.asarray(table.column("kind"))
    fact = table.filter(pa.array(kind == 2))
    back = table.filter(pa.array(kind == 1))
    facts = {c: exchange.flat(exchange.column(fact, c)) for c in ("doc_id", "hash0", "hash1", "size") if fact.column(c).null_count == 0}
    if not back.num_rows:
        return facts, np.zeros(0, np.int16), np.zeros(0, np.int64)
    return facts, exchange.flat(exchange.column(back, "doc")), exchange.flat(exchange.column(back, name))


def extend(docs: DataFrame, flagged: DataFrame, length: int = 35) -> DataFrame:
    """Maximal repeats of the flagged documents: doc_id, hash0, starts and ends (word positions, sorted, disjoint)."""
    buckets = exchange.bucket_count(docs, 0.03)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for base, batch in zip(exchange.batch_ids(), exchange.documents(batches), strict=False):
            w = words.split(batch.column("text"))
            found, row = Anchors(w, length), w.rows()
            whole = words.span_hashes(found.hashes, w.first[:-1], w.first[1:], 0).view(np.int64)
            same = whole == np.asarray(batch.column("hash0"))
            anchors = batch.column("anchors")
            owner = np.repeat(np.arange(len(anchors)), np.diff(np.asarray(anchors.offsets)))
            salt = words.mix(np.arange(1, len(anchors) + 1).astype(np.uint64))
            shared = exchange.flat(anchors).view(np.uint64) ^ salt[owner]
            of = row[found.grams]
            hit = found.runs & same[of] & np.isin(found.anchor ^ salt[of], shared)
            at = found.grams[hit]
            key = words.span_hashes(found.hashes, at, at + length, 0)
            seal = (words.span_hashes(w.hashes(1), at, at + length, 1) >> np.uint64(32)).astype(np.uint32)
            yield exchange.facts(base, buckets, doc_id=np.asarray(batch.column("doc_id")), hash0=whole)
            yield from exchange.send(base, buckets, row[at], key, seal, at - w.first[row[at]])

    def gather(table: pa.Table) -> pa.Table:
        fact, docs_of, starts = _per_document(table, "value")
        order = np.lexsort((starts, docs_of))
        docs_of, starts = docs_of[order].astype(np.int64), starts[order].astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (docs_of[1:] != docs_of[:-1]) | (starts[1:] > starts[:-1] + length)
        first = np.flatnonzero(new)
        ends = starts[np.append(first[1:], len(starts)) - 1] + length if len(first) else starts
        n = len(fact["doc_id"])
        out = {"doc_id": pa.array(fact["doc_id"]), "hash0": pa.array(fact["hash0"])}
        out |= {c: _lists(docs_of[first], n, x) for c, x in (("starts", starts[first]), ("ends", ends))}
        table = pa.table(out)
        return table.filter(pa.array(np.diff(np.asarray(exchange.column(table, "starts").offsets)) > 0))

    texts = docs.select(_doc_key(), "text").join(flagged.select("doc_id", "hash0", "anchors"), "doc_id")
    sent = texts.mapInArrow(run, exchange.ROW)
    answers = sent.repartition(buckets, "bucket").mapInArrow(exchange.answer, exchange.ROW)
    return answers.groupBy("base").applyInArrow(gather, "doc_id long, hash0 long, starts array<long>, ends array<long>")


def repeats(docs: DataFrame, length: int = 35) -> DataFrame:
    """doc_id (a marker for null), hash0, starts, ends of all repeats of at least length words, copies included."""
    found = keep(seeds(docs, length), "substring-seeds")
    same = ["hash0", "hash1", "size"]
    copies = found.where(F.col("size") >= length).groupBy(*same).agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1")
    marked = keep(found.join(copies, same, "left"), "substring-copies")
    flagged = marked.where((F.size("anchors") > 0) & (F.col("n").isNull() | (F.col("doc_id") == F.col("first"))))
    extended = extend(docs, flagged.dropDuplicates(["doc_id", "hash0"]), length)
    whole = marked.where("n is not null").select(
        "doc_id", "hash0", F.array(F.lit(0).cast("long")).alias("starts"), F.array(F.col("size").cast("long")).alias("ends")
    )
    return extended.unionByName(whole)


def remove(docs: DataFrame, length: int = 35) -> DataFrame:
    """Every row of docs (doc_id, text) without the words of repeats: doc_id, n_words, n_removed, kept (text), kept_sha256.

    A word goes if some run of `length` consecutive words over it occurs elsewhere, in another document or at another
    place of the same one; runs are judged on the input. Kept words are joined by one space. A null text has no words; texts shorter than
    length keep all words. Repeated rows are copies of each other. An empty table gives no rows; other columns are
    ignored.
    """
    cuts = keep(repeats(docs, length), "substring-repeats")
    cuts = cuts.groupBy("doc_id").agg(F.collect_list(F.struct("hash0", "starts", "ends")).alias("cuts"))
    rows = docs.select(_doc_key(), F.col("doc_id").cast("long").alias("id"), "text").join(cuts, "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in exchange.documents(batches):
            w = words.split(batch.column("text"))
            whole = words.span_hashes(w.hashes(0), w.first[:-1], w.first[1:], 0).view(np.int64).tolist()
            removed, kept = [], []
            for text, own, parts in zip(batch.column("text").to_pylist(), whole, batch.column("cuts").to_pylist(), strict=True):
                tokens = (text or "").encode().split()
                gone = np.zeros(len(tokens) + 1, np.int64)
                for part in parts or ():
                    if part["hash0"] == own:
                        np.add.at(gone, part["starts"], 1)
                        np.add.at(gone, part["ends"], -1)
                if gone.any():
                    stay = np.cumsum(gone[:-1]) == 0
                    removed.append(int((~stay).sum()))
                    tokens = [t for t, s in zip(tokens, stay.tolist(), strict=True) if s]
                else:
                    removed.append(0)
                kept.append(b" ".join(tokens))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(w.counts),
                    pa.array(removed, pa.int64()),
                    pa.array([x.decode() for x in kept], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    return rows.select("id", "text", "cuts").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
