"""Token ids of whole texts in checksummed record files, with an offset index beside them.

Documents are range-partitioned and sorted by doc_id, tokenized inside their tasks, framed (see frames.py) and written
by Spark's text sink, one file per range. The index is a Parquet table made from the written bytes, checksums checked,
so that shuffled readers can fetch any record by file and offset.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import frames, words

_PLAIN = re.compile(r"[a-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
_TAIL = np.zeros(256, bool)
_TAIL[list(b".,!?;:%&*$#|")] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = True
_CACHE_WORDS = 1_000_000
_BATCH_BYTES = 4 << 20
_READ_BYTES = 4 << 20
_encoders: dict[str, Encoder] = {}

INDEX = (
    "file int, file_path string, ordinal long, offset long, bytes long, doc_id long, "
    "before long, n_tokens long, ids_crc32 long"
)


def _without_tails(w: words.Words) -> words.Words:
    """The same words with ASCII punctuation after a letter or digit as words of their own, as the tokenizer cuts them."""
    solid = np.maximum.accumulate(np.where(_TAIL[w.data], -1, np.arange(len(w.data))))
    cut = solid[w.ends - 1] + 1
    last = w.data[cut - 1]
    accent = (cut - w.starts > 1) & (w.data[np.maximum(cut - 2, 0)] == 0xC3) & (last != 0x97) & (last != 0xB7)
    tail = (cut > w.starts) & (cut < w.ends) & (_LETTER[last] | accent)
    more = np.concatenate([[0], np.cumsum(tail)])
    place = np.arange(len(cut)) + more[:-1]
    starts, ends = np.empty(len(cut) + more[-1], np.int64), np.empty(len(cut) + more[-1], np.int64)
    starts[place], ends[place] = w.starts, np.where(tail, cut, w.ends)
    starts[place[tail] + 1], ends[place[tail] + 1] = cut[tail], w.ends[tail]
    return words.Words(w.data, w.offsets, starts, ends, w.first + more[w.first])


class Encoder:
    """Ids of texts by a tokenizers file whose pieces never span white space and whose words end in a mark.

    Texts are cut at white space and before closing punctuation, and every distinct word is encoded once. Plain words
    (letters that lower-casing and normalization treat one by one) skip the normalizer: they go straight to the merges,
    many at a time, and the end marks tell them apart. All other words take the whole pipeline. Ids of words met before
    are remembered under 128 bits of hash; the memory is a speed-up of fixed size that never changes an id.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.full.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocab = self.full.get_vocab()
        size = max(max(vocab.values()), end_id) + 1
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.end_id = end_id
        self.ends = np.zeros(size, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.keys = self.checks = np.zeros(0, np.uint64)
        self.at = self.sizes = np.zeros(0, np.int64)
        self.pool = np.zeros(0, self.kind)

    def encode_words(self, texts: list[str]) -> list[list[int]]:
        plain = [bool(_PLAIN.fullmatch(x)) for x in texts]
        letters = [x.lower() for x, p in zip(texts, plain, strict=True) if p]
        joined = [" ".join(letters[k : k + 500]) for k in range(0, len(letters), 500)]
        ids = [i for e in self.plain.encode_batch_fast(joined, add_special_tokens=False) for i in e.ids]
        stops = (np.flatnonzero(self.ends[ids]) + 1).tolist() if ids else []
        cut = iter([ids[a:b] for a, b in zip([0, *stops], stops, strict=False)])
        rest = [x for x, p in zip(texts, plain, strict=True) if not p]
        other = iter(self.full.encode_batch_fast(rest, add_special_tokens=False))
        return [next(cut) if p else next(other).ids for p in plain]

    def remember(self, keys: np.ndarray, checks: np.ndarray, ids: list[list[int]]) -> None:
        sizes = np.array([len(x) for x in ids], np.int64)
        at = len(self.pool) + np.cumsum(sizes) - sizes
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(ids), self.kind, int(sizes.sum()))])
        spot = np.searchsorted(self.keys, keys)
        self.keys, self.checks = np.insert(self.keys, spot, keys), np.insert(self.checks, spot, checks)
        self.at, self.sizes = np.insert(self.at, spot, at), np.insert(self.sizes, spot, sizes)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key in the memory, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        spot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[spot] == keys, spot, -1)

    def slowly(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.full.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        return np.array([i for x in got for i in x], self.kind), np.array([len(x) for x in got], np.int64)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, each text ended by the end id, and the ids per text."""
        ids, counts = self.words(texts)
        row = np.repeat(np.arange(len(counts)), counts)
        out = np.full(len(ids) + len(counts), self.end_id, self.kind)
        out[np.arange(len(ids)) + row] = ids
        return out, counts + 1

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        w = _without_tails(words.split(texts, lower=True))
        raw = w.data.tobytes()
        if b"<|" in raw:  # special tokens are told by case
            return self.slowly(texts)
        key, check = w.hashes(0), w.hashes(1)
        distinct, first, which = np.unique(key, return_index=True, return_inverse=True)
        seal = check[first]
        if not np.array_equal(check, seal[which]):  # two words share a 64-bit hash
            return self.slowly(texts)
        if len(self.keys) > _CACHE_WORDS:
            self.forget()
        spot = self.find(distinct)
        if not np.array_equal(self.checks[spot[spot >= 0]], seal[spot >= 0]):
            self.forget()
            spot = self.find(distinct)
        new = np.flatnonzero(spot < 0)
        spans = zip(w.starts[first[new]].tolist(), w.ends[first[new]].tolist(), strict=True)
        self.remember(distinct[new], seal[new], self.encode_words([raw[a:b].decode() for a, b in spans]))
        spot = self.find(distinct)[which]
        sizes = self.sizes[spot]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(self.at[spot] - total[:-1], sizes) + np.arange(total[-1])]
        return ids, np.diff(total[w.first])


def encoder(path: str, end_id: int) -> Encoder:
    key = f"{path}#{end_id}"
    if key not in _encoders:
        _encoders[key] = Encoder(path, end_id)
    return _encoders[key]


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, file_bytes: int = 32 << 20) -> None:
    """Write doc_id and the ids of text (null: empty), each ended by end_id, in ascending doc_id order.

    Null ids come first; rows with equal ids lie next to each other, ordered by a hash of their text. Every row is
    written, so repeated rows are repeated records. An empty table gives a folder without records. Other columns are
    ignored. tokenizer is the path of a tokenizers file that every executor can open. file_bytes of text go to a file.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // file_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, end_id)
        for batch in words.gathered(batches, _BATCH_BYTES):
            doc = batch.column("doc_id")
            out = frames.encode(np.asarray(doc.fill_null(0)), np.asarray(doc.is_null()), *encode(batch.column("text")))
            yield pa.RecordBatch.from_arrays([out], ["frame"])

    order = [F.col("doc_id"), F.xxhash64("text")]
    framed = docs.repartitionByRange(files, *order).sortWithinPartitions(*order).mapInArrow(run, "frame binary")
    framed.select(F.col("frame").cast("string")).write.option("lineSep", "\n").text(path)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Index rows of the record files under path, read back and checked; before counts the ids earlier in the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                yield from _index(name, content.as_buffer())

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, INDEX)


def _index(name: str, content: pa.Buffer) -> Iterator[pa.RecordBatch]:
    number = int(re.search(r"part-(\d+)", name)[1])
    data = np.frombuffer(content, np.uint8)
    spans = frames.spans(memoryview(content))
    before, lo = 0, 0
    while lo < len(spans) - 1:
        hi = max(lo + 1, int(np.searchsorted(spans, spans[lo] + _READ_BYTES, "right")) - 1)
        starts, ends = spans[lo:hi], spans[lo + 1 : hi + 1]
        base = starts[0]
        frames.check(data[base : ends[-1]], starts - base, ends - base)
        body = starts + frames.HEAD
        doc = data[body[:, None] + np.arange(8)].view("<i8").ravel()
        sums, counts = [], []
        for a, b in zip(body.tolist(), (ends - frames.TAIL).tolist(), strict=True):
            width = int(data[a + 9])
            ids = np.frombuffer(content, f"<u{width}", (b - a - frames.BODY) // width, a + frames.BODY)
            sums.append(zlib.crc32(ids.astype("<u4")))
            counts.append(len(ids))
        counts = np.array(counts, np.int64)
        columns = [
            pa.array(np.full(hi - lo, number, np.int32)),
            pa.array([name] * (hi - lo)),
            pa.array(np.arange(lo, hi)),
            pa.array(starts),
            pa.array(ends - starts),
            pa.array(doc, mask=data[body + 8] == 1),
            pa.array(before + np.cumsum(counts) - counts),
            pa.array(counts),
            pa.array(np.array(sums, np.int64)),
        ]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in INDEX.split(", ")])
        before += int(counts.sum())
        lo = hi


def write_index(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """Write the offset index of the record files and return it."""
    scan(spark, path).write.parquet(index_path)
    return spark.read.schema(INDEX).parquet(index_path)


def positions(index: DataFrame) -> DataFrame:
    """Per record doc_id, start (ids of all records before it, over all files in order), n_tokens and ids_crc32."""
    from pyspark.sql import Window

    # One row per file.
    order = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
    files = files.select("file", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("earlier"))
    return index.join(files, "file").select(
        "doc_id", (F.col("earlier") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_records(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """doc_id and ids of the wanted index rows (file_path, offset, bytes), cut from their files by offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, out = [], []
            for content, spots in zip(batch.column("content"), batch.column("spots").to_pylist(), strict=True):
                data = np.frombuffer(content.as_buffer(), np.uint8)
                for spot in spots:
                    frame = data[spot["offset"] : spot["offset"] + spot["bytes"]]
                    frames.check(frame, np.array([0]), np.array([len(frame)]))
                    body = frame[frames.HEAD : -frames.TAIL]
                    docs.append(None if body[8] else int(body[:8].view("<i8")[0]))
                    out.append(body[frames.BODY :].copy().view(f"<u{body[9]}").astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["doc_id", "ids"])

    spots = wanted.groupBy(F.col("file_path").alias("path")).agg(F.collect_list(F.struct("offset", "bytes")).alias("spots"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.join(spots, "path").mapInArrow(run, "doc_id long, ids array<long>")
