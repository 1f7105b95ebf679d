"""Jaccard self-join of documents on word shingles, by universe partitions and the pigeonhole principle.

Sets whose sizes lie in one band (or the next) can differ in at most H shingles if they are similar enough. Shingles are
hashed to m > H segments, so at least m - H segments of such a pair hold exactly the same subset: every segment's
subset becomes a key. m is chosen above H + 1, which leaves slack: that many segments may be skipped. Empty segments
are skipped first, then segments that too many sets share, the costly ones. A set with more empty segments than
slack is given more keys instead: its segments with one shingle deleted, which find partners whose segment differs by one,
and if that cannot suffice either, its single shingles. Candidates are verified exactly on the texts.

Keys travel in arrays (see exchange.py). A key that many sets share is not turned into pairs: its sets are compared with
one leader, and only those that neither end up in the leader's component nor can afford to skip the key are compared with the others.
Equal sets are joined by their hash beforehand and take part once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm import exchange, words
from leafmill.llm.components import components
from leafmill.llm.scratch import keep

WIDTH = 5
COMMON = 16
_NO_ID = -(1 << 63)
_HOT = 1 << 16
# Keys of a set that tie-pairs carry to leave once: the least ones.
FIRST_KEYS = 8
_U = np.uint64
_BYTES = 4 << 20
_SKETCH = 16


@cache
def bands(similar: float, most: int = 1 << 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest size, segments and slack of each band; a similar set of larger size is in the same or the next band."""
    tops = [1]
    while tops[-1] < most:
        tops.append(max(tops[-1] + 1, int(tops[-1] / similar + 1e-9)))
    top = np.array(tops, np.int64)
    differ = ((top + (top / similar + 1e-9).astype(np.int64)) * ((1 - similar) / (1 + similar)) + 1e-9).astype(np.int64)
    slack = np.where(top <= 64, top, np.ceil(0.15 * top)).astype(np.int64)
    return top, differ + 1 + slack, slack


class Sets:
    """Distinct shingles of a batch of texts: token values with their text, sorted by text; sizes and set hashes."""

    def __init__(self, texts: pa.Array, width: int):
        w = words.split(texts, lower=True)
        hashes, n = w.hashes(0), len(texts)
        at = w.windows(width)
        short = np.flatnonzero((w.counts > 0) & (w.counts < width))
        value = np.concatenate(
            [words.span_hashes(hashes, at, at + width, 0), words.span_hashes(hashes, w.first[short], w.first[short + 1], 0)]
        )
        row = np.concatenate([w.rows()[at], short])
        _, first = np.unique(words.mix(value ^ words.mix((row + 1).astype(_U))), return_index=True)
        first.sort()
        first = first[np.argsort(row[first], kind="stable")]
        self.token, self.row = value[first], row[first]
        self.size = np.bincount(self.row, minlength=n)
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        self.hash0 = self.total(words.mix(self.token))
        self.hash1 = self.total(words.mix(self.token * _U(0x9FB21C651E98DF25) + _U(1)))

    def total(self, values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])
        return sums[self.first[1:]] - sums[self.first[:-1]]


def keys_of(sets: Sets, docs: np.ndarray, lower: bool, similar: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the marked documents in their own band, or in the band below: document, key, value, and margins of all.

    value is the band plus one for segment keys and 0 for the extra keys of sparse sets. A margin is the number of
    segments that a set may still skip.
    """
    top, segments, slack = bands(similar)
    band = np.searchsorted(top, np.maximum(sets.size, 1)) - int(lower)
    use = docs & (band >= 0) & (sets.size > 0)
    m = np.where(use, segments[np.maximum(band, 0)], 0)
    base = np.concatenate([[0], np.cumsum(m)])
    taken = use[sets.row]
    token, row = sets.token[taken], sets.row[taken]
    scheme = words.mix(band.astype(np.int64).view(_U) + _U(77))
    cell = base[row] + (words.mix(token ^ scheme[row]) % m[row].astype(_U)).astype(np.int64)
    body = words.mix(token ^ _U(0x5851F42D4C957F2D))
    total, count = np.zeros(base[-1], _U), np.bincount(cell, minlength=base[-1])
    np.add.at(total, cell, body)
    owner = np.repeat(np.arange(len(m)), m)
    place = words.mix(scheme[owner] + (np.arange(base[-1]) - base[owner]).astype(_U))

    def key(kind: int, at: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return words.mix(words.mix(sums + counts.astype(_U)) ^ place[at] ^ _U(kind << 60))

    full = np.flatnonzero(count > 0)
    out = [(owner[full], key(0, full, total[full], count[full]), band[owner[full]] + 1)]
    empty = m - np.bincount(owner[full], minlength=len(m))
    margin = np.where(use, slack[np.maximum(band, 0)] - empty, 0)
    sparse = use & (margin < 0)
    if sparse.any():
        part = np.flatnonzero(sparse[row])
        at = cell[part]
        whole = full[sparse[owner[full]]]
        less = part[count[at] > 1]
        out.append((owner[whole], key(1, whole, total[whole], count[whole]), np.zeros(len(whole), np.int64)))
        at = cell[less]
        out.append((row[less], key(1, at, total[at] - body[less], count[at] - 1), np.zeros(len(less), np.int64)))
        # Segments of at most one shingle tell nothing here; too many of them, and the shingles themselves are keys.
        thin = m - np.bincount(owner[count > 1], minlength=len(m))
        bare = sparse & (thin > m - (m - 1 - slack[np.maximum(band, 0)]) // 2 - 1)
        part = np.flatnonzero(bare[row])
        out.append((row[part], words.mix(token[part] ^ scheme[row[part]] ^ _U(2 << 60)), np.zeros(len(part), np.int64)))
    return (*(np.concatenate(x) for x in zip(*out, strict=True)), margin)


def _pairs(left: np.ndarray, right: np.ndarray, value: np.ndarray) -> pa.RecordBatch | None:
    """One row with the distinct pairs of different sets, their band and the number of keys that gave them."""
    a, b = np.minimum(left, right), np.maximum(left, right)
    keep_ = left != right
    a, b, value = a[keep_], b[keep_], value[keep_] % _HOT
    if not len(a):
        return None
    order = np.lexsort((value, b, a))
    a, b, value = a[order], b[order], value[order]
    new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (value[1:] != value[:-1])))
    count = np.diff(np.append(new, len(a)))
    return exchange.rows(4, np.zeros(1), 0, np.array([0, len(new)]), hash0=a[new], hash1=b[new], value=value[new], size=count)


def _rank(ids: np.ndarray) -> np.ndarray:
    return words.mix(ids.view(_U))


def _common(key: np.ndarray, ids: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Members of common keys, and pairs of each with the first of its key; ordered by key and rank."""
    if len(key):
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        leader = ids[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
        yield exchange.rows(3, np.zeros(1), 0, np.array([0, len(key)]), key=key.view(np.int64), hash0=ids, value=value % _HOT)
        pairs = _pairs(leader, ids, value)
        if pairs is not None:
            yield pairs


def _send(base: int, buckets: int, doc: np.ndarray, key: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Entries for the buckets; of a key that is common within the batch only the leader goes out, marked."""
    if not len(key):
        return
    bucket = (key % _U(buckets)).astype(np.int64)
    seal = (key >> _U(32)).astype(np.uint32)
    short = (bucket.view(_U) << _U(32)) | seal.astype(_U)
    ids = base * (1 << 15) + doc
    order = np.lexsort((_rank(ids), short))
    new = np.ones(len(order), bool)
    new[1:] = short[order][1:] != short[order][:-1]
    size = np.diff(np.append(np.flatnonzero(new), len(order)))
    hot = np.repeat(size > COMMON, size)
    yield from _common(short[order][hot], ids[order][hot], value[order][hot])
    out = np.sort(order[~hot | new])
    mark = np.zeros(len(key), np.int64)
    mark[order[hot & new]] = _HOT
    out = out[np.argsort(bucket[out], kind="stable")]
    names, first = np.unique(bucket[out], return_index=True)
    yield exchange.rows(
        0, names, base, np.append(first, len(out)), doc=doc[out], seal=seal[out].view(np.int32), value=(value + mark)[out]
    )


def _receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (kind 4) and members of common keys (kind 3) from the entries of buckets; other rows pass."""
    held = []
    for batch in batches:
        kind = np.asarray(batch.column("kind"))
        if (kind == 0).any():
            held.append(batch.filter(pa.array(kind == 0)).select(["bucket", "base", "doc", "seal", "value"]))
        if (kind != 0).any():
            yield batch.filter(pa.array(kind != 0))
    if not held:
        return
    table = pa.Table.from_batches(held)
    lists = exchange.column(table, "doc")
    sizes = np.diff(np.asarray(lists.offsets))
    ids = np.repeat(np.asarray(table.column("base")) * (1 << 15), sizes) + exchange.flat(lists)
    key = (np.repeat(np.asarray(table.column("bucket")).astype(np.int64), sizes) << 32).view(_U)
    key = key | exchange.flat(exchange.column(table, "seal")).view(np.uint32).astype(_U)
    value = exchange.flat(exchange.column(table, "value"))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    same[1:] = key[order][1:] == key[order][:-1]
    shared = same.copy()
    shared[:-1] |= same[1:]
    order = order[shared | (value[order] >= _HOT)]
    key, ids, value = key[order], ids[order], value[order]
    if not len(key):
        return
    order = np.lexsort((_rank(ids), key))
    key, ids, value = key[order], ids[order], value[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(first, len(key)))
    hot = np.repeat((size > COMMON) | (np.maximum.reduceat(value, first) >= _HOT), size)
    yield from _common(key[hot], ids[hot], value[hot])
    key, ids, value = key[~hot], ids[~hot], value[~hot]
    left, right, of = [], [], []
    for step in range(1, COMMON):
        near = np.flatnonzero(key[step:] == key[:-step])
        left.append(ids[near])
        right.append(ids[near + step])
        of.append(value[near])
    pairs = _pairs(np.concatenate(left), np.concatenate(right), np.concatenate(of))
    if pairs is not None:
        yield pairs


def _doc_key() -> Column:
    """doc_id as the key of a row; a null doc_id becomes a key below -2**62 drawn from a hash of the text, so rows with
    null ids are as many keys as they have distinct texts (ids below -2**62 are taken for that)."""
    marker = F.lit(_NO_ID) + F.pmod(F.xxhash64(F.col("text")), F.lit(1 << 62))
    return F.coalesce(F.col("doc_id").cast("long"), marker).alias("doc_id")


def candidates(docs: DataFrame, width: int, similar: float) -> DataFrame:
    """Facts on every document (kind 2), members of common keys (kind 3) and candidate pairs (kind 4), as exchange rows."""
    buckets = exchange.bucket_count(docs, 0.13, 2 << 20)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for base, batch in zip(exchange.batch_ids(), exchange.documents(batches, _BYTES), strict=False):
            sets = Sets(batch.column("text"), width)
            # Of equal sets within the batch one takes part.
            once = np.zeros(batch.num_rows, bool)
            once[np.unique(sets.hash0, return_index=True)[1]] = True
            doc, key, value, own = keys_of(sets, once, False, similar)
            doc1, key1, value1, below = keys_of(sets, once, True, similar)
            yield exchange.facts(
                base,
                buckets,
                doc_id=np.asarray(batch.column("doc_id")),
                hash0=sets.hash0.view(np.int64),
                hash1=sets.hash1.view(np.int64),
                size=sets.size,
                seal=own,
                value=below,
            )
            doc, key, value = np.concatenate([doc, doc1]), np.concatenate([key, key1]), np.concatenate([value, value1])
            order = np.argsort(doc, kind="stable")
            yield from _send(base, buckets, doc[order], key[order], value[order])

    sent = docs.select(_doc_key(), "text").mapInArrow(run, exchange.ROW)
    return sent.repartition(buckets, "bucket").mapInArrow(_receive, exchange.ROW)


def verify(texts: DataFrame, pairs: DataFrame, width: int, similar: float, load: int = 2000) -> DataFrame:
    """The pairs (a, b) whose sets are similar. texts has id, hash0 (of the set) and text of every id.

    The set with more pairs is the hub of a pair; texts of its partners travel to it, in parts of about load partners, so
    that a hub with very many is several tasks.
    """
    degree = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    both = (
        pairs.join(degree.withColumnsRenamed({"id": "a", "degree": "da"}), "a")
        .join(degree.withColumnsRenamed({"id": "b", "degree": "db"}), "b")
        .select(
            F.when(F.col("da") >= F.col("db"), F.col("a")).otherwise(F.col("b")).alias("hub"),
            F.when(F.col("da") >= F.col("db"), F.col("b")).otherwise(F.col("a")).alias("id"),
            F.ceil(F.greatest("da", "db") / load).alias("parts"),
        )
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    )
    hubs = both.select("hub", F.col("hub").alias("id"), "part").distinct()
    wanted = both.select("hub", "id", "part").unionByName(hubs)
    wanted = wanted.groupBy("id").agg(F.collect_list(F.struct("hub", "part")).alias("to"))
    moved = texts.join(wanted, "id").select("id", "hash0", "text", F.explode("to").alias("to")).select(
        "to.hub", "to.part", (F.col("id") != F.col("to.hub")).alias("partner"), "id", "hash0", "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in exchange.documents(batches, _BYTES):
            if last is not None:
                batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            s = Sets(batch.column("text"), width)
            good = s.hash0.view(np.int64) == np.asarray(batch.column("hash0"))
            partner = np.asarray(batch.column("partner"))
            hub = np.asarray(batch.column("hub"))
            # A hub's own row comes first of its part; rows that repeat it are passed over.
            lead = ~partner & good
            lead[1:] &= ~((hub[1:] == hub[:-1]) & lead[:-1])
            at = np.maximum.accumulate(np.where(lead, np.arange(len(lead)), -1))
            mine = partner & good & (at >= 0)
            mine[mine] &= hub[at[mine]] == hub[mine]
            salt = words.mix((at + 1).astype(_U))
            token = s.token ^ salt[s.row]
            shared = np.isin(token, token[lead[s.row]]) & mine[s.row]
            inter = np.bincount(s.row[shared], minlength=len(lead))
            union = s.size + s.size[np.maximum(at, 0)] - inter
            link = np.flatnonzero(mine & (inter >= similar * union - 1e-9) & (inter > 0))
            out = [pa.array(hub[link]), pa.array(np.asarray(batch.column("id"))[link])]
            yield pa.RecordBatch.from_arrays(out, ["a", "b"])
            held = np.flatnonzero(lead)
            last = batch.slice(int(held[-1]), 1) if len(held) else None

    order = ["hub", "part", "partner"]
    return moved.repartition("hub", "part").sortWithinPartitions(*order).mapInArrow(run, "a long, b long")


def _band(size: Column, similar: float) -> Column:
    """Band of a size plus one, as keys carry it."""
    return F.size(F.filter(F.expr(f"array({','.join(f'{t}L' for t in bands(similar)[0])})"), lambda t: t < size)) + 1


def _members(found: DataFrame, named: DataFrame, similar: float) -> DataFrame:
    """key, id, rep, size, value (band plus one, or 0) and margin (in that band) of the members of common keys."""
    member = found.where("kind = 3").select(F.explode(F.arrays_zip("key", "hash0", "value")).alias("x"))
    member = member.select("x.key", F.col("x.hash0").alias("id"), "x.value").distinct()
    member = member.join(named.select("id", "rep", "size", "seal", F.col("value").alias("below")), "id")
    margin = F.when(F.col("value") == _band(F.col("size"), similar), F.col("seal")).otherwise(F.col("below"))
    return member.select("key", "id", "rep", "size", "value", margin.alias("margin"))


def _tied(member: DataFrame, similar: float) -> DataFrame:
    """key and rep of members that cannot afford to skip the key.

    Two similar sets that have only common keys of a band in common have at least `least` of them: the segments beyond
    the largest possible difference, without their empty ones. So each set may skip its least - 1 most
    common keys, in one order for all, and a pair still meets in a key that neither skips.
    """
    top, segments, slack = bands(similar)
    at = F.greatest("value", F.lit(1))
    sure, most = (F.element_at(F.expr(f"array({','.join(f'{v}L' for v in x)})"), at) for x in (segments - slack, top))
    partner = F.when(F.col("value") == _band(F.col("size"), similar), F.col("size") / similar).otherwise(most)
    differ = F.floor((F.col("size") + partner) * ((1 - similar) / (1 + similar)) + 1e-9)
    least = F.greatest(F.lit(1), sure + F.col("margin") - differ)
    often = member.groupBy("key").agg(F.count("*").alias("often"))
    own = Window.partitionBy("id", "value")
    ranked = member.where("value > 0").join(often, "key").withColumns(
        {"nth": F.row_number().over(own.orderBy("often", "key")), "n": F.count("*").over(own), "least": least}
    )
    tied = ranked.where("nth <= n - least + 1").select("key", "rep")
    return tied.unionByName(member.where("value = 0").select("key", "rep")).distinct()


def _plausible(found: DataFrame, named: DataFrame, common: DataFrame, similar: float) -> DataFrame:
    """Pairs of representatives (a, b) that have as many keys of their band in common as a similar pair must.

    Of the segments of a similar pair, all but the difference are equal; those that are empty, and common keys that
    gave no pair, are taken off for the set that has fewer of them. Pairs of extra keys are all kept.
    """
    pairs = found.where("kind = 4").select(F.explode(F.arrays_zip("hash0", "hash1", "value", "size")).alias("x"))
    pairs = pairs.groupBy(F.col("x.hash0").alias("a"), F.col("x.hash1").alias("b"), F.col("x.value").alias("value")).agg(F.sum("x.size").alias("n"))
    skipped = common.groupBy("id", "value").agg(F.count("*").alias("skipped"))
    for side in ("a", "b"):
        own = named.select(
            F.col("id").alias(side),
            F.col("rep").alias(f"rep_{side}"),
            F.col("size").alias(f"size_{side}"),
            F.col("seal").alias(f"own_{side}"),
            F.col("value").alias(f"below_{side}"),
        )
        hot = skipped.select(F.col("id").alias(side), "value", F.col("skipped").alias(f"hot_{side}"))
        pairs = pairs.join(own, side).join(hot, [side, "value"], "left")

    def margin(side: str) -> Column:
        return F.when(F.col("value") == _band(F.col(f"size_{side}"), similar), F.col(f"own_{side}")).otherwise(F.col(f"below_{side}"))

    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    _, segments, slack = bands(similar)
    sure = F.element_at(F.expr(f"array({','.join(f'{v}L' for v in segments - slack)})"), F.greatest("value", F.lit(1)))
    differ = F.floor((small + large) * ((1 - similar) / (1 + similar)) + 1e-9)
    least = sure + F.greatest(margin("a"), margin("b")) - differ - F.least(F.coalesce("hot_a", F.lit(0)), F.coalesce("hot_b", F.lit(0)))
    telling = (F.col("value") == 0) | ((F.col("value") == _band(small, similar)) & (F.col("n") >= least))
    fits = small >= similar * large - 1e-9
    return (
        pairs.where((F.col("rep_a") != F.col("rep_b")) & fits & telling)
        .select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b"))
        .distinct()
    )


def _apart(common: DataFrame, comp: DataFrame, rep_of: DataFrame) -> DataFrame:
    """Members of common keys whose members are not all in one component, with the component that most are in."""
    tied = common.join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    tied = tied.join(rep_of.where("id = rep").select("rep", "size"), "rep")
    per = tied.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = per.groupBy("key").agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("kinds"))
    main = main.where("kinds > 1").select("key", F.col("top.component").alias("main"))
    return keep(tied.join(main, "key"), "ngram-apart")


def _sides(apart: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members outside their key's largest component as x, and all members as y."""
    x = apart.where("component <> main").select("key", F.col("rep").alias("x"), F.col("component").alias("cx"), F.col("size").alias("sx"))
    y = apart.select("key", F.col("rep").alias("y"), F.col("component").alias("cy"), F.col("size").alias("sy"))
    return x, y


def sketches(texts: DataFrame, width: int) -> DataFrame:
    """id and the parity sketch of its set: bit h(t) is flipped by every shingle t.

    Shingles that two sets share cancel, so sketches of two sets differ in at most as many bits as the sets in shingles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in exchange.documents(batches, _BYTES):
            s = Sets(batch.column("text"), width)
            h = words.mix(s.token ^ _U(0xD6E8FEB86659FD93))
            bits = np.zeros((batch.num_rows, _SKETCH), _U)
            np.bitwise_xor.at(bits, (s.row, (h % _U(_SKETCH)).astype(np.int64)), _U(1) << (h >> _U(58)))
            cuts = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * _SKETCH)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(s.size), pa.ListArray.from_arrays(cuts, pa.array(bits.ravel().view(np.int64)))],
                ["id", "n", "bits"],
            )

    return texts.select("id", "text").mapInArrow(run, "id long, n long, bits array<long>")


def _near(pairs: DataFrame, sketch: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) whose sketches allow them to be similar."""
    for side in ("a", "b"):
        pairs = pairs.join(sketch.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("bits").alias(f"bits{side}")), side)
    flipped = F.zip_with("bitsa", "bitsb", lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    differ = F.aggregate(flipped, F.lit(0), lambda total, n: total + n)
    return pairs.where(differ <= (F.col("na") + F.col("nb")) * ((1 - similar) / (1 + similar)) + 1e-9).select("a", "b")


def _cross(apart: DataFrame, sketch: DataFrame, similar: float, block: int = 256) -> DataFrame:
    """Pairs of sets in different components that a common key ties and whose sketches allow them to be similar.

    The sets outside a key's largest component are the queries, held against all members in blocks; only pairs that pass
    leave the task, each at the first key that ties it. Rows carry a set's first FIRST_KEYS keys (not all): a pair leaves
    at the least key its two lists share, or, where they share none, at every key that ties it, and the repeats meet in
    one distinct. A key with very many members is as many tasks as it has blocks.
    """
    keys = apart.groupBy("rep").agg(F.slice(F.sort_array(F.collect_set("key")), 1, FIRST_KEYS).alias("keys")).withColumnRenamed("rep", "id")
    x, y = _sides(apart)
    blocks = x.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    queries = x.join(blocks, "key").select(
        "key", F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("side"), F.col("x").alias("id"), F.col("cx").alias("c"), F.col("sx").alias("size")
    )
    every = y.join(blocks, "key").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"), F.col("y").alias("id"), F.col("cy").alias("c"), F.col("sy").alias("size")
    )
    rows = queries.unionByName(every).join(sketch.drop("n").join(keys, "id"), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            key, part, side, ids, comp, size = (np.asarray(batch.column(c)) for c in ("key", "block", "side", "id", "c", "size"))
            bits = exchange.flat(batch.column("bits")).view(_U).reshape(-1, _SKETCH)
            lists = batch.column("keys")
            cuts, all_keys = np.asarray(lists.offsets) - lists.offsets[0].as_py(), exchange.flat(lists)
            own = np.empty(len(key), object)
            own[:] = [all_keys[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            new = np.append(True, (key[1:] != key[:-1]) | (part[1:] != part[:-1]) | (side[1:] != side[:-1]))
            for lo, hi in zip(np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(key)), strict=True):
                here = (key[lo], part[lo])
                mine = (ids[lo:hi], comp[lo:hi], size[lo:hi], bits[lo:hi], own[lo:hi])
                if side[lo] == 0:
                    held = [np.concatenate(z) for z in zip(held, mine, strict=True)] if at == here else mine
                    at = here
                    continue
                if at != here:
                    continue
                for i, c, n, b, k in zip(*held, strict=True):
                    both = mine[2] + n
                    good = (mine[1] != c) & (np.minimum(mine[2], n) >= similar * np.maximum(mine[2], n) - 1e-9)
                    near = np.flatnonzero(good)
                    differ = np.bitwise_count(mine[3][near] ^ b).sum(axis=1)
                    near = near[differ <= both[near] * ((1 - similar) / (1 + similar)) + 1e-9]
                    shared = [np.intersect1d(k, o, assume_unique=True) for o in mine[4][near]]
                    near = near[np.array([len(z) == 0 or z[0] == here[0] for z in shared], bool)]
                    if len(near):
                        other = mine[0][near]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(other, i)), pa.array(np.maximum(other, i))], ["a", "b"])

    rows = rows.repartition("key", "block").sortWithinPartitions("key", "block", "side")
    return rows.mapInArrow(run, "a long, b long").distinct()


def join(docs: DataFrame, width: int = WIDTH, similar: float = 0.75) -> DataFrame:
    """Every row of docs (doc_id, text) with n_shingles, component_id and set_id.

    A set is the distinct runs of `width` words, A-Z lowered; a text of fewer words is one shingle; a null text or one
    without words has none and is linked with nothing. Rows with intersection >= similar * union are linked;
    component_id is the smallest doc_id reachable by links. set_id is equal for rows of equal sets. Rows with a null doc_id take part and get
    the component's smallest id, or null if all are null. Repeated rows are rows of equal sets. An empty
    table gives no rows; other columns are ignored.
    """
    found = keep(candidates(docs, width, similar), "ngram-candidates")
    fact = found.where("kind = 2")
    facts = keep(
        fact.select(
            "base",
            F.posexplode(F.arrays_zip("doc_id", "hash0", "hash1", "size", "seal", "value")).alias("doc", "x"),
        ).select((F.col("base") * (1 << 15) + F.col("doc")).alias("id"), "x.*"),
        "ngram-facts",
    )
    full = facts.where("size > 0")
    same = ["hash0", "hash1", "size"]
    # One id per distinct set.
    sets = full.groupBy(*same).agg(F.min(F.struct("id", "doc_id")).alias("rep")).select(*same, F.col("rep.id").alias("rep"), F.col("rep.doc_id").alias("rep_doc"))
    named = keep(full.join(sets, same).select("id", "rep", "rep_doc", "doc_id", "hash0", "size", "seal", "value"), "ngram-sets")
    rep_of = named.select("id", "rep", "size")
    reps = named.where("id = rep").select("id", "doc_id", "hash0")

    common = keep(_members(found, named, similar), "ngram-common")
    pairs = keep(_plausible(found, named, common, similar), "ngram-pairs")
    common = keep(_tied(common, similar), "ngram-tied")
    # The texts that any comparison needs, once.
    involved = pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(common.select(F.col("rep").alias("id"))).distinct()
    texts = keep(
        docs.select(_doc_key(), "text").join(reps.join(involved, "id"), "doc_id").select("id", "hash0", "text"), "ngram-texts"
    )
    sketch = keep(sketches(texts, width), "ngram-sketches")
    pairs = keep(_near(pairs, sketch, similar), "ngram-near")
    # First each set with one neighbour; a pair within a component that this gives needs no comparison.
    rank = F.xxhash64(F.lit(3), "b")
    arcs = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    first = arcs.groupBy("a").agg(F.min_by("b", rank).alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = keep(verify(texts, first, width, similar), "ngram-links")
    comp = keep(components(links), "ngram-components")

    def across(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(comp.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side, "left")
        same = F.coalesce("ca", "a") == F.coalesce("cb", "b")
        return pairs.where(~same).select("a", "b")

    def more(links: DataFrame, left: DataFrame) -> tuple[DataFrame, DataFrame]:
        left = keep(left, "ngram-left")
        if left.isEmpty():
            return links, comp
        links = keep(links.unionByName(verify(texts, left, width, similar)), "ngram-links")
        return links, keep(components(links), "ngram-components")

    links, comp = more(links, across(pairs).join(first, ["a", "b"], "left_anti"))
    # Sets tied by common keys, where these are still apart.
    links, comp = more(links, _cross(_apart(common, comp, rep_of), sketch, similar))

    known = named.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", "size", "rep", F.coalesce("component", "rep").alias("component")
    )
    least = known.groupBy("component").agg(F.min(F.when(F.col("doc_id") >= _NO_ID + (1 << 62), F.col("doc_id"))).alias("component_id"))
    real = F.when(F.col("doc_id") >= _NO_ID + (1 << 62), F.col("doc_id"))
    out = known.join(least, "component").select(real.alias("doc_id"), F.col("size").cast("long").alias("n_shingles"), "component_id", F.col("rep").alias("set_id"))
    empty = facts.where("size = 0").select(real.alias("doc_id"), F.lit(0).cast("long").alias("n_shingles"), real.alias("component_id"), F.col("id").alias("set_id"))
    return out.unionByName(empty)
