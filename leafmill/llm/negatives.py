"""Hard-negative mining over an inverted multi-index, exact by certified windows.

Vectors are integers (each component floor(256 x)); a row's score for an anchor is the integer inner product. Per anchor,
positives are the first `positives` other rows of its label (higher score first, ties by smaller vec_id); per positive,
negatives are the first `negatives` rows of another label whose score lies in [lo%, hi%] of the positive's.

The index: each vector is cut into two halves, and a k-means codebook is fitted per half on a seeded sample of at most
`sample_rows` rows (the only bounded step; every row is indexed). A row's cell is its pair of nearest centroids; each
centroid keeps the radius of its rows' halves. For an anchor q, a cell (i, j) bounds every member's score by
<q1, C1[i]> + |q1| R1[i] + <q2, C2[j]> + |q2| R2[j]. Rows sorted by label and cell are cut into blocks of `piece_rows`
(a cell of many rows is several blocks) and the blocks into ranges that fit a task; the bound of a block is the largest
of its cells. A task holds a range and takes the anchors in chunks of `anchor_rows`: an anchor visits the range's blocks
by falling bound in rounds of a growing budget and leaves out a block whose bound is below every score its answer still
depends on (fifth positive, third negative in each window, or a window's lower end). At the last budget no other block
is left, so every answer is exact. The first pass visits the blocks of an anchor's label for its positives, the second
the others for its windows; only the first rows per chunk and range leave a task, packed, and are merged by chunk.

Scores are matrix products in the narrowest type that holds every partial sum exactly, by the norms of both sides:
float32 below 2**24, float64 below 2**53, else 64-bit integers.

Edge cases: rows with a null label or vector, or a null or non-finite component, take no part; vectors of other lengths
are padded with zeros (inner product over common positions); an empty vector scores 0. Repeated rows are distinct rows
(an anchor's copy can be its positive); ties go to the smaller vec_id, then to an internal row number. Anchors without
positives, or positives without negatives in window, give no rows; an empty table none. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.scratch import keep

NO_ID = (1 << 63) - 1  # a null vec_id, last among ties
NONE, FAR = -(1 << 62), 1 << 62  # score of an empty place; a score that none reaches
HELD = 1 << 24  # vector components of the rows that one task holds
TILE = 1 << 18  # scores computed at a time, so that they stay in a core's cache
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
PACK = "r int, no long, lo int, hi int, wide boolean, label binary, rid binary, vid binary, cells binary, vec binary"
FOUND = "no long, score binary, vid binary, rid binary"


def valid_rows(embeddings: DataFrame) -> DataFrame:
    """rid, vec_id, label (shifted where 7 divides vec_id) and integer vec of rows that take part."""
    vec, label, vec_id = F.col("embedding"), F.col("label").cast("int"), F.col("vec_id").cast("long")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return embeddings.where(label.isNotNull() & vec.isNotNull() & finite).select(
        vec_id.alias("vec_id"),
        F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform(vec, lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("vec"),
    ).withColumn("rid", F.monotonically_increasing_id())


def _kmeans(points: np.ndarray, k: int, seed: int, rounds: int = 25) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = max(1, min(k, len(points)))
    centres = [points[rng.integers(len(points))]]
    d = np.full(len(points), np.inf)
    for _ in range(1, k):  # k-means++ start
        d = np.minimum(d, ((points - centres[-1]) ** 2).sum(1))
        centres.append(points[rng.choice(len(points), p=d / d.sum())] if d.sum() > 0 else points[rng.integers(len(points))])
    centres = np.array(centres, dtype=np.float64)
    for _ in range(rounds):
        near = _nearest(points, centres)
        for c in range(k):
            if (near == c).any():
                centres[c] = points[near == c].mean(0)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]
    return d.argmin(1)


def _matrix(vectors, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim), dtype=np.float64)
    for i, v in enumerate(vectors):
        v = np.asarray(v, dtype=np.float64)[:dim]
        out[i, : len(v)] = v
    return out


def _ints(column: pa.ListArray, dim: int) -> np.ndarray:
    """Rows of a list column as integers, padded with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros((len(column), dim), dtype=np.int64)
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(column)), sizes), at] = values
    return out


class Index:
    """Two half codebooks with radii per centroid and the number of rows per cell."""

    def __init__(self, dim: int, books: list[np.ndarray]):
        self.dim, self.cut, self.books = dim, dim // 2, books
        self.radii = [np.zeros(len(b)) for b in books]
        self.sizes: dict[tuple[int, int], int] = {}

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.cut], x[:, self.cut :]

    def bounds(self, q: np.ndarray) -> list[np.ndarray]:
        """Per half, the bound of each centroid's rows for each row of q."""
        return [h @ b.T + np.linalg.norm(h, axis=1)[:, None] * r for b, h, r in zip(self.books, self.halves(q), self.radii)]


def fit(rows: DataFrame, cells: int = 32, sample_rows: int = 20_000, seed: int = 7) -> Index | None:
    """Codebooks on a seeded sample of about sample_rows rows; radii and cell sizes over all rows. None: no rows."""
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).first()
    if not stats.n:
        return None
    share = min(1.0, sample_rows / stats.n)
    chance = F.xxhash64(F.lit(seed), "vec_id", "rid").bitwiseAND((1 << 30) - 1) / float(1 << 30)
    sample = [r.vec for r in rows.where(chance < share).select("vec").limit(2 * sample_rows).collect()]  # bounded sample
    if not sample:
        sample = [r.vec for r in rows.select("vec").limit(1).collect()]
    dim = max(int(stats.dim), 1)
    points = _matrix(sample, dim)
    cut = dim // 2
    return Index(dim, [_kmeans(points[:, :cut], cells, seed), _kmeans(points[:, cut:], cells, seed + 1)])


def assign(rows: DataFrame, index: Index) -> DataFrame:
    """rows with c1, c2, the distances r1, r2 of their halves to those centroids, and vec as bytes (16 bits a component where they do)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ints = _ints(batch.column("vec"), index.dim)
            x, out = ints.astype(np.float64), []
            for book, h in zip(index.books, index.halves(x)):
                near = _nearest(h, book) if len(h) else np.zeros(0, dtype=np.int64)
                out += [pa.array(near.astype(np.int32)), pa.array(np.linalg.norm(h - book[near], axis=1) if len(h) else np.zeros(0))]
            narrow = ((ints >= -(1 << 15)) & (ints < 1 << 15)).all(axis=1)
            vecs = [v.astype("<i2" if small else "<i8").tobytes() for v, small in zip(ints, narrow)]
            given = [batch.column(c) for c in ("rid", "vec_id", "label")]
            yield pa.RecordBatch.from_arrays([*given, *out, pa.array(vecs, pa.binary())], ["rid", "vec_id", "label", "c1", "r1", "c2", "r2", "vec"])

    return rows.select("rid", "vec_id", "label", "vec").mapInArrow(
        run, "rid long, vec_id long, label int, c1 int, r1 double, c2 int, r2 double, vec binary"
    )


def _packed(rows: DataFrame, parts: int, size: int, dim: int) -> DataFrame:
    """Rows in order of label, cell, vec_id and rid as PACK: r is one of `parts` ranges, no one of its runs of `size` rows."""

    def pack(table: pa.Table, part: int, no: int) -> dict:
        label, c1, c2 = (table[c].to_numpy().astype("<i4") for c in ("label", "c1", "c2"))
        vecs = table["vec"].to_pylist()
        wide = any(len(v) != 2 * dim for v in vecs)
        if wide:
            vecs = [v if len(v) != 2 * dim else np.frombuffer(v, "<i2").astype("<i8").tobytes() for v in vecs]
        return {
            "r": part, "no": (part << 32) + no, "lo": int(label.min()), "hi": int(label.max()), "wide": wide, "label": label.tobytes(),
            "rid": table["rid"].to_numpy().astype("<i8").tobytes(), "vid": table["vid"].to_numpy().astype("<i8").tobytes(),
            "cells": np.unique(np.stack([c1, c2], 1), axis=0).tobytes(), "vec": b"".join(vecs),
        }

    names = [c.split()[0] for c in PACK.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), *[pa.binary()] * 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, held, n = TaskContext.get().partitionId(), 0, [], 0
        ship = lambda row: pa.RecordBatch.from_arrays([pa.array([row[c]], k) for c, k in zip(names, kinds)], names)
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= size:
                table = pa.Table.from_batches(held)
                yield ship(pack(table.slice(0, size), part, no))
                held, n, no = table.slice(size).to_batches(), n - size, no + 1
        if n:
            yield ship(pack(pa.Table.from_batches(held), part, no))

    keys = ["label", "c1", "c2", "vid", "rid"]  # the last two also spread a cell of many rows over ranges
    rows = rows.select("label", "c1", "c2", F.coalesce("vec_id", F.lit(NO_ID)).alias("vid"), "rid", "vec")
    return rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(run, PACK)


class _Rows:
    """The rows of one PACK row, in order of vec_id and row number."""

    def __init__(self, row: dict, dim: int):
        rid, vid = np.frombuffer(row["rid"], "<i8"), np.frombuffer(row["vid"], "<i8")
        order = np.lexsort((rid, vid))
        self.rid, self.vid, self.label = rid[order], vid[order], np.frombuffer(row["label"], "<i4")[order]
        self.x = np.frombuffer(row["vec"], "<i8" if row["wide"] else "<i2").reshape(len(rid), dim)[order]
        self.cells = np.frombuffer(row["cells"], "<i4").reshape(-1, 2)
        self.lo, self.hi, self.no = row["lo"], row["hi"], row["no"]
        self.norms = np.linalg.norm(self.x.astype(np.float64), axis=1)
        self.norm = self.norms.max()

    def bound(self, halves: list[np.ndarray]) -> np.ndarray:
        """Bound of these rows' scores: the largest of their cells; where cells are many, of their halves."""
        one, two = halves
        if len(self.cells) <= 64:
            return (one[:, self.cells[:, 0]] + two[:, self.cells[:, 1]]).max(axis=1)
        return one[:, np.unique(self.cells[:, 0])].max(axis=1) + two[:, np.unique(self.cells[:, 1])].max(axis=1)


def _first(slot: np.ndarray, score: np.ndarray, vid: np.ndarray, rid: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k entries per slot (higher score, smaller vid, smaller rid), slot by slot."""
    if not len(slot):
        return np.zeros(0, dtype=np.int64)
    real = score > NONE
    top = int(score.max())
    span = top - int(score[real].min()) + 2 if real.any() else 1
    if int(slot.max() + 1) * span < 1 << 62:
        fall = np.where(real, top - score, span - 1)
        key = slot * span + fall
        order = np.argsort(key)
        key = key[order]
        tied = np.flatnonzero((key[1:] == key[:-1]) & real[order[1:]])
        if len(tied):  # slots with equal scores go by vid and rid
            again = np.zeros(int(slot.max()) + 1, dtype=bool)
            again[slot[order[tied]]] = True
            at = np.flatnonzero(again[slot[order]])
            part = order[at]
            order[at] = part[np.lexsort((rid[part], vid[part], -score[part], slot[part]))]
    else:
        order = np.lexsort((rid, vid, -score, slot))
    s = slot[order]
    starts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    place = np.arange(len(s)) - np.repeat(starts, np.diff(np.r_[starts, len(s)]))
    return order[place < k]


class _Answers:
    """First k rows per anchor of a chunk and window [least, most], of the anchor's label (same) or of others."""

    def __init__(self, anchors: _Rows, least: np.ndarray, most: np.ndarray, k: int, same: bool):
        self.anchors, self.k, self.same = anchors, k, same
        self.least, self.most, self.windows = np.where(least > most, FAR, least), most, least.shape[1]
        shape = (*least.shape, k)
        self.score, self.vid, self.rid = np.full(shape, NONE), np.full(shape, NO_ID), np.full(shape, NO_ID)
        self.space = np.empty(max(TILE, 64 * len(least)), np.float32)

    def needed(self) -> np.ndarray:
        """Per anchor the least score that its answer still depends on."""
        return np.maximum(self.least, self.score[:, :, -1]).min(axis=1)

    def visit(self, rows: _Rows, which: np.ndarray) -> None:
        """Scores of a block's rows for the anchors `which`."""
        reach = self.anchors.norms[which] * rows.norm * (1 + 1e-9)
        for kind, fits in (
            (np.float32, reach < 1 << 24), (np.float64, (reach >= 1 << 24) & (reach < 1 << 53)), (np.int64, reach >= 1 << 53)
        ):
            if not fits.any():
                continue
            some = which[fits]
            anchors, width = self.anchors.x[some].astype(kind), max(64, TILE // len(some) // 64 * 64)
            space = self.space.view(kind) if kind is np.float32 else np.empty(len(some) * width, kind)
            for begin in range(0, len(rows.rid), width):
                x = rows.x[begin : begin + width].astype(kind)
                scores = space[: len(some) * len(x)].reshape(len(some), len(x))
                self._take(rows, some, np.matmul(anchors, x.T, out=scores), begin)

    def _take(self, rows: _Rows, which: np.ndarray, scores: np.ndarray, begin: int) -> None:
        """Merge the rows from begin on. They follow each other by vid and rid, so a full answer whose last entry comes before them wins ties."""
        last, vid, rid = self.score[which, :, -1], self.vid[which, :, -1], self.rid[which, :, -1]
        before = (vid < rows.vid[begin]) | (vid == rows.vid[begin]) & (rid < rows.rid[begin])
        low = np.maximum(self.least[which], last + before)
        least = low.min(axis=1).astype(scores.dtype)
        live = np.flatnonzero(scores.max(axis=1) >= least)  # mostly few
        if not len(live):
            return
        if len(live) < len(which):
            which, scores, low, least = which[live], scores[live], low[live], least[live]
        width = scores.shape[1]
        hits = scores >= least[:, None]
        n, many = np.count_nonzero(hits), 8 * len(which)
        if n > many:
            own = rows.label[None, begin : begin + width] == self.anchors.label[which][:, None]
            hits &= own if self.same else ~own
            hits &= scores <= self.most[which].max(axis=1)[:, None].astype(scores.dtype)
            n = np.count_nonzero(hits)
        if n > many and width > 64:  # the first rows raise the scores that the others need
            middle = max(64, width // 128 * 64)
            self._take(rows, which, scores[:, :middle], begin)
            self._take(rows, which, scores[:, middle:], begin + middle)
            return
        if not n:
            return
        flat = hits.reshape(-1)
        if len(flat) % 8 == 0:  # eight at a time, as few are set
            words = np.flatnonzero(flat.view(np.uint64))
            w, b = np.nonzero(flat.reshape(-1, 8)[words])
            flat = words[w] * 8 + b
        else:
            flat = np.flatnonzero(flat)
        i, at = np.divmod(flat, width)
        s, at, a = scores[i, at].astype(np.int64), at + begin, which[i]
        fits = (rows.label[at] == self.anchors.label[a]) & (rows.rid[at] != self.anchors.rid[a]) if self.same else rows.label[at] != self.anchors.label[a]
        i, at, s, a = i[fits], at[fits], s[fits], a[fits]
        h, w = np.nonzero((s[:, None] >= low[i]) & (s[:, None] <= self.most[a]))
        if not len(h):
            return
        slot, at = a[h] * self.windows + w, at[h]
        touched = np.zeros(self.least.size, dtype=bool)
        touched[slot] = True
        touched = np.flatnonzero(touched)
        held = [x.reshape(-1, self.k) for x in (self.score, self.vid, self.rid)]
        new = [np.concatenate([y, x[touched].ravel()]) for x, y in zip(held, (s[h], rows.vid[at], rows.rid[at]))]
        best = _first(np.concatenate([slot, np.repeat(touched, self.k)]), *new, self.k)
        for x, y in zip(held, new):
            x[touched] = y[best].reshape(-1, self.k)


def _answer(anchors: _Rows, blocks: list[_Rows], index: Index, found: _Answers, first_budget: int, growth: int) -> None:
    """Visit a range's blocks by falling bound, in rounds of a growing budget, but for those that cannot change the answer."""
    label, halves = anchors.label, index.bounds(anchors.x.astype(np.float64))
    bound = np.full((len(label), len(blocks)), -np.inf)  # -inf: no row of the block counts
    for j, b in enumerate(blocks):
        counts = (label >= b.lo) & (label <= b.hi) if found.same else (label != b.lo) | (label != b.hi)
        if counts.any():
            bound[counts, j] = b.bound([h[counts] for h in halves])
    bound += np.where(bound > -np.inf, 1e-9 * (np.abs(bound) + 1) + 1e-6, 0)  # rounding
    rank = np.empty(bound.shape, dtype=np.int64)
    np.put_along_axis(rank, np.argsort(-bound, axis=1, kind="stable"), np.arange(len(blocks))[None, :], axis=1)
    done, budget = 0, max(1, first_budget)
    while done < len(blocks):
        left = (rank >= done) & (bound >= found.needed()[:, None]) & (bound > -np.inf)
        if not left.any():
            break
        for j in np.flatnonzero((left & (rank < budget)).any(axis=0)):
            which = np.flatnonzero(left[:, j] & (rank[:, j] < budget))
            found.visit(blocks[j], which[bound[which, j] >= found.needed()[which]])
        done, budget = budget, budget * max(2, growth)


def _windows(scores: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and most score of the window of each positive; closed where there is none."""
    real = scores > NONE
    ps = np.where(real, scores, 0)
    return np.where(real, -(-lo * ps // 100), FAR), np.where(real, hi * ps // 100, NONE)


def _scan(index: Index, k: int, window: tuple[int, int] | None, first_budget: int, growth: int):
    """Per chunk of anchors, the first rows of the range before it: of the anchors' label, or per window of their positives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, blocks = None, []
        for batch in batches:
            for row in (x for i in range(batch.num_rows) for x in batch.slice(i, 1).to_pylist()):
                if row["r"] != r:
                    r, blocks = row["r"], []
                rows = _Rows(row, index.dim)
                if not row["anchors"]:
                    blocks.append(rows)
                    continue
                n = len(rows.rid)
                if window is None:
                    least, most = np.full((n, 1), NONE), np.full((n, 1), FAR)
                else:
                    least, most = _windows(np.frombuffer(row["wins"], "<i8").reshape(n, -1), *window)
                found = _Answers(rows, least, most, k, window is None)
                _answer(rows, blocks, index, found, first_budget, growth)
                if (found.score > NONE).any():
                    yield _found(row["no"], found.score, found.vid, found.rid)

    return run


def _found(no: int, *values: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([no], pa.int64()), *(pa.array([v.astype("<i8").tobytes()], pa.binary()) for v in values)]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in FOUND.split(", ")])


def _merged(k: int):
    """First k entries per place over the ranges of a chunk."""

    def run(table: pa.Table) -> pa.Table:
        score, vid, rid = ([np.frombuffer(v, "<i8") for v in table[c].to_pylist()] for c in ("score", "vid", "rid"))
        slots = len(score[0]) // k
        out = [np.full((slots, k), x) for x in (NONE, NO_ID, NO_ID)]
        slot = np.tile(np.repeat(np.arange(slots), k), len(score))
        values = [np.concatenate(x) for x in (score, vid, rid)]
        real = values[0] > NONE
        slot, values = slot[real], [x[real] for x in values]
        best = _first(slot, *values, k)
        s = slot[best]
        place = np.arange(len(s)) - np.searchsorted(s, s)
        for o, x in zip(out, values):
            o[s, place] = x[best]
        return pa.Table.from_batches([_found(table["no"][0].as_py(), *out)])

    return run


def _rows_out(positives: int, negatives: int):
    """OUT rows from a chunk's anchors (order of _Rows), its positives and their negatives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = lambda c: np.frombuffer(row[c], "<i8")
                vid, rid = ids("a_vid"), ids("a_rid")
                anchor = vid[np.lexsort((rid, vid))]
                ps, pv = (ids(c).reshape(-1, positives) for c in ("p_score", "p_vid"))
                ns, nv = (ids(c).reshape(-1, positives, negatives) for c in ("score", "vid"))
                a, p, rank = np.nonzero(ns > NONE)
                named = lambda v: pa.array(v, pa.int64(), mask=v == NO_ID)
                columns = [
                    pa.array(anchor[a], pa.int64()), named(pv[a, p]), pa.array((rank + 1).astype(np.int32)),
                    named(nv[a, p, rank]), pa.array(ps[a, p], pa.int64()), pa.array(ns[a, p, rank], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in OUT.split(", ")])

    return run


def mine(
    embeddings: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    lo: int = 50,
    hi: int = 95,
    cells: int = 32,
    sample_rows: int = 20_000,
    first_budget: int = 8,
    growth: int = 4,
    piece_rows: int = 2_048,
    anchor_rows: int = 512,
    seed: int = 7,
) -> DataFrame:
    """Hard negatives of every anchor (vec_id divisible by every) of embeddings (vec_id, embedding, label): OUT rows."""
    spark = embeddings.sparkSession
    rows = keep(valid_rows(embeddings), "negatives-rows")
    index = fit(rows, cells, sample_rows, seed)
    if index is None:
        return spark.createDataFrame([], OUT)
    indexed = keep(assign(rows, index), "negatives-indexed")
    chosen = F.col("vec_id") % every == 0
    stats = indexed.groupBy("c1", "c2").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(chosen).alias("anchors"), F.max("r1").alias("r1"), F.max("r2").alias("r2")
    ).collect()  # one row per cell: bounded by cells squared
    for x in stats:
        index.sizes[x.c1, x.c2] = x.n
        index.radii[0][x.c1], index.radii[1][x.c2] = max(index.radii[0][x.c1], x.r1), max(index.radii[1][x.c2], x.r2)
    n, n_anchors = sum(index.sizes.values()), sum(x.anchors for x in stats)
    if not n_anchors:
        return spark.createDataFrame([], OUT)
    # As few ranges as keep the cores busy: the rows that leave tasks are in proportion to them.
    ranges = max(-(-n * index.dim // HELD), min(2 * spark.sparkContext.defaultParallelism, -(-n // (4 * piece_rows))))
    blocks = keep(_packed(indexed, ranges, piece_rows, index.dim), "negatives-blocks")
    chunks = keep(_packed(indexed.where(chosen), -(-n_anchors // (16 * anchor_rows)), anchor_rows, index.dim), "negatives-anchors")
    labels = blocks.groupBy("r").agg(F.min("lo").alias("r_lo"), F.max("hi").alias("r_hi"))  # one row per range

    def found(asked: DataFrame, k: int, window: tuple[int, int] | None) -> DataFrame:
        """Answers of the chunks from each range that has rows for them, merged by chunk."""
        met = (F.col("r_lo") <= F.col("hi")) & (F.col("lo") <= F.col("r_hi"))
        if window:
            met = (F.col("r_lo") < F.col("r_hi")) | (F.col("lo") < F.col("hi")) | (F.col("lo") != F.col("r_lo"))
        met = asked.drop("r").join(F.broadcast(labels), met).drop("r_lo", "r_hi").withColumn("anchors", F.lit(True))
        both = blocks.withColumns({"wins": F.lit(None).cast("binary"), "anchors": F.lit(False)}).unionByName(met)
        tasks = both.repartitionById(ranges, F.col("r")).sortWithinPartitions("r", "anchors", "no")
        scanned = tasks.mapInArrow(_scan(index, k, window, first_budget, growth), FOUND)
        return keep(scanned.groupBy("no").applyInArrow(_merged(k), FOUND), "negatives-found")

    same = found(chunks.withColumn("wins", F.lit(None).cast("binary")), positives, None)
    other = found(chunks.join(same.select("no", F.col("score").alias("wins")), "no"), negatives, (lo, hi))
    answers = chunks.select("no", F.col("vid").alias("a_vid"), F.col("rid").alias("a_rid")).join(
        same.select("no", F.col("score").alias("p_score"), F.col("vid").alias("p_vid")), "no"
    ).join(other.select("no", "score", "vid"), "no")
    return answers.mapInArrow(_rows_out(positives, negatives), OUT)
