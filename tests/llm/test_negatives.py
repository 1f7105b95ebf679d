"""Hard negatives over the inverted multi-index against a brute-force scan and the SQL."""

import math

import duckdb
import numpy as np
import pytest

from leafmill.llm import negatives as ng
from leafmill.llm.checks import NEGATIVES

EMB = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50):
    """Contract rows from (vec_id, embedding, label) by scoring every anchor against every row."""
    keep = []
    for i, (vec_id, emb, label) in enumerate(rows):
        if label is None or emb is None or any(x is None or not math.isfinite(x) for x in emb):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        keep.append((i, vec_id, label, [math.floor(256 * float(x)) for x in emb]))
    out = []
    for i, a_id, a_label, a_vec in keep:
        if a_id is None or a_id % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a_vec, v)), vid if vid is not None else 1 << 62, j, vid, lab) for j, vid, lab, v in keep]
        scored.sort()
        same = [s for s in scored if s[4] == a_label and s[2] != i][:5]
        for ns, _, _, pid, _ in same:
            ps, k = -ns, 0
            for s in scored:
                if s[4] != a_label and 50 * ps <= -100 * s[0] <= 95 * ps:
                    k += 1
                    out.append((a_id, pid, k, s[3], ps, -s[0]))
                    if k == 3:
                        break
    return sorted(out, key=repr)


def run(df, **kw):
    return sorted((tuple(r) for r in ng.mine(df, **kw).collect()), key=repr)


def test_given_table_exact(spark):
    """All 500 rows of sf0.01: every answer equals the scan, i.e. recall 1.0."""
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    assert run(df) == want
    assert len(want) > 100


def test_sql_agrees(spark):
    con = duckdb.connect()
    con.sql("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert sorted(con.sql(NEGATIVES).fetchall(), key=repr) == run(df)


@pytest.mark.parametrize("budget,pieces", [(1, 3), (2, 2048)])
def test_rounds_and_hot_cell(spark, budget, pieces):
    """A hot cell of near copies, split into pieces of 3 rows; anchors that need many rounds."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8)], int(rng.integers(0, 4))) for i in range(400)]
    base = rng.normal(0, 0.3, 8)
    rows += [(400 + i, [float(x) for x in base + rng.normal(0, 0.001, 8)], i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, EMB).repartition(3)
    assert run(df, cells=4, first_budget=budget, piece_rows=pieces) == brute(rows)


def test_odd_rows(spark):
    """Nulls, NaN, infinity, other lengths, empty vectors, repeated rows, ties and clashing columns."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 6)], i % 3) for i in range(120)]
    rows += [
        (200, None, 1),
        (250, [0.1, None, 0.2, 0.1, 0.0, 0.3], 1),
        (300, [0.1, float("nan"), 0.2, 0.1, 0.0, 0.3], 1),
        (350, [0.1, float("inf"), 0.2, 0.1, 0.0, 0.3], 2),
        (400, [0.2, 0.1, 0.3, 0.3, 0.3, 0.3], None),
        (450, [0.2, 0.1], 2),
        (500, [], 2),
        (None, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5], 0),
        (550, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5], 0),
        (551, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5], 0),
        (552, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5], 1),
    ]
    df = spark.createDataFrame(rows, EMB).repartition(2)
    clashing = df.withColumns({"rid": df.vec_id * 0, "score": df.vec_id, "c1": df.label, "a_vec": df.embedding})
    got = run(clashing, cells=3, first_budget=1)
    assert got == brute(rows)
    assert run(df.where("vec_id < 0")) == []


def test_tables_between_steps(spark, monkeypatch):
    """No step hands on more rows than the input has, however few cells an anchor can leave out."""
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) for x in v / np.linalg.norm(v)], i % 5) for i, v in enumerate(rng.normal(0, 1, (2_000, 32)))]
    kept, counts = ng.keep, {}

    def counted(df, name):
        out = kept(df, name)
        counts[name] = max(counts.get(name, 0), out.count())
        return out

    monkeypatch.setattr(ng, "keep", counted)
    assert run(spark.createDataFrame(rows, EMB)) == brute(rows)
    assert counts and max(counts.values()) <= len(rows), counts


@pytest.mark.parametrize("scale", [1.0, 60.0, 2e5])
def test_number_types(spark, scale):
    """Scores beyond what float32 or float64 hold exactly, alone and beside small ones."""
    rng = np.random.default_rng(13)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 8) * (scale if i % 3 else 1.0)], i % 4) for i in range(500)]
    df = spark.createDataFrame(rows, EMB).repartition(3)
    assert run(df, piece_rows=32, anchor_rows=4) == brute(rows)


def test_common_vector(spark):
    """One vector in most rows, in several labels and blocks, ids in no order: ties go by vec_id."""
    rng = np.random.default_rng(17)
    base = [float(x) for x in rng.normal(0, 0.3, 8)]
    ids = rng.permutation(900)
    rows = [(int(i), base if k % 3 else [float(x) * 0.8 for x in base], k % 4) for k, i in enumerate(ids)]
    rows += [(900 + i, [float(x) for x in rng.normal(0, 0.3, 8)], i % 4) for i in range(200)]
    df = spark.createDataFrame(rows, EMB).repartition(3)
    assert run(df, piece_rows=128, anchor_rows=8, first_budget=1) == brute(rows)


def test_first():
    """The first k entries of each slot, by score, vid and rid; empty places last."""
    rng = np.random.default_rng(19)
    slot, score = rng.integers(0, 40, 2_000), rng.integers(0, 30, 2_000)
    score[rng.random(2_000) < 0.2] = ng.NONE
    vid, rid = rng.integers(0, 9, 2_000), rng.permutation(2_000)
    vid[score == ng.NONE] = rid[score == ng.NONE] = ng.NO_ID
    for wide in (1, 1 << 55):
        s = np.where(score > ng.NONE, score * wide, score)
        order = ng._first(slot, s, vid, rid, 4)
        got = list(zip(slot[order], -s[order], vid[order], rid[order]))
        entries = sorted(zip(slot, -s, vid, rid))
        assert got == [e for k in range(40) for e in [x for x in entries if x[0] == k][:4]]
