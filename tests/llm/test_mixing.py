import pytest
from llm_data import prose, rows_of
from pyspark.sql import functions as F

from leafmill.llm import mixing


def test_water_fill():
    assert mixing.water_fill([10, 10, 10], [1, 2, 3], 3) == pytest.approx([5, 10, 15])
    # The third source stops at 3 and the others share the rest by weight.
    assert mixing.water_fill([1, 100, 1], [1, 2, 3], 3) == pytest.approx([3, 96, 3])
    assert mixing.water_fill([], [], 3) == [] and mixing.water_fill([0, 5], [1, 1], 3) == pytest.approx([0, 5])


def test_flow_routes_shared_patterns():
    # Pattern 0 may serve both quotas, pattern 1 only the second.
    flows = mixing.min_cost_flow([10, 4], [[0, 1], [1]], [8, 8], [0, 3, 15])
    for quota in (0, 1):
        assert sum(a for f in flows for (q, _), a in f.items() if q == quota) == pytest.approx(8)
    # Everything once before anything twice.
    assert [sum(a for (_, r), a in f.items() if r == 0) for f in flows] == pytest.approx([10, 4])
    assert sum(a for f in flows for (_, r), a in f.items() if r == 1) == pytest.approx(2)


def check(got, rows):
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(names, mixing.water_fill([sizes[s] for s in names], [1 + i % 3 for i in range(len(names))], 3)))
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken == r.copies * r["size"] and 0 <= r.taken <= 3 * r["size"]
    largest = max(len((t or "").split()) for _, t, *_ in rows)
    for s in names:
        assert abs(sum(r.taken for r in got if r.source == s) - target[s]) <= largest


def test_targets_are_met(docs):
    rows = [(i, prose(i, 5 + i % 60), "en", [None, "a", "b", "é", "c"][i % 7 % 5]) for i in range(900)]
    df = docs(rows)
    got = mixing.mix(df).collect()
    check(got, rows)
    assert rows_of(mixing.mix(df.repartition(5)), "doc_id", "taken") == sorted(((r.doc_id, r.taken) for r in got), key=repr)
    taken = mixing.take(df)
    assert taken.columns == df.columns
    assert taken.count() == sum(r.copies for r in got)


def test_odd_rows(docs, odd_rows):
    df = docs([r for r in odd_rows if r[0] not in (4, 5, 6)], clash=True)
    assert mixing.mix(df).count() == len(odd_rows) - 3
    assert mixing.take(df).columns == df.columns
    assert all(r.taken == 0 for r in mixing.mix(df).where(F.col("size") == 0).collect())


def test_empty(docs):
    assert mixing.mix(docs([])).count() == 0 and mixing.take(docs([])).count() == 0


def test_overlapping_sources(docs):
    rows = [(i, prose(i, 20), "en", "a") for i in range(200)]
    members = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    got = mixing.fit(docs(rows), weights={"a": 1, "b": 1}, members=members).copies(docs(rows)).collect()
    total = sum(r["__copies"] * r["__size"] for r in got)
    assert abs(total - 200 * 20) <= 60
