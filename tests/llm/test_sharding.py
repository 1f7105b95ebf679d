import zlib

from llm_data import prose, rows_of

from leafmill.llm import sharding


def check(result, rows, shards):
    got = [r.asDict() for r in result.collect()]
    expected = sorted(((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == expected
    for k in {r["shard"] for r in got}:
        assert 0 <= k < shards
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))
    return got


def test_odd_rows(docs, odd_rows):
    got = check(sharding.shard(docs(odd_rows, clash=True), 4), odd_rows, 4)
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def test_empty(docs):
    assert sharding.shard(docs([])).count() == 0


def test_even_bytes_with_a_hot_text(docs):
    rows = [(i, "the same text of a third of all rows" if i % 3 == 0 else prose(i, i % 90)) for i in range(3000)]
    df = docs(rows)
    got = check(sharding.shard(df, 8, ranges_per_shard=4, cell_rows=100), rows, 8)
    bytes_ = [sum(r["size"] for r in got if r["shard"] == k) for k in range(8)]
    assert max(bytes_) - min(bytes_) <= 2 * max(r["size"] for r in got)
    again = sharding.shard(df.repartition(3), 8, ranges_per_shard=4, cell_rows=100)
    assert rows_of(again, "doc_id", "shard", "slot") == sorted(((r["doc_id"], r["shard"], r["slot"]) for r in got), key=repr)


def test_range_of_matches_bisection(spark):
    from bisect import bisect_right

    from pyspark.sql import functions as F

    cuts = sorted((i * 7919) % 10_007 for i in range(131))
    rows = spark.range(0, 10_007, 13).select("id", sharding.range_of(F.col("id"), cuts).alias("r")).collect()
    assert all(r.r == bisect_right(cuts, r.id) for r in rows)
