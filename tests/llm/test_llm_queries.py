"""The registered queries on the smallest tables, beside their SQL, and the pipeline stage by stage."""

import corpus_pipeline
import pytest

import __spark_entry__ as E
from corpora.compare import connect, differences
from leafmill.llm.checks import CHECKS
from leafmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_registry():
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(CHECKS) <= set(E.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_against_sql(spark, name):
    assert differences(spark, connect(SF), SF, name) == []


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.keep(stage(spark, docs, SF), "test-pipeline")
        assert docs.columns == columns
        assert name == "mixing" or docs.count() <= rows
        rows = docs.count()
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.collect())
    assert {r.shard for r in got} <= set(range(24))


def test_stages_on_odd_rows(spark, docs, odd_rows):
    df = docs([r for r in odd_rows if r[0] not in (4, 5)], clash=True)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, SF).columns == df.columns
        assert stage(spark, df.limit(0), SF).count() == 0
    kept = corpus_pipeline.one_of_each_group(spark, df, SF)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 6, 7, 8, 9, 10, 11]
