"""The registered queries and the pipeline over the smallest tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import difference, duck
from entigrid.llm.common import prepare
from entigrid.llm.oracle import ORACLE
from entigrid.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), duck(SF), ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_every_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES[name](spark, SF)
    assert got.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_native_queries_run_no_python(spark):
    for name in ("op3_secrets", "op8_sharding"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "decontamination", "secrets", "packing"]
    rows = corpus_pipeline.run(spark, SF).select("doc_id", "sequence_id", "offset", "length").collect()
    assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}
    assert len({r.doc_id for r in rows}) > 0.7 * docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in v) <= 1024 for v in by.values())


def test_stages_take_empty_tables(spark):
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        assert stage is corpus_pipeline.pack or out.columns == docs.columns
