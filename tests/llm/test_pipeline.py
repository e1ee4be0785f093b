from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from millrace.llm.common import kept_in_files
from millrace.llm.oracle import ORACLE
from millrace.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def test_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    result = con.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    wanted = sorted(map(repr, result.fetchall()))
    got = QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert sorted(repr(tuple(r)) for r in got.select(*names).collect()) == wanted


def test_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for label, stage in corpus_pipeline.STAGES[:-1]:
        docs = kept_in_files(stage(spark, docs, DATA), "stage-test")
        assert docs.columns == names, label
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept <= ids and len(kept) > len(ids) / 2, label
        ids = kept
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert {r.doc_id for r in rows} == ids


def test_sequences_are_written_by_length(spark):
    rows = corpus_pipeline.run(spark, DATA)
    assert all(f"/length={r.length}/" in r.file for r in rows.selectExpr("length", "input_file_name() AS file").collect())
    assert rows.where("ids IS NULL OR size(ids) <> length").count() == 0
