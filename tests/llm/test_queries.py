"""Registered queries and the pipeline on the smallest test tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paylater.llm import tables
from paylater.llm.queries import ORACLE_SQL, QUERIES
from paylater.oracle.check import compare_one, duck

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert compare_one(spark, duck(SF), name, QUERIES[name], ORACLE_SQL[name], SF)["status"] == "ok"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op13_filter_audit"}))
def test_query_covers_its_table(spark, name):
    out = QUERIES[name](spark, SF)
    table, key = {"op2": ("embeddings", "query_id"), "op8": ("pages", "page_id")}.get(
        name.split("_")[0], ("documents", "doc_id"))
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    rows = rows.where("vec_id % 100 = 0").select("vec_id") if table == "embeddings" else rows.select(key)
    assert {r[0] for r in out.select(key).collect()} == {r[0] for r in rows.collect()}


def test_line_dedup_and_fingerprints_run_no_python(spark):
    for name in ("op3_fingerprints", "op7_line_dedup", "op11_sharding"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.dtypes, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.dtypes == columns, name
        assert 0 < docs.count() <= before
        before = docs.count()
    out = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_deletes_spent_tables_and_keeps_odd_columns(spark, tmp_path):
    sf = str(tmp_path / "sf")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.withColumns({"line_counts": F.lit(3), "doc": F.lit("d")}).write.parquet(f"{sf}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{sf}/labels.parquet")
    with tables.tracked() as paths:
        out = corpus_pipeline.run(spark, sf)
    left = {os.path.basename(p).rpartition("-")[0] for p in paths if os.path.exists(p)}
    assert "stage-secret_scan" in left and not left & {"toxicity-examples", "shared-shingles", "stage-toxicity",
                                                       "stage-line_dedup", "stage-ngram_jaccard_join"}
    assert out.count() > 0
    cut = corpus_pipeline.drop_boilerplate(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    assert {r[0] for r in cut.select("line_counts").distinct().collect()} == {3}


def test_pipeline_on_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
