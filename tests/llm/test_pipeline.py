"""The pipeline on the smallest tables, and on odd rows."""

import os

import duckdb
import pytest

import corpus_pipeline
from greenwave.llm import catalog, decontaminate, near_dedup
from tools.check_queries import rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = db.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    df = catalog.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names) and rows(df.columns, df.collect()) == rows(names, cur.fetchall())


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert sorted(out.columns) == sorted(columns)
        out.write.parquet(str(tmp_path / name.replace(" ", "-")))
        docs = spark.read.parquet(str(tmp_path / name.replace(" ", "-")))
        assert 0 < docs.count() <= kept
        kept = docs.count()
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert not decontaminate.contamination(docs, benchmark).where("contaminated").count()
    assert docs.select("doc_id").distinct().count() == kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == kept


def test_one_of_each_class_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    classes = near_dedup.classes(docs).select("class_id").distinct().count()
    assert near_dedup.keep_first(docs).count() == classes


def test_stages_take_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).collect()
