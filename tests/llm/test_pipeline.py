"""The corpus pipeline on the smallest tables."""

import os

import pytest

import corpus_pipeline
from brevia.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_stages_keep_columns_and_only_shrink(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = corpus_pipeline.scratch_path(spark, "test-stage")
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and now <= ids and len(now) >= 0.5 * len(ids), name
        ids = now
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in last.collect()} == ids


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_rows_of_null_and_repeated_ids_are_judged_by_their_text(spark, table):
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").where("length(text) > 60").first().text
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    leaks = [(None, item), (None, a), (7, item), (7, b)]
    found = corpus_pipeline.benchmark_leaks(spark, table(leaks), FOLDER).collect()
    assert sorted((str(r.doc_id), r.text) for r in found) == [("7", b), ("None", a)]
    rows = [(None, a), (None, a), (7, b), (7, b), (7, a + " more"), (9, b), (None, b), (3, ""), (None, ""), (None, "")]
    docs = table(rows)
    found = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert found.columns == docs.columns
    got = sorted((str(r.doc_id), r.text) for r in found.collect())
    assert got == sorted([("7", b), ("7", a + " more"), ("3", ""), ("None", ""), ("None", "")])
