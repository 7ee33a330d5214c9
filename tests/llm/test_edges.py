"""Every query and stage over every edge case: defined results, as many rows as came in, no crash."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

pytest.importorskip("loomspark.llm.queries")
from loomspark.llm import queries as Q  # noqa: E402

import corpus_pipeline as pipeline  # noqa: E402

from .conftest import SCHEMA, prose  # noqa: E402

DOCUMENT_QUERIES = [n for n in Q.queries() if n.split("_")[0] not in ("op10", "op12", "op13")]  # those have tests of their own
PER_ROW = [n for n in DOCUMENT_QUERIES if n != "op2_packing"]


def folder(spark, tables, docs):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (None, 1, 0), (9, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    return tables(documents=docs, labels=labels)


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_edges(spark, tables, edges, name):
    out = Q.queries()[name](spark, folder(spark, tables, edges)).collect()
    if name in PER_ROW:
        assert len(out) == edges.count()
    ids = sorted({r["doc_id"] for r in out if r["doc_id"] is not None})
    assert ids == list(range(1, 13))


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_empty(spark, tables, empty, name):
    assert Q.queries()[name](spark, folder(spark, tables, empty)).count() == 0


@pytest.mark.parametrize("stage", pipeline.STAGES, ids=lambda s: s[0])
def test_stage_edges(spark, edges, stage):
    name, f = stage
    out = f(spark, edges, "")
    if name != "packing":
        assert out.columns == edges.columns
        assert {r["_body"] for r in out.select("_body").collect()} <= {"own _body"}
    assert out.count() >= 5


@pytest.mark.parametrize("stage", pipeline.STAGES, ids=lambda s: s[0])
def test_stage_empty(spark, empty, stage):
    assert stage[1](spark, empty, "").count() == 0


def test_repeated_rows_and_nulls_per_stage(spark, edges):
    stages = dict(pipeline.STAGES)
    known = stages["language_id"](spark, edges, "")
    assert known.where("text IS NULL OR doc_id IN (2, 3, 6)").count() == 0 and known.where("doc_id = 4").count() == 2
    near = stages["near_dedup"](spark, edges, "")
    assert near.where("doc_id = 4").count() == 1 and near.where("doc_id IS NULL").count() == 1  # null text: a copy of the empty ones
    assert near.where("doc_id = 10").count() == 1 and near.where("doc_id = 11").count() == 0
    assert near.where("doc_id IN (1, 2, 3)").count() == 1
    texts = [(7, f"{prose(30, 700 + i)}") for i in range(10)] + [(None, prose(30, 700)), (None, prose(30, 900)), (None, prose(30, 900))]
    unlike = stages["near_dedup"](spark, spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], SCHEMA), "").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in unlike) == sorted([*texts[:10], (0, texts[11][1])])
    kept = stages["secret_scan"](spark, edges, "")
    assert kept.count() == edges.count() and kept.where("text IS NULL").count() == 2


def test_pipeline_runs(spark, tables, edges):
    out = pipeline.run(spark, folder(spark, tables, edges))
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_different_texts_under_one_id(spark, tables):
    """Rows that share an id are rows of their own in every query: each has its own result."""
    texts = [prose(40 + i, 60 + i) for i in range(6)] + [f'a{i}@b.example token = "{"0123456789abcdef" * 2}{i}"' for i in range(3)]
    docs = spark.createDataFrame([(5, t, "en", "s", 0) for t in texts] + [(None, t, "en", "s", 0) for t in texts], SCHEMA)
    sf = folder(spark, tables, docs)
    alone = {}
    for name in PER_ROW:
        out = Q.queries()[name](spark, sf).drop("score", "held_out", "component_id", "top_score").collect()
        assert len(out) == 18 and sum(r["doc_id"] is None for r in out) == 9
        by = [sorted((r.asDict() | {"doc_id": 0}).items(), key=str) for r in out]
        alone[name] = len({str(x) for x in by})
    assert alone["op5_bpe"] == alone["op3_line_dedup"] == alone["op7_pii"] == alone["op8_simhash"] == 9
    assert Q.op2_packing(spark, sf).count() == 18


def test_very_long_texts(spark, tables):
    """Half a million characters in each of several shapes."""
    n = 500_000
    texts = ["a" * n, "ab " * (n // 3), "é漢" * (n // 2), "\n" * n, "1" * n, " " * n, "x@y.z " * (n // 6), prose(60_000, 1), "a=\"b\" " * (n // 6)]
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else "fr", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    sf = folder(spark, tables, docs)
    for name in DOCUMENT_QUERIES:
        assert Q.queries()[name](spark, sf).select("doc_id").distinct().count() == len(texts), name
