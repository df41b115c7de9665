"""Registered queries against their oracle SQL, and the pipeline's stages."""

import pytest
from oracle import compare, duckdb_connection
from pyspark.sql import functions as F

import corpus_pipeline
from pitwall.llm import queries
from pitwall.llm.common import save


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, sf_small, name):
    assert compare(queries.QUERIES[name](spark, sf_small), duckdb_connection(sf_small), queries.ORACLE[name]) == []


def test_pipeline_stages(spark):
    from test_operators import LOWER, SCHEMA, corpus

    rows = corpus()
    docs = save(spark.createDataFrame(rows, SCHEMA), "test-pipeline")
    texts = {r[0]: r[1] or "" for r in rows}
    counts = [len(rows)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = save(stage(spark, docs, ""), name)
        assert docs.columns == [f.split()[0] for f in SCHEMA.split(", ")]
        counts.append(docs.count())
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert counts[1] < counts[0] and counts[2] <= counts[1] and counts[3] < counts[2] and counts[4] == counts[3]
    lowered = [t.translate(LOWER) for t in kept.values()]
    assert len(set(lowered)) == len(lowered)
    assert all(len(t.split()) >= 20 or "[SECRET]" in t for t in kept.values())
    assert all(t == texts[i] or "[SECRET]" in t for i, t in kept.items())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    per_doc = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert {r.doc_id for r in per_doc} == set(kept) and all(r.n == r.m for r in per_doc)


def test_pipeline_of_nothing(spark):
    docs = save(spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint"), "none")
    for name, stage in corpus_pipeline.STAGES:
        docs = save(stage(spark, docs, ""), name)
    assert docs.count() == 0
