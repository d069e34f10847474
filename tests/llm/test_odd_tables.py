"""Empty tables, and columns whose names operators use inside."""

from __future__ import annotations

import pytest
from conftest import CLASHING
from pyspark.sql import functions as F
from samples import odd_rows

import corpus_pipeline
from tillroll.llm import near_dedup, piece_tokens, source_mix, topk_search, toxicity


def test_empty_tables(spark, documents):
    empty = documents([])
    coded = piece_tokens.encode(empty)
    assert coded.count() == 0 and piece_tokens.decode(coded).count() == 0
    assert source_mix.mix(empty).count() == 0 and near_dedup.drop_near_copies(empty).count() == 0
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.train(empty, labels).scores(["any text"])[0] < 0.001


def test_clashing_columns(spark, documents):
    docs = documents(odd_rows(), clashing=True)
    near = near_dedup.drop_near_copies(docs)
    plain = near_dedup.drop_near_copies(documents(odd_rows()))
    assert near.columns == docs.columns
    assert sorted(map(str, near.select("doc_id", "text").collect())) == sorted(map(str, plain.select("doc_id", "text").collect()))
    coded = piece_tokens.encode(docs).withColumns({c: F.lit("x") for c in CLASHING if c != "text"})
    back = piece_tokens.decode(coded)
    assert set(CLASHING) <= set(back.columns) and back.where("text IS NULL").count() == 0
    vectors = [(i, [i, 2 * i, 3]) for i in range(30)]
    rows = spark.createDataFrame(vectors, "vec_id long, weights array<long>")
    wide = rows.withColumns({c: F.lit("x") for c in (*CLASHING, "term", "block", "score", "rank", "query_id")})
    got = [sorted(map(str, topk_search.search(df, F.col("vec_id") % 10 == 0).select("query_id", "rank", "vec_id", "score").collect())) for df in (rows, wide)]
    assert got[0] == got[1] and len(got[0]) == 60


@pytest.mark.parametrize("clashing", [False, True])
def test_pipeline_of_odd_tables(spark, documents, clashing):
    docs = documents(odd_rows(), clashing)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_after = stage(spark, docs, "")
        assert docs_after.columns == docs.columns
        docs = docs_after
    out = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    ids = {r.doc_id for r in out.collect()}
    assert ids and not ids & {7, 8, 9, 12}  # without words or letters


def test_pipeline_of_an_empty_table(spark, documents):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
