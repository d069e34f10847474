"""The registered queries, next to their SQL or a plain version, and the pipeline."""

from __future__ import annotations

import os
import subprocess
import sys

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillroll.llm import queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_all_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, key):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = queries.QUERIES[key](spark, sf_dir)
    cur = con.execute(queries.ORACLE_SQL[key])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, cur.fetchall()))


def test_near_dedup_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op3_near_dedup"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(brute.near(docs))


def test_piece_query(spark, sf_dir):
    from tillroll.llm.piece_tokens import Vocabulary

    vocabulary = Vocabulary.load()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = queries.QUERIES["op6_piece_tokens"](spark, sf_dir).join(docs.withColumn("sha", F.sha2("text", 256)), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.text_sha256 == r.sha and r.n_tokens == len(r.ids)
        if len(r.text) < 1500:
            assert list(r.ids) == brute.segment(vocabulary, r.text)


@pytest.mark.parametrize("key", ["op4_source_mix", "op5_toxicity", "op7_language_id", "op10_sharding"])
def test_one_row_per_document(spark, sf_dir, key):
    df = queries.QUERIES[key](spark, sf_dir)
    assert df.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    rows = docs.collect()
    # Language: texts without a letter go.
    docs = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir)
    want = [r for r in rows if any(c.isalpha() for c in r.text or "")]
    assert docs.columns == columns and sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in want)
    # Exact copies: one stays.
    docs = corpus_pipeline.STAGES[1][1](spark, docs, sf_dir)
    kept = {x[0] for x in brute.exact([(r.doc_id, r.text) for r in want]) if x[3]}
    want = [r for r in want if r.doc_id in kept]
    assert docs.columns == columns and sorted(r.doc_id for r in docs.collect()) == sorted(kept)
    # Near copies: the smallest id of each class stays.
    docs = corpus_pipeline.STAGES[2][1](spark, docs, sf_dir)
    kept = {c for _, c, _ in brute.near([(r.doc_id, r.text) for r in want])}
    want = {r.doc_id: r for r in want if r.doc_id in kept}
    assert docs.columns == columns and sorted(r.doc_id for r in docs.collect()) == sorted(want)
    # The mix repeats or drops whole documents.
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, sf_dir).collect()
    assert all(tuple(r) == tuple(want[r.doc_id]) for r in mixed)
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in mixed)


def test_entry_without_the_subpackage(tmp_path):
    """The rest imports, and its queries are there, when these folders are gone."""
    for name in ("__spark_entry__.py", "bench.py"):
        (tmp_path / name).write_text(open(f"{ROOT}/{name}").read())
    copy = tmp_path / "tillroll"
    for folder, _, files in os.walk(f"{ROOT}/tillroll"):
        if "llm" in folder.split(os.sep) or "__pycache__" in folder:
            continue
        own = copy / os.path.relpath(folder, f"{ROOT}/tillroll")
        own.mkdir(exist_ok=True)
        for f in files:
            (own / f).write_bytes(open(f"{folder}/{f}", "rb").read())
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)
