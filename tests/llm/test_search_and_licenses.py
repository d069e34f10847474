"""Operators 1 and 2."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import license_scan, topk_search
from tillroll.llm.licenses import ISC, KNOWN, MIT


def plain_topk(rows, k, is_query):
    rows = sorted({(i, tuple(w)) for i, w in rows if i is not None and w is not None})
    out = []
    for q, w in rows:
        if is_query(q):
            found = [(-sum(a * b for a, b in zip(w, v)), c) for c, v in rows if (c, v) != (q, w)]
            out += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, weights array<long>")


@pytest.mark.parametrize("blocks", [(1024, 8192), (2, 7)])
def test_topk(spark, blocks):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0, 0, 0, 1, -2, 5]) for _ in range(rng.choice([0, 4, 6]))]) for i in range(60)]
    rows += [(3, rows[3][1]), (3, [9, 9]), (None, [1]), (70, None), (71, []), (80, [10**9] * 4), (100, [10**9] * 4)]
    got = topk_search.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, 5, *blocks).collect()
    assert sorted(map(tuple, got)) == plain_topk(rows, 5, lambda i: i % 20 == 0)


def test_large_weights_and_few_candidates(spark):
    rows = [(0, [2**31, 3]), (1, [2**31, -5]), (20, [1, 1])]
    got = topk_search.search(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got)) == plain_topk(rows, 20, lambda i: i % 20 == 0)
    assert topk_search.search(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_dense_and_sparse_terms_agree():
    rng = np.random.default_rng(3)
    q, c = rng.integers(-3, 4, (5, 90)), rng.integers(-3, 4, (40, 90))
    c[:, ::2] *= rng.random((40, 45)) < 0.05
    assert (topk_search.scores(list(q), list(c)) == q @ c.T).all()


def test_products_that_no_long_can_hold(spark):
    rows = [(0, [2**61, 2**61]), (1, [2**61, 1])]
    with pytest.raises(Exception, match="64 bits"):
        topk_search.search(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()
    df = spark.createDataFrame([(1, [1e30])], "vec_id long, v array<float>")
    with pytest.raises(Exception, match="too great"):
        df.select(topk_search.integer_weights(F.col("v"))).collect()
    many = np.random.default_rng(1).integers(-9, 9, (3, 1300))
    assert (topk_search.scores(list(many[:, :20]), list(many.T[:, :3])) == many[:, :20][:, :3] @ many.T[:, :3].T).all()


def test_integer_weights(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.01, 0.0]), (2, [nan]), (3, [inf]), (4, [None, 1.0]), (5, None), (6, [])]
    df = spark.createDataFrame(rows, "vec_id long, v array<float>")
    got = {r.vec_id: r.w for r in df.select("vec_id", topk_search.integer_weights(F.col("v")).alias("w")).collect()}
    assert got == {1: [32, -1, 0], 2: None, 3: None, 4: None, 5: None, 6: []}


def test_canonical_form():
    messy = "Copyright (c) 2020 Someone\nAll rights reserved.\n\n" + MIT.upper().replace(",", " ;").replace("SUBLICENSE", "Sublicence")
    assert license_scan.digest(messy) == license_scan.digest(MIT)
    assert license_scan.digest(MIT + " more") != license_scan.digest(MIT)
    assert license_scan.digest("(c) 1999 X\n\n") is None and license_scan.digest("--") is None


def test_scan(documents):
    rows = [
        (1, "Copyright 2001 A\n" + ISC),
        (2, "some text\nReleased under the MIT Licence!\nmore\nreleased under the mit license"),
        (3, None),
        (4, ""),
        (5, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0."),
        (5, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0."),
        (None, "Released under the MIT License."),
        (6, "x " * 50_000 + "\nReleased under the MIT License. Or not."),
    ]
    got = {(r.doc_id): (r.license_id, r.notices, r.n_notices) for r in license_scan.scan(documents(rows, clashing=True)).collect()}
    assert got == {
        1: ("ISC", "", 0),
        2: (None, "MIT", 2),
        3: (None, "", 0),
        4: (None, "", 0),
        5: (None, "Apache-2.0,CC-BY-NC-4.0", 2),
        None: ("MIT", "MIT", 1),
        6: (None, "", 0),
    }
    assert license_scan.scan(documents([])).count() == 0


def test_own_registry(spark, documents, monkeypatch):
    known = spark.createDataFrame([("b", "my text"), ("a", "My TEXT!"), (None, "x"), ("c", None)], "license_id string, text string")
    docs = documents([(1, "my, text"), (2, "x")])
    for limit in (100_000, 0):  # broadcast, then shuffled
        monkeypatch.setattr(license_scan, "BROADCAST_ROWS", limit)
        got = {r.doc_id: r.license_id for r in license_scan.scan(docs, known).collect()}
        assert got == {1: "a", 2: None}


def test_every_known_text_is_found(documents):
    rows = [(i, t) for i, (_, t) in enumerate(KNOWN)]
    got = {r.doc_id: r.license_id for r in license_scan.scan(documents(rows)).collect()}
    assert got == {i: name for i, (name, _) in enumerate(KNOWN)}
