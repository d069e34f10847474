from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Names that operators use inside, as extra columns of the input.
CLASHING = ("hash", "n", "bucket", "part", "size", "key", "node", "root", "bytes", "shard", "words", "row", "digest", "k")


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text[, lang[, source]]) as a documents table."""

    def make(rows, clashing=False):
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or ""))[:5] for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if clashing:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit("x") for c in CLASHING})
        return df

    return make


@pytest.fixture
def sf_dir():
    return "/root/testdata/sf0.001"
