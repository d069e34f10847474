"""The corpus pipeline: documents through five of the training-data operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents.  Empty tables give empty results, and further columns,
whatever their names, are passed on.  ``run`` writes each stage's result below
``spark.checkpoint.dir`` and reads it back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import exact_dedup, language_id, near_dedup, piece_tokens, source_mix
from tillroll.llm.common import read_table, settle


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents without a recognisable language go.

    Those are null, empty and blank texts and texts without a letter; all rows, if no
    row has a language to learn from.
    """
    return language_id.keep_known(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of equal texts (white space aside) one document stays; of repeated rows one."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of each class of near copies the document with the smallest id stays.

    Rows without words or without an id are in no class; they stay.
    """
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents as often as the mix of sources takes them; rows without words go.

    A null source is a source like others, after them.
    """
    return source_mix.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the ids of each document, and the digest of the text they decode to.

    Every row of the input has one in the result; null and empty texts have no ids.
    """
    return piece_tokens.encode(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("piece_tokens", encode_pieces),
]

# Language prediction and tokenizing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
