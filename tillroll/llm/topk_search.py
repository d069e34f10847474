"""Operator 1, exact top-k search: exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integer weights (terms are positions).  Queries and
candidates are dealt into blocks; every block pair is one task's work.  There the
candidates become postings, term by term, and each term of the query rows
scatters its weighted postings into a dense array of scores, one row per query.
A term that most candidates hold has postings for all of them, zeros included, which
are added without looking up places.  Each block pair keeps its k best per query, and
the partial lists are merged per query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.common import settle

K = 20
SCALE = 64
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
# Candidates whose scores are accumulated at a time; keeps them in cache.
STRIP = 512
# A term has postings for all candidates of a strip if at least this share holds it.
DENSE = 0.25


def integer_weights(vector: Column) -> Column:
    """floor(SCALE * x) of each component; null unless all are finite numbers.

    A component too great for a long is an error.
    """
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def weight(x: Column) -> Column:
        scaled = x.cast("double") * SCALE
        too_great = F.raise_error(F.lit("a component is too great for an integer weight")).cast("long")
        return F.when(F.abs(scaled) >= 2.0**63, too_great).otherwise(F.floor(scaled))

    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(vector, weight))


def _postings(rows: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Term -> (rows that hold it, their weights)."""
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    held = np.flatnonzero(flat)
    held = held[np.argsort(term[held], kind="stable")]
    cuts = np.flatnonzero(np.diff(term[held])) + 1
    return {int(term[at[0]]): (row[at], flat[at]) for at in np.split(held, cuts) if len(at)}


def scores(queries: list[np.ndarray], candidates: list[np.ndarray]) -> np.ndarray:
    """Integer inner products, queries by candidates; OverflowError if they could exceed a long."""
    left, right = _postings(queries), _postings(candidates)
    terms = sorted(left.keys() & right.keys())
    most = sum(float(np.abs(left[t][1].astype(float)).max()) * float(np.abs(right[t][1].astype(float)).max()) for t in terms)
    if most >= 2**63:
        raise OverflowError("inner products of these weights can exceed 64 bits")
    exact = np.float64 if most < 2**53 else np.int64
    out = np.zeros((len(queries), len(candidates)), exact)
    whole = {t: len(left[t][0]) == len(queries) for t in terms}
    for low in range(0, len(candidates), STRIP):
        strip = out[:, low : low + STRIP]
        for t in terms:
            (rows, weights), (columns, posted) = left[t], right[t]
            first, last = np.searchsorted(columns, [low, low + strip.shape[1]])
            at, posted = columns[first:last] - low, posted[first:last].astype(exact)
            weights = weights.astype(exact)[:, None]
            if len(at) < DENSE * strip.shape[1]:
                if len(at):
                    strip[np.ix_(rows, at)] += weights * posted
                continue
            line = np.zeros(strip.shape[1], exact)
            line[at] = posted
            if whole[t]:
                strip += weights * line
            else:
                strip[rows] += weights * line
    return out


def _best(k: int):
    columns = ["query_id", "query_key", "vec_id", "score"]

    def run(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(q) and len(c):
            c = c.sort_values(["vec_id", "key"])
            ids, keys = c["vec_id"].to_numpy(), c["key"].to_numpy()
            table = scores(list(q["weights"]), list(c["weights"]))
            for (query, key), row in zip(zip(q["vec_id"], q["key"]), table):
                own = np.flatnonzero((ids == query) & (keys == key))
                rest = np.delete(row, own)
                if not len(rest):
                    continue
                # Selection: everything at or above the k-th score, then in order.
                least = np.partition(rest, len(rest) - k)[len(rest) - k] if len(rest) > k else rest.min()
                at = np.flatnonzero(row >= least)
                at = at[~np.isin(at, own)]
                at = at[np.argsort(-row[at], kind="stable")][:k]  # ties: smaller vec_id, as c is sorted
                found.append(pd.DataFrame({"query_id": query, "query_key": key, "vec_id": ids[at], "score": row[at].astype(np.int64)}))
        return pd.concat(found) if found else pd.DataFrame({x: pd.Series(dtype=np.int64) for x in columns})

    return run


def search(vectors: DataFrame, is_query: Column, k: int = K, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """The k candidates of highest score for every query, ties to the smaller id.

    ``vectors`` has ``vec_id`` and ``weights`` (array of long, of any lengths;
    missing terms weigh 0); rows with a null in either take no part.  ``is_query``
    picks the queries; candidates are all rows but the query's own.  Returns
    ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``.

    Defined cases: rows equal in id and vector count once; rows with one id and
    different vectors are rows of their own, and such a query's lists share its
    id; fewer than k candidates give shorter lists; an empty table an empty result.
    """
    rows = settle(
        vectors.where("vec_id IS NOT NULL AND weights IS NOT NULL")
        .select("vec_id", "weights", F.xxhash64("weights").alias("key"))
        .groupBy("vec_id", "key", "weights")
        .agg(F.count(F.lit(1)).alias("copies")),
        "op1-vectors",
    )
    queries = rows.where(is_query)
    n, n_queries = rows.count(), queries.count()
    n_c, n_q = max(1, math.ceil(n / candidate_block)), max(1, math.ceil(n_queries / query_block))

    def blocks(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return df.select(
            "vec_id",
            "key",
            "weights",
            F.pmod(F.xxhash64(F.lit(1), "vec_id", "key"), F.lit(n_own)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))).alias(other),
        )

    left = blocks(queries, "qb", n_q, "cb", n_c).groupBy("qb", "cb")
    right = blocks(rows, "cb", n_c, "qb", n_q).groupBy("qb", "cb")
    partial = left.cogroup(right).applyInPandas(_best(k), "query_id long, query_key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
