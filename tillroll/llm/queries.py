"""Query keys of the operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    exact_dedup,
    fingerprints,
    language_id,
    license_scan,
    near_dedup,
    piece_tokens,
    sharding,
    source_mix,
    structure_repair,
    suffix_dedup,
    token_alignment,
    topk_search,
    toxicity,
)
from tillroll.llm.common import read_table
from tillroll.llm.licenses import KNOWN, PHRASES, SPELLINGS
from tillroll.llm.oracles import FINGERPRINTS, STRUCTURE_REPAIR


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", topk_search.integer_weights(F.col("embedding")).alias("weights")
    )
    found = topk_search.search(vectors, F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source_mix.taken(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "source")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op6_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_tokens.encode(read_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs)).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(read_table(spark, sf_dir, "documents"))
    return rows.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair.repaired_damage(read_table(spark, sf_dir, "conversations"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.link_counts(read_table(spark, sf_dir, "documents"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.beside_next(read_table(spark, sf_dir, "documents"))
    return rows.join(fingerprints.neighbours(rows), "fingerprint").select(*rows.columns, "n_near")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk_search": op1_topk_search,
    "op2_license_scan": op2_license_scan,
    "op3_near_dedup": op3_near_dedup,
    "op4_source_mix": op4_source_mix,
    "op5_toxicity": op5_toxicity,
    "op6_piece_tokens": op6_piece_tokens,
    "op7_language_id": op7_language_id,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_sharding": op10_sharding,
    "op11_structure_repair": op11_structure_repair,
    "op12_token_alignment": op12_token_alignment,
    "op13_fingerprints": op13_fingerprints,
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LICENSE_SQL = r"""
WITH known(license_id, text) AS (VALUES {KNOWN}),
units AS (
    SELECT 1 AS kind, CAST(doc_id AS BIGINT) AS doc_id, CAST(NULL AS VARCHAR) AS license_id, text FROM documents
    UNION ALL
    SELECT 2, doc_id, NULL, unnest(string_split(text, chr(10))) FROM documents
    UNION ALL
    SELECT 3, NULL, license_id, text FROM known
), lines AS (
    SELECT kind, doc_id, license_id, string_split(lower(coalesce(text, '')), chr(10)) AS every,
           list_filter(every, lambda x: NOT regexp_matches(x, '{COPYRIGHT}')) AS kept
    FROM units
), worded AS (
    SELECT kind, doc_id, license_id, false AS whole, kept AS own FROM lines
    UNION ALL
    SELECT kind, doc_id, license_id, true, every FROM lines WHERE kind <> 2
), spelled AS (
    SELECT kind, doc_id, license_id, whole, array_to_string(list_transform(
               string_split(trim(regexp_replace(array_to_string(own, chr(10)), '[^a-z0-9\x80-\x{10FFFF}]+', ' ', 'g')), ' '),
               lambda w: coalesce(MAP {SPELLINGS}[w], w)), ' ') AS words
    FROM worded
), forms AS (
    SELECT kind, doc_id, license_id, whole, trim({PHRASES}) AS form FROM spelled
), digests AS (
    SELECT kind, doc_id, license_id, whole, CASE WHEN form <> '' THEN md5(form) END AS digest FROM forms
), registry AS (
    SELECT digest, min(license_id) AS known_id FROM digests WHERE kind = 3 AND digest IS NOT NULL GROUP BY digest
), found AS (
    SELECT d.doc_id, d.kind, d.whole, d.digest, r.known_id FROM digests d LEFT JOIN registry r USING (digest) WHERE d.kind < 3
)
SELECT doc_id,
       max(digest) FILTER (WHERE kind = 1 AND NOT whole) AS text_digest,
       coalesce(max(known_id) FILTER (WHERE kind = 1 AND NOT whole), max(known_id) FILTER (WHERE kind = 1 AND whole)) AS license_id,
       coalesce(string_agg(DISTINCT known_id, ',' ORDER BY known_id) FILTER (WHERE kind = 2), '') AS notices,
       count(known_id) FILTER (WHERE kind = 2) AS n_notices
FROM found GROUP BY doc_id
"""


def _phrases_sql() -> str:
    out = "' ' || words || ' '"
    for phrase, same in PHRASES.items():
        out = f"replace({out}, ' {phrase} ', ' {same} ')"
    return out


ORACLE_SQL: dict[str, str] = {
    "op1_topk_search": """
WITH e AS (
    SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS term
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), w AS (
    SELECT vec_id, term, CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) AS weight FROM e
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.weight * c.weight) AS BIGINT) AS score
    FROM w q JOIN w c ON q.term = c.term AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0
    GROUP BY ALL
), r AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM s
)
SELECT * FROM r WHERE rank <= 20
""",
    "op2_license_scan": _LICENSE_SQL.replace(
        "{SPELLINGS}", "{" + ", ".join(f"'{a}': '{b}'" for a, b in SPELLINGS.items()) + "}"
    )
    .replace("{COPYRIGHT}", license_scan.COPYRIGHT)
    .replace("{PHRASES}", _phrases_sql())
    .replace("{KNOWN}", ", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in KNOWN)),
    "op3_near_dedup": r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(words) - 3, 2)),
                                                  lambda i: array_to_string(words[i:i + 4], ' '))) AS shingle
    FROM w WHERE len(words) > 0
), n AS (
    SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE shared >= 0.8 * (x.size + y.size - shared) - 1e-9
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT a AS doc_id, min(b) AS class_id, (SELECT count(*) FROM links l WHERE l.a = reached.a) AS n_links
FROM reached GROUP BY a
""",
    "op8_exact_dedup": r"""
WITH t AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
), w AS (
    SELECT doc_id, norm,
           first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
           count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) AS place
    FROM t
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM w
""",
    "op9_suffix_dedup": """
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents
), blocks AS (
    SELECT doc_id, b, substr(hx, CAST(2 * b + 1 AS BIGINT), 298) AS piece
    FROM (SELECT doc_id, hx, unnest(range(0, length(hx) // 2 - 49, 100)) AS b FROM d WHERE length(hx) >= 100)
), g AS (
    SELECT doc_id, b + j AS i, substr(piece, CAST(2 * j + 1 AS BIGINT), 100) AS s
    FROM (SELECT doc_id, b, piece, unnest(range(0, length(piece) // 2 - 49)) AS j FROM blocks)
), f AS (
    SELECT s, min(doc_id) AS first_id FROM g GROUP BY s
), starts AS (
    SELECT g.doc_id, g.i FROM g JOIN f ON g.s = f.s WHERE f.first_id < g.doc_id
), marked AS (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh
    FROM starts
), numbered AS (
    SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked
), runs AS (
    SELECT doc_id, run, min(i) AS low, max(i) + 50 AS high FROM numbered GROUP BY ALL
), gaps AS (
    SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS open_at FROM runs
), cut AS (
    SELECT d.doc_id, CAST(sum(high - low) AS BIGINT) AS n_removed, count(*) AS n_spans,
           string_agg(substr(hx, CAST(2 * open_at + 1 AS BIGINT), CAST(2 * (low - open_at) AS BIGINT)), '' ORDER BY low)
               || substr(any_value(hx), CAST(2 * max(high) + 1 AS BIGINT)) AS kept
    FROM gaps JOIN d ON gaps.doc_id = d.doc_id GROUP BY d.doc_id
)
SELECT d.doc_id, CAST(length(hx) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, hx))) AS kept_sha256
FROM d LEFT JOIN cut ON d.doc_id = cut.doc_id
""",
    "op11_structure_repair": STRUCTURE_REPAIR,
    "op13_fingerprints": FINGERPRINTS.replace("{RADIUS}", str(fingerprints.RADIUS)),
}
