"""Registered queries of this subpackage and their DuckDB SQL.

Each query applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (best_fit_packing, decontaminate, divergence, exact_dedup, lm_score, near_join, quality, sharding,
               token_files, tool_calls, toxicity, vector_codes, warc)
from .common import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.jaccard_groups(table(spark, sf_dir, "documents"), n=5, threshold=0.8)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_index(table(spark, sf_dir, "documents"), end_id=2)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, "quality", learn=~quality.held_out(F.col("doc_id"), 5, 0))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_corpus(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    examples = toxicity.fit(docs, labels, "toxic", learn=~quality.held_out(F.col("doc_id"), 4, 2))
    return toxicity.score(docs, examples).select(
        "doc_id", quality.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "neighbours", "cosines")


#: Tools that the turns of a conversation stand for in op7, and their schemas.
TURN_SCHEMAS = {name: {"type": "object", "required": ["text"], "additionalProperties": False,
                       "properties": {"text": {"type": "string", "minLength": 1}}} for name in ("system", "user")}


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn that is not the assistant's (a null role is no tool known) is a call (tool: its
    role, argument: its text) that depends on the opening turn; an assistant turn is the result of the turn before it."""
    turns = table(spark, sf_dir, "conversations")
    name = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    calls = turns.filter("not role <=> 'assistant'").select(
        "conv_id", "turn", name(F.col("turn")).alias("call_id"), F.col("role").alias("name"),
        F.to_json(F.struct("text")).alias("arguments"),
        F.when(F.col("turn") > 0, F.array(name(F.lit(0)))).otherwise(F.array().cast("array<string>")).alias("depends_on"))
    results = turns.filter("role = 'assistant'").select("conv_id", "turn", name(F.col("turn") - 1).alias("call_id"),
                                                        F.col("text").alias("content"))
    return tool_calls.link_calls(calls, results, TURN_SCHEMAS)


OP7_SQL = """
WITH c AS (SELECT conv_id, turn, 'c' || conv_id || '-' || turn AS call_id, role, text,
                  turn > 0 AND NOT EXISTS (SELECT 1 FROM conversations o WHERE o.conv_id = x.conv_id AND o.turn = 0
                                           AND o.role <> 'assistant') AS missing
           FROM conversations x WHERE role <> 'assistant'),
r AS (SELECT conv_id, turn, 'c' || conv_id || '-' || (turn - 1) AS call_id, text FROM conversations WHERE role = 'assistant'),
j AS (SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
             CASE WHEN c.call_id IS NULL THEN NULL WHEN c.turn > 0 AND NOT c.missing THEN 1 ELSE 0 END AS level,
             coalesce(c.turn, r.turn) AS turn, CASE WHEN c.call_id IS NULL THEN 0 ELSE 1 END AS copies,
             c.call_id IS NOT NULL AND r.call_id IS NOT NULL AS linked, c.call_id IS NOT NULL AS is_call, c.role, c.text,
             r.call_id IS NOT NULL AS has_result, r.text AS result, c.missing,
             list_filter([CASE WHEN c.call_id IS NULL THEN 'result without a call' END,
                          CASE WHEN c.call_id IS NOT NULL AND c.text IS NULL THEN 'arguments.text: missing' END,
                          CASE WHEN c.text = '' THEN 'arguments.text: breaks minLength' END,
                          CASE WHEN c.missing THEN 'missing dependency c' || c.conv_id || '-0' END],
                         lambda v: v IS NOT NULL) AS problems
      FROM c FULL JOIN r ON c.conv_id = r.conv_id AND c.call_id = r.call_id),
l AS (SELECT *, CASE WHEN is_call THEN
        '{"arguments":{' || CASE WHEN text IS NULL THEN '' ELSE '"text":' || CAST(to_json(text) AS VARCHAR) END || '},"call_id":' || CAST(to_json(call_id) AS VARCHAR)
        || ',"depends_on":[' || CASE WHEN turn > 0 THEN CAST(to_json('c' || conv_id || '-0') AS VARCHAR) ELSE '' END || '],"name":' || CAST(to_json(role) AS VARCHAR)
        || ',"problems":' || CAST(to_json(problems) AS VARCHAR) || CASE WHEN has_result THEN ',"result":' || coalesce(CAST(to_json(result) AS VARCHAR), 'null') ELSE '' END || '}'
      ELSE '{"call_id":' || CAST(to_json(call_id) AS VARCHAR) || ',"problems":' || CAST(to_json(problems) AS VARCHAR) || ',"result":' || coalesce(CAST(to_json(result) AS VARCHAR), 'null') || '}'
      END AS line FROM j)
SELECT conv_id, call_id, level, turn, copies, linked, len(problems) = 0 AS valid, line,
       row_number() OVER (PARTITION BY conv_id ORDER BY level IS NULL, level, turn, call_id, line) - 1 AS place
FROM l"""


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack(table(spark, sf_dir, "documents"), capacity=2048, end_id=0)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="max")


#: ASCII lower-casing as SQL: translate() maps A-Z only.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5_SQL = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)"""



def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


OP11_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
b AS (SELECT page_id, h, strlen(h) AS payload_bytes, max(page_id) OVER (PARTITION BY h) AS best FROM p)
SELECT page_id, payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN best END AS refers_to
FROM b"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_digest(table(spark, sf_dir, "embeddings"))


def _op12_sql(rounds: int = 4) -> str:
    """Each round's assignment and codebook as CTEs of their own."""
    assigned = """a{r} AS MATERIALIZED (SELECT i, p, any_value(x) AS x, min(struct_pack(d := d, e := e)) AS best
      FROM (SELECT q.i, q.p, q.x, c.e, list_sum(list_transform(list_zip(q.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
            FROM parts q JOIN c{r} c ON c.p = q.p) GROUP BY i, p)"""
    moved = """c{n} AS MATERIALIZED (SELECT c.p, c.e, coalesce(s.x, c.x) AS x FROM c{r} c LEFT JOIN (
      SELECT p, e, list(floor(total / n)::BIGINT ORDER BY pos) AS x FROM (
        SELECT p, best.e AS e, u.pos, sum(x[u.pos])::DOUBLE AS total, count(*) AS n
        FROM a{r}, (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM parts))) AS pos) u GROUP BY ALL) GROUP BY p, e) s
      ON s.p = c.p AND s.e = c.e)"""
    steps = [step for r in range(rounds) for step in (assigned.format(r=r), moved.format(r=r, n=r + 1))]
    return """
WITH ints AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS i FROM ints),
parts AS MATERIALIZED (SELECT i, p, v[(p * len(v) // 4 + 1):((p + 1) * len(v) // 4)] AS x FROM numbered, (SELECT unnest(range(4)) AS p)),
c0 AS MATERIALIZED (SELECT p, i AS e, x FROM parts WHERE i < 256),
""" + ",\n".join([*steps, assigned.format(r=rounds)]) + f""",
coded AS (SELECT i, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY i)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM c{rounds}) AS codebooks_sha256
FROM coded JOIN numbered USING (i)"""


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


OP13_SQL = f"""
WITH d AS MATERIALIZED (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
k AS MATERIALIZED (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 3),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS MATERIALIZED (SELECT lang, source, (SELECT count(*) FROM k WHERE k.lang = s.lang) AS v,
                          (SELECT coalesce(sum(n), 0) FROM c WHERE c.lang = s.lang AND c.source = s.source) AS total,
                          (SELECT coalesce(sum(n), 0) FROM c WHERE c.lang = s.lang) AS lang_total
                   FROM (SELECT DISTINCT lang, source FROM d) s),
t AS MATERIALIZED (SELECT g.lang, g.source, term, coalesce(n, 0) AS n,
                          1 + 1000000000::HUGEINT * (coalesce(n, 0) + 1) // (total + v) AS p,
                          1 + 1000000000::HUGEINT * (sum(coalesce(n, 0)) OVER (PARTITION BY g.lang, term) + 1) // (lang_total + v) AS q
                   FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
far AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p)::BIGINT AS value
        FROM t x JOIN t y USING (lang, term) WHERE x.source <> y.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM t WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM (FROM pairs UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= 200"""

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_decontamination": op2_decontamination,
    "op3_token_files": op3_token_files,
    "op4_sharding": op4_sharding,
    "op6_quality": op6_quality,
    "op7_tool_calls": op7_tool_calls,
    "op9_lm_score": op9_lm_score,
    "op10_toxicity": op10_toxicity,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op5_exact_dedup": op5_exact_dedup,
    "op11_warc": op11_warc,
    "op12_vector_codes": op12_vector_codes,
    "op13_source_divergence": op13_source_divergence,
}
ORACLES = {
    "op5_exact_dedup": OP5_SQL,
    "op7_tool_calls": OP7_SQL,
    "op11_warc": OP11_SQL,
    "op12_vector_codes": _op12_sql(),
    "op13_source_divergence": OP13_SQL,
}
