"""Registered data-quality queries. The DuckDB oracle is rendered from the same
check specs (labels and thresholds), with DuckDB computing every metric."""

from __future__ import annotations

from pyspark.sql import functions as F

from livepulse.operators import gold
from livepulse.operators import quality as Q
from livepulse.plans import profiles as P
from livepulse.plans.q_gold import s_clean
from livepulse.plans.q_transitions import e_transitions
from livepulse.plans.registry import query
from livepulse.plans.sqllib import block, sql
from livepulse.session import materialize

NATURAL = {"game_id": "game_name", "streamer_id": "user_name", "language_id": "language"}


def _lit(v):
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def render(table: str, source: str, checks, colmap=None) -> str:
    """DuckDB SELECTs (UNION ALL) producing the result rows of ``checks`` on ``source``."""
    colmap = colmap or {}
    m = lambda c: colmap.get(c, c)
    out = []
    for c in checks:
        if isinstance(c, Q.Check):
            expr = {
                "row_count": "count(*)",
                "missing_count": f"count(*) FILTER (WHERE {m(c.column)} IS NULL)" if c.column else "",
                "min": f"min({m(c.column)})", "max": f"max({m(c.column)})",
                "invalid_count": (f"count(*) FILTER (WHERE {m(c.column)} IS NOT NULL AND {m(c.column)} NOT IN ("
                                  + ", ".join(_lit(v) for v in c.valid_values) + "))") if c.column else "",
                "failed_rows": f"count(*) FILTER (WHERE coalesce({c.condition}, false))",
            }[c.metric]
            v = f"CAST({expr} AS DOUBLE)"
            out.append(f"SELECT {_lit(table)} AS \"table\", {_lit(c.label())} AS \"check\", {_lit(c.metric)} AS metric, "
                       f"{_lit(c.column)} AS \"column\", {v} AS value, "
                       f"coalesce({v} {c.op} {float(c.threshold)}, false) AS passed FROM {source}")
        elif isinstance(c, Q.Duplicates):
            cols = ", ".join(m(x) for x in c.columns)
            v = f"CAST((SELECT count(*) FROM (SELECT {cols} FROM {source} GROUP BY {cols} HAVING count(*) > 1)) AS DOUBLE)"
            out.append(f"SELECT {_lit(table)} AS \"table\", {_lit(c.label())} AS \"check\", "
                       f"'duplicate_count' AS metric, {_lit(', '.join(c.columns))} AS \"column\", "
                       f"{v} AS value, {v} = 0 AS passed")
    return "\nUNION ALL\n".join(out)


# --- silver streams (profile E) ----------------------------------------------------

@query("dq_snapshots", sql(render("streams", "e_silver", Q.silver_stream_checks()), "e_silver"))
def q_dq_snapshots(spark, sf):
    return Q.run_checks("streams", P.e_silver(spark, sf), Q.silver_stream_checks())


@query("dq_invalid", sql(render("stream_transitions", "e_transitions", Q.transition_checks()) + "\nUNION ALL\n"
                         + render("stream_tags", "e_tags", Q.tag_checks()), "e_transitions", "e_tags"))
def q_dq_invalid(spark, sf):
    t = Q.run_checks("stream_transitions", e_transitions(spark, sf), Q.transition_checks())
    g = Q.run_checks("stream_tags", P.e_tags(spark, sf), Q.tag_checks())
    return t.unionByName(g)


# --- gold (profile S) -------------------------------------------------------------

block("s_fact_partials", ("s_clean",), """
SELECT game_name, user_name, language, CAST(year AS BIGINT) * 10000 + month * 100 + day AS date_id,
       ingestion_hour AS time_hour, CAST(max(viewer_count) AS BIGINT) AS max_viewers,
       CAST(sum(viewer_count) AS DOUBLE) AS sum_viewers, count(viewer_count) AS count_observations
FROM s_clean GROUP BY game_name, user_name, language, date_id, time_hour, CAST(stream_id AS BIGINT) % 2""")

PARTIAL_CHECKS = [Q.Duplicates(("game_id", "date_id", "streamer_id", "language_id", "time_hour"))]


def _partials(spark, sf):
    clean = s_clean(spark, sf)
    parity = F.col("stream_id").cast("long") % 2
    return gold.fact_hourly(clean.where(parity == 0)).unionByName(gold.fact_hourly(clean.where(parity == 1)))


@query("dq_duplicates", sql(render("fact_partials", "s_fact_partials", PARTIAL_CHECKS, NATURAL) + "\nUNION ALL\n"
                            + render("fact_stream_hourly_final", "s_fact", PARTIAL_CHECKS, NATURAL),
                            "s_fact_partials", "s_fact"))
def q_dq_duplicates(spark, sf):
    """Partial hourly rows share keys (why the summing merge is needed); merged rows do not."""
    partials = _partials(spark, sf)
    return (Q.run_checks("fact_partials", partials, PARTIAL_CHECKS)
            .unionByName(Q.run_checks("fact_stream_hourly_final", gold.merge_fact(partials), PARTIAL_CHECKS)))


FACT_SIMPLE = [c for c in Q.fact_checks() if isinstance(c, Q.Check)]


@query("dq_failed_rows", sql(render("fact_stream_hourly_final", "s_fact", FACT_SIMPLE, NATURAL), "s_fact"))
def q_dq_failed_rows(spark, sf):
    fact = gold.merge_fact(gold.fact_hourly(s_clean(spark, sf)))
    return Q.run_checks("fact_stream_hourly_final", fact, FACT_SIMPLE)


# --- dimensions, with planted faults --------------------------------------------------

ORPHAN_KEYS = {"game_id": "dim_game", "date_id": "dim_date", "streamer_id": "dim_streamer", "language_id": "dim_language"}


def _orphan_sql(key: str, dim: str) -> str:
    natural = NATURAL.get(key, key)
    kept = " AND substr(game_name, 1, 1) NOT IN ('a', 'b', 'c')" if key == "game_id" else ""
    source = ("SELECT CAST(year AS BIGINT) * 10000 + month * 100 + day AS date_id FROM s_bronze" if key == "date_id"
              else f"SELECT {natural} FROM s_clean WHERE true{kept}")
    return (f"SELECT 'fact_stream_hourly_final' AS \"table\", '{key} known to {dim}' AS \"check\", 'orphans' AS metric, "
            f"'{key}' AS \"column\", CAST(count(*) AS DOUBLE) AS value, count(*) = 0 AS passed "
            f"FROM s_fact WHERE {natural} IS NULL OR {natural} NOT IN ({source})")


@query("dq_orphans", sql("\nUNION ALL\n".join(_orphan_sql(k, d) for k, d in ORPHAN_KEYS.items()),
                         "s_fact", "s_clean", "s_bronze"))
def q_dq_orphans(spark, sf):
    """Referential integrity of the merged fact against four dimensions, one of which lacks the
    rows of some games. The fact is computed once; dimensions come from it."""
    named = materialize(gold.fact_hourly(s_clean(spark, sf), keep_names=True))
    dims = gold.dimensions_of(named, P.s_games(spark, sf), P.CATALOGUE_ORDER)
    dims["dim_game"] = dims["dim_game"].where(~F.substring("game_name", 1, 1).isin("a", "b", "c"))
    return Q.run_checks("fact_stream_hourly_final", named, [c for c in Q.fact_checks(dims) if isinstance(c, Q.Orphans)])


block("f_dim_game", ("s_dim_game",), """
SELECT game_name AS game_id, CASE WHEN game_name LIKE 'b%' THEN NULL ELSE game_name END AS game_name,
       CASE WHEN game_name LIKE 'c%' THEN 101.0 WHEN game_name LIKE 'd%' THEN -1.0 ELSE total_rating END AS total_rating
FROM s_dim_game UNION ALL
SELECT game_name, game_name, total_rating FROM s_dim_game WHERE game_name LIKE 'a%'""")


@query("dq_dim_game", sql(render("dim_game_final", "f_dim_game", Q.dim_game_checks()), "f_dim_game"))
def q_dq_dim_game(spark, sf):
    """Rules of dim_game on a dimension with planted faults: repeated rows, null names, ratings out of range."""
    d = gold.dim_game(s_clean(spark, sf), P.s_games(spark, sf), P.CATALOGUE_ORDER)
    first = F.substring("game_name", 1, 1)
    faulty = d.select("game_id", F.when(first != "b", F.col("game_name")).alias("game_name"),
                      F.when(first == "c", 101.0).when(first == "d", -1.0).otherwise(F.col("total_rating")).alias("total_rating"))
    return Q.run_checks("dim_game_final", faulty.unionByName(
        d.where(first == "a").select("game_id", "game_name", "total_rating")), Q.dim_game_checks())


block("f_dim_date", ("s_bronze",), """
SELECT CASE WHEN month = 1 AND day = 1 AND year % 3 = 0 THEN NULL ELSE CAST(year AS BIGINT) * 10000 + month * 100 + day END AS date_id,
       CASE WHEN year % 3 = 1 THEN 13 ELSE month END AS date_month, CASE WHEN year % 3 = 2 THEN 0 ELSE day END AS date_day
FROM (SELECT DISTINCT year, month, day FROM s_bronze) UNION ALL
SELECT CAST(max(year) AS BIGINT) * 10000 + 101, 1, 1 FROM s_bronze""")


@query("dq_dim_date", sql(render("dim_date_final", "f_dim_date", Q.dim_date_checks()), "f_dim_date"))
def q_dq_dim_date(spark, sf):
    """Rules of dim_date with planted faults: null keys, a repeated last year, months of 13 and days of 0."""
    bronze = P.s_bronze(spark, sf)
    d, third = gold.dim_date(bronze), F.col("date_year") % 3
    faulty = d.select(
        F.when(~((F.col("date_month") == 1) & (F.col("date_day") == 1) & (third == 0)), F.col("date_id")).alias("date_id"),
        F.when(third == 1, 13).otherwise(F.col("date_month")).alias("date_month"),
        F.when(third == 2, 0).otherwise(F.col("date_day")).alias("date_day"))
    again = bronze.agg((F.max("year").cast("long") * 10000 + 101).alias("date_id")).select(
        "date_id", F.lit(1).alias("date_month"), F.lit(1).alias("date_day"))
    return Q.run_checks("dim_date_final", faulty.unionByName(again), Q.dim_date_checks())


def _name_dim_sql(key: str, name: str) -> str:
    return f"""
SELECT {name} AS {key}, CASE WHEN {name} LIKE 'A%' THEN NULL ELSE {name} END AS {name} FROM (SELECT DISTINCT {name} FROM s_clean)
UNION ALL SELECT {name}, {name} FROM (SELECT DISTINCT {name} FROM s_clean) WHERE {name} LIKE 'E%'
UNION ALL SELECT NULL, 'no key'"""


def _name_dim(dim, key, name):
    """Planted faults: names that begin with A are null, rows that begin with E are there twice, one row has no key."""
    first = F.substring(name, 1, 1)
    return (dim.select(key, F.when(first != "A", F.col(name)).alias(name))
            .unionByName(dim.where(first == "E").select(key, name))
            .unionByName(dim.sparkSession.range(1).select(F.lit(None).cast("long").alias(key), F.lit("no key").alias(name))))


block("f_dim_streamer", ("s_clean",), _name_dim_sql("streamer_id", "user_name"))
block("f_dim_language", ("s_clean",), _name_dim_sql("language_id", "language"))


@query("dq_dim_streamer", sql(render("dim_streamer_final", "f_dim_streamer", Q.dim_streamer_checks()), "f_dim_streamer"))
def q_dq_dim_streamer(spark, sf):
    return Q.run_checks("dim_streamer_final", _name_dim(gold.dim_streamer(s_clean(spark, sf)), "streamer_id", "user_name"),
                        Q.dim_streamer_checks())


@query("dq_dim_language", sql(render("dim_language_final", "f_dim_language", Q.dim_language_checks()), "f_dim_language"))
def q_dq_dim_language(spark, sf):
    return Q.run_checks("dim_language_final", _name_dim(gold.dim_language(s_clean(spark, sf)), "language_id", "language"),
                        Q.dim_language_checks())
