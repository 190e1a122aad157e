"""Registered catalogue-dashboard queries (profile S catalogue and snapshots)."""

from __future__ import annotations

from pyspark.sql import functions as F

from livepulse.operators import catalogue as G
from livepulse.operators.broadcasts import latest_snapshot
from livepulse.plans import profiles as P
from livepulse.plans.registry import query
from livepulse.plans.sqllib import block, lj, sql

TOP_N = 10
THEMES = ("red", "blue")
PLATFORMS = ("SMALL", "ECONOMY")

block("s_latest", ("s_silver",), """
SELECT * FROM s_silver WHERE ingestion_ts = (SELECT max(ingestion_ts) FROM s_silver)""")

block("s_rvp", ("s_latest_games", "s_latest"), """
SELECT g.game_name, g.total_rating, g.total_rating_count, v.current_viewers, v.live_streams
FROM s_latest_games g
JOIN (SELECT game_name, sum(viewer_count) AS current_viewers, count(*) AS live_streams
      FROM s_latest GROUP BY game_name) v ON g.game_name = v.game_name
WHERE g.total_rating IS NOT NULL""")

block("s_quadrants", ("s_rvp",), """
SELECT r.*, CASE
    WHEN total_rating >= m.mr AND current_viewers < m.mv THEN 'Hidden gem'
    WHEN total_rating >= m.mr AND current_viewers >= m.mv THEN 'Mainstream hit'
    WHEN total_rating < m.mr AND current_viewers >= m.mv THEN 'Overhyped'
    ELSE 'Niche' END AS quadrant
FROM s_rvp r CROSS JOIN (SELECT median(total_rating) AS mr, median(current_viewers) AS mv FROM s_rvp) m""")

block("s_rated", ("s_latest_games",), """
SELECT * FROM s_latest_games WHERE total_rating IS NOT NULL AND total_rating_count IS NOT NULL""")


def games(spark, sf):
    return G.latest_games(P.s_games(spark, sf), order=P.CATALOGUE_ORDER)


def merged(spark, sf):
    return G.rating_vs_popularity(games(spark, sf), latest_snapshot(P.s_silver(spark, sf)))


@query("latest_games", sql(f"""
SELECT game_id, game_name, ingestion_ts, total_rating, total_rating_count, {lj('keywords')} AS keywords
FROM s_latest_games""", "s_latest_games"))
def q_latest_games(spark, sf):
    return games(spark, sf).select("game_id", "game_name", "ingestion_ts", "total_rating", "total_rating_count",
                                   F.array_join("keywords", "|", "NULL").alias("keywords"))


@query("top_rated", sql(f"""
SELECT game_id, game_name, total_rating, total_rating_count, url FROM s_latest_games
WHERE total_rating IS NOT NULL AND total_rating_count >= 5
ORDER BY total_rating DESC, game_name ASC, game_id ASC LIMIT {TOP_N}""", "s_latest_games"))
def q_top_rated(spark, sf):
    return G.top_rated(games(spark, sf), TOP_N, 5)


def _freq_sql(col, alias):
    return sql(f"""
SELECT t.v AS {alias}, count(*) AS "count" FROM s_latest_games, unnest({col}) AS t(v)
WHERE t.v IS NOT NULL AND t.v <> ''
GROUP BY t.v ORDER BY "count" DESC, {alias} ASC LIMIT {TOP_N}""", "s_latest_games")


def _freq_query(col, alias):
    return lambda spark, sf: G.category_frequency(games(spark, sf), col, alias, TOP_N)


query("category_frequency", _freq_sql("themes", "theme"))(_freq_query("themes", "theme"))
for _col, _alias in G.CATEGORY_COLUMNS.items():
    if _col != "themes":
        query(f"category_frequency_{_col}", _freq_sql(_col, _alias))(_freq_query(_col, _alias))


@query("release_periods", sql("""
SELECT CAST(floor(year(first_release_date) / 5) * 5 AS INTEGER) AS period_start, count(*) AS games_released,
       CAST(CAST(floor(year(first_release_date) / 5) * 5 AS INTEGER) AS VARCHAR) || '–' ||
       CAST(CAST(floor(year(first_release_date) / 5) * 5 AS INTEGER) + 4 AS VARCHAR) AS period
FROM s_latest_games WHERE first_release_date IS NOT NULL GROUP BY ALL""", "s_latest_games"))
def q_release_periods(spark, sf):
    return G.release_periods(games(spark, sf), 5)


@query("rating_vs_popularity", sql("SELECT * FROM s_rvp", "s_rvp"))
def q_rating_vs_popularity(spark, sf):
    return merged(spark, sf)


@query("quadrants", sql("SELECT * FROM s_quadrants", "s_quadrants"))
def q_quadrants(spark, sf):
    return G.quadrants(merged(spark, sf))


@query("hidden_gems", sql(f"""
SELECT game_name, total_rating, current_viewers, live_streams FROM s_quadrants WHERE quadrant = 'Hidden gem'
ORDER BY total_rating DESC, game_name, current_viewers, live_streams LIMIT {TOP_N}""", "s_quadrants"))
def q_hidden_gems(spark, sf):
    return G.quadrant_top(G.quadrants(merged(spark, sf)), "Hidden gem", "total_rating", TOP_N)


@query("overhyped", sql(f"""
SELECT game_name, total_rating, current_viewers, live_streams FROM s_quadrants WHERE quadrant = 'Overhyped'
ORDER BY current_viewers DESC, game_name, total_rating, live_streams LIMIT {TOP_N}""", "s_quadrants"))
def q_overhyped(spark, sf):
    return G.quadrant_top(G.quadrants(merged(spark, sf)), "Overhyped", "current_viewers", TOP_N)


@query("games_kpis", sql("""
SELECT count(*) AS games_tracked,
       CASE WHEN count(*) = 0 THEN 0.0 ELSE round(count(igdb_id) * 100.0 / count(*), 6) END AS coverage_pct,
       round(avg(total_rating), 6) AS avg_rating,
       (SELECT game_name FROM s_latest_games WHERE total_rating_count IS NOT NULL
        ORDER BY total_rating_count DESC, game_name ASC LIMIT 1) AS most_reviewed,
       max(total_rating_count) AS most_reviewed_count
FROM s_latest_games""", "s_latest_games"))
def q_games_kpis(spark, sf):
    return G.games_kpis(games(spark, sf))


@query("rating_histogram", sql("""
SELECT bucket, round(lo + (bucket - 1) * (hi - lo) / 30, 6) AS bin_start,
       round(lo + bucket * (hi - lo) / 30, 6) AS bin_end, count(*) AS games
FROM (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((total_rating - lo) / ((hi - lo) / 30.0)) + 1, 30) END
                  AS INTEGER) AS bucket, lo, hi
      FROM s_rated CROSS JOIN (SELECT min(total_rating) AS lo, max(total_rating) AS hi FROM s_rated))
GROUP BY bucket, lo, hi""", "s_rated"))
def q_rating_histogram(spark, sf):
    return G.rating_histogram(games(spark, sf), 30)


@query("rating_log_points", sql("""
SELECT game_id, game_name, total_rating, round(log10(total_rating_count), 6) AS log_rating_count
FROM s_rated WHERE total_rating_count > 0""", "s_rated"))
def q_rating_log_points(spark, sf):
    return G.rating_log_points(games(spark, sf))


@query("list_facets", sql("""
SELECT DISTINCT 'themes' AS facet, t.v AS value FROM s_latest_games, unnest(themes) AS t(v) WHERE t.v IS NOT NULL
UNION ALL
SELECT DISTINCT 'platforms', t.v FROM s_latest_games, unnest(platforms) AS t(v) WHERE t.v IS NOT NULL""",
    "s_latest_games"))
def q_list_facets(spark, sf):
    return G.list_facets(games(spark, sf))


def _in(vals):
    return "[" + ", ".join(f"'{v}'" for v in vals) + "]"


@query("games_explorer", sql(f"""
SELECT game_id, game_name, total_rating, total_rating_count, {lj('themes')} AS themes,
       {lj('platforms')} AS platforms, {lj('game_modes')} AS game_modes
FROM s_latest_games
WHERE coalesce(list_has_any(themes, {_in(THEMES)}), false)
  AND coalesce(list_has_any(platforms, {_in(PLATFORMS)}), false)""", "s_latest_games"))
def q_games_explorer(spark, sf):
    out = G.explore(games(spark, sf), {"themes": THEMES, "platforms": PLATFORMS})
    return out.select("game_id", "game_name", "total_rating", "total_rating_count",
                      *[F.array_join(c, "|", "NULL").alias(c) for c in ("themes", "platforms", "game_modes")])
