"""Registered broadcast-dashboard queries (profile E, latest poll = latest day)."""

from __future__ import annotations

from pyspark.sql import functions as F

from livepulse.operators import broadcasts as Fq
from livepulse.operators.selection import audience_by, exact_median, hourly_audience
from livepulse.plans import profiles as P
from livepulse.plans.q_transitions import e_transitions
from livepulse.plans.registry import query
from livepulse.plans.sqllib import block, sql
from livepulse.sources.tables import table

GRAIN = "day"          # profile E polls carry unique stamps; a "poll" is one day
AS_OF = "2024-01-15 12:00:00"
TOP_N = 10
GAMES = ("click", "view")
LANGUAGES = ("NATION_3", "NATION_7", "NATION_11")

block("e_latest", ("e_silver",), """
SELECT * FROM e_silver
WHERE date_trunc('day', ingestion_ts) = (SELECT max(date_trunc('day', ingestion_ts)) FROM e_silver)""")

block("e_online", ("e_silver", "e_latest"), """
SELECT s.*, CAST(round(avg(viewer_count) OVER (PARTITION BY stream_id ORDER BY ingestion_ts
                      ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) AS INTEGER) AS avg_viewers_10
FROM e_silver s WHERE stream_id IN (SELECT stream_id FROM e_latest)""")

block("e_top_streamers", ("e_online",), f"""
SELECT user_name, latest_viewer_count, peak_viewers, avg_viewers_10 FROM (
  SELECT user_name, viewer_count AS latest_viewer_count, avg_viewers_10,
         max(viewer_count) OVER (PARTITION BY user_name) AS peak_viewers,
         row_number() OVER (PARTITION BY user_name
                            ORDER BY viewer_count DESC, ingestion_ts DESC, stream_id DESC) AS rn
  FROM e_online) WHERE rn = 1
ORDER BY avg_viewers_10 DESC NULLS LAST, user_name ASC NULLS LAST LIMIT {TOP_N}""")


def silver(spark, sf):
    return P.e_silver(spark, sf)


def polls(spark, sf):
    """Poll times from the raw table alone: every event becomes a snapshot."""
    return table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ingestion_ts"))


def latest(spark, sf):
    return Fq.latest_snapshot(silver(spark, sf), grain=GRAIN, polls=polls(spark, sf))


def top(spark, sf):
    return Fq.top_streamers(silver(spark, sf), latest(spark, sf), TOP_N)


SNAP_COLS = ["stream_id", "user_name", "game_name", "viewer_count", "ingestion_ts"]


@query("latest_snapshot", sql(f"SELECT {', '.join(SNAP_COLS)} FROM e_latest", "e_latest"))
def q_latest_snapshot(spark, sf):
    return latest(spark, sf).select(*SNAP_COLS)


@query("snapshot_asof", sql(f"""
SELECT {', '.join(SNAP_COLS)} FROM e_silver
WHERE date_trunc('day', ingestion_ts) = (
  SELECT coalesce(max(CASE WHEN ingestion_ts <= TIMESTAMP '{AS_OF}' THEN date_trunc('day', ingestion_ts) END),
                  min(date_trunc('day', ingestion_ts))) FROM e_silver)""", "e_silver"))
def q_snapshot_asof(spark, sf):
    return Fq.snapshot_asof(silver(spark, sf), AS_OF, grain=GRAIN, polls=polls(spark, sf)).select(*SNAP_COLS)


@query("top_games", sql(f"""
SELECT game_name, sum(viewer_count) AS total_viewers, count(*) AS streams FROM e_latest
GROUP BY game_name ORDER BY total_viewers DESC NULLS LAST, game_name ASC NULLS LAST LIMIT {TOP_N}""", "e_latest"))
def q_top_games(spark, sf):
    return Fq.top_games(latest(spark, sf), TOP_N)


@query("rolling_mean_10", sql("""
SELECT stream_id, ingestion_ts, viewer_count,
       CAST(round(avg(viewer_count) OVER (PARTITION BY stream_id ORDER BY ingestion_ts
                  ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) AS INTEGER) AS avg_viewers_10
FROM e_silver""", "e_silver"))
def q_rolling_mean_10(spark, sf):
    return Fq.with_rolling_mean(silver(spark, sf).select("stream_id", "ingestion_ts", "viewer_count"))


@query("top_streamers", sql("SELECT * FROM e_top_streamers", "e_top_streamers"))
def q_top_streamers(spark, sf):
    return top(spark, sf)


@query("top_tags_freq", sql(f"""
SELECT tag_name, count(*) AS uses FROM e_tags GROUP BY tag_name
ORDER BY uses DESC, tag_name ASC NULLS LAST LIMIT {TOP_N}""", "e_tags"))
def q_top_tags_freq(spark, sf):
    return Fq.top_tags_by_frequency(P.e_tags(spark, sf), TOP_N)


@query("top_tags_viewers", sql(f"""
SELECT t.tag_name, round(avg(s.viewer_count), 6) AS avg_viewers, count(*) AS uses
FROM e_tags t JOIN e_silver s ON t.stream_id = s.stream_id AND t.ingestion_ts = s.ingestion_ts
GROUP BY t.tag_name ORDER BY avg_viewers DESC NULLS LAST, t.tag_name ASC NULLS LAST LIMIT {TOP_N}""",
    "e_tags", "e_silver"))
def q_top_tags_viewers(spark, sf):
    return Fq.top_tags_by_viewers(P.e_tags(spark, sf), silver(spark, sf), TOP_N)


@query("longest_streams", sql(f"""
SELECT stream_id, user_name, stream_time_seconds, stream_time_seconds / 3600.0 AS duration_hours
FROM e_latest WHERE stream_time_seconds IS NOT NULL
ORDER BY stream_time_seconds DESC, stream_id ASC LIMIT {TOP_N}""", "e_latest"))
def q_longest_streams(spark, sf):
    return Fq.longest_streams(latest(spark, sf), TOP_N).select(
        "stream_id", "user_name", "stream_time_seconds", "duration_hours")


@query("event_feed", sql(f"""
SELECT replace(event_type, '_', ' ') AS label, user_name,
       strftime(event_ts, '%B %d, %Y - %H:%M:%S') AS "when",
       coalesce(old_value, 'None') || ' → ' || coalesce(new_value, 'None') AS change, event_ts, stream_id
FROM e_transitions ORDER BY event_ts DESC, stream_id ASC, event_type ASC LIMIT {TOP_N}""", "e_transitions"))
def q_event_feed(spark, sf):
    return Fq.event_feed(e_transitions(spark, sf), TOP_N)


def _in(vals):
    return ", ".join(f"'{v}'" for v in vals)


@query("filtered_streams", sql(f"""
SELECT stream_id, game_name, language, viewer_count, ingestion_ts FROM e_silver
WHERE game_name IN ({_in(GAMES)}) AND language IN ({_in(LANGUAGES)})""", "e_silver"))
def q_filtered_streams(spark, sf):
    return Fq.filter_streams(silver(spark, sf), GAMES, LANGUAGES).select(
        "stream_id", "game_name", "language", "viewer_count", "ingestion_ts")


@query("filtered_tags", sql(f"""
SELECT * FROM e_tags WHERE stream_id IN (
  SELECT stream_id FROM e_silver WHERE game_name IN ({_in(GAMES)}) AND language IN ({_in(LANGUAGES)}))""",
    "e_tags", "e_silver"))
def q_filtered_tags(spark, sf):
    parents = Fq.filter_streams(silver(spark, sf), GAMES, LANGUAGES)
    return Fq.filter_children(P.e_tags(spark, sf), parents)


@query("facet_values", sql("""
SELECT DISTINCT 'game_name' AS facet, game_name AS value FROM e_silver WHERE game_name IS NOT NULL
UNION ALL
SELECT DISTINCT 'language' AS facet, language AS value FROM e_silver WHERE language IS NOT NULL""", "e_silver"))
def q_facet_values(spark, sf):
    s = silver(spark, sf)
    g = Fq.facet_values(s, "game_name").select(F.lit("game_name").alias("facet"), F.col("game_name").alias("value"))
    lang = Fq.facet_values(s, "language").select(F.lit("language").alias("facet"), F.col("language").alias("value"))
    return g.unionByName(lang)


@query("time_bounds", sql("SELECT min(ingestion_ts) AS min_time, max(ingestion_ts) AS max_time FROM e_silver",
                          "e_silver"))
def q_time_bounds(spark, sf):
    return Fq.time_bounds(silver(spark, sf))


@query("stream_kpis", sql("""
SELECT (SELECT count(DISTINCT stream_id) + max(CASE WHEN stream_id IS NULL THEN 1 ELSE 0 END) FROM e_silver)
         AS unique_streams,
       (SELECT count(DISTINCT user_name) + max(CASE WHEN user_name IS NULL THEN 1 ELSE 0 END) FROM e_silver)
         AS unique_streamers,
       (SELECT sum(viewer_count) FROM e_latest) AS current_viewers,
       (SELECT CAST(median(viewer_count) AS DOUBLE) FROM e_latest) AS median_viewers""", "e_silver", "e_latest"))
def q_stream_kpis(spark, sf):
    return Fq.stream_kpis(silver(spark, sf), latest(spark, sf))


@query("median_viewers_by_language", sql("""
SELECT language, CAST(median(viewer_count) AS DOUBLE) AS median_viewers FROM e_silver GROUP BY language""", "e_silver"))
def q_median_viewers_by_language(spark, sf):
    """Exact medians over the whole history, by selection: no group's values meet in one task."""
    return exact_median(silver(spark, sf), "viewer_count", ["language"], "median_viewers")


@query("streamers_by_day_sketch", sql("""
SELECT started_day, count(DISTINCT user_name) AS streamers, true AS sketch_is_close FROM e_silver GROUP BY started_day""", "e_silver"))
def q_streamers_by_day_sketch(spark, sf):
    """Distinct streamers by day of the month from merged sketches of the daily groups, beside the exact count."""
    s = silver(spark, sf)
    sketched = audience_by(hourly_audience(s, keys=("language", "started_year", "started_month", "started_day", "started_hour")), "started_day")
    exact = s.groupBy("started_day").agg(F.count_distinct("user_name").alias("streamers"))
    close = F.abs(F.col("distinct_streamers") - F.col("streamers")) <= F.greatest(F.lit(1), F.col("streamers") * 0.05)
    return exact.join(sketched, "started_day").select("started_day", "streamers", close.alias("sketch_is_close"))


@query("streamer_metrics_long", sql("""
SELECT user_name, 'latest' AS metric, CAST(latest_viewer_count AS BIGINT) AS viewers FROM e_top_streamers
UNION ALL SELECT user_name, 'peak', CAST(peak_viewers AS BIGINT) FROM e_top_streamers
UNION ALL SELECT user_name, 'avg', CAST(avg_viewers_10 AS BIGINT) FROM e_top_streamers""", "e_top_streamers"))
def q_streamer_metrics_long(spark, sf):
    return Fq.streamer_metrics_long(top(spark, sf))


@query("viewer_trend", sql("""
SELECT user_name, ingestion_ts, viewer_count FROM e_silver
WHERE user_name IN (SELECT user_name FROM e_top_streamers)""", "e_silver", "e_top_streamers"))
def q_viewer_trend(spark, sf):
    return Fq.viewer_trend(silver(spark, sf), top(spark, sf))


@query("streams_by_language", sql("SELECT language, count(*) AS streams FROM e_latest GROUP BY language",
                                  "e_latest"))
def q_streams_by_language(spark, sf):
    return Fq.streams_by(latest(spark, sf), "language")


@query("streams_by_hour", sql("SELECT started_hour, count(*) AS streams FROM e_latest GROUP BY started_hour",
                              "e_latest"))
def q_streams_by_hour(spark, sf):
    return Fq.streams_by(latest(spark, sf), "started_hour")


@query("event_counts", sql("SELECT event_type, count(*) AS events FROM e_transitions GROUP BY event_type",
                           "e_transitions"))
def q_event_counts(spark, sf):
    return Fq.event_counts(e_transitions(spark, sf))
