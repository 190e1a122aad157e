"""Registered change-detection queries (batch form)."""

from __future__ import annotations

from pyspark.sql import functions as F

from livepulse.operators.transitions import detect_transitions
from livepulse.plans import profiles as P
from livepulse.plans.registry import query
from livepulse.plans.sqllib import block, sql

block("e_lagged", ("e_snap",), """
SELECT stream_id, user_name, game_name, title, viewer_count, ingestion_ts,
       lag(game_name) OVER w AS pg, lag(title) OVER w AS pt, lag(viewer_count) OVER w AS pv,
       lag(ingestion_ts) OVER w AS pts
FROM e_snap WHERE ingestion_ts IS NOT NULL AND stream_id IS NOT NULL
WINDOW w AS (PARTITION BY stream_id ORDER BY ingestion_ts)""")


def transitions_sql(idle_hours: int | None) -> str:
    live = "pts IS NOT NULL" + (f" AND ingestion_ts - pts <= INTERVAL {idle_hours} HOUR" if idle_hours else "")
    return f"""
SELECT stream_id, user_name, 'GAME_CHANGE' AS event_type, pg AS old_value, game_name AS new_value,
       ingestion_ts AS event_ts, viewer_count - pv AS viewer_delta
FROM e_lagged WHERE {live} AND game_name IS DISTINCT FROM pg
UNION ALL
SELECT stream_id, user_name, 'TITLE_CHANGE' AS event_type, pt AS old_value, title AS new_value,
       ingestion_ts AS event_ts, viewer_count - pv AS viewer_delta
FROM e_lagged WHERE {live} AND title IS DISTINCT FROM pt"""


block("e_transitions", ("e_lagged",), transitions_sql(12))


def e_transitions(spark, sf, idle_hours=12):
    return detect_transitions(P.e_snapshots(spark, sf), idle_hours=idle_hours)


@query("transitions", sql("SELECT * FROM e_transitions", "e_transitions"))
def q_transitions(spark, sf):
    return e_transitions(spark, sf)


@query("transitions_timeout", sql(transitions_sql(1), "e_lagged"))
def q_transitions_timeout(spark, sf):
    """Same detector with a 1-hour idle limit: most gaps now start a new session."""
    return e_transitions(spark, sf, idle_hours=1)


@query("game_changes", sql("""
SELECT old_value, new_value, count(*) AS changes, CAST(sum(viewer_delta) AS BIGINT) AS viewer_delta
FROM e_transitions WHERE event_type = 'GAME_CHANGE' GROUP BY old_value, new_value""", "e_transitions"))
def q_game_changes(spark, sf):
    t = e_transitions(spark, sf).where(F.col("event_type") == "GAME_CHANGE")
    return t.groupBy("old_value", "new_value").agg(F.count(F.lit(1)).alias("changes"),
                                                   F.sum("viewer_delta").alias("viewer_delta"))


@query("title_changes", sql("""
SELECT stream_id, count(*) AS changes, max(event_ts) AS last_change
FROM e_transitions WHERE event_type = 'TITLE_CHANGE' GROUP BY stream_id""", "e_transitions"))
def q_title_changes(spark, sf):
    t = e_transitions(spark, sf).where(F.col("event_type") == "TITLE_CHANGE")
    return t.groupBy("stream_id").agg(F.count(F.lit(1)).alias("changes"), F.max("event_ts").alias("last_change"))
