"""Queries over broadcast snapshots: latest snapshot, rankings, tags, KPIs, feeds.

Top-n results are ordered by their metric and then by their label, so ties
resolve the same way every run. ``orderBy(...).limit(n)`` plans as a per-task
top-n followed by one small merge (TakeOrderedAndProject), never a full sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from livepulse.functions.text import change_text, event_label, readable_ts
from livepulse.functions.time import truncate_ts
from livepulse.operators.keyed import latest_per_key, scalar_broadcast
from livepulse.operators.sequence import rolling_mean_rows
from livepulse.session import materialize


def _desc(c):
    return F.col(c).desc_nulls_last()


def _asc(c):
    return F.col(c).asc_nulls_last()


def _day_key(c: Column) -> Column:
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def _between_polls(df: DataFrame, ts: str, low: DataFrame, grain: str | None, closed: bool) -> DataFrame:
    """Rows of ``df`` from the scalar ``low`` on (``closed``: only within its grain). The bounds are
    scalar subqueries on the raw time column, so they move below the joins that made ``df`` and
    reach the scan; a table partitioned by year/month/day is pruned by them too."""
    def bound(expr: Column) -> Column:
        return low.select(expr.alias("v")).scalar()

    at = F.col("_low")
    cond = F.col(ts) >= bound(at)
    if closed:
        end = at if grain is None else at + F.expr(f"INTERVAL 1 {grain.upper()}")
        cond = cond & ((F.col(ts) == bound(at)) if grain is None else (F.col(ts) < bound(end)))
    if {"year", "month", "day"} <= set(df.columns):
        day = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
        cond = cond & (day >= bound(_day_key(at)))
        if closed:
            cond = cond & (day <= bound(_day_key(end)))
    return df.where(cond)


def latest_snapshot(df: DataFrame, ts: str = "ingestion_ts", grain: str | None = None,
                    polls: DataFrame | None = None) -> DataFrame:
    """Rows of the most recent poll (ts equal to the global max, after truncation to ``grain``).

    ``polls``: a frame whose column ``ts`` has the same maximum and is cheaper to read (the raw
    table behind ``df``); by default the maximum is taken from ``df``.
    """
    source = df if polls is None else polls
    low = source.select(F.col(ts)).agg(truncate_ts(F.max(ts), grain).alias("_low"))
    return _between_polls(df, ts, low, grain, closed=False)


def snapshot_asof(df: DataFrame, at: datetime | str | Column, ts: str = "ingestion_ts",
                  grain: str | None = None, per_stream: bool = False, key: str = "stream_id",
                  polls: DataFrame | None = None) -> DataFrame:
    """Snapshot as of time ``at``: the latest poll at or before it; when ``at`` is
    before the first poll, the earliest poll. A naive ``at`` is UTC.

    ``per_stream`` instead keeps each stream's own latest row at or before ``at``.
    ``polls`` as in :func:`latest_snapshot` (the same set of poll times).
    """
    at_c = at if isinstance(at, Column) else F.lit(at).cast("timestamp")
    if per_stream:
        before = df.where(F.col(ts) <= at_c)
        return latest_per_key(before, [key], [ts])
    t = truncate_ts(ts, grain)
    source = (df if polls is None else polls).select(F.col(ts))
    low = source.agg(F.coalesce(F.max(F.when(F.col(ts) <= at_c, t)), F.min(t)).alias("_low"))
    return _between_polls(df, ts, low, grain, closed=True)


def top_games(latest: DataFrame, n: int = 10) -> DataFrame:
    return (latest.groupBy("game_name")
            .agg(F.sum("viewer_count").alias("total_viewers"), F.count(F.lit(1)).alias("streams"))
            .orderBy(_desc("total_viewers"), _asc("game_name")).limit(n))


def online_streams(streams: DataFrame, latest: DataFrame, key: str = "stream_id",
                   materialize_ids: bool = True) -> DataFrame:
    """History of the streams present in the latest snapshot (semi join on the ids).

    The live ids (one row per stream of one poll) are materialized once, so the
    sequence operators that read this history twice do not recompute the
    snapshot and its max-poll aggregate each time."""
    ids = latest.select(key).distinct()
    return streams.join(materialize(ids) if materialize_ids else ids, key, "left_semi")


def with_rolling_mean(streams: DataFrame, rows: int = 10, key: str = "stream_id",
                      ts: str = "ingestion_ts", value: str = "viewer_count",
                      out: str = "avg_viewers_10", bucket_seconds: int = 86400) -> DataFrame:
    """Mean of each stream's last ``rows`` polls (at least one), rounded half up, as int.
    ``bucket_seconds`` is the unit one task sorts; make it smaller for denser polls."""
    r = rolling_mean_rows(streams, key, ts, value, rows, bucket_seconds=bucket_seconds, out="_rm")
    return r.withColumn(out, F.round("_rm").cast("int")).drop("_rm")


def top_streamers(streams: DataFrame, latest: DataFrame, n: int = 10, mode: str = "peak") -> DataFrame:
    """Per user: viewers and rolling mean at the chosen row, and peak viewers; top n by the mean.

    ``mode="peak"`` takes the row with the most viewers (what a sort by viewers
    then "first" gives); ``mode="latest"`` takes the most recent row.
    Ties: more viewers, then later poll, then stream id.
    """
    online = with_rolling_mean(online_streams(streams, latest))
    order = (F.struct("viewer_count", "ingestion_ts", "stream_id") if mode == "peak"
             else F.struct("ingestion_ts", "viewer_count", "stream_id"))
    pick = F.max_by(F.struct("viewer_count", "avg_viewers_10"), order)
    return (online.groupBy("user_name")
            .agg(pick.alias("_p"), F.max("viewer_count").alias("peak_viewers"))
            .select("user_name", F.col("_p.viewer_count").alias("latest_viewer_count"),
                    "peak_viewers", F.col("_p.avg_viewers_10").alias("avg_viewers_10"))
            .orderBy(_desc("avg_viewers_10"), _asc("user_name")).limit(n))


def top_tags_by_frequency(tags: DataFrame, n: int = 10) -> DataFrame:
    return (tags.groupBy("tag_name").agg(F.count(F.lit(1)).alias("uses"))
            .orderBy(_desc("uses"), _asc("tag_name")).limit(n))


def top_tags_by_viewers(tags: DataFrame, streams: DataFrame, n: int = 10, digits: int = 6) -> DataFrame:
    """Each tag use joined to the viewers of that exact snapshot (stream_id, ingestion_ts)."""
    s = streams.select("stream_id", "ingestion_ts", "viewer_count")
    return (tags.join(s, ["stream_id", "ingestion_ts"])
            .groupBy("tag_name")
            .agg(F.round(F.avg("viewer_count"), digits).alias("avg_viewers"), F.count(F.lit(1)).alias("uses"))
            .orderBy(_desc("avg_viewers"), _asc("tag_name")).limit(n))


def longest_streams(latest: DataFrame, n: int = 10) -> DataFrame:
    return (latest.where(F.col("stream_time_seconds").isNotNull())
            .orderBy(_desc("stream_time_seconds"), _asc("stream_id")).limit(n)
            .withColumn("duration_hours", F.col("stream_time_seconds") / 3600.0))


def filter_streams(streams: DataFrame, games: Sequence[str] = (), languages: Sequence[str] = ()) -> DataFrame:
    out = streams
    if games:
        out = out.where(F.col("game_name").isin(list(games)))
    if languages:
        out = out.where(F.col("language").isin(list(languages)))
    return out


def filter_children(child: DataFrame, parents: DataFrame, key: str = "stream_id") -> DataFrame:
    """Propagate a filter to a child table by id (semi join)."""
    return child.join(parents.select(key), key, "left_semi")


def facet_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def time_bounds(df: DataFrame, ts: str = "ingestion_ts") -> DataFrame:
    return df.agg(F.min(ts).alias("min_time"), F.max(ts).alias("max_time"))


def _n_unique(c: str) -> Column:
    """Distinct count where null counts as one value of its own."""
    return F.count_distinct(F.col(c)) + F.max(F.col(c).isNull().cast("int"))


def stream_kpis(streams: DataFrame, latest: DataFrame, approx_median: bool = False) -> DataFrame:
    """Unique streams and users over the history; sum and median viewers of the latest poll.
    Nothing selected gives 0 for each."""
    pairs = streams.select("stream_id", "user_name").distinct()      # small before the exact counts
    hist = pairs.agg(_n_unique("stream_id").alias("unique_streams"),
                     _n_unique("user_name").alias("unique_streamers"))
    med = (F.percentile_approx("viewer_count", 0.5) if approx_median else F.median("viewer_count"))
    now = latest.agg(F.sum("viewer_count").alias("current_viewers"), med.cast("double").alias("median_viewers"))
    both = hist.crossJoin(scalar_broadcast(now))                      # two one-row aggregates
    return both.select(*[F.coalesce(c, F.lit(0)).cast(both.schema[c].dataType).alias(c) for c in both.columns])


def streamer_metrics_long(top: DataFrame) -> DataFrame:
    """Three metrics per streamer in long form (user_name, metric, viewers)."""
    wide = top.select("user_name", F.col("latest_viewer_count").cast("long").alias("latest"),
                      F.col("peak_viewers").cast("long").alias("peak"),
                      F.col("avg_viewers_10").cast("long").alias("avg"))
    return wide.unpivot("user_name", ["latest", "peak", "avg"], "metric", "viewers")


def viewer_trend(streams: DataFrame, top: DataFrame) -> DataFrame:
    """History of the top users, in time order."""
    return (streams.join(top.select("user_name"), "user_name", "left_semi")
            .select("user_name", "ingestion_ts", "viewer_count").orderBy("ingestion_ts", "user_name"))


def streams_by(latest: DataFrame, col: str) -> DataFrame:
    return latest.groupBy(col).agg(F.count(F.lit(1)).alias("streams")).orderBy(col)


def event_counts(transitions: DataFrame) -> DataFrame:
    return transitions.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def event_feed(transitions: DataFrame, n: int = 10) -> DataFrame:
    """The n most recent events with a readable time and an "old → new" text."""
    return (transitions.orderBy(_desc("event_ts"), _asc("stream_id"), _asc("event_type")).limit(n)
            .select(event_label("event_type").alias("label"), "user_name",
                    readable_ts("event_ts").alias("when"), change_text("old_value", "new_value").alias("change"),
                    "event_ts", "stream_id"))


def broadcast_page(streams: DataFrame, tags: DataFrame, transitions: DataFrame,
                   at: datetime | str | None = None, games: Sequence[str] = (),
                   languages: Sequence[str] = (), n: int = 10, grain: str | None = None) -> dict[str, DataFrame]:
    """Every panel of the broadcasts page as a DataFrame. Building it runs one job, which
    computes the ids of the live streams; the panels themselves are lazy.

    Order of the page: facet filters on the snapshots, the filter propagated to
    tags and transitions by stream id, the snapshot as of ``at`` (latest when
    None), then each panel. Facet values and time bounds come from the
    unfiltered history, as the page's selectors do.
    """
    facets = {"games": facet_values(streams, "game_name"), "languages": facet_values(streams, "language"),
              "time_bounds": time_bounds(streams)}
    s = filter_streams(streams, games, languages)
    t = filter_children(tags, s)
    tr = filter_children(transitions, s)
    latest = latest_snapshot(s, grain=grain) if at is None else snapshot_asof(s, at, grain=grain)
    top = top_streamers(s, latest, n)
    return {
        **facets,
        "kpis": stream_kpis(s, latest),
        "top_games": top_games(latest, n),
        "top_streamers": top,
        "streamer_metrics": streamer_metrics_long(top),
        "viewer_trend": viewer_trend(s, top),
        "longest_streams": longest_streams(latest, n),
        "streams_by_language": streams_by(latest, "language"),
        "streams_by_hour": streams_by(latest, "started_hour"),
        "top_tags": top_tags_by_frequency(t, n),
        "top_tags_by_viewers": top_tags_by_viewers(t, s, n),
        "event_counts": event_counts(tr),
        "event_feed": event_feed(tr, n),
    }
