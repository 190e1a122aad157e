"""Silver: enriched snapshots, exploded tags, flattened catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from livepulse.functions.lists import distinct_nested_names, field_names
from livepulse.functions.text import normalise_tag, resolve_thumbnail
from livepulse.functions.time import epoch_to_ts, uptime_seconds


def silver_streams(bronze: DataFrame, started: str = "started_at",
                   ingested: str = "ingestion_ts") -> DataFrame:
    """Drop tags; add start parts, poll hour, 1080p thumbnail and uptime seconds.

    Hours are in the session time zone, which livepulse pins to UTC.
    """
    s, i = F.col(started), F.col(ingested)
    out = bronze.drop("tags").withColumns({
        "started_year": F.year(s),
        "started_month": F.month(s),
        "started_day": F.dayofmonth(s),
        "started_hour": F.hour(s),
        "ingestion_hour": F.hour(i),
    })
    if "thumbnail_url" in bronze.columns:
        out = out.withColumn("thumbnail_url_1080p", resolve_thumbnail("thumbnail_url"))
    return out.withColumn("stream_time_seconds", uptime_seconds(i, s))


def stream_tags(bronze: DataFrame, key: str = "stream_id", ts: str = "ingestion_ts",
                tags: str = "tags") -> DataFrame:
    """One row per tag use; null and empty lists give no rows; tags are lower(trim())."""
    return (bronze.select(key, ts, F.explode(tags).alias("tag_name"))
            .withColumn("tag_name", normalise_tag("tag_name")))


def silver_games(bronze_games: DataFrame, meta: str = "igdb_data", extra=()) -> DataFrame:
    """Flatten the metadata struct into 17 columns (7 of them array<string>);
    ``extra`` columns are passed through."""
    m = lambda f: F.col(f"{meta}.{f}")
    return bronze_games.select(
        "ingestion_ts", "game_id", "game_name", "igdb_id",
        m("summary").alias("summary"), m("total_rating").alias("total_rating"),
        m("total_rating_count").alias("total_rating_count"),
        m("storyline").alias("storyline"), m("url").alias("url"),
        epoch_to_ts(m("first_release_date")).alias("first_release_date"),
        field_names(f"{meta}.themes").alias("themes"),
        field_names(f"{meta}.player_perspectives").alias("player_perspectives"),
        field_names(f"{meta}.keywords").alias("keywords"),
        field_names(f"{meta}.game_modes").alias("game_modes"),
        field_names(f"{meta}.platforms").alias("platforms"),
        distinct_nested_names(f"{meta}.platforms", "platform_family").alias("platform_families"),
        distinct_nested_names(f"{meta}.platforms", "platform_type").alias("platform_types"),
        *extra,
    )
