"""Gold: star schema (dimensions, hourly fact) and the merge-on-read views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from livepulse.functions.constants import UNKNOWN
from livepulse.functions.keys import date_key, surrogate_key
from livepulse.operators.keyed import latest_per_key
from livepulse.schemas import DIM_GAME_COLUMNS


def clean_batch(df: DataFrame, game: str = "game_name",
                fill: Sequence[str] = ("user_name", "language")) -> DataFrame:
    """Drop rows whose category is null or blank; fill null names with 'Unknown'."""
    g = F.col(game)
    return df.where(g.isNotNull() & (F.trim(g) != "")).fillna({c: UNKNOWN for c in fill})


def dim_streamer(clean: DataFrame, inserted_at: Column | None = None) -> DataFrame:
    out = clean.select("user_name").distinct().withColumn("streamer_id", surrogate_key("user_name"))
    return out if inserted_at is None else out.withColumn("inserted_at", inserted_at)


def dim_language(clean: DataFrame, inserted_at: Column | None = None) -> DataFrame:
    out = clean.select("language").distinct().withColumn("language_id", surrogate_key("language"))
    return out if inserted_at is None else out.withColumn("inserted_at", inserted_at)


def dedupe_catalogue(catalogue: DataFrame, by: str = "game_name",
                     order: Sequence[str] = ("ingestion_ts",)) -> DataFrame:
    """Latest catalogue row per name, so joining on the name never fans out."""
    return latest_per_key(catalogue.where(F.col(by).isNotNull()), [by], list(order))


def dim_game(clean: DataFrame, catalogue: DataFrame, order: Sequence[str] = ("ingestion_ts",),
             inserted_at: Column | None = None) -> DataFrame:
    """Distinct game names of the batch, left-joined to their latest catalogue entry.

    The catalogue side is reduced to one row per name first; the join then
    matches at most one row. AQE picks broadcast or shuffle from its measured size.
    """
    cat_cols = ["game_name"] + [c for c in DIM_GAME_COLUMNS if c not in ("game_id", "game_name")]
    cat = dedupe_catalogue(catalogue.select(*cat_cols, *[c for c in order if c not in cat_cols]),
                           order=order).select(*cat_cols)
    out = (clean.select("game_name").distinct()
           .withColumn("game_id", surrogate_key("game_name"))
           .join(cat, "game_name", "left")
           .select(*DIM_GAME_COLUMNS))
    return out if inserted_at is None else out.withColumn("inserted_at", inserted_at)


def dim_date(batch: DataFrame, inserted_at: Column | None = None) -> DataFrame:
    """Distinct poll dates of the whole (unfiltered) batch with their YYYYMMDD key."""
    out = (batch.select(F.col("year").alias("date_year"), F.col("month").alias("date_month"),
                        F.col("day").alias("date_day"))
           .distinct()
           .withColumn("date_id", date_key("date_year", "date_month", "date_day"))
           .select("date_id", "date_year", "date_month", "date_day"))
    return out if inserted_at is None else out.withColumn("inserted_at", inserted_at)


def fact_hourly(clean: DataFrame, keep_names: bool = False,
                inserted_at: Column | None = None) -> DataFrame:
    """Hourly fact: per (game, streamer, language, date, hour) max, sum and count of viewers.

    Grouping is on 64-bit surrogate keys (cheap to shuffle); partial aggregation
    runs before the exchange, so a hot key sends one row per map task.
    ``keep_names`` also carries the natural keys (functionally dependent on the
    surrogate keys, so the groups are the same).
    """
    keyed = clean.withColumns({
        "game_id": surrogate_key("game_name"),
        "streamer_id": surrogate_key("user_name"),
        "language_id": surrogate_key("language"),
        "date_id": date_key("year", "month", "day"),
        "time_hour": F.col("ingestion_hour"),
    })
    keys = ["game_id", "streamer_id", "language_id", "date_id", "time_hour"]
    if keep_names:
        keys += ["game_name", "user_name", "language"]
    v = F.col("viewer_count")
    out = keyed.groupBy(*keys).agg(
        F.max(v).cast("long").alias("max_viewers"),
        F.sum(v).cast("double").alias("sum_viewers"),
        F.count(v).alias("count_observations"),
    )
    return out if inserted_at is None else out.withColumn("inserted_at", inserted_at)


def latest_by_version(df: DataFrame, keys: Sequence[str], version: str = "inserted_at",
                      tiebreak: Sequence[str] = ()) -> DataFrame:
    """Replacing-merge read: one row per key, the highest version (then tiebreak) wins."""
    return latest_per_key(df, list(keys), [version, *tiebreak])


def merge_fact(partials: DataFrame, keys: Sequence[str] = ("game_id", "streamer_id", "language_id",
                                                            "date_id", "time_hour"),
               measures: Sequence[str] = ()) -> DataFrame:
    """Summing-merge read: partial hourly rows of one key collapse to
    max of max, sum of sum, sum of count (splitting a batch never changes the result).
    ``measures``: further columns whose maximum is kept, such as the row version."""
    return partials.groupBy(*keys).agg(
        F.max("max_viewers").alias("max_viewers"),
        F.sum("sum_viewers").alias("sum_viewers"),
        F.sum("count_observations").alias("count_observations"),
        *[F.max(m).alias(m) for m in measures],
    )


def dimensions_of(fact_named: DataFrame, catalogue: DataFrame,
                  catalogue_order: Sequence[str] = ("ingestion_ts",)) -> dict[str, DataFrame]:
    """The dimension rows a fact references, from a fact that still carries its
    natural keys (``fact_hourly(..., keep_names=True)``)."""
    dates = fact_named.select("date_id").distinct()
    return {
        "dim_game": dim_game(fact_named, catalogue, catalogue_order),
        "dim_streamer": fact_named.select("streamer_id", "user_name").distinct(),
        "dim_language": fact_named.select("language_id", "language").distinct(),
        "dim_date": dates.select("date_id", (F.col("date_id") / 10000).cast("int").alias("date_year"),
                                 ((F.col("date_id") / 100).cast("long") % 100).cast("int").alias("date_month"),
                                 (F.col("date_id") % 100).cast("int").alias("date_day")),
    }


#: The columns of a batch that the star is built from.
STAR_INPUT = ["game_name", "user_name", "language", "viewer_count", "year", "month", "day", "ingestion_hour"]


def build_star(batch: DataFrame, catalogue: DataFrame, catalogue_order: Sequence[str] = ("ingestion_ts",),
               inserted_at: Column | None = None) -> dict[str, DataFrame]:
    """All five gold outputs of one batch (the caller persists ``batch`` around this)."""
    clean = clean_batch(batch)
    return {
        "dim_streamer": dim_streamer(clean, inserted_at),
        "dim_language": dim_language(clean, inserted_at),
        "dim_game": dim_game(clean, catalogue, catalogue_order, inserted_at),
        "dim_date": dim_date(batch, inserted_at),
        "fact_stream_hourly": fact_hourly(clean, inserted_at=inserted_at),
    }
