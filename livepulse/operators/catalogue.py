"""Queries over the game catalogue: latest versions, ratings, categories, quadrants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from livepulse.functions.constants import (
    PERIOD_SEPARATOR, QUADRANT_HIDDEN_GEM, QUADRANT_MAINSTREAM, QUADRANT_NICHE, QUADRANT_OVERHYPED)
from livepulse.functions.lists import any_of
from livepulse.operators.keyed import latest_per_key, scalar_broadcast
from livepulse.session import materialize


def _desc(c):
    return F.col(c).desc_nulls_last()


def _asc(c):
    return F.col(c).asc_nulls_last()


def latest_games(games: DataFrame, key: str = "game_id",
                 order: Sequence[str] = ("ingestion_ts",)) -> DataFrame:
    """Most recent catalogue row per game id (metadata may change between polls)."""
    return latest_per_key(games, [key], list(order))


def top_rated(games: DataFrame, n: int = 10, min_rating_count: int = 5) -> DataFrame:
    return (games.where(F.col("total_rating").isNotNull() & (F.col("total_rating_count") >= min_rating_count))
            .select("game_id", "game_name", "total_rating", "total_rating_count", "url")
            .orderBy(_desc("total_rating"), _asc("game_name"), _asc("game_id")).limit(n))


def category_frequency(games: DataFrame, list_col: str, alias: str, n: int = 10) -> DataFrame:
    """The n most frequent labels of a list column (null and '' labels dropped)."""
    return (games.select(F.explode(list_col).alias(alias))
            .where(F.col(alias).isNotNull() & (F.col(alias) != ""))
            .groupBy(alias).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(_desc("count"), _asc(alias)).limit(n))


CATEGORY_COLUMNS = {
    "themes": "theme", "game_modes": "game_mode", "player_perspectives": "player_perspective",
    "platform_types": "platform_type", "platform_families": "platform_family", "keywords": "keyword",
}


def release_periods(games: DataFrame, bin_size: int = 5) -> DataFrame:
    """Games per release period of ``bin_size`` years, labelled "2000–2004"."""
    start = (F.floor(F.year("first_release_date") / bin_size) * bin_size).cast("int")
    return (games.where(F.col("first_release_date").isNotNull())
            .groupBy(start.alias("period_start")).agg(F.count(F.lit(1)).alias("games_released"))
            .withColumn("period", F.concat(F.col("period_start").cast("string"), F.lit(PERIOD_SEPARATOR),
                                           (F.col("period_start") + bin_size - 1).cast("string")))
            .orderBy("period_start"))


def rating_vs_popularity(games: DataFrame, latest_streams: DataFrame) -> DataFrame:
    """Rated games with the current viewers and live streams of their name (inner join)."""
    viewers = latest_streams.groupBy("game_name").agg(F.sum("viewer_count").alias("current_viewers"),
                                                      F.count(F.lit(1)).alias("live_streams"))
    return (games.where(F.col("total_rating").isNotNull()).join(viewers, "game_name")
            .select("game_name", "total_rating", "total_rating_count", "current_viewers", "live_streams"))


def quadrants(merged: DataFrame, approx: bool = False) -> DataFrame:
    """Label each game around the median rating and median viewers (≥ median is high).

    The per-game rows are read twice (medians, then labels), so they are
    materialized once rather than recomputed from the snapshots.
    """
    med = (lambda c: F.percentile_approx(c, 0.5)) if approx else F.median
    merged = materialize(merged)
    m = scalar_broadcast(merged.agg(med("total_rating").alias("_mr"), med("current_viewers").alias("_mv")))
    hi_r = F.col("total_rating") >= F.col("_mr")
    hi_v = F.col("current_viewers") >= F.col("_mv")
    label = (F.when(hi_r & ~hi_v, QUADRANT_HIDDEN_GEM).when(hi_r & hi_v, QUADRANT_MAINSTREAM)
             .when(~hi_r & hi_v, QUADRANT_OVERHYPED).otherwise(QUADRANT_NICHE))
    return merged.crossJoin(m).withColumn("quadrant", label).drop("_mr", "_mv")


def quadrant_top(quads: DataFrame, quadrant: str, by: str, n: int = 10) -> DataFrame:
    cols = ["game_name", "total_rating", "current_viewers", "live_streams"]
    rest = [c for c in cols if c != by]
    return (quads.where(F.col("quadrant") == quadrant).select(*cols)
            .orderBy(_desc(by), *[_asc(c) for c in rest]).limit(n))


def games_kpis(games: DataFrame) -> DataFrame:
    """Games tracked, metadata coverage % (0 when empty), mean rating, most-reviewed game.

    Most reviewed: highest rating count, then the smallest name.
    """
    total = F.count(F.lit(1))
    cnt = F.col("total_rating_count")
    most = F.min_by(F.struct(F.col("game_name"), cnt),
                    F.when(cnt.isNotNull(), F.struct((-cnt).alias("c"), F.col("game_name"))))
    return games.agg(
        total.alias("games_tracked"),
        F.when(total == 0, F.lit(0.0)).otherwise(F.round(F.count("igdb_id") * 100.0 / total, 6))
        .alias("coverage_pct"),
        F.round(F.avg("total_rating"), 6).alias("avg_rating"),
        most.alias("_most"),
    ).select("games_tracked", "coverage_pct", "avg_rating", F.col("_most.game_name").alias("most_reviewed"),
             F.col("_most.total_rating_count").alias("most_reviewed_count"))


def rated(games: DataFrame) -> DataFrame:
    return games.where(F.col("total_rating").isNotNull() & F.col("total_rating_count").isNotNull())


def rating_histogram(games: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width bins between the min and max rating; the max falls in the last bin.

    Bounds are one aggregate row broadcast to the scan; the rated games (one
    row per game) are materialized once for the two reads.
    """
    r = materialize(rated(games).select("total_rating"))
    b = scalar_broadcast(r.agg(F.min("total_rating").alias("_lo"), F.max("total_rating").alias("_hi")))
    x, lo, hi = F.col("total_rating"), F.col("_lo"), F.col("_hi")
    width = (hi - lo) / F.lit(float(bins))
    bucket = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((x - lo) / width) + 1, F.lit(bins))).cast("int")
    return (r.crossJoin(b).groupBy(bucket.alias("bucket"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("games"))
            .select("bucket",
                    F.round(F.col("_lo") + (F.col("bucket") - 1) * (F.col("_hi") - F.col("_lo")) / bins, 6)
                    .alias("bin_start"),
                    F.round(F.col("_lo") + F.col("bucket") * (F.col("_hi") - F.col("_lo")) / bins, 6)
                    .alias("bin_end"), "games"))


def rating_log_points(games: DataFrame) -> DataFrame:
    r = rated(games).where(F.col("total_rating_count") > 0)
    return r.select("game_id", "game_name", "total_rating",
                    F.round(F.log10("total_rating_count"), 6).alias("log_rating_count"))


def list_facets(games: DataFrame, cols: Sequence[str] = ("themes", "platforms")) -> DataFrame:
    out = None
    for c in cols:
        part = (games.select(F.lit(c).alias("facet"), F.explode(c).alias("value"))
                .where(F.col("value").isNotNull()).distinct())
        out = part if out is None else out.unionByName(part)
    return out


def explore(games: DataFrame, filters: dict[str, Sequence[str]]) -> DataFrame:
    """Any-of filter per list column (OR within a facet, AND across facets)."""
    cond: Column = F.lit(True)
    for col, values in filters.items():
        if values:
            cond = cond & F.coalesce(any_of(col, values), F.lit(False))
    return games.where(cond)


def catalogue_page(games: DataFrame, latest_streams: DataFrame, n: int = 10, bin_size: int = 5,
                   filters: dict[str, Sequence[str]] | None = None,
                   order: Sequence[str] = ("ingestion_ts",)) -> dict[str, DataFrame]:
    """Every panel of the catalogue page: latest version per game first, then
    KPIs, ratings, category frequencies, release periods, quadrants, explorer.

    The latest version per game (one row per game) feeds every panel, so it is
    materialized once when the page is built; the panels stay lazy otherwise."""
    g = materialize(latest_games(games, order=order))
    merged = rating_vs_popularity(g, latest_streams)
    quads = quadrants(merged)
    out = {
        "kpis": games_kpis(g),
        "top_rated": top_rated(g, n),
        "rating_histogram": rating_histogram(g),
        "rating_log_points": rating_log_points(g),
        "release_periods": release_periods(g, bin_size),
        "quadrants": quads,
        "hidden_gems": quadrant_top(quads, QUADRANT_HIDDEN_GEM, "total_rating", n),
        "overhyped": quadrant_top(quads, QUADRANT_OVERHYPED, "current_viewers", n),
        "facets": list_facets(g),
        "explorer": explore(g, filters or {}),
    }
    for col, alias in CATEGORY_COLUMNS.items():
        out[f"frequency_{alias}"] = category_frequency(g, col, alias, n)
    return out
