"""Registered gold queries (star schema build and merge-on-read views)."""

from __future__ import annotations

from pyspark.sql import functions as F

from livepulse.operators import gold, semantic
from livepulse.plans import profiles as P
from livepulse.plans.registry import query
from livepulse.plans.sqllib import lj, sql
from livepulse.schemas import DIM_GAME_COLUMNS
from livepulse.session import materialize


def _lists(df, cols=("themes", "keywords", "platforms")):
    return df.withColumns({c: F.array_join(c, "|", "NULL") for c in cols})


def s_clean(spark, sf):
    return gold.clean_batch(P.s_silver(spark, sf))


def s_fact(spark, sf):
    """Hourly fact keyed by surrogate ids."""
    return gold.fact_hourly(s_clean(spark, sf))


def s_named_fact(spark, sf):
    return gold.fact_hourly(s_clean(spark, sf), keep_names=True)


def s_dim_game(spark, sf):
    return gold.dim_game(s_named_fact(spark, sf), P.s_games(spark, sf), P.CATALOGUE_ORDER)


def s_star(spark, sf):
    """The BI star of profile S in one pass: the merged hourly fact, which carries its
    natural keys, gets its date parts from the date key and the game attributes from
    one left join with the catalogue (latest version per name). Each input chain is
    scanned once; a dimension built from the fact in a second branch would be
    column-pruned differently and rescan the snapshots."""
    named = s_named_fact(spark, sf)
    cat_cols = [c for c in DIM_GAME_COLUMNS if c not in ("game_id",)]
    cat = gold.dedupe_catalogue(P.s_games(spark, sf).select(*cat_cols, *P.CATALOGUE_ORDER),
                                order=P.CATALOGUE_ORDER).select(*cat_cols)
    d = F.col("date_id")
    star = named.join(cat, "game_name", "left").withColumns({
        "date_year": (d / 10000).cast("int"),
        "date_month": ((d / 100).cast("long") % 100).cast("int"),
        "date_day": (d % 100).cast("int"),
    })
    return semantic.with_row_datetime(star)


def s_star_dimensional(spark, sf):
    """The same star through the general operator: hourly fact joined to the four
    dimensions on their surrogate keys. The fact is written once (an eager checkpoint) and the
    dimensions are derived from it, so the snapshots are read once."""
    named = materialize(s_named_fact(spark, sf))
    dims = gold.dimensions_of(named, P.s_games(spark, sf), P.CATALOGUE_ORDER)
    return semantic.star_join(named.drop("game_name", "user_name", "language"), **dims)


def s_catalogue(spark, sf, *columns):
    """Latest catalogue row per game name."""
    return gold.dedupe_catalogue(P.s_games(spark, sf).select("game_name", *columns, *P.CATALOGUE_ORDER),
                                 order=P.CATALOGUE_ORDER).select("game_name", *columns)


@query("clean_batch", sql("""
SELECT stream_id, user_name, game_name, language, viewer_count, ingestion_ts FROM (
  SELECT * REPLACE (coalesce(user_name, 'Unknown') AS user_name, coalesce(language, 'Unknown') AS language)
  FROM e_silver WHERE game_name IS NOT NULL AND trim(game_name) <> '')""", "e_silver"))
def q_clean_batch(spark, sf):
    return gold.clean_batch(P.e_silver(spark, sf)).select(
        "stream_id", "user_name", "game_name", "language", "viewer_count", "ingestion_ts")


@query("dim_streamer", sql("SELECT DISTINCT user_name FROM s_clean", "s_clean"))
def q_dim_streamer(spark, sf):
    return gold.dim_streamer(s_clean(spark, sf)).select("user_name")


@query("dim_language", sql("SELECT DISTINCT language FROM s_clean", "s_clean"))
def q_dim_language(spark, sf):
    return gold.dim_language(s_clean(spark, sf)).select("language")


@query("dim_game", sql(f"""
SELECT game_name, igdb_id, total_rating, total_rating_count, first_release_date,
       {lj('themes')} AS themes, {lj('keywords')} AS keywords, {lj('platforms')} AS platforms
FROM s_dim_game""", "s_dim_game"))
def q_dim_game(spark, sf):
    d = gold.dim_game(s_clean(spark, sf), P.s_games(spark, sf), P.CATALOGUE_ORDER)
    return _lists(d.drop("game_id").withColumn("total_rating_count", F.col("total_rating_count").cast("long")))


@query("dim_date", sql("""
SELECT DISTINCT CAST(year AS BIGINT) * 10000 + month * 100 + day AS date_id,
       year AS date_year, month AS date_month, day AS date_day
FROM e_bronze""", "e_bronze"))
def q_dim_date(spark, sf):
    return gold.dim_date(P.e_bronze(spark, sf))


@query("fact_hourly", sql("SELECT * FROM s_fact", "s_fact"))
def q_fact_hourly(spark, sf):
    return gold.fact_hourly(s_clean(spark, sf), keep_names=True).drop("game_id", "streamer_id", "language_id")


@query("fact_merge", sql("SELECT * FROM s_fact", "s_fact"))
def q_fact_merge(spark, sf):
    """Split the batch in two by stream parity, aggregate each part, then merge:
    must equal the one-shot fact."""
    clean = s_clean(spark, sf)
    parity = F.col("stream_id").cast("long") % 2
    a = gold.fact_hourly(clean.where(parity == 0), keep_names=True)
    b = gold.fact_hourly(clean.where(parity == 1), keep_names=True)
    keys = ["game_name", "user_name", "language", "date_id", "time_hour"]
    return gold.merge_fact(a.unionByName(b), keys)


@query("latest_by_version", sql(f"""
SELECT game_id, game_name, ingestion_ts, version_tiebreak, total_rating, {lj('themes')} AS themes
FROM s_latest_games""", "s_latest_games"))
def q_latest_by_version(spark, sf):
    g = P.s_games(spark, sf).select("game_id", "game_name", "ingestion_ts", "version_tiebreak",
                                     "total_rating", "themes")
    out = gold.latest_by_version(g, ["game_id"], "ingestion_ts", ["version_tiebreak"])
    return out.withColumn("themes", F.array_join("themes", "|", "NULL"))
