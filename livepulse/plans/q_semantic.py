"""Registered BI-model queries (measures, bridges, calendar, report visuals)."""

from __future__ import annotations

from pyspark.sql import functions as F

from livepulse.operators import semantic as H
from livepulse.operators.label_index import label_index
from livepulse.plans.q_gold import s_catalogue, s_dim_game, s_named_fact, s_star, s_star_dimensional
from livepulse.plans.registry import query
from livepulse.plans.sqllib import lj, sql
from livepulse.session import materialize

R6 = lambda c: F.round(c, 6)


@query("bi_avg_viewers_by_language", sql("""
SELECT language,
       round(CAST(sum(sum_viewers) AS DOUBLE) / nullif(sum(count_observations), 0), 6) AS avg_viewers,
       max(max_viewers) AS max_viewers
FROM s_fact GROUP BY language""", "s_fact"))
def q_bi_avg_viewers_by_language(spark, sf):
    return H.by(s_star(spark, sf), ["language"],
                {"avg_viewers": R6(H.avg_viewers()), "max_viewers": F.max("max_viewers")})


def _ratio(num="sum_viewers", den="count_observations"):
    return f"round(CAST(sum({num}) AS DOUBLE) / nullif(sum({den}), 0), 6)"


AVG = _ratio()
HOURS = "sum(count_observations) / 60.0"
THEMES = ("red", "blue")
SLICE_YEAR = 1997


def _m(**kw):
    return kw


@query("bi_viewers_by_streamer", sql(f"""
SELECT user_name, {AVG} AS avg_viewers, max(max_viewers) AS max_viewers FROM s_fact GROUP BY user_name""",
    "s_fact"))
def q_bi_viewers_by_streamer(spark, sf):
    return H.by(s_star(spark, sf), ["user_name"],
                _m(avg_viewers=R6(H.avg_viewers()), max_viewers=F.max("max_viewers")))


@query("bi_viewers_by_game", sql(f"SELECT game_name, {AVG} AS avg_viewers FROM s_fact GROUP BY game_name",
                                 "s_fact"))
def q_bi_viewers_by_game(spark, sf):
    return H.by(s_star(spark, sf), ["game_name"], _m(avg_viewers=R6(H.avg_viewers())))


@query("bi_viewers_by_hour", sql(f"""
SELECT time_hour, max(max_viewers) AS max_viewers, {AVG} AS avg_viewers FROM s_fact
GROUP BY time_hour ORDER BY time_hour""", "s_fact"))
def q_bi_viewers_by_hour(spark, sf):
    return H.by(s_star(spark, sf), ["time_hour"],
                _m(max_viewers=F.max("max_viewers"), avg_viewers=R6(H.avg_viewers()))).orderBy("time_hour")


@query("bi_streamers_by_hour", sql("""
SELECT time_hour, count(DISTINCT user_name) AS distinct_streamers FROM s_fact GROUP BY time_hour""", "s_fact"))
def q_bi_streamers_by_hour(spark, sf):
    return H.by(s_star(spark, sf), ["time_hour"], _m(distinct_streamers=H.distinct_streamers()))


@query("bi_streamers_by_game", sql("""
SELECT game_name, count(DISTINCT user_name) AS distinct_streamers FROM s_fact GROUP BY game_name""", "s_fact"))
def q_bi_streamers_by_game(spark, sf):
    return H.by(s_star(spark, sf), ["game_name"], _m(distinct_streamers=H.distinct_streamers()))


@query("bi_hours_by_streamer", sql(f"SELECT user_name, {HOURS} AS hours_online FROM s_fact GROUP BY user_name",
                                   "s_fact"))
def q_bi_hours_by_streamer(spark, sf):
    return H.by(s_star(spark, sf), ["user_name"], _m(hours_online=H.hours_online()))


@query("bi_hours_by_language", sql(f"SELECT language, {HOURS} AS hours_online FROM s_fact GROUP BY language",
                                   "s_fact"))
def q_bi_hours_by_language(spark, sf):
    return H.by(s_star(spark, sf), ["language"], _m(hours_online=H.hours_online()))


STAR_COLS = ["game_name", "user_name", "language", "date_id", "date_year", "date_month", "date_day", "time_hour",
             "max_viewers", "sum_viewers", "count_observations", "total_rating", "row_datetime"]


@query("star_join", sql("""
SELECT game_name, user_name, language, date_id, CAST(date_id // 10000 AS INTEGER) AS date_year,
       CAST(date_id // 100 % 100 AS INTEGER) AS date_month, CAST(date_id % 100 AS INTEGER) AS date_day, time_hour,
       max_viewers, sum_viewers, count_observations, total_rating, row_datetime
FROM s_star""", "s_star"))
def q_star_join(spark, sf):
    return s_star_dimensional(spark, sf).select(*STAR_COLS)


@query("fact_datetime", sql("SELECT game_name, user_name, language, date_id, time_hour, row_datetime FROM s_star",
                            "s_star"))
def q_fact_datetime(spark, sf):
    return s_star(spark, sf).select("game_name", "user_name", "language", "date_id", "time_hour", "row_datetime")


@query("viewers_on_day", sql("""
SELECT max(date_id) AS date_id, sum(sum_viewers) AS viewers FROM s_fact
WHERE date_id = (SELECT max(date_id) FROM s_fact)""", "s_fact"))
def q_viewers_on_day(spark, sf):
    """Σ viewers on the as-of day; here the as-of day is the last day with data."""
    by_day = H.by(s_named_fact(spark, sf), ["date_id"], _m(viewers=F.sum("sum_viewers")))
    return H.last_group(by_day, "date_id", "viewers").select("date_id", "viewers")


@query("viewers_on_date", sql("""
SELECT max(date_id) AS date_id, sum(sum_viewers) AS viewers FROM s_fact WHERE date_id = 19970101""", "s_fact"))
def q_viewers_on_date(spark, sf):
    """Σ viewers on a given calendar day (today is the default of the operator)."""
    return H.viewers_on_day(s_named_fact(spark, sf), day=F.lit("1997-01-01").cast("date")).select("date_id", "viewers")


def _bridge_sql(col, label):
    return f"""(SELECT DISTINCT game_name, t.v AS {label} FROM s_dim_game, unnest({col}) AS t(v)
             WHERE t.v IS NOT NULL)"""


def _dim_game(spark, sf):
    return s_dim_game(spark, sf)


@query("bridge_themes", sql(f"SELECT * FROM {_bridge_sql('themes', 'theme')}", "s_dim_game"))
def q_bridge_themes(spark, sf):
    d = _dim_game(spark, sf)
    return H.bridge(d, "themes", "theme").join(d.select("game_id", "game_name"), "game_id").select(
        "game_name", "theme")


def _by_label_sql(col, label, measures):
    return sql(f"""
SELECT b.{label}, {measures} FROM s_fact f JOIN {_bridge_sql(col, label)} b ON f.game_name = b.game_name
GROUP BY b.{label}""", "s_fact", "s_dim_game")


def _labels(spark, sf, col, label):
    """Bridge by game name from the catalogue alone; games without facts drop out in the join."""
    return H.bridge(s_catalogue(spark, sf, col), col, label, key="game_name")


def _by_label(spark, sf, col, label, measures):
    return H.by_label(s_named_fact(spark, sf), _labels(spark, sf, col, label), label, measures, key="game_name")


@query("bi_by_theme", _by_label_sql("themes", "theme", f"{AVG} AS avg_viewers, max(max_viewers) AS max_viewers"))
def q_bi_by_theme(spark, sf):
    return _by_label(spark, sf, "themes", "theme",
                     _m(avg_viewers=R6(H.avg_viewers()), max_viewers=F.max("max_viewers")))


@query("bi_by_keyword", _by_label_sql("keywords", "keyword",
                                      f"{AVG} AS avg_viewers, max(max_viewers) AS max_viewers"))
def q_bi_by_keyword(spark, sf):
    return _by_label(spark, sf, "keywords", "keyword",
                     _m(avg_viewers=R6(H.avg_viewers()), max_viewers=F.max("max_viewers")))


@query("bi_hours_by_platform", _by_label_sql("platforms", "platform", f"{HOURS} AS hours_online"))
def q_bi_hours_by_platform(spark, sf):
    return _by_label(spark, sf, "platforms", "platform", _m(hours_online=H.hours_online()))


@query("bi_hours_by_theme", _by_label_sql("themes", "theme", f"{HOURS} AS hours_online"))
def q_bi_hours_by_theme(spark, sf):
    return _by_label(spark, sf, "themes", "theme", _m(hours_online=H.hours_online()))


@query("slicer_theme", sql(f"""
SELECT language, {AVG} AS avg_viewers FROM s_fact
WHERE game_name IN (SELECT game_name FROM {_bridge_sql('themes', 'theme')} WHERE theme IN ('red', 'blue'))
GROUP BY language""", "s_fact", "s_dim_game"))
def q_slicer_theme(spark, sf):
    sliced = H.apply_slicers(s_named_fact(spark, sf), bridges={"theme": (_labels(spark, sf, "themes", "theme"), "theme", THEMES)})
    return H.by(sliced, ["language"], _m(avg_viewers=R6(H.avg_viewers())))


@query("slicer_keyword", sql(f"""
SELECT language, {AVG} AS avg_viewers FROM s_fact
WHERE game_name IN (SELECT game_name FROM {_bridge_sql('keywords', 'keyword')} WHERE keyword IN ('Brand#11', 'Brand#22'))
GROUP BY language""", "s_fact", "s_dim_game"))
def q_slicer_keyword(spark, sf):
    sliced = H.apply_slicers(s_named_fact(spark, sf), bridges={
        "keyword": (_labels(spark, sf, "keywords", "keyword"), "keyword", ("Brand#11", "Brand#22"))})
    return H.by(sliced, ["language"], _m(avg_viewers=R6(H.avg_viewers())))


@query("slicer_theme_and_keyword", sql(f"""
SELECT language, {AVG} AS avg_viewers FROM s_fact
WHERE game_name IN (SELECT game_name FROM {_bridge_sql('themes', 'theme')} WHERE theme IN ('red', 'blue'))
  AND game_name IN (SELECT game_name FROM {_bridge_sql('keywords', 'keyword')} WHERE keyword IN ('Brand#11', 'Brand#22', 'Brand#33'))
GROUP BY language""", "s_fact", "s_dim_game"))
def q_slicer_theme_and_keyword(spark, sf):
    """Two bridge slicers at once, through the bitmaps of the catalogue's labels."""
    index = label_index(s_catalogue(spark, sf, "themes", "keywords"), {"theme": "themes", "keyword": "keywords"}, key="game_name")
    games = index.select({"theme": THEMES, "keyword": ("Brand#11", "Brand#22", "Brand#33")})
    return H.by(s_named_fact(spark, sf).join(games, "game_name", "left_semi"), ["language"], _m(avg_viewers=R6(H.avg_viewers())))


@query("slicer_language", sql(f"""
SELECT user_name, {AVG} AS avg_viewers FROM s_fact WHERE language IN ('ASIA', 'EUROPE') GROUP BY user_name""", "s_fact"))
def q_slicer_language(spark, sf):
    sliced = H.apply_slicers(s_named_fact(spark, sf), columns={"language": ("ASIA", "EUROPE"), "game_name": ()})
    return H.by(sliced, ["user_name"], _m(avg_viewers=R6(H.avg_viewers())))


@query("slicer_game", sql(f"""
SELECT language, {AVG} AS avg_viewers FROM s_fact
WHERE game_name IN (SELECT game_name FROM s_fact GROUP BY game_name ORDER BY game_name LIMIT 5) GROUP BY language""", "s_fact"))
def q_slicer_game(spark, sf):
    """Slicer by game: the five first names, as a user would pick them from the facet."""
    fact = s_named_fact(spark, sf)
    names = [r[0] for r in fact.select("game_name").distinct().orderBy("game_name").limit(5).collect()]
    return H.by(H.apply_slicers(fact, columns={"game_name": names}), ["language"], _m(avg_viewers=R6(H.avg_viewers())))


@query("slicer_date", sql(f"""
SELECT language, {AVG} AS avg_viewers FROM s_fact WHERE date_id // 10000 = {SLICE_YEAR}
GROUP BY language""", "s_fact"))
def q_slicer_date(spark, sf):
    fact = s_named_fact(spark, sf).withColumn("date_year", (F.col("date_id") / 10000).cast("int"))
    return H.by(H.apply_slicers(fact, columns={"date_year": (SLICE_YEAR,)}), ["language"], _m(avg_viewers=R6(H.avg_viewers())))


@query("parse_list_text", sql(f"""
SELECT game_name, {lj('themes')} AS themes FROM s_dim_game WHERE themes IS NOT NULL""", "s_dim_game"))
def q_parse_list_text(spark, sf):
    """Lists written to the warehouse as text ("['a', 'b']") read back as arrays."""
    d = _dim_game(spark, sf)
    text = F.when(F.col("themes").isNotNull(),
                  F.concat(F.lit("['"), F.array_join("themes", "', '"), F.lit("']")))
    parsed = d.select("game_name", H.parse_list_text(text).alias("themes")).where(F.col("themes").isNotNull())
    return parsed.select("game_name", F.array_join("themes", "|", "NULL").alias("themes"))


CAL_SQL = """
SELECT d AS "Date", CAST(year(d) AS INTEGER) AS "Year", CAST(month(d) AS INTEGER) AS "MonthNo",
       strftime(d, '%B') AS "Month", CAST(quarter(d) AS INTEGER) AS "QuarterNo",
       'Qtr ' || CAST(quarter(d) AS VARCHAR) AS "Quarter", CAST(day(d) AS INTEGER) AS "Day"
FROM (SELECT CAST(unnest(generate_series(make_date(CAST(min(year(row_datetime)) AS INTEGER), 1, 1),
                                          make_date(CAST(max(year(row_datetime)) AS INTEGER), 12, 31),
                                          INTERVAL 1 DAY)) AS DATE) AS d FROM s_star)"""


def _calendar(spark, sf, star=None):
    star = star if star is not None else s_star(spark, sf)
    return H.calendar(star, "row_datetime")


@query("calendar", sql(CAL_SQL, "s_star"))
def q_calendar(spark, sf):
    return _calendar(spark, sf)


@query("calendar_join", sql(f"""
SELECT s.game_name, s.user_name, s.row_datetime, c."Year", c."Quarter", c."Month", c."Day"
FROM s_star s LEFT JOIN ({CAL_SQL}) c ON CAST(s.row_datetime AS DATE) = c."Date" """, "s_star"))
def q_calendar_join(spark, sf):
    star = s_star(spark, sf)
    return H.calendar_join(star, "row_datetime", _calendar(spark, sf, star)).select(
        "game_name", "user_name", "row_datetime", "Year", "Quarter", "Month", "Day")


@query("calendar_rollup", sql(f"""
SELECT c."Year", c."QuarterNo", c."MonthNo", c."Day", sum(s.sum_viewers) AS viewers,
       CAST(sum(s.count_observations) AS BIGINT) AS observations,
       CAST(grouping(c."Year", c."QuarterNo", c."MonthNo", c."Day") AS INTEGER) AS level
FROM s_star s JOIN ({CAL_SQL}) c ON CAST(s.row_datetime AS DATE) = c."Date"
GROUP BY ROLLUP (c."Year", c."QuarterNo", c."MonthNo", c."Day")""", "s_star"))
def q_calendar_rollup(spark, sf):
    """One row per day first: the calendar join and the five-level rollup then see days, not facts."""
    days = H.with_row_datetime(s_named_fact(spark, sf).groupBy("date_id").agg(
        F.sum("sum_viewers").alias("sum_viewers"), F.sum("count_observations").alias("count_observations"))
        .withColumn("time_hour", F.lit(0)))
    days = materialize(days)                    # read twice: the calendar's bounds and the totals
    joined = days.join(_calendar(spark, sf, days), F.to_date("row_datetime") == F.col("Date"))
    return H.hierarchy_totals(joined, _m(viewers=F.sum("sum_viewers"),
                                         observations=F.sum("count_observations")))


@query("kpi_last_day", sql("""
SELECT date_id, round(avg(sum_viewers), 6) AS avg_sum_viewers FROM s_fact
GROUP BY date_id ORDER BY date_id DESC LIMIT 1""", "s_fact"))
def q_kpi_last_day(spark, sf):
    by_day = H.by(s_star(spark, sf), ["date_id"], _m(avg_sum_viewers=R6(F.avg("sum_viewers"))))
    return H.last_group(by_day, "date_id", "avg_sum_viewers")


@query("kpi_last_hour", sql("""
SELECT row_datetime, round(avg(sum_viewers), 6) AS avg_sum_viewers FROM s_star
GROUP BY row_datetime ORDER BY row_datetime DESC LIMIT 1""", "s_star"))
def q_kpi_last_hour(spark, sf):
    by_hour = H.by(s_star(spark, sf), ["row_datetime"], _m(avg_sum_viewers=R6(F.avg("sum_viewers"))))
    return H.last_group(by_hour, "row_datetime", "avg_sum_viewers")


@query("kpi_hours_last_day", sql(f"""
SELECT date_id, {HOURS} AS hours_online FROM s_fact GROUP BY date_id ORDER BY date_id DESC LIMIT 1""", "s_fact"))
def q_kpi_hours_last_day(spark, sf):
    by_day = H.by(s_star(spark, sf), ["date_id"], _m(hours_online=H.hours_online()))
    return H.last_group(by_day, "date_id", "hours_online")


@query("top10_games_by_hour", sql(f"""
SELECT *, CAST(rank() OVER (PARTITION BY time_hour ORDER BY avg_viewers DESC NULLS LAST, game_name) AS INTEGER)
       AS "rank"
FROM (SELECT time_hour, game_name, {AVG} AS avg_viewers FROM s_fact
      WHERE game_name IN (SELECT game_name FROM s_fact GROUP BY game_name
                          ORDER BY sum(sum_viewers) DESC NULLS LAST, game_name LIMIT 10)
      GROUP BY time_hour, game_name)""", "s_fact"))
def q_top10_games_by_hour(spark, sf):
    star = s_star(spark, sf)
    top = H.top_n_filter(star, "game_name", F.sum("sum_viewers"), 10)
    agg = H.by(top, ["time_hour", "game_name"], _m(avg_viewers=R6(H.avg_viewers())))
    return H.rank_within(agg, "time_hour", "avg_viewers", "rank", tiebreak="game_name")


@query("rating_viewer_points", sql(f"""
SELECT game_name, {AVG} AS avg_viewers, sum(total_rating) AS rating FROM s_star GROUP BY game_name""", "s_star"))
def q_rating_viewer_points(spark, sf):
    return H.by(s_star(spark, sf), ["game_name"], _m(avg_viewers=R6(H.avg_viewers()),
                                                      rating=F.sum("total_rating")))


@query("rating_viewer_corr", sql(f"""
SELECT round(corr(avg_viewers, total_rating), 6) AS correlation, count(*) AS games FROM (
  SELECT game_name, CAST(sum(sum_viewers) AS DOUBLE) / nullif(sum(count_observations), 0) AS avg_viewers,
         max(total_rating) AS total_rating
  FROM s_star GROUP BY game_name)""", "s_star"))
def q_rating_viewer_corr(spark, sf):
    per_game = H.by(s_star(spark, sf), ["game_name"],
                    _m(avg_viewers=H.avg_viewers(), total_rating=F.max("total_rating")))
    return per_game.agg(F.round(F.corr("avg_viewers", "total_rating"), 6).alias("correlation"),
                        F.count(F.lit(1)).alias("games"))
