"""BI model: star joins, measures, bridges, calendar and report queries.

Measures are ratios of sums (never means of ratios) and are computed after the
slicers have filtered the star, as a BI engine would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from livepulse.functions.constants import POLLS_PER_HOUR, QUARTER_PREFIX
from livepulse.functions.lists import parse_list_text  # noqa: F401  (re-exported)


# --- measures -------------------------------------------------------------------

def avg_viewers() -> Column:
    """Σ sum_viewers / Σ count_observations; null when the count sum is 0."""
    return F.try_divide(F.sum("sum_viewers"), F.sum("count_observations").cast("double"))


def distinct_streamers(approx: bool = False) -> Column:
    return F.approx_count_distinct("streamer_id") if approx else F.count_distinct("streamer_id")


def hours_online(polls_per_hour: int = POLLS_PER_HOUR) -> Column:
    return F.sum("count_observations") / F.lit(float(polls_per_hour))


# --- star -----------------------------------------------------------------------

def star_join(fact: DataFrame, dim_game: DataFrame | None = None, dim_streamer: DataFrame | None = None,
              dim_language: DataFrame | None = None, dim_date: DataFrame | None = None) -> DataFrame:
    """Fact joined to its dimensions (left, from the fact side), plus the row datetime.

    Dimensions are deduplicated per key before they reach here (replacing-merge
    read), so each join keeps the fact's row count. The strategy (broadcast or
    shuffle) is left to AQE, which measures each dimension at runtime.
    """
    out = fact
    for dim, key in ((dim_game, "game_id"), (dim_streamer, "streamer_id"),
                     (dim_language, "language_id"), (dim_date, "date_id")):
        if dim is not None:
            out = out.join(dim.drop("inserted_at"), key, "left")
    return with_row_datetime(out)


def with_row_datetime(fact: DataFrame) -> DataFrame:
    """Datetime of a fact row: its date key's calendar day at ``time_hour``:00."""
    d = F.col("date_id")
    return fact.withColumn("row_datetime", F.make_timestamp(
        (d / 10000).cast("int"), ((d / 100).cast("long") % 100).cast("int"), (d % 100).cast("int"),
        F.col("time_hour").cast("int"), F.lit(0), F.lit(0)))


def by(star: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    return star.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])


def viewers_on_day(star: DataFrame, day: Column | None = None, day_key: DataFrame | None = None) -> DataFrame:
    """Σ sum_viewers on one day. The day is a date (today by default), or a
    one-row frame ``day_key`` holding a ``date_id`` (e.g. the last day with data)."""
    if day_key is not None:
        return star.join(day_key, "date_id", "left_semi").agg(
            F.max("date_id").alias("date_id"), F.sum("sum_viewers").alias("viewers"))
    key = F.date_format(day if day is not None else F.current_date(), "yyyyMMdd").cast("long")
    return star.where(F.col("date_id") == key).agg(F.max("date_id").alias("date_id"),
                                                   F.sum("sum_viewers").alias("viewers"))


# --- bridges --------------------------------------------------------------------

def bridge(dim_game: DataFrame, list_col: str, out: str | None = None, key: str = "game_id") -> DataFrame:
    """game × label pairs from a list column: explode, distinct, no nulls."""
    name = out or list_col
    return (dim_game.select(key, F.explode(list_col).alias(name))
            .where(F.col(name).isNotNull()).distinct())


def bridge_from_text(dim_game: DataFrame, text_col: str, out: str | None = None) -> DataFrame:
    """Bridge from a list stored as text; rows whose text does not parse are dropped."""
    parsed = dim_game.select("game_id", parse_list_text(text_col).alias("_l")).where(F.col("_l").isNotNull())
    return bridge(parsed, "_l", out or text_col)


def per_game(fact: DataFrame, key: str = "game_id") -> DataFrame:
    """The fact's three measures merged to one row per game (max of max, sums of sums): what a
    bridge join needs, however many fact rows a popular game has."""
    return fact.groupBy(key).agg(F.max("max_viewers").alias("max_viewers"), F.sum("sum_viewers").alias("sum_viewers"),
                                 F.sum("count_observations").alias("count_observations"))


def by_label(fact: DataFrame, bridge_df: DataFrame, label: str, measures: dict[str, Column],
             key: str = "game_id") -> DataFrame:
    """Measures per bridge label: a game counts once under each of its labels, so
    label totals overlap and must not be summed. ``measures`` are over max_viewers,
    sum_viewers and count_observations, which merge, so games are merged before the join."""
    return per_game(fact, key).join(bridge_df, key).groupBy(label).agg(*[m.alias(n) for n, m in measures.items()])


def slice_by_label(star: DataFrame, bridge_df: DataFrame, label: str, values: Sequence[str],
                   key: str = "game_id") -> DataFrame:
    """Slicer through a bridge: fact rows whose game has any of the labels (semi join)."""
    chosen = bridge_df.where(F.col(label).isin(list(values))).select(key)
    return star.join(chosen, key, "left_semi")


def apply_slicers(star: DataFrame, columns: dict[str, Sequence] | None = None,
                  bridges: dict[str, tuple[DataFrame, str, Sequence[str]]] | None = None) -> DataFrame:
    """Report slicers, applied before any measure is aggregated.

    ``columns``: {column: allowed values} on the star's own columns (language,
    game, date parts ...), each an ``isin``. ``bridges``: {name: (bridge frame,
    label column, allowed labels)}, each a semi join through the bridge. Empty
    selections mean "no filter", as in a report.
    """
    out = star
    for col, values in (columns or {}).items():
        if values:
            out = out.where(F.col(col).isin(list(values)))
    for _, (bridge_df, label, values) in (bridges or {}).items():
        if values:
            key = next(c for c in bridge_df.columns if c != label)
            out = slice_by_label(out, bridge_df, label, values, key)
    return out


# --- calendar -------------------------------------------------------------------

def calendar(dates: DataFrame, col: str) -> DataFrame:
    """Every day from Jan 1 of the first year to Dec 31 of the last year in ``col``.

    The bounds are one aggregate row; the days are generated by ``sequence``
    from it (at most 366 per covered year).
    """
    bounds = dates.agg(F.min(F.year(col)).alias("y0"), F.max(F.year(col)).alias("y1"))
    days = bounds.select(F.explode(F.sequence(
        F.make_date("y0", F.lit(1), F.lit(1)), F.make_date("y1", F.lit(12), F.lit(31)))).alias("Date"))
    return days.select(
        "Date",
        F.year("Date").alias("Year"),
        F.month("Date").alias("MonthNo"),
        F.date_format("Date", "MMMM").alias("Month"),
        F.quarter("Date").alias("QuarterNo"),
        F.concat(F.lit(QUARTER_PREFIX), F.quarter("Date").cast("string")).alias("Quarter"),
        F.dayofmonth("Date").alias("Day"),
    )


def calendar_join(df: DataFrame, ts_col: str, cal: DataFrame) -> DataFrame:
    """Attach calendar attributes by the calendar date of a datetime column."""
    return df.join(cal, F.to_date(F.col(ts_col)) == cal["Date"], "left")


def hierarchy_totals(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Year > Quarter > Month > Day drill-down totals (one rollup pass)."""
    return (df.rollup("Year", "QuarterNo", "MonthNo", "Day")
            .agg(*[m.alias(n) for n, m in measures.items()],
                 F.grouping_id().alias("level")))


# --- report helpers -------------------------------------------------------------

def last_group(df: DataFrame, order_col: str, measure: str) -> DataFrame:
    """Value of a measure in the last group by ``order_col`` (a KPI card's "latest")."""
    return df.agg(F.max_by(measure, order_col).alias(measure), F.max(order_col).alias(order_col))


def top_n_filter(star: DataFrame, key: str, score: Column, n: int) -> DataFrame:
    """Rows whose ``key`` is among the top n by ``score`` (subquery filter as a semi join)."""
    top = (star.groupBy(key).agg(score.alias("_score"))
           .orderBy(F.col("_score").desc_nulls_last(), F.col(key)).limit(n).select(key))
    return star.join(top, key, "left_semi")


def rank_within(df: DataFrame, part: str, score: str, out: str = "rank", tiebreak: str | None = None) -> DataFrame:
    order = [F.col(score).desc_nulls_last()] + ([F.col(tiebreak)] if tiebreak else [])
    return df.withColumn(out, F.rank().over(Window.partitionBy(part).orderBy(*order)))
