"""Explicit schemas of every table in the pipeline (no inference on data paths).

Fixed values: field names and types of the wire records and tables must match the feeds.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# --- wire records (one message per live broadcast / per game, per poll) ------

WIRE_STREAM = T.StructType([
    _f("id", S), _f("user_name", S), _f("game_name", S), _f("title", S),
    _f("tags", T.ArrayType(S)), _f("viewer_count", I), _f("started_at", S),
    _f("language", S), _f("thumbnail_url", S),
])

ID_NAME = T.StructType([_f("id", I), _f("name", S)])

PLATFORM = T.StructType([
    _f("name", S), _f("platform_family", ID_NAME), _f("platform_type", ID_NAME),
])

METADATA = T.StructType([
    _f("id", I), _f("summary", S), _f("total_rating", D), _f("total_rating_count", I),
    _f("first_release_date", L), _f("storyline", S), _f("url", S),
    _f("themes", T.ArrayType(ID_NAME)), _f("player_perspectives", T.ArrayType(ID_NAME)),
    _f("keywords", T.ArrayType(ID_NAME)), _f("game_modes", T.ArrayType(ID_NAME)),
    _f("platforms", T.ArrayType(PLATFORM)),
])

WIRE_GAME = T.StructType([
    _f("id", S), _f("name", S), _f("igdb_id", S), _f("igdb_data", METADATA),
])

# --- bronze -------------------------------------------------------------------

BRONZE_STREAMS = T.StructType([
    _f("ingestion_ts", TS), _f("stream_id", S), _f("user_name", S), _f("game_name", S),
    _f("title", S), _f("tags", T.ArrayType(S)), _f("viewer_count", I), _f("started_at", TS),
    _f("language", S), _f("thumbnail_url", S), _f("year", I), _f("month", I), _f("day", I),
])

BRONZE_GAMES = T.StructType([
    _f("ingestion_ts", TS), _f("game_id", S), _f("game_name", S), _f("igdb_id", S),
    _f("igdb_data", METADATA),
])

# --- silver -------------------------------------------------------------------

STREAM_TAGS = T.StructType([_f("stream_id", S), _f("ingestion_ts", TS), _f("tag_name", S)])

TRANSITIONS = T.StructType([
    _f("stream_id", S), _f("user_name", S), _f("event_type", S), _f("old_value", S),
    _f("new_value", S), _f("event_ts", TS), _f("viewer_delta", L),
])

SILVER_GAMES_LISTS = ["themes", "player_perspectives", "keywords", "game_modes",
                      "platforms", "platform_families", "platform_types"]

SILVER_GAMES = T.StructType([
    _f("ingestion_ts", TS), _f("game_id", S), _f("game_name", S), _f("igdb_id", S),
    _f("summary", S), _f("total_rating", D), _f("total_rating_count", I), _f("storyline", S),
    _f("url", S), _f("first_release_date", TS),
] + [_f(c, T.ArrayType(S)) for c in SILVER_GAMES_LISTS])

# State kept per stream by the change detector: its previous poll, and the polls the watermark has not
# passed yet (poll times as microseconds), packed: the polls of one micro-batch are one element, a list per column.
LAST_POLL = T.StructType([_f("us", L), _f("game", S), _f("title", S), _f("viewers", L)])
WAITING_POLLS = T.StructType([_f(f.name, T.ArrayType(f.dataType)) for f in [*LAST_POLL, _f("user", S)]])

# --- gold (star schema) ---------------------------------------------------------

DIM_GAME_COLUMNS = ["game_id", "game_name", "igdb_id", "total_rating", "total_rating_count",
                    "first_release_date", "themes", "keywords", "platforms"]
DIM_DATE_COLUMNS = ["date_id", "date_year", "date_month", "date_day"]
FACT_KEYS = ["game_id", "streamer_id", "language_id", "date_id", "time_hour"]
FACT_MEASURES = ["max_viewers", "sum_viewers", "count_observations"]

# Natural keys of each dimension (the surrogate key is xxhash64 of it).
DIMENSION_KEYS = {
    "dim_game": ("game_id", "game_name"),
    "dim_streamer": ("streamer_id", "user_name"),
    "dim_language": ("language_id", "language"),
    "dim_date": ("date_id", None),
}

# --- the tables the registered queries read ------------------------------------------

NTZ = T.TimestampNTZType()
SOURCE_TABLES = {
    "region": T.StructType([_f("r_regionkey", I), _f("r_name", S)]),
    "nation": T.StructType([_f("n_nationkey", I), _f("n_name", S), _f("n_regionkey", I)]),
    "customer": T.StructType([_f("c_custkey", L), _f("c_name", S), _f("c_nationkey", I), _f("c_acctbal", D),
                              _f("c_mktsegment", S)]),
    "supplier": T.StructType([_f("s_suppkey", L), _f("s_name", S), _f("s_nationkey", I), _f("s_acctbal", D)]),
    "part": T.StructType([_f("p_partkey", L), _f("p_name", S), _f("p_brand", S), _f("p_type", S), _f("p_size", I),
                          _f("p_retailprice", D)]),
    "orders": T.StructType([_f("o_orderkey", L), _f("o_custkey", L), _f("o_orderstatus", S), _f("o_totalprice", D),
                            _f("o_orderdate", NTZ), _f("o_orderpriority", S)]),
    "lineitem": T.StructType([_f("l_orderkey", L), _f("l_partkey", L), _f("l_suppkey", L), _f("l_linenumber", I),
                              _f("l_quantity", D), _f("l_extendedprice", D), _f("l_discount", D), _f("l_tax", D),
                              _f("l_returnflag", S), _f("l_linestatus", S), _f("l_shipdate", NTZ)]),
    "events": T.StructType([_f("event_id", L), _f("ts", NTZ), _f("user_id", L), _f("event_type", S), _f("value", D),
                            _f("props", S)]),
}
