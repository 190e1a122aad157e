"""Registered bronze and silver queries (decode, project, explode, flatten)."""

from __future__ import annotations

from pyspark.sql import functions as F

from livepulse.operators import bronze as B
from livepulse.operators import silver as C
from livepulse.plans import profiles as P
from livepulse.plans.registry import query
from livepulse.plans.sqllib import lj, sql
from livepulse.schemas import WIRE_GAME, WIRE_STREAM
from livepulse.sources.tables import table


def _message(record):
    """A broker message: 5-byte header + JSON record. JSON text is UTF-8 already, so its bytes are taken as they are."""
    return F.concat(F.unhex(F.lit("0000000001")), F.to_json(record).cast("binary"))


def wire_messages(spark, sf):
    """Profile E snapshots encoded as broker messages: 5-byte header + JSON record,
    with the poll time as the message timestamp."""
    s = P.e_snapshots(spark, sf)
    record = F.struct(
        F.col("stream_id").alias("id"), "user_name", "game_name", "title", "tags",
        F.col("viewer_count").cast("int").alias("viewer_count"),
        F.date_format("started_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("started_at"),
        "language", "thumbnail_url")
    return s.select(_message(record).alias("value"), F.col("ingestion_ts").alias("timestamp"))


@query("envelope_decode", sql(f"""
SELECT stream_id, user_name, game_name, title, CAST(viewer_count AS INTEGER) AS viewer_count, language,
       {lj('tags')} AS tags
FROM e_snap""", "e_snap"))
def q_envelope_decode(spark, sf):
    d = B.decode_envelope(wire_messages(spark, sf), WIRE_STREAM)
    return d.select(F.col("record.id").alias("stream_id"), "record.user_name", "record.game_name",
                    "record.title", "record.viewer_count", "record.language",
                    F.array_join("record.tags", "|", "NULL").alias("tags"))


@query("bronze_streams", sql("""
SELECT ingestion_ts, stream_id, user_name, game_name, title, CAST(viewer_count AS INTEGER) AS viewer_count,
       started_at, language, thumbnail_url, year, month, day
FROM e_bronze""", "e_bronze"))
def q_bronze_streams(spark, sf):
    d = B.decode_envelope(wire_messages(spark, sf), WIRE_STREAM)
    return B.bronze_streams(d).drop("tags")


@query("distinct_keys", sql("SELECT DISTINCT user_name FROM e_snap WHERE user_name IS NOT NULL AND user_name <> ''",
                            "e_snap"))
def q_distinct_keys(spark, sf):
    return B.distinct_keys(P.e_snapshots(spark, sf), "user_name")


def _part_catalogue(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("game_id"), F.col("p_name").alias("game_name"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit(None))
         .otherwise((F.col("p_partkey") + 1000).cast("string")).alias("igdb_id"))


def _part_metadata(spark, sf):
    """Metadata records keyed by an integer id, one per part. Every third part's
    record carries an id no catalogue row refers to, so those catalogue rows find
    no metadata (left join keeps them with a null struct)."""
    p = table(spark, sf, "part")
    shift = F.when(F.col("p_partkey") % 3 == 0, F.lit(1_000_000)).otherwise(F.lit(0))
    return p.select((F.col("p_partkey") + 1000 + shift).cast("int").alias("id"),
                    F.col("p_type").alias("summary"),
                    (F.col("p_size") * 2.0).alias("total_rating"))


@query("metadata_enrich", sql("""
SELECT CAST(p.p_partkey AS VARCHAR) AS game_id, p.p_name AS game_name,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE CAST(p.p_partkey + 1000 AS VARCHAR) END AS igdb_id,
       m.summary AS meta_summary, m.total_rating AS meta_rating
FROM part p
LEFT JOIN (SELECT CAST(p_partkey + 1000 + CASE WHEN p_partkey % 3 = 0 THEN 1000000 ELSE 0 END AS VARCHAR) AS k,
                  p_type AS summary, CAST(p_size * 2 AS DOUBLE) AS total_rating
           FROM part) m
  ON (CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE CAST(p.p_partkey + 1000 AS VARCHAR) END) = m.k"""))
def q_metadata_enrich(spark, sf):
    out = B.enrich_with_metadata(_part_catalogue(spark, sf), _part_metadata(spark, sf))
    return out.select("game_id", "game_name", "igdb_id", F.col("igdb_data.summary").alias("meta_summary"),
                      F.col("igdb_data.total_rating").alias("meta_rating"))


@query("silver_streams", sql("SELECT * EXCLUDE (thumbnail_url) FROM e_silver", "e_silver"))
def q_silver_streams(spark, sf):
    return P.e_silver(spark, sf).drop("thumbnail_url")


@query("stream_tags", sql("SELECT * FROM e_tags", "e_tags"))
def q_stream_tags(spark, sf):
    return P.e_tags(spark, sf)


SILVER_GAME_LISTS = ("themes", "player_perspectives", "keywords", "game_modes", "platforms",
                     "platform_families", "platform_types")


@query("silver_games", sql(
    "SELECT * REPLACE (" + ", ".join(f"{lj(c)} AS {c}" for c in SILVER_GAME_LISTS) + ") FROM s_games",
    "s_games"))
def q_silver_games(spark, sf):
    g = C.silver_games(P.s_bronze_games(spark, sf), extra=("version_tiebreak",))
    return g.withColumns({c: F.array_join(c, "|", "NULL") for c in SILVER_GAME_LISTS})


TASKS_PER_CORE = 8    # least number of tasks a core gets of the catalogue's messages


def game_messages(spark, sf):
    """Catalogue versions encoded as broker messages: 5-byte header + JSON record with the
    nested metadata; the version rides along in the message key.

    A message costs far more time than the plain row it is made of, and tasks cut by the bytes of plain rows (a file's
    row groups, shuffle partitions that AQE joins to about one a core) leave cores idle. So the rows are dealt to a
    fixed number of tasks before their records are made."""
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    g = P.s_bronze_games(spark, sf, tasks)
    record = F.struct(F.col("game_id").alias("id"), F.col("game_name").alias("name"), "igdb_id", "igdb_data")
    return g.select(_message(record).alias("value"),
                    F.col("ingestion_ts").alias("timestamp"), F.col("version_tiebreak").alias("key"))


GAME_COLS = ["ingestion_ts", "game_id", "game_name", "igdb_id", "total_rating", "first_release_date"]
GAME_LISTS = ["themes", "keywords", "game_modes", "platforms", "platform_families", "platform_types"]


@query("bronze_games", sql(f"""
SELECT {", ".join(GAME_COLS)}, {", ".join(f"{lj(c)} AS {c}" for c in GAME_LISTS)} FROM s_games""", "s_games"))
def q_bronze_games(spark, sf):
    """The nested catalogue record through the wire: decode, bronze projection, silver flattening."""
    decoded = B.decode_envelope(game_messages(spark, sf), WIRE_GAME)
    out = C.silver_games(B.bronze_games(decoded))
    return out.select(*GAME_COLS, *[F.array_join(c, "|", "NULL").alias(c) for c in GAME_LISTS])
