"""Bronze: decode broker records, project, add partition columns, enrich catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from livepulse.functions.text import strip_envelope
from livepulse.functions.time import parse_iso_ts


def decode_envelope(df: DataFrame, schema: StructType, value_col: str = "value",
                    encoding: str = "json", header_bytes: int = 5, out: str = "record",
                    avro_schema: str | None = None) -> DataFrame:
    """Strip the wire header and decode the payload with a fixed reader schema.

    ``encoding="avro"`` uses ``from_avro`` (needs the spark-avro package and the
    Avro schema text); ``"json"`` decodes a JSON payload with ``schema``. Both
    fail fast on a malformed record when ``mode=FAILFAST`` is the default of the
    decoder.
    """
    payload = strip_envelope(value_col, header_bytes)
    if encoding == "avro":
        from pyspark.sql.avro.functions import from_avro
        decoded = from_avro(payload, avro_schema)
    elif encoding == "json":
        decoded = F.from_json(payload.cast("string"), schema, {"mode": "FAILFAST"})
    else:
        raise ValueError(f"unknown encoding {encoding!r}")
    return df.withColumn(out, decoded)


def with_partition_columns(df: DataFrame, ts_col: str = "ingestion_ts") -> DataFrame:
    """year / month / day of the poll time, used as the table's partition layout."""
    ts = F.col(ts_col)
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def bronze_streams(decoded: DataFrame, record: str = "record", ts_col: str = "timestamp",
                   lenient_timestamps: bool = False) -> DataFrame:
    """Decoded stream records → bronze rows (renames id→stream_id, parses started_at)."""
    r = lambda f: F.col(f"{record}.{f}")
    projected = decoded.select(
        F.col(ts_col).cast("timestamp").alias("ingestion_ts"),
        r("id").alias("stream_id"), r("user_name"), r("game_name"), r("title"), r("tags"),
        r("viewer_count"),
        parse_iso_ts(r("started_at"), lenient_timestamps).cast("timestamp").alias("started_at"),
        r("language"), r("thumbnail_url"),
    )
    return with_partition_columns(projected)


def bronze_games(decoded: DataFrame, record: str = "record", ts_col: str = "timestamp") -> DataFrame:
    """Decoded catalogue records → bronze rows (metadata struct kept raw and nested)."""
    r = lambda f: F.col(f"{record}.{f}")
    return decoded.select(
        F.col(ts_col).cast("timestamp").alias("ingestion_ts"), r("id").alias("game_id"),
        r("name").alias("game_name"), r("igdb_id"), r("igdb_data"),
    )


def distinct_keys(df: DataFrame, key: str, out: str | None = None) -> DataFrame:
    """Distinct non-empty values of a foreign key (null and '' are dropped)."""
    k = F.col(key)
    return df.where(k.isNotNull() & (k.cast("string") != "")).select(k.alias(out or key)).distinct()


# Nested fields requested from the metadata service, in request order.
METADATA_FIELDS = [
    "id", "summary", "total_rating", "total_rating_count", "first_release_date", "storyline",
    "themes.name", "player_perspectives.name", "keywords.name", "game_modes.name",
    "platforms.name", "platforms.platform_family.name", "platforms.platform_type.name", "url",
]


def metadata_projection(records: DataFrame, fields=METADATA_FIELDS) -> DataFrame:
    """Select the requested (possibly nested, ``a.b.name``) fields of metadata
    records; a nested path over arrays of structs yields the array of names."""
    return records.select(*[F.col(f).alias(f.replace(".", "_")) for f in fields])


def enrich_with_metadata(catalogue: DataFrame, metadata: DataFrame, key: str = "igdb_id",
                         meta_key: str = "id", out: str = "igdb_data") -> DataFrame:
    """Attach each catalogue row's metadata record as a struct (or null).

    Left join on the key compared as text, so numeric metadata ids match string
    catalogue ids. The metadata side is deduplicated per key first, so a key
    never fans a catalogue row out. Join strategy is left to AQE: a small
    metadata side is broadcast after its size is measured, a large one is
    shuffled.
    """
    meta_cols = [c for c in metadata.columns]
    meta = (metadata
            .withColumn("_k", F.col(meta_key).cast("string"))
            .where(F.col("_k").isNotNull())
            .groupBy("_k")
            .agg(F.max_by(F.struct(*[F.col(c) for c in meta_cols]),
                          F.struct(*[F.col(c) for c in meta_cols])).alias(out)))
    return (catalogue
            .join(meta, F.col(key).cast("string") == F.col("_k"), "left")
            .drop("_k"))
