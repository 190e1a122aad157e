"""Batch table reads and writes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from livepulse.schemas import SOURCE_TABLES


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | None = None, options: dict | None = None) -> DataFrame:
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table: ``{sf_dir}/{name}.parquet``. Its schema is given, so that building a query
    runs no job; a table without one here is read with the schema of its files."""
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", schema=SOURCE_TABLES.get(name))


def read_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                  options: dict | None = None) -> DataFrame:
    """Read a table; a path that does not exist yet gives an empty frame of ``schema``.

    Only a missing path is forgiven: any other failure (corrupt file, bad
    schema) propagates, so lost data is never silently read as empty.
    """
    try:
        return read_table(spark, path, fmt, schema, options)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or "") or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose DataFrames to SQL under the given names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_append(df: DataFrame, path: str | None = None, fmt: str = "parquet",
                 options: dict | None = None, partition_by: Iterable[str] = ()) -> None:
    """Append write to any connector: a path-based format, or a connector configured
    by options alone (e.g. a warehouse format with host/table options)."""
    w = df.write.format(fmt).options(**(options or {})).mode("append")
    parts = list(partition_by)
    if parts:
        w = w.partitionBy(*parts)
    if path is None:
        w.save()
    else:
        w.save(path)
