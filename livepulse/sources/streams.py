"""Streaming sources, sinks and triggers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def broker_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                  fail_on_data_loss: bool = False, fmt: str = "kafka",
                  extra: dict | None = None) -> DataFrame:
    """Subscribe to a message-broker topic (key, value, topic, partition, offset, timestamp).

    The connector jar must be on the classpath; the value column carries the
    encoded record, decoded by ``operators.bronze.decode_envelope``.
    """
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    opts.update(extra or {})
    return spark.readStream.format(fmt).options(**opts).load()


def table_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                 max_bytes_per_trigger: int | None = None,
                 max_files_per_trigger: int | None = None,
                 options: dict | None = None) -> DataFrame:
    """Incremental read of an append-only table (each new file is read once).

    ``max_bytes_per_trigger`` caps a micro-batch (table formats that support
    it); ``max_files_per_trigger`` is the file-source equivalent.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path)


def trigger_options(kind: str = "default", interval: str = "60 seconds") -> dict:
    """Keyword arguments for ``DataStreamWriter.trigger``: default micro-batch,
    fixed processing-time interval, or catch-up-then-stop."""
    if kind == "default":
        return {}
    if kind == "processing_time":
        return {"processingTime": interval}
    if kind == "available_now":
        return {"availableNow": True}
    raise ValueError(f"unknown trigger kind {kind!r}")


def append_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                  partition_by: Iterable[str] = (), trigger: str = "default",
                  interval: str = "60 seconds", query_name: str | None = None) -> StreamingQuery:
    """Append sink with a checkpoint (exactly-once for file sinks)."""
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint))
    parts = list(partition_by)
    if parts:
        w = w.partitionBy(*parts)
    if query_name:
        w = w.queryName(query_name)
    opts = trigger_options(trigger, interval)
    if opts:
        w = w.trigger(**opts)
    return w.start(path)


def await_any(spark: SparkSession, timeout_s: float | None = None) -> bool:
    """Block until any active query of the session ends (or the timeout passes)."""
    if timeout_s is None:
        spark.streams.awaitAnyTermination()
        return True
    return bool(spark.streams.awaitAnyTermination(int(timeout_s * 1000)))
