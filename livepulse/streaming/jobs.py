"""Streaming jobs of the medallion pipeline.

bronze: broker records → decoded rows, partitioned by poll date.
silver: bronze table read as a stream → enriched snapshots / tags / catalogue.
gold:   silver snapshots read as a rate-limited stream → per micro-batch star
        schema; its five tables become visible together by one commit record
        (``sources.committed``), a replayed batch that has one is done already;
        readers merge partial rows on read, without a shuffle.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from livepulse.operators import bronze as B
from livepulse.operators import gold
from livepulse.operators import quality as Q
from livepulse.operators import silver as C
from livepulse.schemas import BRONZE_GAMES, FACT_KEYS, WIRE_GAME, WIRE_STREAM
from livepulse.session import list_dir, path_exists, read_small
from livepulse.sources.committed import CommittedTables
from livepulse.sources.streams import append_stream, table_stream, trigger_options
from livepulse.sources.tables import write_append


def bronze_streams_job(broker: DataFrame, out: str, checkpoint: str, encoding: str = "json",
                       avro_schema: str | None = None, trigger: str = "default", fmt: str = "parquet") -> StreamingQuery:
    decoded = B.decode_envelope(broker, WIRE_STREAM, encoding=encoding, avro_schema=avro_schema)
    return append_stream(B.bronze_streams(decoded), out, checkpoint, fmt=fmt,
                         partition_by=("year", "month", "day"), trigger=trigger)


def bronze_games_job(broker: DataFrame, out: str, checkpoint: str, encoding: str = "json",
                     avro_schema: str | None = None, trigger: str = "default", fmt: str = "parquet") -> StreamingQuery:
    decoded = B.decode_envelope(broker, WIRE_GAME, encoding=encoding, avro_schema=avro_schema)
    return append_stream(B.bronze_games(decoded), out, checkpoint, fmt=fmt, trigger=trigger)


def silver_job(spark: SparkSession, kind: str, bronze_path: str, out: str, checkpoint: str,
               schema=None, trigger: str = "processing_time", interval: str = "60 seconds",
               max_files_per_trigger: int | None = None, fmt: str = "parquet") -> StreamingQuery:
    """One of the silver streams: kind is 'streams', 'tags' or 'games'; ``fmt`` is the table
    format of both sides."""
    from livepulse.schemas import BRONZE_STREAMS
    src_schema = schema or (BRONZE_GAMES if kind == "games" else BRONZE_STREAMS)
    src = table_stream(spark, bronze_path, src_schema, fmt=fmt, max_files_per_trigger=max_files_per_trigger)
    op = {"streams": C.silver_streams, "tags": C.stream_tags, "games": C.silver_games}[kind]
    return append_stream(op(src), out, checkpoint, fmt=fmt, trigger=trigger, interval=interval)


def transitions_job(spark: SparkSession, bronze_path: str, out: str, checkpoint: str, schema=None,
                    trigger: str = "processing_time", interval: str = "60 seconds",
                    watermark: str = "1 hour", max_files_per_trigger: int | None = None,
                    state_partitions: int | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Stateful change detection as a job. ``state_partitions`` fixes the number of
    state-store partitions (None: the session's shuffle partitions); it is recorded in
    the checkpoint at the first start and cannot change afterwards (AQE never re-plans a
    stateful shuffle), so size it for the keys expected, not for today's."""
    from livepulse.schemas import BRONZE_STREAMS
    from livepulse.streaming.transitions import detect_transitions_stream
    src = table_stream(spark, bronze_path, schema or BRONZE_STREAMS, fmt=fmt, max_files_per_trigger=max_files_per_trigger)
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    if state_partitions is not None:
        spark.conf.set(key, str(int(state_partitions)))
    try:
        return append_stream(detect_transitions_stream(src, watermark), out, checkpoint, fmt=fmt,
                             trigger=trigger, interval=interval)
    finally:
        spark.conf.set(key, previous)


GOLD_TABLES = ("dim_streamer", "dim_language", "dim_game", "dim_date", "fact_stream_hourly")
#: What partial rows are merged by when read.
GOLD_KEYS = {"dim_streamer": ["streamer_id"], "dim_language": ["language_id"], "dim_game": ["game_id"],
             "dim_date": ["date_id"], "fact_stream_hourly": FACT_KEYS}


def gold_tables(spark: SparkSession, root: str, buckets: int | None = None) -> CommittedTables:
    return CommittedTables(spark, root, GOLD_KEYS, buckets)


def checkpoint_query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id a streaming checkpoint has given its query; None before the first start."""
    path = f"{checkpoint.rstrip('/')}/metadata"
    if not path_exists(spark, path):
        return None
    parts = [f for f in list_dir(spark, path) if f.startswith("part-")]     # a folder, if a job has written it
    return json.loads("".join(read_small(spark, f"{path}/{f}") for f in parts) or read_small(spark, path))["id"]


def gold_batch_writer(catalogue: DataFrame, root: str, checkpoint: str, catalogue_order: Sequence[str] = ("ingestion_ts",),
                      fmt: str = "parquet", options: dict | None = None, parallel_writes: int = 4,
                      gate: bool = False, buckets: int | None = None):
    """foreachBatch function: build the star of one micro-batch, write it, commit it.

    The batch's columns that the star needs are persisted once for its five outputs and released in ``finally``.
    The fact is written first (its job fills the cache); the four dimensions,
    which only read the cached batch, are then written as concurrent jobs from
    ``parallel_writes`` driver threads, and the first failure is raised after all
    of them have ended. The commit record comes last: until then readers see the state before, and
    a batch that failed anywhere is written anew, to fresh folders. A batch whose record is there is
    not written again. ``inserted_at`` carries the batch id as the row version, so the
    replacing-merge read is deterministic.

    The column rules of the five tables are measured while they are written (no further scan) and the
    failed ones kept with the record; with ``gate`` a failed rule ends the batch before its commit.

    With ``options`` the outputs are appended through a connector instead (``fmt`` its name,
    the table name in option ``dbtable``); it must merge partial rows on read, and a
    replayed batch is then told apart by its columns query_id and batch_id only.
    """
    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        query_id = checkpoint_query_id(spark, checkpoint)
        tables = gold_tables(spark, root, buckets)
        if options is None and tables.state().holds(query_id, batch_id):
            return
        batch = batch_df.select(*gold.STAR_INPUT).persist()
        try:
            outputs = gold.build_star(batch, catalogue, catalogue_order,
                                      inserted_at=F.lit(int(batch_id)).cast("long"))
            if options is None:
                tables.begin({n: df.schema for n, df in outputs.items()})

            def save(name: str) -> tuple[str, list[dict]]:
                if options is not None:
                    marked = outputs[name].withColumns({"query_id": F.lit(query_id), "batch_id": F.lit(int(batch_id))})
                    write_append(marked, fmt=fmt, options={**options, "dbtable": name})
                    return "", []
                rules = Q.fact_checks() if name == "fact_stream_hourly" else Q.DIMENSION_CHECKS[name]()
                watch, results = Q.watch_checks(name, rules)
                folder = tables.write(name, outputs[name], query_id, batch_id, watch)
                return folder, results()

            done = {"fact_stream_hourly": save("fact_stream_hourly")}
            dims = [n for n in GOLD_TABLES if n != "fact_stream_hourly"]
            with ThreadPoolExecutor(max_workers=max(1, parallel_writes)) as pool:
                running = {n: pool.submit(save, n) for n in dims}
            done |= {n: f.result() for n, f in running.items()}
            if options is None:
                failed = [r for _, results in done.values() for r in results if not r["passed"]]
                if gate:
                    Q.raise_failed(failed)
                tables.commit(query_id, int(batch_id), {n: folder for n, (folder, _) in done.items()}, failed)
        finally:
            batch.unpersist()
    return write


def gold_job(spark: SparkSession, silver_path: str, catalogue: DataFrame, root: str, checkpoint: str,
             silver_schema, catalogue_order: Sequence[str] = ("ingestion_ts",),
             max_bytes_per_trigger: int | None = None, max_files_per_trigger: int | None = None,
             trigger: str = "available_now", fmt: str = "parquet", sink_fmt: str | None = None,
             sink_options: dict | None = None, gate: bool = False, buckets: int | None = None) -> StreamingQuery:
    """Catch-up job: process everything new in silver, then stop (``availableNow``). The caller
    chooses the size of a micro-batch. A root that a query with another checkpoint has
    written is refused: its rows would be counted twice. ``fmt`` is silver's table format; gold is
    stored as Parquet in ``buckets`` buckets (None: the session's shuffle partitions), or handed to a
    connector (``sink_fmt`` with ``sink_options``)."""
    if sink_options is None:
        others = gold_tables(spark, root).state().queries() - {checkpoint_query_id(spark, checkpoint)}
        if others:
            raise ValueError(f"{root} holds rows of another query {sorted(others)}; go on with its checkpoint, "
                             "or write a new start to a new root")
    src = table_stream(spark, silver_path, silver_schema, fmt=fmt, max_bytes_per_trigger=max_bytes_per_trigger,
                       max_files_per_trigger=max_files_per_trigger)
    w = (src.writeStream.outputMode("update")
         .foreachBatch(gold_batch_writer(catalogue, root, checkpoint, catalogue_order, sink_fmt or fmt, sink_options,
                                         gate=gate, buckets=buckets))
         .option("checkpointLocation", checkpoint))
    return w.trigger(**trigger_options(trigger)).start()


GOLD_MERGES = {n: functools.partial(gold.latest_by_version, keys=k, version="inserted_at")
               for n, k in GOLD_KEYS.items() if n != "fact_stream_hourly"}


def read_gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Gold tables as readers see them, all of one committed state: dimensions deduplicated (latest batch
    wins), fact partial rows merged (max of max, sum of sum, sum of count). The stored buckets are those of
    the merge keys, so no table is shuffled."""
    tables = gold_tables(spark, root)
    state = tables.state()
    out = {n: merge(tables.read(n, state)) for n, merge in GOLD_MERGES.items()}
    out["fact_stream_hourly"] = gold.merge_fact(tables.read("fact_stream_hourly", state))
    return out


def fold_gold(spark: SparkSession, root: str) -> bool:
    """Merge the committed batches into one generation; False if there are fewer than two."""
    version = lambda df: gold.merge_fact(df, measures=("inserted_at",))
    return gold_tables(spark, root).fold({**GOLD_MERGES, "fact_stream_hourly": version})
