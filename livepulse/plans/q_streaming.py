"""Registered queries that run the streaming jobs end to end over driver-table data.

Each call stages its input under the shared checkpoint root (a fresh folder),
runs the job with ``availableNow`` until it has drained its input, and returns
a batch read of what the job wrote.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from livepulse.operators import maintenance as J
from livepulse.operators import silver as C
from livepulse.operators.broadcasts import latest_snapshot
from livepulse.plans import profiles as P
from livepulse.plans.q_transitions import e_transitions  # noqa: F401  (oracle block)
from livepulse.plans.registry import query
from livepulse.plans.sqllib import sql
from livepulse.schemas import STREAM_TAGS, TRANSITIONS
from livepulse.session import drop_dir, list_dir, materialize, scratch_dir
from livepulse.sources.streams import append_stream, table_stream
from livepulse.streaming import jobs
from livepulse.streaming.transitions import detect_transitions_stream

def _stage(df, spark, name, partition_by=()):
    """Write a job's input at the width of its plan."""
    path = scratch_dir(spark, "stage", name)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def _drain(q):
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


@query("stream_tags_stream", sql("SELECT * FROM e_tags", "e_tags"))
def q_stream_tags_stream(spark, sf):
    """Bronze table read incrementally as a stream → exploded tags → append sink."""
    bronze = P.e_bronze(spark, sf)
    src_path = _stage(bronze, spark, "bronze_streams")
    out, ckpt = scratch_dir(spark, "silver", "stream_tags"), scratch_dir(spark, "ckpt", "stream_tags")
    src = table_stream(spark, src_path, bronze.schema)
    _drain(append_stream(C.stream_tags(src), out, ckpt, trigger="available_now"))
    drop_dir(spark, src_path)
    return spark.read.schema(STREAM_TAGS).parquet(out)


ARRIVAL_HOURS = 12    # how late a poll may arrive in transitions_stream


def _in_order(spark, path):
    """Give the files of a folder modification times in the order of their names: a file stream takes
    the oldest first."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    names = [n for n in list_dir(spark, path) if n.startswith("part-")]
    for i, n in enumerate(names):
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/{n}")
        p.getFileSystem(conf).setTimes(p, 1_000_000_000_000 + 1000 * i, -1)


@query("transitions_stream", sql("SELECT * FROM e_transitions", "e_transitions"))
def q_transitions_stream(spark, sf):
    """Stateful streaming detector over snapshots that arrive late: each poll up to ``ARRIVAL_HOURS`` after
    its time, so the files, in order of arrival, hold polls out of order. The watermark is an hour more
    than that, and a stream's state holds the polls of that time and of a micro-batch, not all of them. A
    last file moves the watermark past the data, which settles every poll."""
    snaps = P.e_snapshots(spark, sf)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    late = F.pmod(F.xxhash64("stream_id", "ingestion_ts"), F.lit(ARRIVAL_HOURS * 3600)).cast("int")
    arrival = F.timestamp_add("SECOND", late, F.col("ingestion_ts"))
    src_path = _stage(snaps.withColumn("_arrival", arrival).repartitionByRange(width, "_arrival").drop("_arrival"), spark, "snapshots")
    _in_order(spark, src_path)
    last = spark.read.schema(snaps.schema).parquet(src_path).agg(F.max("ingestion_ts")).first()[0]
    closing = spark.range(1).select(*[
        (F.lit("closing") if f.name == "stream_id" else
         F.lit(last).cast("timestamp") + F.make_dt_interval(F.lit(4)) if f.name == "ingestion_ts" else
         F.lit(None)).cast(f.dataType).alias(f.name) for f in snaps.schema])
    closing.write.mode("append").parquet(src_path)
    out, ckpt = scratch_dir(spark, "silver", "transitions"), scratch_dir(spark, "ckpt", "transitions")
    src = table_stream(spark, src_path, snaps.schema, max_files_per_trigger=-(-width // 3))
    _drain(append_stream(detect_transitions_stream(src, f"{ARRIVAL_HOURS + 1} hours"), out, ckpt, trigger="available_now"))
    drop_dir(spark, src_path)
    return spark.read.schema(TRANSITIONS).parquet(out)


GOLD_BATCHES = 3      # micro-batches of fact_hourly_stream


def _stage_files(df, spark, name, least):
    """Write a job's input at the width of its plan, in ``least`` files or more; (folder, number of files). Only an
    input of fewer files, which one or two tasks have written, is dealt anew."""
    path = _stage(df, spark, name)
    files = [n for n in list_dir(spark, path) if n.startswith("part-")]
    if len(files) < least:
        narrow, path = path, _stage(spark.read.schema(df.schema).parquet(path).repartition(least), spark, name)
        drop_dir(spark, narrow)
        files = [n for n in list_dir(spark, path) if n.startswith("part-")]
    return path, max(len(files), 1)


def _named_fact(g):
    """The fact with the names its dimensions give."""
    return (g["fact_stream_hourly"].join(g["dim_game"].select("game_id", "game_name"), "game_id")
            .join(g["dim_streamer"].select("streamer_id", "user_name"), "streamer_id")
            .join(g["dim_language"].select("language_id", "language"), "language_id")
            .select("game_name", "user_name", "language", "date_id", "time_hour", "max_viewers",
                    "sum_viewers", "count_observations"))


@query("fact_hourly_stream", sql("SELECT * FROM s_fact", "s_fact"))
def q_fact_hourly_stream(spark, sf):
    """Gold catch-up over silver in several micro-batches; partial hourly rows of different
    batches are merged on read."""
    silver = P.s_silver(spark, sf)
    src_path, files = _stage_files(silver, spark, "silver_streams", GOLD_BATCHES)
    root, ckpt = scratch_dir(spark, "gold"), scratch_dir(spark, "ckpt", "gold")
    # The catalogue does not change while this job runs, so its latest version per
    # name is computed once and kept for the job's micro-batches (stream-static join).
    games = P.s_latest_games(spark, sf).persist()
    try:
        q = jobs.gold_job(spark, src_path, games, root, ckpt, silver.schema,
                          catalogue_order=P.CATALOGUE_ORDER, max_files_per_trigger=-(-files // GOLD_BATCHES))
        _drain(q)
    finally:
        games.unpersist()
    drop_dir(spark, src_path)
    return _named_fact(jobs.read_gold(spark, root))


@query("fact_hourly_folded", sql("SELECT * FROM s_fact", "s_fact"))
def q_fact_hourly_folded(spark, sf):
    """Gold catch-up in micro-batches capped by bytes, each committed by its record; the committed batches
    folded into one generation and read back without a shuffle."""
    silver = P.s_silver(spark, sf)
    src_path = _stage(silver, spark, "silver_streams")
    size = J.data_files(spark, src_path).agg(F.sum("length")).first()[0] or 0
    root, ckpt = scratch_dir(spark, "gold"), scratch_dir(spark, "ckpt", "gold")
    games = P.s_latest_games(spark, sf).persist()
    try:
        _drain(jobs.gold_job(spark, src_path, games, root, ckpt, silver.schema, catalogue_order=P.CATALOGUE_ORDER,
                             max_bytes_per_trigger=max(size // 3, 1_000_000), gate=True))
    finally:
        games.unpersist()
    drop_dir(spark, src_path)
    jobs.fold_gold(spark, root)
    jobs.gold_tables(spark, root).vacuum()
    return _named_fact(jobs.read_gold(spark, root))


@query("partition_pruned_scan", sql("""
SELECT stream_id, ingestion_ts, viewer_count, year, month, day FROM e_bronze
WHERE (year, month, day) = (SELECT (year, month, day) FROM e_bronze ORDER BY year DESC, month DESC, day DESC LIMIT 1)
""", "e_bronze"))
def q_partition_pruned_scan(spark, sf):
    """Date-partitioned bronze sink, then a read of the last day: only that day's
    folder is listed and scanned (PartitionFilters on year/month/day)."""
    path = _stage(P.e_bronze(spark, sf), spark, "bronze_partitioned", partition_by=("year", "month", "day"))
    t = spark.read.parquet(path)
    # The day is one scalar taken from the partition columns only (a metadata-sized
    # read); it becomes literal predicates, so pruning happens at planning time.
    last = t.select(F.max(F.col("year") * 10000 + F.col("month") * 100 + F.col("day"))).first()[0]
    d = date(last // 10000, last // 100 % 100, last % 100)
    return J.on_date(t, d).select("stream_id", "ingestion_ts", "viewer_count", "year", "month", "day")


@query("latest_snapshot_by_listing", sql("""
SELECT stream_id, ingestion_ts, viewer_count FROM e_bronze
WHERE date_trunc('day', ingestion_ts) = (SELECT max(date_trunc('day', ingestion_ts)) FROM e_bronze)""", "e_bronze"))
def q_latest_snapshot_by_listing(spark, sf):
    """The newest poll (a day here) of a date-partitioned table: its day comes from the listing, its time from that
    day's rows, and the snapshot is read from that day alone."""
    bronze = P.e_bronze(spark, sf)
    path = _stage(bronze, spark, "bronze_partitioned", partition_by=("year", "month", "day"))
    t = spark.read.schema(bronze.schema).parquet(path)
    polls = J.newest_day(spark, path, bronze.schema)
    return latest_snapshot(t, grain="day", polls=polls).select("stream_id", "ingestion_ts", "viewer_count")


SMALL_FILES = 8       # per day, before compaction


@query("compaction_preserves", sql("""
SELECT year, month, day, count(*) AS rows, sum(viewer_count) AS viewers, true AS fewer_files, 1 AS files_after
FROM e_bronze GROUP BY year, month, day""",
    "e_bronze"))
def q_compaction_preserves(spark, sf):
    """Several small files per day → compact the first month, then the rest → same rows per day, and
    as few files as the day's bytes need."""
    cols = ("year", "month", "day")
    salted = P.e_bronze(spark, sf).repartition(*cols, F.pmod(F.xxhash64("stream_id", "ingestion_ts"), F.lit(SMALL_FILES)))
    path = _stage(salted.sortWithinPartitions(*cols), spark, "bronze_small_files", partition_by=cols)
    before = J.files_per_partition(spark, path, cols).withColumnRenamed("files", "files_before")
    before = materialize(before)               # counted before anything is rewritten
    first = spark.read.parquet(path).agg(F.min(F.struct("year", "month")).alias("m")).first()["m"]
    args = J.maintenance_args("bronze", first["year"], first["month"])
    J.compact(spark, path, partition_cols=cols, year=args["year"], month=args["month"])
    J.compact(spark, path, partition_cols=cols)
    after = J.files_per_partition(spark, path, cols).withColumnRenamed("files", "files_after")
    rows = spark.read.parquet(path).groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"),
                                                       F.sum("viewer_count").alias("viewers"))
    return rows.join(before, list(cols)).join(after, list(cols)).select(
        *cols, "rows", "viewers", (F.col("files_after") <= F.col("files_before")).alias("fewer_files"),
        F.col("files_after").cast("int").alias("files_after"))
