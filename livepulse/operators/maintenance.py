"""Table maintenance: compaction of small files, optionally for some partitions only."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from livepulse.session import drop_dir, list_dir, move_file, path_exists, read_small, write_small

TARGET_FILE_BYTES = 128 * 1024 * 1024


def partition_predicate(year: int | None = None, month: int | None = None, day: int | None = None):
    """Equality predicates on the year/month/day partition columns (prunable at planning)."""
    cond = F.lit(True)
    for name, v in (("year", year), ("month", month), ("day", day)):
        if v is not None:
            cond = cond & (F.col(name) == F.lit(int(v)))
    return cond


def on_date(df: DataFrame, d: date) -> DataFrame:
    """Rows of one calendar day of a year/month/day-partitioned table."""
    return df.where(partition_predicate(d.year, d.month, d.day))


def _file_bytes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bytes of the files behind ``df`` per value of ``cols`` (partition columns)."""
    files = df.select(*cols, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size"))
    return files.distinct().groupBy(*cols).agg(F.sum("_size").alias("_bytes"))


def newest_day(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", as_of: date | None = None) -> DataFrame:
    """Rows of the newest day (not after ``as_of``) of a table partitioned by year/month/day of its poll time: the day
    comes from the listing alone, so the newest poll is found by reading one day and not the history's
    time column. Pass it as ``polls`` to ``latest_snapshot`` or ``snapshot_asof``."""
    table = spark.read.format(fmt).schema(schema).load(path)
    days = data_files(spark, path).select((F.col("year") * 10000 + F.col("month") * 100 + F.col("day")).alias("d"))
    if as_of is not None:
        days = days.where(F.col("d") <= as_of.year * 10000 + as_of.month * 100 + as_of.day)
    newest = days.agg(F.max("d")).first()[0]
    return table.where(F.lit(False)) if newest is None else on_date(table, date(newest // 10000, newest // 100 % 100, newest % 100))


#: A file below this share of the target is small.
SMALL_SHARE = 0.75
COMPACTED = "compacted-"
RUNS = "_compaction"


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """The files of a table as Spark lists them (path, length, modificationTime and the partition columns);
    nothing is opened."""
    return spark.read.format("binaryFile").load(path).drop("content")


def compact(spark: SparkSession, path: str, fmt: str = "parquet", partition_cols: Sequence[str] = (),
            year: int | None = None, month: int | None = None, day: int | None = None,
            target_file_bytes: int = TARGET_FILE_BYTES, files_at_once: int = 100_000) -> int:
    """Merge the small files of a table (or only of its partitions matching year/month/day) into files of
    about ``target_file_bytes``; rows are unchanged. Returns how many files were replaced.

    Table formats with their own command (``fmt="delta"``) use OPTIMIZE. For plain files the listing is
    grouped by partition, and only files below ``SMALL_SHARE`` of the target are read, in partitions that
    hold at least two of them and one that no earlier run has made: larger files keep their names and
    times, and a second run writes nothing. The small files' rows of a partition are dealt to as many
    bins as their bytes fill targets, each bin a task and a file.

    New files are staged in a hidden folder of the table. When all are there, a journal names what is to
    be moved in and what removed; a run that dies before it has left nothing but that folder, and one that
    dies after it is finished by the next run. Between the first move and the last removal readers may see
    rows twice, so they must wait. At most about ``files_at_once`` files are in one journal.

    Nothing may write to the selected partitions meanwhile. A folder that a stream has written (it lists
    its files in ``_spark_metadata``) is refused, and one that a stream reads must not be compacted
    either, because the stream would read the rewritten files as new data; use a transactional table
    format for both.
    """
    if fmt == "delta":
        clause = ""
        parts = [f"{n} = {int(v)}" for n, v in (("year", year), ("month", month), ("day", day)) if v is not None]
        if parts:
            clause = " WHERE " + " AND ".join(parts)
        spark.sql(f"OPTIMIZE delta.`{path}`{clause}")
        return 0
    path = path.rstrip("/")
    if path_exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is the sink of a stream; compacting it would make it unreadable. "
                         "Write the stream to a transactional format, or copy the table first.")
    finish_compactions(spark, path)
    cols = list(partition_cols)
    files = data_files(spark, path)
    if cols:
        files = files.where(partition_predicate(year, month, day))
    small = files.where(F.col("length") < SMALL_SHARE * target_file_bytes)
    made = F.substring_index("path", "/", -1).startswith(COMPACTED)
    # one row a partition: its small files and how many full files their bytes make
    chosen = small.groupBy(*cols).agg(
        F.collect_list("path").alias("paths"), F.greatest(F.lit(1), F.floor(F.sum("length") / target_file_bytes)).cast("int").alias("bins"),
        F.count_if(~made).alias("fresh")).where((F.size("paths") > 1) & (F.col("fresh") > 0)).drop("fresh")
    schema = spark.read.format(fmt).load(path).schema            # of the whole table, partition columns too
    group: list = []
    replaced = 0
    for row in chosen.toLocalIterator():
        group.append(row)
        if sum(len(r["paths"]) for r in group) >= files_at_once:
            replaced += _rewrite(spark, path, fmt, schema, cols, group)
            group = []
    return replaced + (_rewrite(spark, path, fmt, schema, cols, group) if group else 0)


def _rewrite(spark: SparkSession, path: str, fmt: str, schema: StructType, cols: Sequence[str], group: Sequence) -> int:
    """Stage, journal and publish the files of some partitions."""
    run = uuid.uuid4().hex
    paths = [p for r in group for p in r["paths"]]
    df = spark.read.format(fmt).schema(schema).option("basePath", path).load(paths)
    names, bins, first = df.columns, [], 0
    for r in group:
        bins.append((*(r[c] for c in cols), first, r["bins"]))
        first += r["bins"]
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    numbered = spark.createDataFrame(bins, ", ".join([*(f"_p_{c} {kinds[c]}" for c in cols), "_first int", "_bins int"]))
    on = [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in cols]
    joined = df.join(F.broadcast(numbered), on) if cols else df.crossJoin(F.broadcast(numbered))   # a row a partition
    bin_of = (F.col("_first") + F.pmod(F.xxhash64(*names), F.col("_bins"))).cast("int")
    staged = f"{path}/{RUNS}/{run}/files"
    writer = joined.repartitionById(first, bin_of).select(*names).write.format(fmt)
    (writer.partitionBy(*cols) if cols else writer).save(staged)
    new = [r["path"] for r in data_files(spark, staged).select("path").collect()]
    inside = f"/{RUNS}/{run}/files/"
    moves = []
    for i, p in enumerate(sorted(new)):
        root, rest = p.split(inside)
        folder, _, name = rest.rpartition("/")
        suffix = name[name.index("."):] if "." in name else ""
        moves.append([p, "/".join(x for x in (root, folder, f"{COMPACTED}{run}-{i:06d}{suffix}") if x)])
    write_small(spark, f"{path}/{RUNS}/{run}/journal.json", json.dumps({"moves": moves, "removes": paths}))
    _publish(spark, path, run)
    return len(paths)


def _publish(spark: SparkSession, path: str, run: str) -> None:
    """What a journal says; every step may have been done already."""
    journal = json.loads(read_small(spark, f"{path}/{RUNS}/{run}/journal.json"))
    for source, target in journal["moves"]:
        move_file(spark, source, target)
    for old in journal["removes"]:
        drop_dir(spark, old)
    drop_dir(spark, f"{path}/{RUNS}/{run}")


def finish_compactions(spark: SparkSession, path: str) -> int:
    """Finish the runs that died behind their journal, clear those that died before it."""
    path = path.rstrip("/")
    finished = 0
    for run in list_dir(spark, f"{path}/{RUNS}"):
        if path_exists(spark, f"{path}/{RUNS}/{run}/journal.json"):
            _publish(spark, path, run)
            finished += 1
        else:
            drop_dir(spark, f"{path}/{RUNS}/{run}")
    if path_exists(spark, f"{path}/{RUNS}"):
        drop_dir(spark, f"{path}/{RUNS}")
    return finished


def files_per_partition(spark: SparkSession, path: str, partition_cols: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Number of data files of each partition."""
    df = spark.read.format(fmt).load(path)
    return df.select(*partition_cols, F.col("_metadata.file_path").alias("_path")).distinct() \
        .groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("files"))


def maintenance_args(layer: str, year: int | None = None, month: int | None = None,
                     day: int | None = None) -> dict:
    """Validate a maintenance request: bronze needs year and month (day optional);
    silver takes no date."""
    if layer == "bronze":
        if year is None or month is None:
            raise ValueError("bronze compaction needs at least year and month")
        if not 1 <= int(month) <= 12 or (day is not None and not 1 <= int(day) <= 31):
            raise ValueError("month must be 1-12 and day 1-31")
        return {"layer": layer, "year": int(year), "month": int(month),
                "day": None if day is None else int(day)}
    if layer == "silver":
        return {"layer": layer, "year": None, "month": None, "day": None}
    raise ValueError(f"unknown layer {layer!r}")


def nightly_args(now: datetime) -> dict:
    """The nightly job compacts the month of the day that just ended."""
    prev = (now - timedelta(days=1)).date()
    return maintenance_args("bronze", prev.year, prev.month)
