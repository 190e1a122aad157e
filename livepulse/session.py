"""Session helpers: building a session for tests/bench and finding shared dirs."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every livepulse job relies on. UTC pins hour()/date parts; AQE re-plans
# shuffles at runtime (partition coalescing, skew split, broadcast conversion
# after the real size of a join side is known).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of frames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def scale_conf(input_bytes: int, executor_cores_total: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Settings sized to the data: enough initial shuffle partitions that each
    holds about ``target_partition_bytes`` (AQE then coalesces small ones and
    splits skewed ones), at least two waves of tasks, and scan splits of the
    same size. For 100 TB on 1,000 executors x 8 cores this gives 400k shuffle
    partitions and 256 MiB scan splits."""
    parts = max(2 * executor_cores_total, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 4),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(8 * 1024 * 1024),
    }


def build_session(master: str | None = None, app: str = "livepulse", shuffle_partitions: int | None = None,
                  extra: dict | None = None, input_bytes: int | None = None, total_cores: int = 1) -> SparkSession:
    """A session with the library's settings. ``input_bytes`` (with ``total_cores``) sizes
    shuffles and splits by :func:`scale_conf`; ``shuffle_partitions`` sets their number outright;
    without either Spark's own defaults hold. ``master`` None: as the launcher says."""
    builder = SparkSession.builder.appName(app)
    builder = builder.master(master) if master else builder
    conf = dict(DEFAULT_CONF)
    if input_bytes is not None:
        conf.update(scale_conf(input_bytes, total_cores))
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system);
    only a local-mode session (tests) gets a private folder when it is unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="livepulse-ckpt-")
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint root (never a local temp dir)."""
    return "/".join([checkpoint_root(spark), "livepulse", *parts, uuid.uuid4().hex])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    root = checkpoint_root(spark)
    spark.sparkContext.setCheckpointDir(root)
    return root


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder this library made."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def ship_package(spark: SparkSession) -> None:
    """Send the library to the executors, for sessions started without ``--py-files`` or
    an installed package: functions that run in Python workers are loaded by module name."""
    import shutil
    root = os.path.dirname(os.path.abspath(__file__))
    target = scratch_dir(spark, "package") + "/livepulse.zip"      # shared: executors fetch it from there
    with tempfile.TemporaryDirectory() as folder:
        archive = shutil.make_archive(os.path.join(folder, "livepulse"), "zip", os.path.dirname(root),
                                      os.path.basename(root))
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        dest = path(target)
        dest.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).copyFromLocalFile(path(f"file://{archive}"), dest)
    spark.sparkContext.addPyFile(target)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage: an eager, reliable checkpoint into
    the shared checkpoint folder. For a small derived frame (one row per game,
    say) that several branches of a query read: each branch reads the written
    rows instead of recomputing the scans and shuffles behind them, and a lost
    executor does not replay that lineage. Streaming frames are returned as they are.
    """
    if df.isStreaming:
        return df
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _path_and_fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, in order; none if it does not exist."""
    p, fs = _path_and_fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_small(spark: SparkSession, path: str) -> str:
    """Text of a small file (a commit record, a checkpoint's metadata), read on the driver without a job."""
    p, fs = _path_and_fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole or not at all; one that is there already is an error."""
    p, fs = _path_and_fs(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    fs.mkdirs(p.getParent())
    jvm = spark.sparkContext._jvm
    part = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(part, p):
        fs.delete(part, False)
        raise FileExistsError(path)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, making the target's folder; a source that is gone because an earlier try moved it is fine."""
    src, fs = _path_and_fs(spark, source)
    dst, _ = _path_and_fs(spark, target)
    if not fs.exists(src):
        if not fs.exists(dst):
            raise FileNotFoundError(source)
        return
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"cannot move {source} to {target}")
