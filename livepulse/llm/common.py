"""Helpers shared by the operators of this subpackage.

Text is read in Arrow batches and hashed with numpy over the raw UTF-8 bytes, so
no operator runs Python code per word. Intermediate tables go to the shared
folder the session names in ``spark.checkpoint.dir`` (lineage is cut there, and a
lost executor re-reads them); nothing is written to a machine-local folder.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from livepulse.session import scratch_dir

#: Bytes of text hashed at once inside a task; bounds the numpy temporaries.
BLOCK_BYTES = 2 << 20
NULL_LONG = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it again."""
    spark = df.sparkSession
    path = scratch_dir(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns every operator needs, typed, a null text read as empty.
    Other columns, whatever their names, are not touched."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
          "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(),
          "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
          "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string())}


@functools.lru_cache(maxsize=64)
def _arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a flat ``name type, name type`` list (tasks have no JVM parser)."""
    return pa.schema([(name, _ARROW[kind]) for name, kind in (f.split() for f in ddl.split(","))])


def batch_of(ddl: str, **columns) -> pa.RecordBatch:
    """A record batch with the columns of ``ddl``."""
    schema = _arrow_schema(ddl)
    arrays = [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, type=f.type, from_pandas=False)
              for f in schema]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def text_blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
                most: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each batch cut into row slices of about ``most`` bytes of text (at least one
    row each): (slice, bytes, offsets)."""
    for batch in batches:
        raw, off = utf8(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
            yield batch.slice(lo, hi - lo), raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
            lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (multiply and xor-shift), elementwise."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def padded(raw: np.ndarray) -> np.ndarray:
    """``raw`` followed by 8 zero bytes, viewed as one unaligned 64-bit word per byte."""
    buf = np.concatenate([raw, np.zeros(8, np.uint8)])
    return np.ndarray(shape=(len(raw) + 1,), dtype="<u8", buffer=buf, strides=(1,))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], np.uint64)


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (maximal runs outside space and \\t to \\r) of every text:
    (start byte, end byte, first word of each text with the total at the end)."""
    n = len(raw)
    ink = ~_SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[off[:-1]] = True
    before = np.concatenate([[False], ink[:-1]])
    starts = np.flatnonzero(ink & (~before | edge[:n]))
    after = np.concatenate([ink[1:], [False]])
    edge[off] = True
    ends = np.flatnonzero(ink & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte span, 8 bytes a step."""
    size = (ends - starts).astype(np.int64)
    h = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 + seed))
    if not len(size):
        return h
    view = padded(raw)
    live = np.arange(len(size))
    at = 0
    while len(live):
        left = size[live] - at
        word = view[starts[live] + at] & _MASK[np.minimum(left, 8)]
        h[live] = mix(h[live] ^ word)
        at += 8
        live = live[left > 8]
    return h


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    up = (raw >= 65) & (raw <= 90)
    return raw + (up.astype(np.uint8) << 5)


def number_rows(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Rows of ``df`` (columns unique) with ``name``: place 0, 1, ... inside its group
    by ``order``. One range sort on (group, order), so a group of any size is spread
    over many tasks; places before a task come from a table with one row per
    (task, group). The numbered rows are stored."""
    keys = [F.col(c) for c in (*group, *order)]
    spread = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumn("_at", F.monotonically_increasing_id()), "numbered")
    spread = spread.withColumn("_task", F.shiftright("_at", 33))
    tasks = spread.groupBy("_task", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    from pyspark.sql import Window
    # one row for each task and group; the window adds up counts, not rows
    before = F.sum("_rows").over(Window.partitionBy(*group).orderBy("_task").rowsBetween(
        Window.unboundedPreceding, -1))
    tasks = tasks.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_rows")
    on = F.lit(True)
    right = tasks.select("_task", *[F.col(g).alias(f"_g_{g}") for g in group], "_first", "_before") \
        .withColumnRenamed("_task", "_task2")
    on = F.col("_task") == F.col("_task2")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return spread.join(right, on, "left").select(
        *df.columns, (F.col("_at") - F.col("_first") + F.col("_before")).cast("long").alias(name))


def stored_with(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``stored``, and what ``measures`` (aggregates) come to over the rows written; no job of their own.
    They are taken in the last stage, whose tasks count once each."""
    seen = Observation()
    out = stored(df.observe(seen, *[m.alias(k) for k, m in measures.items()]), name)
    return out, seen.get


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges as a spanning forest of stars: (vertex, least vertex of its tree) of all vertices but the roots."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[:len(a)], at[len(a):]
    root = np.arange(len(ids))
    while True:                                      # least neighbour, then jumps to the root's root
        new = root.copy()
        np.minimum.at(new, left, root[right])
        np.minimum.at(new, right, root[left])
        np.minimum.at(new, root[left], root[right])
        np.minimum.at(new, root[right], root[left])
        new = new[new]
        if (new == root).all():
            break
        root = new
    hung = np.flatnonzero(root != np.arange(len(ids)))
    return ids[hung], ids[root[hung]]


def contract(most: int = 1 << 18):
    """Edges (a, b) of a task -> stars that connect the same vertices, about ``most`` edges at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            a = np.concatenate([a, batch.column("a").to_numpy()])
            b = np.concatenate([b, batch.column("b").to_numpy()])
            if len(a) >= most:
                a, b = forest(a, b)
                if len(a) >= most // 2:              # mostly different vertices: pass them on
                    yield batch_of("a long, b long", a=a, b=b)
                    a, b = a[:0], b[:0]
        if len(a):
            a, b = forest(a, b)
            yield batch_of("a long, b long", a=a, b=b)
    return run


def least_labels(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of the edges (a long, b long): rows (id, label), label the
    least id of the component. Each task first contracts its edges to stars; then alternating
    large-star and small-star steps (Kiveris et al., "Connected components in MapReduce and
    beyond") until nothing is re-hung. A round is three shuffles of narrow rows and its result is
    stored; the number of rounds grows with the logarithm of the longest chain. A vertex keeps at most
    one smaller neighbour from each task, so what is gathered by vertex is bounded by the tasks."""
    edges = stored(edges.mapInArrow(contract(), "a long, b long"), name)
    while True:
        parents = edges.groupBy("a").agg(F.min("b").alias("parent")).withColumnRenamed("a", "_b")
        # large star: whatever hangs on b moves to the parent of b
        large = edges.join(parents, F.col("b") == F.col("_b"), "left").select(
            "a", F.coalesce("parent", "b").alias("b"), F.col("parent").isNotNull().alias("moved"))
        # small star: the smaller neighbours of a hang on the least of them
        small = large.groupBy("a").agg(F.min("b").alias("m"), F.collect_set("b").alias("smaller"), F.max("moved").alias("moved"))
        small = small.withColumn("moved", F.col("moved") | (F.size("smaller") > 1))
        hung = small.select("m", "moved", F.explode(F.concat(F.array("a"), F.array_except("smaller", F.array("m")))).alias("a"))
        edges, seen = stored_with(hung.select("a", F.col("m").alias("b"), "moved"), name, moved=F.count_if("moved"))
        edges = edges.select("a", "b")
        if not seen["moved"]:
            break
    hung = edges.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return hung.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct())


def null_safe(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)
