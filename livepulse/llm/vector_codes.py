"""Operator 12, vector code compression: product codes whose codebooks are learned with
adaptive distance bounds (after Drake and Hamerly).

Components become integers floor(scale * x). A vector is cut into ``parts`` equal consecutive parts
and each part is coded by the nearest of ``entries`` codebook entries. Learning alternates
assignment (squared Euclidean distance, ties to the lower index) and replacement of each entry by
the componentwise floor(sum / count) of its parts; an entry no part is assigned to stays.

A part keeps its ``b`` closest entries, a lower bound on its distance to each of them, in order, and
one outer bound for all others. When the codebook has moved, each bound falls by its own entry's way
and the outer bound by the longest way. The distance to the assigned entry is exact; only entries
whose bound does not exceed it are looked at again, by their exact integer distance; if the outer
bound does not exceed it either, all entries are. Bounds are rounded downwards and compared
strictly, so a tie always counts as uncertain and is decided by integers. ``b`` starts at ``FIRST_B``
(lists about as large as the vectors) and shrinks to what the parts had to look at. Bounds, codes and integers are one stored table
per round (the one before it is removed); only sums by (part, entry) reach the driver, a codebook's
size whatever the table's.

Defined cases: rows whose vector is null or holds a null, NaN or infinite component are dropped; so
are vectors whose length is not the commonest (of equally common lengths the longest stays); a
length that ``parts`` does not divide is filled up with zeros; a table with fewer rows than entries
has as many entries as rows; repeated rows, vec_ids and vectors count each, equal vec_ids start in
the order of their components; null vec_ids come last; null labels are one label; an empty table
gives an empty result; a component beyond 2**26 after scaling ends the job with an error, as its
distances would leave 64 bits; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livepulse.session import drop_dir, scratch_dir

from .common import batch_of

INTEGERS = "vec_id long, label long, v binary, size int, top long"
STATE = "vec_id long, label long, v binary, code binary, near binary, low binary, outer binary, looked binary, error long"
SUMS = "part int, entry int, n long, sums array<long>"
LIMIT = 1 << 26
LEAST_B, FIRST_B = 4, 16
ROWS = 2048


def _integers(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column("_vector")
            keep, v, size, top = [], [], [], []
            for i, x in enumerate(column):
                values = x.values if x.is_valid else None
                if values is None or values.null_count:
                    continue
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                x = np.floor(scale * x)
                if len(x) and np.abs(x).max() > LIMIT:
                    raise ValueError(f"a component of vector {b.column('vec_id')[i]} passes 2**26 after scaling")
                keep.append(i)
                # big-endian with the sign bit turned: bytes sort as the components do
                v.append((x.astype(np.int64) + (1 << 31)).astype(">u4").tobytes())
                size.append(len(x))
                top.append(int(np.abs(x).max(initial=0)))
            if keep:
                yield batch_of(INTEGERS, vec_id=b.column("vec_id").take(pa.array(keep)),
                               label=b.column("label").take(pa.array(keep)), v=v, size=size, top=top)
    return run


class _Plan:
    """What every task of a round gets: the codebook, how far its entries moved (None in the first
    round, whose rows have no bounds yet), and b."""

    def __init__(self, book: np.ndarray, moved: np.ndarray | None, b: int, width: int, dim: int):
        self.book, self.moved, self.b, self.width, self.dim = book, moved, b, width, dim

    def integers(self, column: pa.Array) -> np.ndarray:
        parts, _, d = self.book.shape
        raw = b"".join(column.to_pylist())
        got = np.frombuffer(raw, f"<i{self.width}") if self.moved is not None else \
            (np.frombuffer(raw, ">u4").astype(np.int64) - (1 << 31))
        out = np.zeros((len(column), parts * d), np.int64)
        out[:, :self.dim] = got.reshape(len(column), -1)[:, :self.dim]
        return out.reshape(len(column), parts, d)


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    if top * top * x.shape[1] < 1 << 53:                     # every partial sum is exact in floating point
        cross = (x.astype(np.float64) @ book.astype(np.float64).T).astype(np.int64)
        return (x * x).sum(1)[:, None] - 2 * cross + (book * book).sum(1)[None, :]
    out = np.empty((len(x), len(book)), np.int64)
    for e, c in enumerate(book):
        out[:, e] = ((x - c) ** 2).sum(1)
    return out


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _all_entries(x: np.ndarray, book: np.ndarray, b: int):
    """Every entry looked at: the b closest by (distance, index), bounds, outer bound, error."""
    dist = _distances(x, book)
    k = len(book)
    if int(dist.max(initial=0)) < 1 << 54:                   # (distance, index) as one number
        key = dist << 8 | np.arange(k)
        if b < k:
            key = np.partition(key, b, axis=1)[:, :b + 1]
        key.sort(axis=1)
        near, dist = key & 255, key >> 8
    else:
        near = np.argsort(dist, axis=1, kind="stable")
        dist = np.take_along_axis(dist, near, 1)
    outer = _down(np.sqrt(dist[:, b].astype(np.float64))) if b < k else np.full(len(x), np.inf, np.float32)
    return near[:, :b], _down(np.sqrt(dist[:, :b].astype(np.float64))), outer, dist[:, 0]


def assign_part(x: np.ndarray, book: np.ndarray, moved: np.ndarray | None, state, b: int):
    """One part position of many rows: (near, low, outer, error, looked). ``state``: near, low and
    outer of the round before, or None. near[:, 0] is the assigned entry; ``looked`` is the place up
    to which entries were looked at, 0 where all had to be."""
    n, k = len(x), len(book)
    b = min(b, k)
    if state is None:
        return *_all_entries(x, book, b), np.zeros(n, np.int64)
    near, low, outer = state
    had = near.shape[1]
    b = min(b, had)
    low = _down(low - moved[near])
    outer = _down(outer - moved.max(initial=0)) if had < k else outer
    # ordered: no bound above those further out
    low = np.minimum.accumulate(np.concatenate([low, outer[:, None]], 1)[:, ::-1], 1)[:, ::-1][:, :had]
    own = ((x - book[near[:, 0]]) ** 2).sum(1)
    up = np.nextafter(np.sqrt(own.astype(np.float64)).astype(np.float32), np.float32(np.inf))
    looked = np.maximum(1 + (low[:, 1:] <= up[:, None]).sum(1), 1)
    looked[outer <= up] = 0
    near, low, error = near.copy(), low.copy(), own.copy()
    low[:, 0] = np.minimum(_down(np.sqrt(own.astype(np.float64))), low[:, 1] if had > 1 else outer)
    for z in np.unique(looked[looked > 1]):
        at = np.flatnonzero(looked == z)
        some = near[at, :z]
        dist = ((x[at][:, None, :] - book[some]) ** 2).sum(2)
        # nearest first, the lower index of equal distances
        order = np.lexsort((some, dist), axis=1)
        some, dist = np.take_along_axis(some, order, 1), np.take_along_axis(dist, order, 1)
        near[at, :z], error[at] = some, dist[:, 0]
        beyond = (low[at, z] if z < had else outer[at])[:, None]
        low[at, :z] = np.minimum(_down(np.sqrt(dist.astype(np.float64))), beyond)
    every = np.flatnonzero(looked == 0)
    if b < had:                                              # the list is cut, the outer bound takes the rest over
        outer = np.minimum(outer, low[:, b])
        near, low = near[:, :b], low[:, :b]
    if len(every):
        near[every], low[every], outer[every], error[every] = _all_entries(x[every], book, b)
    return near, low, outer, error, looked


def _assign(plan: _Plan):
    parts, k, _ = plan.book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                yield one(whole.slice(lo, ROWS))

    def one(part: pa.RecordBatch) -> pa.RecordBatch:
        n = part.num_rows
        x = plan.integers(part.column("v"))
        out: dict[str, list[np.ndarray]] = {c: [] for c in ("code", "near", "low", "outer", "looked")}
        error = np.zeros(n, np.int64)
        if plan.moved is not None:
            def read(c, kind):
                return np.frombuffer(b"".join(part.column(c).to_pylist()), kind).reshape(n, parts, -1)
            before = read("near", np.uint8), read("low", "<f4"), read("outer", "<f4")
        for p in range(parts):
            state = None if plan.moved is None else (before[0][:, p].astype(np.int64), before[1][:, p], before[2][:, p, 0])
            near, low, outer, err, looked = assign_part(
                x[:, p], plan.book[p], None if state is None else plan.moved[p], state, plan.b)
            error += err
            out["code"].append(near[:, :1].astype(np.uint8))
            out["near"].append(near.astype(np.uint8))
            out["low"].append(low.astype("<f4"))
            out["outer"].append(outer.astype("<f4")[:, None])
            out["looked"].append(looked.astype(np.uint8)[:, None])

        def rows(c):
            wide = np.ascontiguousarray(np.concatenate(out[c], 1))
            return _binary(wide)
        v = x.reshape(n, -1)[:, :plan.dim].astype(f"<i{plan.width}")
        return batch_of(STATE, vec_id=part.column("vec_id"), label=part.column("label"), v=_binary(v), error=error,
                        **{c: rows(c) for c in out})
    return run


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    rows = np.ascontiguousarray(rows)
    size = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _sums(plan: _Plan):
    """Per task, part position and entry: parts assigned, their sums, and (entry -1 - z) how many
    parts looked at z entries."""
    parts, k, d = plan.book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, k), np.int64), np.zeros((parts * k, d), np.int64)
        looked = np.zeros(256, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = np.zeros((b.num_rows, parts * d), np.int64)
            x[:, :plan.dim] = np.frombuffer(b"".join(b.column("v").to_pylist()), f"<i{plan.width}").reshape(b.num_rows, -1)
            code = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(b.num_rows, parts)
            looked += np.bincount(np.frombuffer(b"".join(b.column("looked").to_pylist()), np.uint8), minlength=256)
            for p in range(parts):
                count[p] += np.bincount(code[:, p], minlength=k)
                np.add.at(total, p * k + code[:, p].astype(np.int64), x.reshape(-1, parts, d)[:, p])
        at = np.flatnonzero(count.ravel())
        z = np.flatnonzero(looked)
        yield batch_of(SUMS, part=np.concatenate([at // k, np.zeros(len(z), np.int64)]),
                       entry=np.concatenate([at % k, -1 - z]), n=np.concatenate([count.ravel()[at], looked[z]]),
                       sums=pa.array([*total[at].tolist(), *([0] * d for _ in z)], pa.list_(pa.int64())))
    return run


def next_b(looked: dict[int, int], b: int) -> int:
    """The list length for the next round, from how many parts looked at z entries (0: at all): the
    shortest that would have settled 19 of 20 of the parts their lists settled. Lists only get
    shorter, as entries come to rest; a longer one would have to be made from all distances again."""
    settled = sum(n for z, n in looked.items() if z)
    for z in range(LEAST_B, b):
        if sum(n for y, n in looked.items() if 0 < y < z) * 20 >= settled * 19 > 0:
            return z
    return b


def learn_codes(vectors: DataFrame, vector: str = "embedding", parts: int = 4, entries: int = 256, rounds: int = 4,
                scale: int = 1024) -> tuple[DataFrame, np.ndarray, list[int]]:
    """(rows, codebooks, list lengths). rows: vec_id, label, code (binary, an index a part), error;
    codebooks: parts x entries x components; the b of each assignment."""
    if not 0 < entries <= 256:
        raise ValueError("an index is one byte: 1 to 256 entries")
    spark = vectors.sparkSession
    label = F.col("label").cast("long") if "label" in vectors.columns else F.lit(None).cast("long")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"),
                          F.col(vector).cast("array<double>").alias("_vector"))

    def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = scratch_dir(spark, "llm", name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    state, path = written(rows.mapInArrow(_integers(scale), INTEGERS), "vector-integers")
    lengths = state.groupBy("size").agg(F.count("*").alias("n"), F.max("top").alias("top")) \
        .orderBy(F.desc("n"), F.desc("size")).first()
    dim, top = (lengths["size"], lengths["top"]) if lengths else (0, 0)
    state = state.filter(F.col("size") == dim)
    d = -(-dim // parts)
    start = state.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()   # a codebook
    book = np.zeros((len(start), parts * d), np.int64)
    for i, r in enumerate(start):
        book[i, :dim] = np.frombuffer(bytes(r["v"]), ">u4").astype(np.int64) - (1 << 31)
    book = np.ascontiguousarray(book.reshape(len(start), parts, d).transpose(1, 0, 2))
    if not len(start) or not dim:
        done = state.select("vec_id", "label", F.lit(bytes(parts)).alias("code"), F.lit(0).cast("long").alias("error"))
        return done, book, []
    width = 2 if top < 1 << 15 else 4
    b = min(FIRST_B, len(start))
    moved, used = None, []
    for r in range(rounds + 1):
        plan = _Plan(book, moved, b, width, dim)
        used.append(b)
        new, new_path = written(state.mapInArrow(_assign(plan), STATE), "vector-state")
        drop_dir(spark, path)
        state, path = new, new_path
        if r == rounds:
            break
        got = state.select("v", "code", "looked").mapInArrow(_sums(plan), SUMS).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(d)]).alias("sums")).collect()
        after = book.copy()
        for g in got:
            if g["entry"] >= 0:
                after[g["part"], g["entry"]] = [s // g["n"] for s in g["sums"]]
        # a little more than the way each entry went
        moved = np.nextafter(np.sqrt(((after - book) ** 2).sum(2).astype(np.float64)).astype(np.float32), np.float32(np.inf))
        moved[(after == book).all(2)] = 0
        if r:
            b = next_b({-1 - g["entry"]: g["n"] for g in got if g["entry"] < 0}, b)
        book = after
    return state.select("vec_id", "label", "code", "error"), book, used


def codebooks_sha256(book: np.ndarray) -> str:
    """Digest of all entries' components by part, entry and position, decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def code_digest(vectors: DataFrame, vector: str = "embedding", **options) -> DataFrame:
    """vec_id, code (hexadecimal), error, label_error (summed over equal labels), codebooks_sha256."""
    rows, book, _ = learn_codes(vectors, vector, **options)
    rows = rows.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error")
    labels = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return rows.join(labels, F.col("label").eqNullSafe(F.col("_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(book)).alias("codebooks_sha256"))
