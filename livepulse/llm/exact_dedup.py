"""Operator 5, exact dedup: tree-merge of sorted digest runs.

Every task turns its rows into a run (digest, best row, count). A run is numbered
by its task in base ``fan_in``; in round r, the runs whose numbers differ only in
digit r meet: each takes over the digests whose own digit r is its own, so after
the last round every digest range lies in one run. A round is one shuffle of runs
that have already been reduced, a sort by digest and a multiway merge that keeps,
of equal digests, the smallest (or largest) identifier. A group that holds a third of
all rows is one line per run from the start. Lines that meet must agree in byte
length and CRC-32 too; if they do not, the job stops with an error instead of
merging two texts.

Defined cases: a null text is empty; texts are equal when their bytes are equal
after lower-casing A-Z; a null ``doc_id`` loses to any number; of rows with the same
text and the same ``doc_id`` exactly one is kept; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_LONG, batch_of, id_and_text, stored

ROW = "doc_id long, sha binary, size long, crc long"
RUN = "slot long, sha binary, doc_id long, uid long, n long, same long, size long, crc long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 1024):
            part = b.slice(lo, 1024)
            low = [t.lower() for t in part.column("text").cast(pa.binary()).to_pylist()]   # bytes: A-Z only
            yield batch_of(ROW, doc_id=part.column("doc_id"), sha=[hashlib.sha256(t).digest() for t in low],
                           size=[len(t) for t in low], crc=[zlib.crc32(t) for t in low])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (slot, sha, best first): the first of each (slot, sha) stays and
    takes the summed count. A group that goes on in the next batch is carried over."""
    carry = None
    for b in batches:
        if carry is not None:
            b = pa.Table.from_batches([carry, b.cast(carry.schema)]).combine_chunks().to_batches()[0]
        if not b.num_rows:
            continue
        sha = np.array(b.column("sha").to_pylist(), dtype="S32")
        slot = b.column("slot").to_numpy()
        first = np.concatenate([[True], (sha[1:] != sha[:-1]) | (slot[1:] != slot[:-1])])
        heads = np.flatnonzero(first)
        group = np.cumsum(first) - 1
        for c in ("size", "crc"):
            v = b.column(c).to_numpy()
            if (v != v[heads][group]).any():
                raise ValueError("two different texts have one digest")
        total = np.add.reduceat(b.column("n").to_numpy(), heads)
        ids = b.column("doc_id").fill_null(NULL_LONG).to_numpy()
        same = np.add.reduceat(np.where(ids == ids[heads][group], b.column("same").to_numpy(), 0), heads)
        rows = b.take(pa.array(heads))
        rows = rows.set_column(rows.schema.get_field_index("n"), "n", pa.array(total, pa.int64()))
        rows = rows.set_column(rows.schema.get_field_index("same"), "same", pa.array(same, pa.int64()))
        if len(heads) > 1:
            yield rows.slice(0, len(heads) - 1)
        carry = rows.slice(len(heads) - 1)
    if carry is not None:
        yield carry


def digest_rows(docs: DataFrame) -> DataFrame:
    """doc_id, sha, size, crc of every row's normalised text."""
    return id_and_text(docs).mapInArrow(_digests, ROW)


def merge_runs(rows: DataFrame, keep: str = "min", fan_in: int = 16) -> DataFrame:
    """rows: digest_rows() with a ``uid``. One row per digest: sha, doc_id and uid of
    the row that stays, n rows in all, ``same`` of them with that doc_id."""
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    best = [F.col("doc_id").asc_nulls_last() if keep == "min" else F.col("doc_id").desc_nulls_last(), F.col("uid")]
    tasks = max(rows.select((F.shiftright("uid", 33) + 1).alias("t")).agg(F.max("t")).first()[0] or 1, 2)
    rounds = max(1, math.ceil(math.log(tasks, fan_in) - 1e-9))
    runs = rows.select(F.shiftright("uid", 33).alias("slot"), "sha", "doc_id", "uid", F.lit(1).cast("long").alias("n"),
                       F.lit(1).cast("long").alias("same"), "size", "crc")
    # the run each task starts from: its own rows, sorted and reduced, nothing moves
    runs = runs.sortWithinPartitions("slot", "sha", *best).mapInArrow(_merge, RUN)
    # a digest's place in the tree: its first 48 bits (exact in the division below) in base fan_in
    place = F.conv(F.substring(F.hex("sha"), 1, 12), 16, 10).cast("long")
    for r in range(rounds):
        unit = fan_in ** r
        own = F.floor(F.col("slot") / unit) % fan_in
        new = F.floor(place / unit) % fan_in
        runs = runs.withColumn("slot", (F.col("slot") + (new - own) * unit).cast("long"))
        runs = runs.repartition(F.col("slot")).sortWithinPartitions("slot", "sha", *best).mapInArrow(_merge, RUN)
    return runs.drop("slot")


def exact_duplicates(docs: DataFrame, keep: str = "min", fan_in: int = 16) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stored(digest_rows(docs).withColumn("uid", F.monotonically_increasing_id()), "digests")
    best = merge_runs(rows, keep, fan_in).select(
        F.col("sha").alias("_sha"), F.col("doc_id").alias("keep_id"), F.col("uid").alias("_uid"),
        F.col("n").alias("group_size"))
    return rows.join(best, rows.sha == F.col("_sha")).select(
        "doc_id", "keep_id", "group_size", (F.col("uid") == F.col("_uid")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def _with_sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        low = [(t or b"").lower() for t in b.column("text").cast(pa.binary()).to_pylist()]
        sha = pa.array([hashlib.sha256(t).digest() for t in low], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("_row"), b.column("doc_id"), sha], names=["_row", "doc_id", "_sha"])


def drop_exact_duplicates(docs: DataFrame, keep: str = "min", fan_in: int = 16) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    rows = stored(digest_rows(docs).withColumn("uid", F.monotonically_increasing_id()), "digests")
    best = stored(merge_runs(rows, keep, fan_in).select(
        F.col("sha").alias("_keep_sha"), F.col("doc_id").alias("_keep"), F.col("same").alias("_same")), "kept")
    whole = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    whole = whole.mapInArrow(_with_sha, whole.select("_row", "doc_id", F.lit(b"").alias("_sha")).schema)

    def rows_of(which):
        return whole.join(which, (F.col("_sha") == F.col("_keep_sha"))
                          & F.col("doc_id").eqNullSafe(F.col("_keep")), "left_semi")

    out = rows_of(best)
    repeated = best.filter(F.col("_same") > 1)
    if not repeated.isEmpty():   # rows that repeat text and doc_id: one of each stays
        out = rows_of(best.filter(F.col("_same") == 1)).select("_row").unionByName(
            rows_of(repeated).groupBy("_sha").agg(F.first("_row").alias("_row")).select("_row"))
    return out.select("_row.*")
