"""Operator 4, sharding: best-fit-decreasing bin packing of indivisible groups.

Rows with one text form a group that is never divided. Groups are sorted by size,
largest first, and each enters the shard whose remaining capacity is the tightest that
holds it; a balanced tree (a treap on (remaining, shard)) finds that shard, and a group
that fits nowhere opens one. With a fixed ``capacity`` this minimises the number of
shards; with a fixed number of ``shards`` the least capacity is searched for which
best-fit-decreasing needs no more shards, so their sizes come out nearly equal. A group
above the share of the shards that are left gets a shard of its own first, and the others
are levelled over the rest; where they are few and large, so that best fit leaves some
shards emptier than others, they go largest first to the emptiest shard if that is nearer
to equal.

What grows with the data runs in Spark: group sizes, the range sort by size, and the
places. The packing itself sees a bounded list: a group of at least a ``grain`` (a
shard's share / ``grains``, without the groups that have a shard of their own) is an item of
its own, and there are at most ``grains`` of these per shard; smaller groups, neighbours in the sorted order, form an
item of about one grain. Shards beyond ``cell_shards`` are dealt into cells by a hash of
the group, and each cell is packed in its own task.

Defined cases: a null text has size 1 and forms a group with the empty one; a group
larger than ``capacity`` gets a shard of its own; repeated rows and null ids are rows
like others (null ids come first in a shard); an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, id_and_text, number_rows, stored

ITEM = "grp binary, cell int, task int, item long, bytes long"


class CapacityTree:
    """Treap of (remaining capacity, shard): insert, and take out the tightest that holds a size."""

    def __init__(self) -> None:
        self.root, self.draw = None, random.Random(7).random

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b

    def insert(self, remaining: int, shard: int) -> None:
        key = (remaining, shard)
        left, right = self._split(self.root, key)
        self.root = self._join(self._join(left, [key, self.draw(), None, None]), right)

    def take(self, size: int) -> tuple[int, int] | None:
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        node = right
        while node[2] is not None:
            node = node[2]
        key = node[0]
        _, rest = self._split(right, (key[0], key[1] + 1))
        self.root = self._join(left, rest)
        return key


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Shard of each item (``sizes`` in descending order); None once ``most`` shards do not do."""
    tree, used, out = CapacityTree(), 0, []
    for size in sizes:
        found = tree.take(size)
        if found is None:
            if most is not None and used >= most:
                return None
            found = (max(capacity, size), used)
            used += 1
        tree.insert(found[0] - size, found[1])
        out.append(found[1])
    return out


def own_shards(sizes: list[int], total: int, shards: int) -> tuple[int, int]:
    """How many of the largest groups get a shard of their own, since each is above the share of
    the shards still left; and the bytes of all others."""
    alone = 0
    while alone < len(sizes) and sizes[alone] * (shards - alone) > total:
        total -= sizes[alone]
        alone += 1
    return alone, total


def emptiest_first(sizes: list[int], shards: int) -> list[int]:
    """Each item (``sizes`` in descending order) into the shard that holds least."""
    heap, out = [(0, s) for s in range(shards)], []
    for size in sizes:
        filled, shard = heap[0]
        heapq.heapreplace(heap, (filled + size, shard))
        out.append(shard)
    return out


def spread(sizes: list[int], packed: list[int], shards: int) -> int:
    """Bytes between the fullest and the emptiest of all ``shards``, used or not."""
    filled = [0] * shards
    for size, shard in zip(sizes, packed):
        filled[shard] += size
    return max(filled) - min(filled)


def level_fit(sizes: list[int], shards: int) -> list[int]:
    """Groups above a share alone; the others by best-fit-decreasing at the least capacity
    that needs at most the ``shards`` left, or to the emptiest where that leaves them unequal."""
    alone, total = own_shards(sizes, sum(sizes), shards)
    rest, left = sizes[alone:], shards - alone
    if not rest:
        return list(range(alone))
    low = max(rest[0], -(-total // left), 1)
    best, at = best_fit_decreasing(rest, low, left), low
    step = 1
    while best is None:                       # a capacity that does, then bisection down to it
        at = low + step
        best, step = best_fit_decreasing(rest, at, left), step * 4
    while at - low > max(1, low // 100_000):
        mid = (low + at) // 2
        got = best_fit_decreasing(rest, mid, left)
        low, at, best = (mid, at, best) if got is None else (low, mid, got)
    if (uneven := spread(rest, best, left)) * left * 100 > total:       # over a hundredth of a share
        other = emptiest_first(rest, left)
        best = other if spread(rest, other, left) < uneven else best
    return [*range(alone), *(alone + shard for shard in best)]


def shard_rows(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32, grp (digest of the text)."""
    t = F.col("text")
    return id_and_text(docs).select("doc_id", (F.octet_length(t) + 1).cast("long").alias("size"),
                                    F.crc32(t.cast("binary")).alias("text_crc32"),
                                    F.unhex(F.sha2(t.cast("binary"), 256)).alias("grp"))


def assign_shards(docs: DataFrame, shards: int | None = None, capacity: int | None = None,
                  grains: int = 4096, cell_shards: int = 256) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, slot (0, 1, ... in the shard by doc_id)."""
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    rows = stored(shard_rows(docs), "shard-rows")
    groups = stored(rows.groupBy("grp").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    cells = 1 if shards else max(1, math.ceil(total / (capacity * cell_shards)))
    if shards:
        largest = [r["bytes"] for r in groups.orderBy(F.desc("bytes")).limit(shards).select("bytes").collect()]
        alone, others = own_shards(largest, total, shards)
        grain = max(1, others // (max(1, shards - alone) * grains))
    else:
        grain = max(1, capacity // grains)

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Number the items of a sorted range; nothing has to be known of other ranges."""
        from pyspark import TaskContext
        task, item, filled, cell = TaskContext.get().partitionId(), 0, 0, None
        for b in batches:
            numbers = []
            for c, size in zip(b.column("cell").to_pylist(), b.column("bytes").to_pylist()):
                if cell is not None and (c != cell or filled + size > grain):
                    item, filled = item + 1, 0
                cell, filled = c, filled + size
                numbers.append(item)
            yield batch_of(ITEM, grp=b.column("grp"), cell=b.column("cell"), bytes=b.column("bytes"),
                           task=np.full(b.num_rows, task), item=numbers)

    order = [F.col("cell"), F.col("bytes").desc(), F.col("grp")]
    celled = groups.withColumn("cell", F.pmod(F.xxhash64("grp"), F.lit(cells)).cast("int"))
    placed = stored(celled.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(items, ITEM),
                    "shard-items")

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["bytes", "task", "item"], ascending=[False, True, True], kind="stable")
        sizes = part["bytes"].tolist()
        part["bin"] = level_fit(sizes, shards) if shards else best_fit_decreasing(sizes, capacity)
        return part[["cell", "task", "item", "bin"]]

    # at most about 2 * grains * shards rows a cell, plus one for each task
    plan = stored(placed.groupBy("cell", "task", "item").agg(F.sum("bytes").alias("bytes"))
                  .groupBy("cell").applyInPandas(fit, "cell int, task int, item long, bin int"), "shard-plan")
    used = plan.groupBy("cell").agg((F.max("bin") + 1).alias("n")).select(
        F.col("cell").alias("_cell"), (F.expr("sum(n) over (order by cell)") - F.col("n")).cast("int").alias("_first"))
    group_shard = placed.join(plan, ["cell", "task", "item"]).join(used, F.col("cell") == F.col("_cell")).select(
        F.col("grp").alias("_grp"), (F.col("bin") + F.col("_first")).alias("shard"))
    out = rows.join(group_shard, rows.grp == F.col("_grp")).select("doc_id", "size", "text_crc32", "shard")
    return number_rows(out, ["shard"], ["doc_id", "text_crc32"], "slot")


def write_shards(docs: DataFrame, assigned: DataFrame, folder: str) -> None:
    """The documents as Parquet, one folder per shard (``assigned``: from assign_shards)."""
    key = assigned.select(F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_crc"), "shard", "slot")
    crc = F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    (docs.join(key.dropDuplicates(["_id", "_crc"]), F.col("doc_id").eqNullSafe(F.col("_id")) & (crc == F.col("_crc")))
     .drop("_id", "_crc").write.partitionBy("shard").parquet(folder))
