"""Exact medians of groups of any size, and sketches that merge.

``median`` and ``percentile`` keep every distinct value of a group in one task. :func:`exact_median`
selects instead: each pass counts a group's values in at most ``bins`` equal stretches of the range that
still holds the wanted rank, and goes on in the stretch that has it, until that holds one value. What is
shuffled is counts, at most ``bins`` a group from each task; a pass narrows the range ``bins`` times, so
64 bits take at most six passes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, StructField, StructType

from livepulse.session import materialize

SHIFT = 40     # ranges up to 2**40 are divided as they are, wider ones in halves


def _ordered(column: str, back: bool):
    """Doubles as whole numbers in the same order (their bits, those of negative ones turned round), and back;
    NaN comes last, as in Spark, and -0.0 is 0.0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(column)
            v = b.column(at)
            null = v.is_null().to_numpy(zero_copy_only=False)
            if back:
                bits = v.fill_null(0).to_numpy()
                out = (bits ^ ((bits >> 63) & np.int64(2**63 - 1))).view(np.float64)
            else:
                x = v.fill_null(0.0).to_numpy() + 0.0
                bits = np.where(np.isnan(x), np.nan, x).view(np.int64)
                out = bits ^ ((bits >> 63) & np.int64(2**63 - 1))
            yield b.set_column(at, column, pa.array(out, mask=null))
    return run


def _stretch(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Number of the stretch of [lo, hi] that ``v`` lies in; never smaller for a larger value."""
    far = F.shiftright(hi, 1) - F.shiftright(lo, 1)
    near = far < F.lit(1 << SHIFT)
    width = F.call_function("div", F.when(near, hi - lo).otherwise(far), F.lit(bins)) + 1
    # halves of far ends, so that their difference stays a long
    return F.call_function("div", F.when(near, v - lo).otherwise(F.shiftright(v, 1) - F.shiftright(lo, 1)), width)


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median", bins: int = 4096) -> DataFrame:
    """``by`` and the median (double) of the non-null values of each group, equal to ``median``: the mean of
    the two middle values, NaN above all numbers; a group without values has a null. The values are
    written once (an eager checkpoint) and read in every pass; doubles are selected by their bits, so
    a pass settles as many of them for any range of values."""
    floating = isinstance(df.schema[value].dataType, (DoubleType, FloatType))
    by = list(by)
    keys = [f"_k{i}" for i in range(len(by))]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(value).cast("double" if floating else "long").alias("_v"))
    if floating:
        kinds = StructType([*rows.schema.fields[:-1], StructField("_v", LongType())])
        rows = rows.mapInArrow(_ordered("_v", back=False), kinds)
    rows = materialize(rows)
    groups = rows.groupBy(*keys).agg(F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    # the two middle ranks of each group, one for an odd count; nothing lies below its range yet
    middle = F.array_distinct(F.array(F.call_function("div", F.col("n") - 1, F.lit(2)), F.call_function("div", F.col("n"), F.lit(2))))
    targets = materialize(groups.where("n > 0").select(*keys, F.explode(middle).alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below")))
    one = F.col("lo") == F.col("hi")
    found: DataFrame | None = None
    while True:
        done = targets.where(one).select(*keys, "rank", F.col("lo").alias("_v"))
        found = done if found is None else found.unionByName(done)
        targets = targets.where(~one)
        if targets.isEmpty():
            break
        named = targets.select(*[F.col(k).alias(f"_t{k}") for k in keys], "rank", "lo", "hi", "below")
        on = [F.col(k).eqNullSafe(F.col(f"_t{k}")) for k in keys]
        inside = rows.where("_v is not null")
        inside = inside.join(named, on) if keys else inside.crossJoin(F.broadcast(named))    # two rows
        # values below the range are counted already, those above it come after it
        inside = inside.where(F.col("_v").between(F.col("lo"), F.col("hi"))).withColumn(
            "bin", _stretch(F.col("_v"), F.col("lo"), F.col("hi"), bins))
        counts = inside.groupBy(*keys, "rank", "below", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        # at most ``bins`` rows a group and rank
        upto = F.sum("n").over(Window.partitionBy(*keys, "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
        chosen = counts.withColumn("upto", F.col("below") + upto).where(
            (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        targets = materialize(chosen.select(*keys, "rank", "lo", "hi", (F.col("upto") - F.col("n")).alias("below")))
    if floating:
        kinds = StructType([*found.schema.fields[:-1], StructField("_v", DoubleType())])
        found = found.mapInArrow(_ordered("_v", back=True), kinds)
    medians = found.groupBy(*keys).agg(F.avg(F.col("_v").cast("double")).alias("_median"))
    groups = groups.select(*keys) if keys else groups.select(F.lit(1).alias("_one"))
    joined = groups.join(medians.select(*[F.col(k).alias(f"_m{k}") for k in keys], "_median"),
                         [F.col(k).eqNullSafe(F.col(f"_m{k}")) for k in keys], "left") if keys else groups.crossJoin(medians)
    return joined.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], F.col("_median").alias(name))


def approx_median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    """The same within a rank error of about one percent, in one pass: a KLL sketch per group, merged from
    those of the tasks."""
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"))
    return df.groupBy(*by).agg(F.count(value).alias("_n"), sketch.alias("_s")).select(
        *by, F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_double("_s", F.lit(0.5))).alias(name))


def hourly_audience(clean: DataFrame, user: str = "user_name", keys: Sequence[str] = ("game_name", "language", "year", "month", "day", "ingestion_hour")) -> DataFrame:
    """One row per hourly group with a sketch of its distinct streamers (HyperLogLog, ``streamers``), which
    reports merge instead of counting the history's streamers again."""
    return clean.groupBy(*keys).agg(F.hll_sketch_agg(user).alias("streamers"))


def audience_by(hourly: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and the estimated number of distinct streamers (about 2 % off at the default size)."""
    return hourly.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("streamers")).alias("distinct_streamers"))
