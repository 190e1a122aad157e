"""Per-key sequential operators that stay balanced when one key is hot.

A window over ``partitionBy(key)`` sends every row of a key to one task. Here
rows are partitioned by (key, time bucket) instead; what a bucket needs from
earlier buckets (the previous row, the last few rows) is computed from small
per-bucket summaries, so no task ever holds more than one bucket of one key.
With one poll per minute a day bucket holds at most 1,440 rows of a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

BUCKET = "_bucket"


def with_bucket(df: DataFrame, ts: str, bucket_seconds: int) -> DataFrame:
    return df.withColumn(BUCKET, F.floor(F.unix_timestamp(F.col(ts)) / F.lit(bucket_seconds)).cast("long"))


def previous_row(df: DataFrame, key: str, ts: str, fields: Sequence[str],
                 tiebreak: Sequence[str] = (), bucket_seconds: int = 86400,
                 prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<f>`` for each field (and ``prev_<ts>``): the values of the previous
    row of the same key in (ts, *tiebreak) order; null for a key's first row.

    Inside a bucket this is ``lag``; the first row of a bucket takes the last row
    of the nearest earlier non-empty bucket, found on the per-bucket summary.
    """
    order = [F.col(ts), *[F.col(c) for c in tiebreak]]
    carried = [*fields, ts]
    b = with_bucket(df, ts, bucket_seconds)
    w = Window.partitionBy(key, BUCKET).orderBy(*order)
    b = b.withColumn("_rn", F.row_number().over(w))
    b = b.withColumns({f"_lag_{c}": F.lag(c).over(w) for c in carried})

    # per-bucket summary from the windowed rows: the last row of each bucket is the one
    # without a successor (this branch reads the pruned input a second time)
    b = b.withColumn("_is_last", F.lead(F.lit(1)).over(w).isNull())
    last = b.where("_is_last").select(key, BUCKET, F.struct(*[F.col(c).alias(c) for c in carried]).alias("_last"))
    wb = Window.partitionBy(key).orderBy(BUCKET)
    boundary = last.select(key, BUCKET, F.lag("_last").over(wb).alias("_carry"))

    joined = b.join(boundary, [key, BUCKET], "left")
    first = F.col("_rn") == 1
    out = joined.withColumns({
        f"{prefix}{c}": F.when(first, F.col(f"_carry.{c}")).otherwise(F.col(f"_lag_{c}"))
        for c in carried
    })
    return out.drop("_rn", "_is_last", "_carry", BUCKET, *[f"_lag_{c}" for c in carried])


def rolling_mean_rows(df: DataFrame, key: str, ts: str, value: str, rows: int = 10,
                      tiebreak: Sequence[str] = (), bucket_seconds: int = 86400,
                      out: str = "rolling_mean") -> DataFrame:
    """Mean of the non-null values among the last ``rows`` rows (current included)
    per key; null when all of them are null.

    The input is read twice, each time shuffled by (key, bucket) only:
    1. the last ``rows - 1`` rows of every bucket (a bucket-local window), packed
       as one small array per bucket; a window over these per-bucket rows (one row
       per key and bucket) gathers the ``rows - 1`` values that precede each
       bucket, from however many earlier non-empty buckets they span;
    2. those values are put in front of their bucket as ghost rows, and one
       bucket-local ``avg`` over ``rowsBetween(-(rows - 1), 0)`` gives every real
       row its mean; the ghost rows are then dropped.
    """
    k = rows - 1
    order = [F.col(ts), *[F.col(c) for c in tiebreak]]
    b = with_bucket(df, ts, bucket_seconds).withColumn("_v", F.col(value).cast("double"))
    w = Window.partitionBy(key, BUCKET).orderBy(*order)
    if k <= 0:
        return b.withColumn(out, F.col("_v")).drop("_v", BUCKET)

    last_first = Window.partitionBy(key, BUCKET).orderBy(*[c.desc() for c in order])
    tails = (b.select(key, BUCKET, *order, "_v")
             .withColumn("_back", F.row_number().over(last_first))
             .where(F.col("_back") <= k)
             .groupBy(key, BUCKET)
             .agg(F.collect_list(F.struct(F.col(BUCKET).alias("b"), (-F.col("_back")).alias("p"),
                                          F.col("_v").alias("v"))).alias("_tail")))
    before = Window.partitionBy(key).orderBy(BUCKET).rowsBetween(-k, -1)
    gathered = F.sort_array(F.flatten(F.collect_list("_tail").over(before)))
    carry = (tails.select(key, BUCKET, gathered.alias("_c"))
             .select(key, BUCKET, F.slice("_c", F.greatest(F.size("_c") - k + 1, F.lit(1)), k).alias("_c"))
             .where(F.size("_c") > 0))
    ghosts = carry.select(key, BUCKET, F.posexplode("_c").alias("_gpos", "_g")).select(
        key, BUCKET, F.lit(0).alias("_real"), "_gpos", F.col("_g.v").alias("_v"))

    cols = df.columns
    real = b.withColumn("_real", F.lit(1))
    both = real.unionByName(ghosts, allowMissingColumns=True)
    wg = Window.partitionBy(key, BUCKET).orderBy("_real", "_gpos", *order)
    return (both.withColumn(out, F.avg("_v").over(wg.rowsBetween(-k, 0)))
            .where(F.col("_real") == 1)
            .select(*cols, out))
