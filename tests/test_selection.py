"""Exact medians by selection against ``median``, and sketches that merge."""

import random

import pytest
from pyspark.sql import functions as F

from livepulse.operators.selection import approx_median, audience_by, exact_median, hourly_audience


def same(spark, rows, ddl, by=("g",), **kw):
    df = spark.createDataFrame(rows, ddl)
    got = {r[:-1]: r[-1] for r in map(tuple, exact_median(df, "v", by, **kw).collect())}
    want = {r[:-1]: r[-1] for r in map(tuple, df.groupBy(*by).agg(F.median("v").cast("double")).collect())}
    assert {k: str(v) for k, v in got.items()} == {k: str(v) for k, v in want.items()}
    return got


@pytest.mark.parametrize("bins", [1000, 4096])
def test_medians_of_whole_numbers(spark, bins):
    rnd = random.Random(bins)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([rnd.randint(-50, 50), 7, None])) for _ in range(400)]
    rows += [("one", 3), ("two", 1), ("two", 2), ("none", None), ("equal", 5), ("equal", 5), ("far", 2**62), ("far", -2**62), ("far", 1)]
    rows += [("edge", 2**63 - 1), ("edge", -2**63), ("edge", -2**63 + 1), ("edge", 2**63 - 2), ("edge", 2**63 - 3)]
    got = same(spark, rows, "g string, v long", bins=bins)
    assert got["two",] == 1.5 and got["none",] is None


def test_medians_of_doubles(spark):
    rnd = random.Random(4)
    rows = [(rnd.randint(0, 3), rnd.choice([rnd.gauss(0, 1), rnd.gauss(0, 1) * 1e300, rnd.random() * 1e-300, 0.0])) for _ in range(500)]
    inf, nan = float("inf"), float("nan")
    rows += [(10, nan), (10, 1.0), (10, inf), (11, -inf), (11, -inf), (11, 5.0), (12, nan), (13, 1.7e308), (13, -1.7e308), (13, 1.0),
             (14, inf), (14, 2.0), (15, 5e-324), (15, 0.0), (15, 5e-324), (16, nan), (16, nan), (16, 3.0), (16, 4.0), (16, 4.5)]
    same(spark, rows, "g int, v double")


def test_median_without_groups(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (10,)], "v int")
    assert exact_median(df, "v").collect()[0].median == 3.0
    assert [tuple(r) for r in exact_median(df.limit(0), "v").collect()] in ([], [(None,)])
    assert exact_median(df.limit(0).withColumn("g", F.lit(1)), "v", ["g"]).collect() == []


def test_kll_median_is_close(spark):
    df = spark.range(100_000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("v"))
    exact = {r.g: r.median for r in exact_median(df, "v", ["g"]).collect()}
    for r in approx_median(df, "v", ["g"]).collect():
        rank = df.where((F.col("g") == r.g) & (F.col("v") <= r.median)).count() / df.where(F.col("g") == r.g).count()
        assert abs(rank - 0.5) < 0.02 and (r.median > 0) == (r.median > 0) and r.g in exact


def test_streamer_sketches_merge(spark):
    rows = spark.range(60_000).select(
        F.concat(F.lit("u"), F.col("id") % 9000).alias("user_name"), F.concat(F.lit("g"), F.col("id") % 7).alias("game_name"),
        F.lit("en").alias("language"), F.lit(2024).alias("year"), F.lit(1).alias("month"), (F.col("id") % 5).alias("day"),
        (F.col("id") % 24).alias("ingestion_hour"))
    whole = audience_by(hourly_audience(rows), "game_name")
    half = hourly_audience(rows.where("user_name < 'u5'")).unionByName(hourly_audience(rows.where("user_name >= 'u5'")))
    split = {r.game_name: r.distinct_streamers for r in audience_by(half, "game_name").collect()}
    assert all(abs(split[r.game_name] - r.distinct_streamers) <= 0.02 * r.distinct_streamers for r in whole.collect())   # however split
    exact = {r.game_name: r.n for r in rows.groupBy("game_name").agg(F.count_distinct("user_name").alias("n")).collect()}
    assert all(abs(r.distinct_streamers - exact[r.game_name]) <= 0.05 * exact[r.game_name] for r in whole.collect())
    total = audience_by(hourly_audience(rows)).first().distinct_streamers
    assert abs(total - 9000) <= 0.05 * 9000
