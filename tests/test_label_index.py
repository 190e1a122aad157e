"""Selections by bitmaps against plain list filters, and duplicates found by hash."""

import random

from pyspark.sql import functions as F

from livepulse.operators import quality as Q
from livepulse.operators.catalogue import explore
from livepulse.operators.label_index import label_index


def test_selections_equal_list_filters(spark):
    rnd = random.Random(3)
    pick = lambda: rnd.choice([None, [], [rnd.choice("abcdef") for _ in range(rnd.randint(1, 3))] + [None]])
    games = spark.createDataFrame([(i, pick(), pick()) for i in range(3000)] + [(None, ["a"], ["a"])],
                                  "game_id long, themes array<string>, platforms array<string>").repartition(3)
    index = label_index(games, {"theme": "themes", "platform": "platforms"})
    for theme, platform in ((["a"], ["b"]), (["a", "c"], []), ([], []), (["a", "b", "f"], ["d", "e"]), (["zzz"], ["a"])):
        got = sorted(r.game_id for r in index.select({"theme": theme, "platform": platform}).collect())
        want = explore(games.where("game_id is not null"), {"themes": theme, "platforms": platform})
        assert got == sorted(r.game_id for r in want.collect())
    plan = index.select({"theme": ["a"], "platform": ["b"]})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") + plan.count("ShuffledHashJoin") <= 4


def test_games_beyond_one_bucket(spark):
    games = spark.range(100_000).select(F.col("id").alias("game_id"), F.array(F.concat(F.lit("l"), F.col("id") % 7)).alias("labels"))
    index = label_index(games, {"label": "labels"})
    assert index.bitmaps.select("bucket").distinct().count() > 1
    got = index.select({"label": ["l3", "l5"]}).agg(F.count("*"), F.sum("game_id")).first()
    want = games.where("game_id % 7 in (3, 5)").agg(F.count("*"), F.sum("game_id")).first()
    assert tuple(got) == tuple(want)


def test_duplicates_by_hash(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("key-" * 20), F.when(F.col("id") < 20, 0).otherwise(F.col("id"))).alias("k"),
                                      F.when(F.col("id") % 1000 == 0, None).otherwise(F.col("id")).alias("n"))
    for columns in (("k",), ("n",), ("k", "n")):
        plain = Q.run_checks("t", rows, [Q.Duplicates(columns)]).collect()
        hashed = Q.run_checks("t", rows, [Q.Duplicates(columns, by_hash=True)]).collect()
        assert [tuple(r) for r in plain] == [tuple(r) for r in hashed] and plain[0].value == (1 if columns != ("k", "n") else 0)


def test_newest_day_from_the_listing(spark):
    from datetime import date, datetime

    from livepulse.operators import maintenance as J
    from livepulse.operators.broadcasts import latest_snapshot
    from livepulse.session import scratch_dir
    rows = [(datetime(2023 + d // 300, 1 + d % 12, 1 + d % 28, d % 24), d) for d in range(600)]
    df = spark.createDataFrame(rows, "ingestion_ts timestamp, v int").withColumns(
        {"year": F.year("ingestion_ts"), "month": F.month("ingestion_ts"), "day": F.dayofmonth("ingestion_ts")})
    path = scratch_dir(spark, "test", "days")
    df.repartition(1).write.partitionBy("year", "month", "day").parquet(path)
    newest = J.newest_day(spark, path, df.schema)
    assert newest.agg(F.max("ingestion_ts")).first() == df.agg(F.max("ingestion_ts")).first()
    assert "PartitionFilters: [isnotnull(year" in newest._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    table = spark.read.schema(df.schema).parquet(path)
    assert sorted(latest_snapshot(table, polls=newest).collect()) == sorted(latest_snapshot(table).collect())
    before = J.newest_day(spark, path, df.schema, as_of=date(2023, 6, 15))
    assert before.agg(F.max("ingestion_ts")).first()[0] == df.where("ingestion_ts < '2023-06-16'").agg(F.max("ingestion_ts")).first()[0]
    assert J.newest_day(spark, path, df.schema, as_of=date(2000, 1, 1)).count() == 0
