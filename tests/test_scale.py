"""Scale properties: hot keys spread over tasks, partial aggregation, sizing."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from livepulse.operators.keyed import latest_per_key
from livepulse.operators.sequence import BUCKET, with_bucket
from livepulse.operators.transitions import detect_transitions
from livepulse.session import scale_conf


def hot_key_frame(spark, n=30000):
    """One stream holds a third of all rows, spread over 100 days."""
    t0 = datetime(2024, 1, 1)
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("stream_id"),
        F.lit("u").alias("user_name"), (F.col("id") % 5).cast("string").alias("game_name"),
        F.lit("t").alias("title"), F.col("id").alias("viewer_count"),
        (F.lit(t0).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") % 144000).cast("int"),
                                                          F.lit(0))).alias("ingestion_ts"))


def test_hot_stream_is_split_across_tasks(spark):
    df = hot_key_frame(spark)
    # the sequence operators partition by (key, day bucket): the hot key's rows land in many partitions
    parts = (with_bucket(df, "ingestion_ts", 86400).repartition(8, "stream_id", BUCKET)
             .where(F.col("stream_id") == "hot").select(F.spark_partition_id()).distinct().count())
    assert parts >= 6  # of 8 (hash placement of ~100 day buckets)
    plan = detect_transitions(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(stream_id" in plan and "_bucket" in plan
    assert "Window" in plan


def test_latest_per_key_aggregates_before_the_shuffle(spark):
    df = hot_key_frame(spark)
    out = latest_per_key(df, ["stream_id"], ["ingestion_ts", "viewer_count"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert out.where("stream_id = 'hot'").count() == 1


def test_scale_conf():
    c = scale_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(10, 8)["spark.sql.shuffle.partitions"] == "16"


def test_catalogue_messages_are_dealt_to_many_tasks(spark):
    """One file of order lines, most of them of one part: the messages are made by many tasks of about equal size, and
    they are those of the versions as they come."""
    from livepulse.plans import profiles as P
    from livepulse.plans.q_bronze_silver import TASKS_PER_CORE, game_messages
    from livepulse.session import scratch_dir
    root, n = scratch_dir(spark, "test", "messages"), 4000
    line = spark.range(n).select((F.col("id") / 4).cast("long").alias("l_orderkey"), (F.col("id") % 4).cast("int").alias("l_linenumber"),
                                 F.when(F.col("id") % 10 == 0, F.col("id") % 9).otherwise(F.lit(1)).alias("l_partkey"))
    tables = {"lineitem": line,
              "orders": spark.range(n // 4).select(F.col("id").alias("o_orderkey"), F.expr("timestamp_ntz '2024-01-01'").alias("o_orderdate")),
              "part": spark.range(9).selectExpr("id p_partkey", "'größe \"' || id p_name", "'B' p_brand", "'T' p_type", "int(id) p_size")}
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    got = game_messages(spark, root)
    per_task = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("t")).count().collect()]
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert len(per_task) > tasks * 0.9 and sum(per_task) == n and max(per_task) < 3 * n / tasks
    g = P.s_bronze_games(spark, root)
    record = F.struct(F.col("game_id").alias("id"), F.col("game_name").alias("name"), "igdb_id", "igdb_data")
    want = g.select(F.concat(F.unhex(F.lit("0000000001")), F.encode(F.to_json(record), "UTF-8")).alias("value"),
                    F.col("ingestion_ts").alias("timestamp"), F.col("version_tiebreak").alias("key"))
    rows = lambda df: sorted((r.key, r.timestamp, bytes(r.value)) for r in df.collect())
    assert rows(got) == rows(want)
