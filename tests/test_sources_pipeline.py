"""Sources, sinks, triggers, and the streaming pipeline end to end
(broker-shaped frames → bronze → silver → change detection and gold)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from livepulse.operators import bronze as B
from livepulse.plans import profiles as P
from livepulse.plans.q_bronze_silver import wire_messages
from livepulse.schemas import BRONZE_STREAMS, TRANSITIONS
from livepulse.session import scratch_dir
from livepulse.sources import await_any, read_or_empty, register_views, trigger_options, write_append
from livepulse.streaming import jobs

SF = "/root/testdata/sf0.001"


def test_read_or_empty_only_forgives_missing_paths(spark):
    df = read_or_empty(spark, scratch_dir(spark, "test", "missing"), BRONZE_STREAMS)
    assert df.count() == 0 and df.schema == BRONZE_STREAMS
    bad = scratch_dir(spark, "test", "bad")
    import os
    os.makedirs(bad)
    with open(f"{bad}/part-0.parquet", "w") as fh:
        fh.write("not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, bad, BRONZE_STREAMS).count()


def test_append_write_and_views(spark):
    path = scratch_dir(spark, "test", "append")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    write_append(df, path)
    write_append(df, path)
    register_views({"appended": spark.read.parquet(path)})
    assert spark.sql("SELECT count(*) FROM appended").first()[0] == 2


def test_trigger_options():
    assert trigger_options("default") == {}
    assert trigger_options("processing_time", "60 seconds") == {"processingTime": "60 seconds"}
    assert trigger_options("available_now") == {"availableNow": True}
    with pytest.raises(ValueError):
        trigger_options("sometimes")


def test_metadata_projection(spark):
    from livepulse.schemas import METADATA
    rec = {"id": 1, "themes": [{"id": 1, "name": "a"}],
           "platforms": [{"name": "p", "platform_family": {"id": 2, "name": "f"}, "platform_type": None}]}
    df = spark.createDataFrame([(rec,)], f"m {METADATA.simpleString()}").select("m.*")
    r = B.metadata_projection(df).first()
    assert r.themes_name == ["a"] and r.platforms_platform_family_name == ["f"]


def test_pipeline_end_to_end(spark):
    """Broker-shaped records (value, timestamp) staged as files stand in for the
    broker source (its connector jar is not installed here)."""
    msgs = scratch_dir(spark, "test", "msgs")
    wire_messages(spark, SF).repartition(3).write.parquet(msgs)
    broker = spark.readStream.schema("value binary, timestamp timestamp").parquet(msgs)
    bronze, bronze_ckpt = scratch_dir(spark, "test", "bronze"), scratch_dir(spark, "test", "bronze_ckpt")
    q = jobs.bronze_streams_job(broker, bronze, bronze_ckpt, trigger="available_now")
    assert await_any(spark, 300)
    q.awaitTermination(300)
    b = spark.read.parquet(bronze)
    assert b.count() == P.e_snapshots(spark, SF).count()
    assert set(b.columns) >= {"year", "month", "day", "stream_id", "ingestion_ts", "started_at"}

    silver, silver_ckpt = scratch_dir(spark, "test", "silver"), scratch_dir(spark, "test", "silver_ckpt")
    jobs.silver_job(spark, "streams", bronze, silver, silver_ckpt, trigger="available_now",
                    max_files_per_trigger=2).awaitTermination(300)
    s = spark.read.parquet(silver)
    assert s.count() == b.count() and "stream_time_seconds" in s.columns

    tr, tr_ckpt = scratch_dir(spark, "test", "tr"), scratch_dir(spark, "test", "tr_ckpt")
    jobs.transitions_job(spark, bronze, tr, tr_ckpt, trigger="available_now",
                         state_partitions=4).awaitTermination(300)
    from livepulse.operators.transitions import detect_transitions
    got = spark.read.schema(TRANSITIONS).parquet(tr)
    newest = b.agg(F.max("ingestion_ts")).first()[0]                 # polls of the last hour are still held
    exp = detect_transitions(b).where(F.col("event_ts") <= F.lit(newest) - F.expr("INTERVAL 1 HOUR"))
    assert got.count() == exp.count() > 0
    assert got.exceptAll(exp.select(*got.columns)).count() == 0

    gold_root, gold_ckpt = scratch_dir(spark, "test", "gold"), scratch_dir(spark, "test", "gold_ckpt")
    catalogue = spark.createDataFrame([], "ingestion_ts timestamp, game_id string, game_name string, "
                                          "igdb_id string, total_rating double, total_rating_count int, "
                                          "first_release_date timestamp, themes array<string>, "
                                          "keywords array<string>, platforms array<string>")
    jobs.gold_job(spark, silver, catalogue, gold_root, gold_ckpt, s.schema,
                  max_bytes_per_trigger=60_000).awaitTermination(300)
    g = jobs.read_gold(spark, gold_root)
    n_batches = spark.read.parquet(f"{gold_root}/fact_stream_hourly").select("batch_id").distinct().count()
    assert n_batches > 1  # size-capped micro-batches
    from livepulse.operators import gold
    one_shot = gold.fact_hourly(gold.clean_batch(s))
    cols = ["game_id", "streamer_id", "language_id", "date_id", "time_hour", "max_viewers", "sum_viewers",
            "count_observations"]
    assert g["fact_stream_hourly"].select(*cols).exceptAll(one_shot.select(*cols)).count() == 0
    assert g["fact_stream_hourly"].count() == one_shot.count()

    # a fresh checkpoint on the same root would count every row again
    with pytest.raises(ValueError, match="another query"):
        jobs.gold_job(spark, silver, catalogue, gold_root, scratch_dir(spark, "test", "fresh"), s.schema)
    # the same checkpoint goes on: nothing new, nothing twice
    jobs.gold_job(spark, silver, catalogue, gold_root, gold_ckpt, s.schema).awaitTermination(300)
    assert jobs.read_gold(spark, gold_root)["fact_stream_hourly"].agg(F.sum("count_observations")).first()[0] == \
        one_shot.agg(F.sum("count_observations")).first()[0]


def test_games_ingest_end_to_end(spark):
    """Nested catalogue records: broker-shaped frame → bronze games → silver games."""
    from livepulse.plans.q_bronze_silver import game_messages
    from livepulse.schemas import BRONZE_GAMES
    msgs, bronze, silver = (scratch_dir(spark, "test", x) for x in ("game_msgs", "bronze_games", "silver_games"))
    game_messages(spark, SF).select("value", "timestamp").limit(500).write.parquet(msgs)
    broker = spark.readStream.schema("value binary, timestamp timestamp").parquet(msgs)
    jobs.bronze_games_job(broker, bronze, scratch_dir(spark, "test", "ckpt"), trigger="available_now").awaitTermination(300)
    back = spark.read.schema(BRONZE_GAMES).parquet(bronze)
    assert back.count() == 500 and back.where("igdb_data.platforms[0].platform_type.name like 'Type%'").count() > 0
    jobs.silver_job(spark, "games", bronze, silver, scratch_dir(spark, "test", "ckpt"), trigger="available_now",
                    fmt="parquet").awaitTermination(300)
    assert spark.read.parquet(silver).where("size(platform_types) > 0").count() > 0


def test_package_reaches_python_workers(spark, tmp_path):
    """``ship_package`` registers a zip in the shared folder, and a bare Python process that has
    nothing else of the library on its path loads it by module name and runs the detector's function."""
    import subprocess
    import sys

    from livepulse.session import checkpoint_root, ship_package
    ship_package(spark)
    shipped = [f for f in spark.sparkContext.listFiles if f.endswith("livepulse.zip")]
    assert shipped
    archive = shipped[-1].removeprefix("file:")
    assert archive.startswith(checkpoint_root(spark).removeprefix("file://"))
    code = """
import sys, numpy as np
import livepulse.streaming.transitions as t
assert ".zip" in t.__file__, t.__file__
polls = t._arrays([0, 1, 2], ["a", "b", "b"], ["x", "x", "y"], [5, 7, None], ["u", "u", "u"])
found = t._events("s", polls, 10, None)
print(found[["event_type", "old_value", "new_value"]].values.tolist())
"""
    site = [p for p in sys.path if p and "repo" not in p]
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120,
                          env={"PYTHONPATH": ":".join([archive, *site]), "PATH": "/usr/bin:/bin"})
    assert done.stdout.strip() == "[['GAME_CHANGE', 'a', 'b'], ['TITLE_CHANGE', 'x', 'y']]", done.stderr[-2000:]
