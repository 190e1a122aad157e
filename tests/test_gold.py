"""Gold layer: cleaning, dimensions, fact, merge reads, idempotent micro-batches."""

from datetime import datetime

from pyspark.sql import functions as F

from livepulse.operators import gold
from livepulse.session import scratch_dir
from livepulse.streaming import jobs


def test_clean_batch(spark):
    df = spark.createDataFrame([(None, "u", "l"), ("", "u", "l"), ("  ", "u", "l"), (" x ", None, None),
                                ("y", "", "l")], "game_name string, user_name string, language string")
    out = sorted((r.game_name, r.user_name, r.language) for r in gold.clean_batch(df).collect())
    assert out == [(" x ", "Unknown", "Unknown"), ("y", "", "l")]


def test_dim_game_one_row_per_name(spark):
    clean = spark.createDataFrame([("g",)], "game_name string")
    cat = spark.createDataFrame(
        [(datetime(2024, 1, 1), "1", "g", "i1", 50.0, 3, None, ["a"], ["k"], ["p"]),
         (datetime(2024, 1, 2), "2", "g", "i2", 70.0, 4, None, ["b"], ["k"], ["p"])],
        "ingestion_ts timestamp, game_id string, game_name string, igdb_id string, total_rating double, "
        "total_rating_count int, first_release_date timestamp, themes array<string>, keywords array<string>, "
        "platforms array<string>")
    rows = gold.dim_game(clean, cat).collect()
    assert len(rows) == 1 and rows[0].igdb_id == "i2" and rows[0].total_rating == 70.0


def test_date_dim_key(spark):
    df = spark.createDataFrame([(2026, 7, 9), (2026, 7, 9)], "year int, month int, day int")
    assert [r.date_id for r in gold.dim_date(df).collect()] == [20260709]


def test_merge_fact(spark):
    df = spark.createDataFrame([(1, 1, 1, 1, 1, 5, 8.0, 2), (1, 1, 1, 1, 1, 4, 4.0, 1)],
                               "game_id long, streamer_id long, language_id long, date_id long, time_hour int, "
                               "max_viewers long, sum_viewers double, count_observations long")
    r = gold.merge_fact(df).first()
    assert (r.max_viewers, r.sum_viewers, r.count_observations) == (5, 12.0, 3)


def test_latest_by_version_tie(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c")], "k int, v int, x string")
    rows = gold.latest_by_version(df, ["k"], "v", ["x"]).collect()
    assert [(r.k, r.x) for r in rows] == [(1, "b")]


def test_fact_counts_non_null_viewers(spark):
    df = spark.createDataFrame(
        [("g", "u", "l", 2024, 1, 1, 3, 10), ("g", "u", "l", 2024, 1, 1, 3, None)],
        "game_name string, user_name string, language string, year int, month int, day int, "
        "ingestion_hour int, viewer_count int")
    r = gold.fact_hourly(df).first()
    assert (r.max_viewers, r.sum_viewers, r.count_observations, r.date_id, r.time_hour) == \
        (10, 10.0, 1, 20240101, 3)


def test_gold_batch_replay_is_idempotent(spark):
    batch = spark.createDataFrame(
        [("g", "u", "l", 2024, 1, 1, 3, 10, datetime(2024, 1, 1, 3))],
        "game_name string, user_name string, language string, year int, month int, day int, "
        "ingestion_hour int, viewer_count int, ingestion_ts timestamp")
    cat = spark.createDataFrame([], "ingestion_ts timestamp, game_id string, game_name string, igdb_id string, "
                                    "total_rating double, total_rating_count int, first_release_date timestamp, "
                                    "themes array<string>, keywords array<string>, platforms array<string>")
    root = scratch_dir(spark, "test", "gold")
    ckpt = scratch_dir(spark, "test", "gold_ckpt")
    spark.createDataFrame([('{"id":"q1"}',)], "value string").write.text(f"{ckpt}/metadata")
    write = jobs.gold_batch_writer(cat, root, ckpt)
    write(batch, 0)
    write(batch, 1)
    write(batch, 1)          # replay of batch 1 after a failure
    g = jobs.read_gold(spark, root)
    f = g["fact_stream_hourly"].first()
    assert (f.max_viewers, f.sum_viewers, f.count_observations) == (10, 20.0, 2)
    assert g["dim_streamer"].count() == 1
    assert g["dim_streamer"].first().inserted_at == 1
    assert spark.read.parquet(f"{root}/fact_stream_hourly").select(F.countDistinct("batch_id")).first()[0] == 2


def _catalogue_tables(spark):
    """Order lines, orders and parts of two names, one of them with two versions of the newest day."""
    root = scratch_dir(spark, "test", "catalogue")
    day = [datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = {"lineitem": ("l_orderkey long, l_partkey long, l_linenumber int", [(1, 1, 1), (2, 8, 1), (2, 1, 2), (3, 2, 1), (3, 7, 3), (9, 2, 1)]),
            "orders": ("o_orderkey long, o_orderdate timestamp_ntz", [(k + 1, d) for k, d in enumerate(day)]),
            "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int",
                     [(1, "red car", "B1", "T1", 4), (8, "red car", "B2", None, 5), (2, "blue", "B1", "T2", 1), (7, "blue", "B3", "T3", 3)])}
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def test_latest_games_are_those_of_the_flattened_catalogue(spark):
    """The versions are compared before their records are made: the same rows, and nothing nested in the aggregate."""
    from livepulse.plans import profiles as P
    root = _catalogue_tables(spark)
    got = P.s_latest_games(spark, root)
    want = gold.dedupe_catalogue(P.s_games(spark, root), order=P.CATALOGUE_ORDER).select(*got.columns)
    key = lambda r: r.game_name
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    assert [(r.game_name, r.game_id) for r in sorted(got.collect(), key=key)] == [("blue", "7"), ("red car", "1")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "themes" not in plan[plan.index("Aggregate"):]


def test_staged_files_are_dealt_anew_only_when_few(spark):
    from livepulse.plans.q_streaming import _stage_files
    from livepulse.session import list_dir
    for parts, least in ((7, 3), (1, 3)):
        path, files = _stage_files(spark.range(0, 1000, 1, parts), spark, "test", least)
        assert files == (parts if parts >= least else least)
        assert len([n for n in list_dir(spark, path) if n.startswith("part-")]) == files
        assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(1000))
