"""Quality checks, gate, gated run order; compaction and its argument contract."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from livepulse.operators import maintenance as J
from livepulse.operators import quality as Q
from livepulse.session import scratch_dir


def test_duplicates_and_orphans(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (2,), (2,), (3,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    res = {r.metric: r for r in Q.run_checks("t", df, [Q.Duplicates(("k",)), Q.Orphans("k", dim)]).collect()}
    assert res["duplicate_count"].value == 2 and not res["duplicate_count"].passed
    assert res["orphans"].value == 2  # unknown key 3 and the null key


def test_one_pass_metrics(spark):
    df = spark.createDataFrame([(1, "GAME_CHANGE"), (-1, "OTHER"), (None, None)], "v int, e string")
    checks = [Q.row_count_positive(), Q.missing("v"), Q.min_at_least("v", 0), Q.max_at_most("v", 23),
              Q.invalid("e", ["GAME_CHANGE", "TITLE_CHANGE"]), Q.failed_rows("v < 0", "negative")]
    res = {r.check: (r.value, r.passed) for r in Q.run_checks("t", df, checks).collect()}
    assert res["row_count() > 0"] == (3.0, True)
    assert res["missing_count(v) = 0"] == (1.0, False)
    assert res["min(v) >= 0"] == (-1.0, False)
    assert res["max(v) <= 23"] == (1.0, True)
    assert res["invalid_count(e) = 0"] == (1.0, False)
    assert res["negative"] == (1.0, False)
    # all simple metrics of a table are one aggregate: a single scan, no shuffle
    plan = Q.run_checks("t", df, checks)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan or plan.count("Exchange") <= 1


def test_empty_table_fails_min(spark):
    df = spark.createDataFrame([], "v int")
    res = Q.run_checks("t", df, [Q.row_count_positive(), Q.min_at_least("v", 0)]).collect()
    assert not any(r.passed for r in res)


def test_gate_and_order(spark):
    ok = Q.run_checks("t", spark.createDataFrame([(1,)], "v int"), [Q.row_count_positive()])
    bad = Q.run_checks("t", spark.createDataFrame([], "v int"), [Q.row_count_positive()])
    calls = []
    with pytest.raises(Q.QualityError):
        Q.run_gated(lambda: bad, lambda: calls.append("load"), lambda: ok)
    assert calls == []
    report = Q.run_gated(lambda: ok, lambda: calls.append("load"), lambda: bad)
    assert calls == ["load"] and len(report) == 1


def test_maintenance_args():
    with pytest.raises(ValueError):
        J.maintenance_args("bronze", 2024)
    assert J.maintenance_args("bronze", 2024, 2, 3)["day"] == 3
    assert J.nightly_args(datetime(2024, 3, 1, 2))["month"] == 2


def _small_files(spark, files=20, rows=5000):
    path = scratch_dir(spark, "test", "compact")
    df = spark.range(0, rows).select(F.col("id"), (F.lit(2024)).alias("year"), (F.col("id") % 2 + 1).alias("month"),
                                     (F.col("id") % 3 + 1).alias("day"))
    df.repartition(files).write.partitionBy("year", "month", "day").parquet(path)
    return path


def _content(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).groupBy("month", "day").agg(F.count("*"), F.sum("id")).collect()))


DAYS = ("year", "month", "day")


def test_compaction_leaves_one_small_file_per_partition(spark):
    path = _small_files(spark)
    exp = _content(spark, path)
    J.compact(spark, path, partition_cols=DAYS, year=2024, month=1)
    files = {(r.month, r.day): r.files for r in J.files_per_partition(spark, path, DAYS).collect()}
    assert [files[1, d] for d in (1, 2, 3)] == [1, 1, 1] and all(files[2, d] == 20 for d in (1, 2, 3))
    J.compact(spark, path, partition_cols=DAYS)
    assert {r.files for r in J.files_per_partition(spark, path, DAYS).collect()} == {1}
    assert _content(spark, path) == exp


def test_compaction_of_one_day_with_small_target(spark):
    """A partition larger than the target gets several files, and only its own bytes count."""
    path = _small_files(spark, files=4, rows=30_000)
    exp = _content(spark, path)
    before = {(r.month, r.day): r.files for r in J.files_per_partition(spark, path, DAYS).collect()}
    size = {(r.month, r.day): r._bytes for r in J._file_bytes(spark.read.parquet(path), DAYS).collect()}
    J.compact(spark, path, partition_cols=DAYS, year=2024, month=2, day=3, target_file_bytes=size[2, 3] // 2)
    after = {(r.month, r.day): r.files for r in J.files_per_partition(spark, path, DAYS).collect()}
    assert 2 <= after.pop((2, 3)) <= 3
    assert all(before[k] == n for k, n in after.items()) and _content(spark, path) == exp


def _listing(spark, path):
    return {r.path.split(path)[1]: (r.length, r.modificationTime) for r in J.data_files(spark, path).collect()}


def test_compaction_leaves_large_files_and_its_own_alone(spark):
    path = scratch_dir(spark, "test", "compact")
    df = spark.range(0, 40_000).select("id", F.lit(2024).alias("year"), F.lit(1).alias("month"), (F.col("id") % 2 + 1).alias("day"))
    df.where("id < 36000").coalesce(1).write.partitionBy(*DAYS).parquet(path)            # one large file a day
    for k in range(4):
        df.where(f"id >= 36000 and id % 4 = {k}").coalesce(1).write.mode("append").partitionBy(*DAYS).parquet(path)
    before, exp = _listing(spark, path), _content(spark, path)
    large = {n: v for n, v in before.items() if v[0] > 30_000}
    assert len(large) == 2 and len(before) > 4
    assert J.compact(spark, path, partition_cols=DAYS, target_file_bytes=40_000) == len(before) - 2
    after = _listing(spark, path)
    assert {n: after[n] for n in large} == large and len(after) == 4
    assert _content(spark, path) == exp and sorted(r.id for r in spark.read.parquet(path).select("id").collect()) == list(range(40_000))
    assert J.compact(spark, path, partition_cols=DAYS, target_file_bytes=40_000) == 0     # a second run writes nothing
    assert _listing(spark, path) == after
    df.limit(10).write.mode("append").partitionBy(*DAYS).parquet(path)                    # new small files meet the remainder
    assert J.compact(spark, path, partition_cols=DAYS, target_file_bytes=40_000) > 0 and len(_listing(spark, path)) == 4


@pytest.mark.parametrize("dies", ["before the journal", "while moving", "while removing"])
def test_a_compaction_that_dies_is_cleared_or_finished(spark, monkeypatch, dies):
    path = _small_files(spark, files=5, rows=600)
    exp, before = _content(spark, path), _listing(spark, path)
    calls = []

    def dying(f, after):
        def run(*args):
            calls.append(args)
            if len(calls) > after:
                raise RuntimeError("killed")
            return f(*args)
        return run
    name, after = {"before the journal": ("write_small", 0), "while moving": ("move_file", 2), "while removing": ("drop_dir", 7)}[dies]
    monkeypatch.setattr(J, name, dying(getattr(J, name), after))
    with pytest.raises(RuntimeError, match="killed"):
        J.compact(spark, path, partition_cols=DAYS)
    monkeypatch.undo()
    if dies == "before the journal":
        assert _listing(spark, path) == before and _content(spark, path) == exp           # readers never notice
    assert J.finish_compactions(spark, path) == (dies != "before the journal")
    assert _content(spark, path) == exp
    J.compact(spark, path, partition_cols=DAYS)
    assert {r.files for r in J.files_per_partition(spark, path, DAYS).collect()} == {1} and _content(spark, path) == exp


def test_compaction_of_null_partitions_in_several_journals(spark):
    path = scratch_dir(spark, "test", "compact")
    df = spark.range(300).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("a b/"), F.col("id") % 3)).alias("kind"))
    df.repartition(6).write.partitionBy("kind").parquet(path)
    assert J.compact(spark, path, partition_cols=["kind"], files_at_once=6) == 18
    back = spark.read.parquet(path)
    assert sorted(map(str, back.select("id", "kind").collect())) == sorted(map(str, df.collect())) and len(back.inputFiles()) == 3


def test_compaction_refuses_a_stream_sink(spark):
    src, out, ckpt = (scratch_dir(spark, "test", x) for x in ("src", "out", "ckpt"))
    spark.range(10).write.parquet(src)
    stream = spark.readStream.schema("id long").parquet(src)
    stream.writeStream.format("parquet").option("checkpointLocation", ckpt).trigger(availableNow=True).start(out).awaitTermination()
    with pytest.raises(ValueError, match="sink of a stream"):
        J.compact(spark, out)
    assert spark.read.parquet(out).count() == 10


def test_compaction_of_an_unpartitioned_table_through_the_cli(spark):
    from livepulse import cli
    path = scratch_dir(spark, "test", "games")
    spark.range(100).withColumnRenamed("id", "game_id").repartition(10).write.parquet(path)
    assert cli.run(["compact", "--layer", "bronze", "--path", path, "--year", "2024", "--month", "1"], spark) == 0
    back = spark.read.parquet(path)
    assert back.count() == 100 and len(back.inputFiles()) == 1


def test_dimension_rules(spark):
    d = spark.createDataFrame([(1, "a", 50.0), (1, None, 101.0), (None, "b", -1.0)], "game_id long, game_name string, total_rating double")
    res = {r.check: r.value for r in Q.run_checks("dim_game", d, Q.dim_game_checks()).collect() if not r.passed}
    assert len(res) == 5
