"""Commit records, merge reads without a shuffle, folding, and rules measured during the write."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from livepulse import cli
from livepulse.operators import gold
from livepulse.operators import quality as Q
from livepulse.session import list_dir, read_small, scratch_dir, write_small
from livepulse.sources.committed import CommittedTables
from livepulse.streaming import jobs

BATCH = ("game_name string, user_name string, language string, year int, month int, day int, "
         "ingestion_hour int, viewer_count int, ingestion_ts timestamp")
CATALOGUE = ("ingestion_ts timestamp, game_id string, game_name string, igdb_id string, total_rating double, "
             "total_rating_count int, first_release_date timestamp, themes array<string>, keywords array<string>, "
             "platforms array<string>")


def batch_of(spark, seed, n=40):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["g1", "g2", "g3", None, " "]), rnd.choice(["u1", "u2", None]), rnd.choice(["l1", "l2"]), 2024, 1,
             rnd.randint(1, 3), rnd.randint(0, 3), rnd.randint(0, 90), datetime(2024, 1, 1, rnd.randint(0, 3))) for _ in range(n)]
    return spark.createDataFrame(rows, BATCH)


@pytest.fixture()
def root(spark):
    return scratch_dir(spark, "test", "gold")


@pytest.fixture()
def writer(spark, root):
    def make(query="q1", **options):
        ckpt = scratch_dir(spark, "test", "ckpt")
        write_small(spark, f"{ckpt}/metadata", f'{{"id":"{query}"}}')
        cat = spark.createDataFrame([(datetime(2024, 1, 1), "1", "g1", "i1", 50.0, 3, None, ["a"], ["k"], ["p"])], CATALOGUE)
        return jobs.gold_batch_writer(cat, root, ckpt, **options)
    return make


def content(spark, root):
    return {n: sorted(map(str, df.collect())) for n, df in jobs.read_gold(spark, root).items()}


FACT = ["game_id", "streamer_id", "language_id", "date_id", "time_hour", "max_viewers", "sum_viewers", "count_observations"]


def test_a_batch_is_seen_whole_or_not_at_all(spark, root, writer, monkeypatch):
    write = writer(parallel_writes=1)
    write(batch_of(spark, 1), 0)
    before = content(spark, root)

    put = CommittedTables.write
    for dies_at in ("dim_streamer", "dim_date"):                  # behind the fact, and behind three dimensions
        def dying(self, table, *args, **kw):
            if table == dies_at:
                raise RuntimeError("killed")
            return put(self, table, *args, **kw)
        monkeypatch.setattr(CommittedTables, "write", dying)
        with pytest.raises(RuntimeError, match="killed"):
            write(batch_of(spark, 2), 1)
        monkeypatch.setattr(CommittedTables, "write", put)
        assert spark.read.parquet(f"{root}/fact_stream_hourly").select("batch_id").distinct().count() == 2   # rows are there
        assert content(spark, root) == before                     # and nobody reads them
    write(batch_of(spark, 2), 1)                                  # the replay
    both = batch_of(spark, 1).unionByName(batch_of(spark, 2))
    want = gold.fact_hourly(gold.clean_batch(both))
    got = jobs.read_gold(spark, root)["fact_stream_hourly"]
    assert sorted(map(str, got.select(*FACT).collect())) == sorted(map(str, want.select(*FACT).collect()))
    after = content(spark, root)
    write(batch_of(spark, 3), 1)                                  # committed already: nothing is written again
    assert content(spark, root) == after
    assert jobs.gold_tables(spark, root).vacuum() == 2 * 4        # what the two dead writers left: a fact and three dimensions each
    assert content(spark, root) == after


def test_merge_reads_have_no_shuffle(spark, root, writer):
    write = writer(buckets=5)
    for i in range(3):
        write(batch_of(spark, i), i)
    for name, df in jobs.read_gold(spark, root).items():
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString(), name
    one_shot = gold.fact_hourly(gold.clean_batch(batch_of(spark, 0).unionByName(batch_of(spark, 1)).unionByName(batch_of(spark, 2))))
    assert jobs.read_gold(spark, root)["fact_stream_hourly"].select(*FACT).exceptAll(one_shot.select(*FACT)).count() == 0


def test_folding_changes_files_and_not_rows(spark, root, writer):
    write = writer(buckets=4)
    write(batch_of(spark, 0), 0)
    assert not jobs.fold_gold(spark, root)                        # one batch is one generation
    for i in (1, 2):
        write(batch_of(spark, i), i)
    before = content(spark, root)
    old = jobs.read_gold(spark, root)                             # a reader of the state before
    assert jobs.fold_gold(spark, root) and not jobs.fold_gold(spark, root)
    assert content(spark, root) == before
    assert {n: sorted(map(str, df.collect())) for n, df in old.items()} == before
    state = jobs.gold_tables(spark, root).state()
    assert state.generation == 1 and state.through == {"q1": 2} and all(len(f) == 1 for f in state.folders.values())
    for name, df in jobs.read_gold(spark, root).items():
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString(), name
    write(batch_of(spark, 2), 2)                                  # a replay of a folded batch is one of a committed batch
    assert content(spark, root) == before
    write(batch_of(spark, 7), 3)
    assert cli.run(["fold", "--gold-root", root, "--vacuum"], spark) == 0
    rows = [batch_of(spark, i) for i in (0, 1, 2, 7)]
    want = gold.fact_hourly(gold.clean_batch(rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])))
    got = jobs.read_gold(spark, root)["fact_stream_hourly"]
    assert sorted(map(str, got.select(*FACT).collect())) == sorted(map(str, want.select(*FACT).collect()))
    assert jobs.read_gold(spark, root)["dim_streamer"].agg(F.max("inserted_at")).first()[0] == 3
    assert list_dir(spark, f"{root}/_commits") == ["fold-0000000002.json", "layout.json"]
    assert len(list_dir(spark, f"{root}/_generations")) == 1 and not list_dir(spark, f"{root}/fact_stream_hourly/query_id=q1")
    # a fold that died before its record changes nothing
    write(batch_of(spark, 8), 4)
    before = content(spark, root)
    tables = jobs.gold_tables(spark, root)

    def dying(df):
        raise RuntimeError("killed")
    with pytest.raises(RuntimeError):
        tables.fold({**jobs.GOLD_MERGES, "fact_stream_hourly": dying})
    assert content(spark, root) == before and tables.state().generation == 2


def test_a_root_without_batches_and_with_other_columns(spark, root, writer):
    with pytest.raises(ValueError, match="no committed batch"):
        jobs.read_gold(spark, root)
    tables = CommittedTables(spark, root, {"t": ["k"]}, buckets=2)
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "k int, v string")
    tables.begin({"t": df.schema})
    assert tables.read("t").count() == 0 and tables.state().queries() == set()
    tables.commit("q", 0, {"t": tables.write("t", df, "q", 0)})
    assert sorted(tables.read("t").collect(), key=str) == sorted(df.collect(), key=str)       # null keys have a bucket
    with pytest.raises(ValueError, match="columns"):
        tables.begin({"t": df.withColumn("x", F.lit(1)).schema})
    with pytest.raises(FileExistsError):
        tables.commit("q", 0, {})
    assert read_small(spark, f"{root}/_commits/layout.json").startswith('{"buckets": 2')


def test_rules_measured_during_the_write_equal_a_scan(spark):
    df = spark.createDataFrame([(1, "GAME_CHANGE"), (-1, "OTHER"), (None, None), (40, "TITLE_CHANGE")], "v int, e string")
    checks = [Q.row_count_positive(), Q.missing("v"), Q.min_at_least("v", 0), Q.max_at_most("v", 23), Q.invalid("e", ["GAME_CHANGE"]),
              Q.failed_rows("v < 0", "negative"), Q.Duplicates(("v",))]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b
    watch, results = Q.watch_checks("t", checks)
    watch(df.mapInPandas(counted, df.schema)).write.parquet(scratch_dir(spark, "test", "watched"))
    assert read.value == 4                                        # one pass wrote the rows and measured them
    got = {r["check"]: (r["table"], r["metric"], r["column"], r["value"], r["passed"]) for r in results()}
    want = {r.check: (r.table, r.metric, r.column, r.value, r.passed) for r in Q.run_checks("t", df, checks).collect()}
    assert got == {k: v for k, v in want.items() if v[1] != "duplicate_count"}
    watch, results = Q.watch_checks("t", checks)
    watch(df.limit(0)).write.parquet(scratch_dir(spark, "test", "watched"))
    assert {r["check"] for r in results() if not r["passed"]} == {"row_count() > 0"}


def test_the_gate_stops_a_batch_before_its_commit(spark, root, writer):
    write = writer(gate=True)
    write(batch_of(spark, 1), 0)
    before = content(spark, root)
    bad = batch_of(spark, 2).withColumn("ingestion_hour", F.lit(30))
    with pytest.raises(Q.QualityError, match="time_hour not above 23"):
        write(bad, 1)
    assert content(spark, root) == before
    writer()(bad, 1)                                              # without the gate it is committed, with its report
    failed = jobs.gold_tables(spark, root).report("q1", 1)
    assert [(r["table"], r["check"], r["value"]) for r in failed] == [("fact_stream_hourly", "time_hour not above 23", 30.0)]
    blank = batch_of(spark, 3).withColumn("game_name", F.lit(" "))
    writer(gate=True)(blank, 2)                                   # a batch without a clean row has nothing that fails
    assert jobs.gold_tables(spark, root).state().holds("q1", 2)
