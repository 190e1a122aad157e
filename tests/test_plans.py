"""Physical-plan properties that matter at scale."""

from livepulse.plans import profiles as P
from livepulse.plans.q_gold import s_clean
from livepulse.operators import broadcasts as Fq
from livepulse.operators import gold

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_partial_aggregation_and_pruned_scan(spark):
    p = plan(gold.fact_hourly(s_clean(spark, SF)))
    assert p.count("HashAggregate") >= 2          # partial (map side) + final
    import re
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", gold.fact_hourly(s_clean(spark, SF))
                         ._jdf.queryExecution().explainString(
                             spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    lineitem = [s for s in schemas if "l_quantity" in s][0]
    assert "l_extendedprice" not in lineitem and "l_comment" not in lineitem


def formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_latest_snapshot_filters_the_raw_scan(spark):
    """The poll's bound is a scalar subquery on the raw time column, below the joins."""
    from livepulse.plans.q_broadcasts import latest
    p = formatted(latest(spark, SF))
    scan = next(x for x in p.split("\n\n") if "Scan parquet" in x and "props" in x)
    assert "ReadSchema" in scan and "ts >= " in p.replace("#", "").replace("cast(", "") or "Subquery" in p
    flat = plan(latest(spark, SF))
    join_at, filter_at = flat.index("Join"), flat.index("scalar-subquery" if "scalar-subquery" in flat else "Subquery")
    assert join_at < filter_at                                    # deeper in the tree: under the join


def test_latest_snapshot_prunes_partitions(spark):
    from livepulse.session import scratch_dir
    path = scratch_dir(spark, "test", "days")
    P.e_bronze(spark, SF).write.partitionBy("year", "month", "day").parquet(path)
    t = spark.read.parquet(path)
    p = formatted(Fq.latest_snapshot(t, grain="day"))
    import re
    filters = re.findall(r"PartitionFilters: \[([^\n]*)\]", p)
    assert any("day" in f and "ubquery" in f for f in filters)
    assert Fq.latest_snapshot(t, grain="day").count() == Fq.latest_snapshot(P.e_bronze(spark, SF), grain="day").count()


def test_kpis_of_nothing_are_zero(spark):
    s = P.e_silver(spark, SF).where("false")
    r = Fq.stream_kpis(s, s).first()
    assert tuple(r) == (0, 0, 0, 0.0)


def test_fact_is_read_once(spark):
    """BI queries read lineitem once for the fact, and once more only where the catalogue
    (made of lineitem too) is part of the question; the star's fact is written first."""
    import __spark_entry__ as entry
    q = entry.queries()
    assert _scans(q["star_join"](spark, SF), "lineitem") <= 1
    assert _scans(q["calendar_rollup"](spark, SF), "lineitem") == 0
    assert _scans(q["viewers_on_day"](spark, SF), "lineitem") == 1
    for name in ("bi_by_theme", "bi_by_keyword", "bi_hours_by_platform", "bi_hours_by_theme", "slicer_theme"):
        assert _scans(q[name](spark, SF), "lineitem") == 2


def test_partition_filters(spark):
    import __spark_entry__ as entry
    df = entry.queries()["partition_pruned_scan"](spark, SF)
    s = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in s or "PartitionFilters" in s


def _scans(df, name):
    import re
    return len(re.findall(rf"FileScan parquet [^\n]*/{name}\.parquet", plan(df)))


def test_rolling_mean_reads_its_input_twice(spark):
    """The bucket tails and the main window each read the input once: no join or
    union over all rows re-evaluates it."""
    rm = Fq.with_rolling_mean(P.e_silver(spark, SF))
    assert _scans(rm, "events") == 2
    assert "Union" in plan(rm)                      # ghost rows in front of their bucket


def test_referential_and_column_checks_share_one_pass(spark):
    from livepulse.operators import quality as Q
    clean = s_clean(spark, SF)
    fact = gold.fact_hourly(clean)
    dims = {"dim_streamer": gold.dim_streamer(clean), "dim_language": gold.dim_language(clean)}
    checks = [Q.row_count_positive(), Q.missing("max_viewers"),
              Q.Orphans("streamer_id", dims["dim_streamer"]), Q.Orphans("language_id", dims["dim_language"])]
    res = Q.run_checks("fact", fact, checks)
    # one read for the fact, one for each of the two dimensions
    assert _scans(res, "lineitem") == 3
    got = {r["check"]: r["passed"] for r in res.collect()}
    assert len(got) == 4 and all(got.values())


def test_quadrants_read_the_snapshots_once(spark):
    """The per-game rows are materialized (reliable checkpoint) for the median and
    label reads, so the final plan scans no input file."""
    import __spark_entry__ as entry
    q = entry.queries()["quadrants"](spark, SF)
    assert _scans(q, "lineitem") == 0


def test_building_a_query_runs_no_job(spark):
    """Tables are read with given schemas: nothing runs before the first action."""
    from livepulse.plans.registry import QUERIES, load_all
    load_all()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        for name in ("time_bounds", "clean_batch", "bi_viewers_by_game", "bronze_streams", "fact_hourly", "latest_games"):
            QUERIES[name](spark, SF)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
