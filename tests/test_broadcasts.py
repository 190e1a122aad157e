"""Snapshot selection, rolling means, KPIs (FIXTURES.md §2 F cases)."""

from datetime import datetime, timedelta

from livepulse.operators import broadcasts as Fq

T0 = datetime(2024, 1, 1)
SCHEMA = "stream_id string, user_name string, game_name string, viewer_count long, ingestion_ts timestamp"


def snaps(spark):
    data = [(f"s{i}", f"u{i}", "g", i, T0 + timedelta(hours=h)) for h in (0, 2, 4) for i in range(3)]
    return spark.createDataFrame(data, SCHEMA)


def test_latest_snapshot(spark):
    out = Fq.latest_snapshot(snaps(spark)).collect()
    assert {r.ingestion_ts for r in out} == {T0 + timedelta(hours=4)} and len(out) == 3


def test_snapshot_asof(spark):
    df = snaps(spark)
    ts = lambda at: {r.ingestion_ts for r in Fq.snapshot_asof(df, at).collect()}
    assert ts(T0 - timedelta(hours=1)) == {T0}
    assert ts(T0 + timedelta(hours=3)) == {T0 + timedelta(hours=2)}
    assert ts(T0 + timedelta(days=3)) == {T0 + timedelta(hours=4)}


def test_snapshot_grain(spark):
    data = [("a", "u", "g", 1, T0 + timedelta(minutes=1)), ("b", "u", "g", 1, T0 + timedelta(minutes=1, seconds=7))]
    df = spark.createDataFrame(data, SCHEMA)
    assert Fq.latest_snapshot(df).count() == 1
    assert Fq.latest_snapshot(df, grain="minute").count() == 2


def test_rolling_mean(spark):
    data = [("s", "u", "g", v, T0 + timedelta(minutes=v)) for v in range(1, 13)] + [("t", "u", "g", 7, T0)]
    out = {(r.stream_id, r.viewer_count): r.avg_viewers_10
           for r in Fq.with_rolling_mean(spark.createDataFrame(data, SCHEMA)).collect()}
    assert out[("t", 7)] == 7
    assert out[("s", 12)] == round(sum(range(3, 13)) / 10)
    assert out[("s", 1)] == 1 and out[("s", 2)] == 2  # 1.5 rounds half up


def test_top_streamers_peak_row(spark):
    data = [("s", "u", "g", v, T0 + timedelta(minutes=i)) for i, v in enumerate([5, 50, 10])]
    df = spark.createDataFrame(data, SCHEMA)
    r = Fq.top_streamers(df, Fq.latest_snapshot(df), 5).first()
    assert (r.latest_viewer_count, r.peak_viewers, r.avg_viewers_10) == (50, 50, 28)
    r2 = Fq.top_streamers(df, Fq.latest_snapshot(df), 5, mode="latest").first()
    assert r2.latest_viewer_count == 10


def test_kpis_count_null_as_value(spark):
    data = [("a", None, "g", 1, T0), ("b", "x", "g", 3, T0), ("b", "x", "g", 4, T0)]
    df = spark.createDataFrame(data, SCHEMA)
    r = Fq.stream_kpis(df, df).first()
    assert (r.unique_streams, r.unique_streamers, r.current_viewers, r.median_viewers) == (2, 2, 8, 3.0)
