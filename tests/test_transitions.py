"""Change detection: batch operator, streaming operator, and their agreement."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from livepulse.operators.sequence import previous_row, rolling_mean_rows
from livepulse.operators.transitions import detect_transitions
from livepulse.session import scratch_dir
from livepulse.streaming.transitions import detect_transitions_stream, dropped_rows

SCHEMA = "stream_id string, user_name string, game_name string, title string, viewer_count long, ingestion_ts timestamp"
T0 = datetime(2024, 1, 1)


def rows(*specs, sid="s"):
    return [(sid, "u", g, t, v, T0 + timedelta(hours=h)) for h, g, t, v in specs]


def events(spark, data, **kw):
    df = spark.createDataFrame(data, SCHEMA)
    return [(r.event_type, r.old_value, r.new_value, r.viewer_delta)
            for r in detect_transitions(df, **kw).orderBy("event_ts", "event_type").collect()]


def test_first_same_game_title_both(spark):
    data = rows((0, "g1", "t1", 10), (1, "g1", "t1", 12), (2, "g2", "t1", 15), (3, "g2", "t2", 11),
                (4, "g3", "t3", 20))
    assert events(spark, data) == [
        ("GAME_CHANGE", "g1", "g2", 3), ("TITLE_CHANGE", "t1", "t2", -4),
        ("GAME_CHANGE", "g2", "g3", 9), ("TITLE_CHANGE", "t2", "t3", 9)]


def test_null_safe_comparison(spark):
    data = rows((0, None, "t", 1), (1, None, "t", 1), (2, "x", "t", 1), (3, "", "t", 1), (4, "y", "t", 1))
    ev = events(spark, data)
    assert ev == [("GAME_CHANGE", None, "x", 0), ("GAME_CHANGE", "x", "", 0), ("GAME_CHANGE", "", "y", 0)]
    assert events(spark, data, null_text="None")[0][1] == "None"


def test_idle_gap(spark):
    data = rows((0, "a", "t", 1), (11, "b", "t", 1), (24, "c", "t", 1))
    assert [e[2] for e in events(spark, data)] == ["b"]


def test_bucket_boundaries_match_plain_window(spark):
    """Tiny buckets force most previous rows to come from the per-bucket carry."""
    import random
    rnd = random.Random(7)
    data = []
    for sid in ("a", "b", "c"):
        h = 0.0
        for _ in range(60):
            h += rnd.choice([0.1, 0.5, 2, 5, 30])
            data.append((sid, "u", rnd.choice(["g1", "g2", None]), rnd.choice(["t1", "t2"]), rnd.randint(0, 50),
                         T0 + timedelta(hours=h)))
    df = spark.createDataFrame(data, SCHEMA)
    small = detect_transitions(df, bucket_seconds=3600)
    big = detect_transitions(df, bucket_seconds=10 ** 9)
    key = lambda t: tuple(str(x) for x in t)
    assert sorted(map(tuple, small.collect()), key=key) == sorted(map(tuple, big.collect()), key=key)
    p = previous_row(df, "stream_id", "ingestion_ts", ["viewer_count"], bucket_seconds=1800)
    from pyspark.sql import Window
    w = Window.partitionBy("stream_id").orderBy("ingestion_ts")
    ref = df.withColumn("r", F.lag("viewer_count").over(w))
    got = {(r.stream_id, r.ingestion_ts): r.prev_viewer_count for r in p.collect()}
    exp = {(r.stream_id, r.ingestion_ts): r.r for r in ref.collect()}
    assert got == exp
    rm = rolling_mean_rows(df, "stream_id", "ingestion_ts", "viewer_count", 10, bucket_seconds=3600)
    ref_rm = df.withColumn("rolling_mean", F.avg("viewer_count").over(w.rowsBetween(-9, 0)))
    a = {(r.stream_id, r.ingestion_ts): round(r.rolling_mean, 9) for r in rm.collect()}
    b = {(r.stream_id, r.ingestion_ts): round(r.rolling_mean, 9) for r in ref_rm.collect()}
    assert a == b


def _run_stream(spark, batches, close=True, **kw):
    """One file and one run per batch; ``close``: a last row of another stream moves the watermark on."""
    from livepulse.schemas import TRANSITIONS
    src = scratch_dir(spark, "test", "src")
    out, ckpt = scratch_dir(spark, "test", "out"), scratch_dir(spark, "test", "ckpt")
    dropped = 0
    if close:
        batches = [*batches, [("closing", "u", "g", "t", 0, T0 + timedelta(days=400))]]
    for b in batches:
        df = spark.createDataFrame(b, SCHEMA)
        df.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(df.schema).parquet(src)
        q = (detect_transitions_stream(stream, **kw).writeStream.format("parquet")
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
        assert q.awaitTermination(300)
        dropped += dropped_rows(q)
    results = spark.read.schema(TRANSITIONS).parquet(out)
    found = [(r.event_type, r.old_value, r.new_value, r.viewer_delta, r.event_ts) for r in results.collect()]
    return sorted(found, key=lambda r: (r[4], r[0])), dropped


def as_rows(events):
    return sorted(((e.event_type, e.old_value, e.new_value, e.viewer_delta, e.event_ts) for e in events.collect()),
                  key=lambda r: (r[4], r[0]))


def test_stream_equals_batch_in_any_order(spark):
    b1 = rows((2, "g2", "t1", 5), (0, "g1", "t1", 1), (1, "g1", "t2", 3))      # out of order in a batch
    b2 = rows((3, "g3", "t2", 9), (0.5, "gX", "tX", 0))                        # an old poll in a later batch
    df = spark.createDataFrame(b1 + b2, SCHEMA)
    exp = as_rows(detect_transitions(df))
    for batches in ([b1, b2], [b2, b1], [b2[:1], b1, b2[1:]]):
        got, dropped = _run_stream(spark, batches, watermark="4 hours")
        assert got == exp and dropped == 0


def test_late_rows_are_dropped_and_counted(spark):
    """A file 13 h late and one inside the lateness: the first is counted, the second takes part."""
    on_time = [rows((0, "a", "t", 1)), rows((20, "b", "t", 2))]
    inside, late = rows((19.5, "c", "t", 3)), rows((7, "z", "t", 9))
    got, dropped = _run_stream(spark, [*on_time, inside, late], watermark="1 hour")
    exp = as_rows(detect_transitions(spark.createDataFrame([r for b in (*on_time, inside) for r in b], SCHEMA)))
    assert got == exp
    assert dropped == 1


def test_weekly_files_out_of_order_survive(spark):
    """Files in the order 0, 2, 1, 3: the state's timers never lie behind the watermark."""
    weeks = [rows(*[(24 * 7 * w + h, f"g{(w + h) % 3}", "t", h) for h in range(0, 40, 10)]) for w in range(4)]
    got, dropped = _run_stream(spark, [weeks[k] for k in (0, 2, 1, 3)], watermark="1 hour")
    assert dropped == len(weeks[1])                                       # two weeks late: more than the lateness
    got, dropped = _run_stream(spark, [weeks[k] for k in (0, 2, 1, 3)], watermark="40 days")
    exp = as_rows(detect_transitions(spark.createDataFrame([r for w in weeks for r in w], SCHEMA)))
    assert dropped == 0 and got == exp and exp


def test_nulls_compare_and_are_kept(spark):
    got, _ = _run_stream(spark, [rows((0, None, "t", None), (1, "b", "t", 4), (2, None, "t", 5))], watermark="1 hour")
    assert [g[1:4] for g in sorted(got, key=lambda g: g[4])] == [(None, "b", None), ("b", None, 1)]
    text, _ = _run_stream(spark, [rows((0, None, "t", 1), (1, "b", "t", 4))], watermark="1 hour", null_text="None")
    assert [(g[1], g[2]) for g in text] == [("None", "b")]


def test_stream_idle_gap_on_arrival(spark):
    got, _ = _run_stream(spark, [rows((0, "a", "t", 1)), rows((13, "b", "t", 1)), rows((14, "c", "t", 1))])
    assert [(g[1], g[2]) for g in got] == [("b", "c")]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_batch_equals_stream_on_driver_data(spark, sf):
    import __spark_entry__ as entry
    qs = entry.queries()
    key = lambda t: tuple(str(x) for x in t)
    a = sorted(map(tuple, qs["transitions"](spark, sf).collect()), key=key)
    b = sorted(map(tuple, qs["transitions_stream"](spark, sf).collect()), key=key)
    assert a == b and len(a) > 0


def test_rolling_mean_nulls_and_sparse_buckets(spark):
    """Null values are skipped (mean of the non-null ones, null when none); the
    preceding rows of a bucket may come from many earlier one-row buckets."""
    from pyspark.sql import Window
    rnd = random.Random(11)
    data = []
    for sid in ("a", "b"):
        h = 0.0
        for _ in range(80):
            h += rnd.choice([0.2, 1, 3, 26])
            data.append((sid, "u", "g", "t", rnd.choice([None, None, 1, 7, 40]), T0 + timedelta(hours=h)))
    df = spark.createDataFrame(data, SCHEMA)
    w = Window.partitionBy("stream_id").orderBy("ingestion_ts")
    for rows in (1, 3, 10):
        got = rolling_mean_rows(df, "stream_id", "ingestion_ts", "viewer_count", rows, bucket_seconds=3600)
        ref = df.withColumn("rolling_mean", F.avg("viewer_count").over(w.rowsBetween(-(rows - 1), 0)))
        as_map = lambda d: {(r.stream_id, r.ingestion_ts): (None if r.rolling_mean is None
                                                            else round(r.rolling_mean, 9)) for r in d.collect()}
        assert got.columns == df.columns + ["rolling_mean"]
        assert as_map(got) == as_map(ref)


def test_state_holds_the_polls_of_one_watermark_delay(spark):
    """Three days of polls a minute apart in three batches: what waits in the state afterwards are the polls
    of the last hour, and each stream has one previous poll."""
    src, out, ckpt = (scratch_dir(spark, "test", x) for x in ("src", "out", "ckpt"))
    for day in range(3):
        polls = [(sid, "u", f"g{m % 7}", "t", m, T0 + timedelta(days=day, minutes=m)) for sid in ("a", "b") for m in range(0, 1440, 5)]
        spark.createDataFrame(polls, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(spark.createDataFrame([], SCHEMA).schema).parquet(src)
        q = (detect_transitions_stream(stream, watermark="1 hour").writeStream.format("parquet")
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
        assert q.awaitTermination(300)
    read = lambda name: spark.read.format("statestore").option("stateVarName", name).load(ckpt)
    waiting = read("waiting").collect()
    assert len(waiting) <= 2 * (12 + 1) and {r.key.stream_id for r in waiting} == {"a", "b"}     # twelve polls an hour and stream
    assert read("last").count() == 2


def test_polls_of_a_micro_batch_are_one_state_element(spark):
    """120 polls of a stream in one micro-batch wait as one element of its list, with every poll in it."""
    src, out, ckpt = (scratch_dir(spark, "test", x) for x in ("src", "out", "ckpt"))
    polls = [(sid, "u", None, "t", None if m % 2 else m, T0 + timedelta(minutes=m)) for sid in ("a", "b") for m in range(120)]
    df = spark.createDataFrame(polls, SCHEMA)
    df.coalesce(1).write.parquet(src)
    q = (detect_transitions_stream(spark.readStream.schema(df.schema).parquet(src), watermark="1 day").writeStream.format("parquet")
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
    assert q.awaitTermination(300)
    waiting = spark.read.format("statestore").option("stateVarName", "waiting").load(ckpt).collect()
    assert sorted(r.key.stream_id for r in waiting) == ["a", "b"]
    for r in waiting:
        pack = r.list_element
        assert len(pack.us) == len(pack.game) == len(pack.viewers) == 120
        assert sorted(v for v in pack.viewers if v is not None) == list(range(0, 120, 2))
