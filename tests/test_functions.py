"""Edge cases of the column functions and small operators (FIXTURES.md §2)."""

from datetime import datetime

from pyspark.sql import functions as F

from livepulse.functions import (
    date_key, epoch_to_ts, normalise_tag, parse_list_text, resolve_thumbnail, strip_envelope, surrogate_key)
from livepulse.operators import catalogue as G
from livepulse.operators import semantic as H
from livepulse.operators import silver as C


def test_surrogate_key_pins(spark):
    r = spark.range(1).select(surrogate_key(F.lit("abc")).alias("a"),
                              surrogate_key(F.lit(None).cast("string")).alias("n")).first()
    assert r.a == 1423657621850124518 and r.n == 42


def test_date_key(spark):
    assert spark.range(1).select(date_key(F.lit(2026), F.lit(7), F.lit(9))).first()[0] == 20260709


def test_strip_envelope(spark):
    df = spark.createDataFrame([(bytes.fromhex("0000000001") + b"payload",), (bytes.fromhex("0000000001"),)],
                               "value binary")
    out = [bytes(r[0]) for r in df.select(strip_envelope("value")).collect()]
    assert out == [b"payload", b""]


def test_thumbnail_all_placeholders(spark):
    df = spark.createDataFrame([("a-{width}x{height}-{width}x{height}.jpg",)], "u string")
    assert df.select(resolve_thumbnail("u")).first()[0] == "a-1920x1080-1920x1080.jpg"


def test_tags_explode_and_normalise(spark):
    df = spark.createDataFrame(
        [("s1", datetime(2024, 1, 1), None), ("s2", datetime(2024, 1, 1), []),
         ("s3", datetime(2024, 1, 1), [" A ", "a", ""])],
        "stream_id string, ingestion_ts timestamp, tags array<string>")
    out = [r.tag_name for r in C.stream_tags(df).orderBy("tag_name").collect()]
    assert sorted(out) == ["", "a", "a"]
    assert spark.range(1).select(normalise_tag(F.lit("  MiXed "))).first()[0] == "mixed"


def test_epoch_to_ts(spark):
    df = spark.createDataFrame([(None,), (0,), (-86400,)], "e long")
    out = [r[0] for r in df.select(epoch_to_ts("e")).collect()]
    assert out == [None, datetime(1970, 1, 1), datetime(1969, 12, 31)]


def test_platform_families_keep_one_null(spark):
    from livepulse.schemas import BRONZE_GAMES
    meta = {"platforms": [{"name": "A", "platform_family": None, "platform_type": {"id": 1, "name": "t"}},
                          {"name": "B", "platform_family": None, "platform_type": {"id": 1, "name": "t"}},
                          {"name": "C", "platform_family": {"id": 2, "name": "f"}, "platform_type": None}]}
    df = spark.createDataFrame([(datetime(2024, 1, 1), "1", "g", "9", meta)], BRONZE_GAMES)
    r = C.silver_games(df).first()
    assert r.platforms == ["A", "B", "C"]
    assert r.platform_families == [None, "f"]
    assert r.platform_types == ["t", None]


def test_parse_list_text(spark):
    df = spark.createDataFrame([("['a', 'b']",), ("[]",), ("['it's']",), (" ['x']\n",)], "t string")
    out = [r[0] for r in df.select(parse_list_text("t")).collect()]
    assert out == [["a", "b"], [], None, ["x"]]


def test_release_periods_labels(spark):
    df = spark.createDataFrame([(datetime(y, 6, 1),) for y in (1999, 2000, 2004, 2005)] + [(None,)],
                               "first_release_date timestamp")
    out = [(r.period, r.games_released) for r in G.release_periods(df, 5).collect()]
    assert out == [("1995–1999", 1), ("2000–2004", 2), ("2005–2009", 1)]


def test_quadrant_median_counts_as_high(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 2), ("c", 3.0, 3)],
                               "game_name string, total_rating double, current_viewers long")
    q = {r.game_name: r.quadrant for r in G.quadrants(df).collect()}
    assert q == {"a": "Niche", "b": "Mainstream hit", "c": "Mainstream hit"}


def test_avg_viewers_zero_count_is_null(spark):
    df = spark.createDataFrame([("x", 0.0, 0)], "language string, sum_viewers double, count_observations long")
    assert H.by(df, ["language"], {"a": H.avg_viewers()}).first().a is None


def test_calendar_covers_whole_years(spark):
    df = spark.createDataFrame([(datetime(2023, 5, 2),), (datetime(2024, 1, 1),)], "t timestamp")
    cal = H.calendar(df, "t")
    assert cal.count() == 731
    first = cal.orderBy("Date").first()
    assert (first.Year, first.MonthNo, first.Month, first.QuarterNo, first.Quarter, first.Day) == \
        (2023, 1, "January", 1, "Qtr 1", 1)


def test_rating_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(i, float(i), 10) for i in range(0, 101)],
                               "game_id int, total_rating double, total_rating_count int")
    h = {r.bucket: r.games for r in G.rating_histogram(df, 30).collect()}
    assert max(h) == 30 and sum(h.values()) == 101
