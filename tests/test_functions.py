"""Column functions."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from playspan import fixed
from playspan.functions import calendar, keys, labels, numbers


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def test_rounding_at_ties(spark):
    values = [1.005, 2.675, -1.005, 0.125, 1.115, 33.335, 1e9 + 0.005, 0.285]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(numbers.round_to(F.col("v"), 2)).collect()]
    assert got == [duckdb.execute("SELECT round(?::DOUBLE, 2)", [v]).fetchone()[0] for v in values]


def test_ratio_by_zero_is_null(spark):
    assert one(spark, r=numbers.ratio(F.lit(1), F.lit(0))).r is None


def test_calendar(spark):
    ts = F.lit("2024-01-07 03:30:00").cast("timestamp")
    row = one(spark, **calendar.calendar_parts(ts), local=calendar.local_time(ts))
    assert row.played_day_of_week == 0 and row.played_day_name == "Sunday"
    assert row.local == dt.datetime(2024, 1, 6, 21, 30)


@pytest.mark.parametrize("text", ["1999", "1999-03", "1999-03-04"])
def test_year(spark, text):
    assert one(spark, y=calendar.leading_year(F.lit(text))).y == 1999


def test_bad_year(spark):
    with pytest.raises(Exception):
        spark.createDataFrame([("abcd",)], "t string").select(calendar.leading_year(F.col("t"))).collect()
    assert one(spark, y=calendar.leading_year(F.lit("abcd"), strict=False)).y is None


def test_keys(spark):
    none = F.lit(None).cast("string")
    row = one(
        spark, a=keys.hash_key(none, F.lit("x")), b=keys.hash_key(F.lit("x"), none),
        c=keys.name_based_artist_id(none), d=keys.track_id_of(F.lit(fixed.EPISODE_URI_PREFIX + "x")),
        e=keys.last_uri_piece(F.lit(fixed.EPISODE_URI_PREFIX + "x")),
    )
    assert row.a != row.b and row.c == "ext_artist_ad921d604863662588"
    assert row.d is None and row.e == "x"


def test_moods(spark):
    rows = [(0.7, 0.7), (0.7, 0.39), (0.39, 0.7), (0.1, 0.1), (0.7, 0.5), (None, 0.9)]
    df = spark.createDataFrame(rows, "v double, e double")
    track = [r[0] for r in df.select(labels.track_mood(F.col("v"), F.col("e"))).collect()]
    assert track == [
        "Happy & Energetic", "Happy & Calm", "Sad & Energetic", "Sad & Calm", "Neutral", "Neutral",
    ]
    playlist = [r[0] for r in df.select(labels.playlist_mood(F.col("v"), F.col("e"))).collect()]
    assert playlist[4] == "Happy & Calm"
    modes = spark.createDataFrame([(0,), (1,), (2,), (None,)], "m int")
    assert [r[0] for r in modes.select(labels.mode_label(F.col("m"))).collect()] == ["Minor", "Major", None, None]
