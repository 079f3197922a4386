"""Data-quality checks on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from playspan.operators import quality
from playspan.operators.quality import TableChecks


def test_duplicates_skip_or_keep_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "id string")
    assert [r.id for r in quality.duplicates(df, ["id"]).collect()] == ["a"]
    kept = quality.duplicates(df, ["id"], skip_null=False).collect()
    assert sorted((r.id or "") for r in kept) == ["", "a"]


def test_range_limits(spark):
    df = spark.createDataFrame([(-1,), (0,), (100,), (101,), (None,)], "v int")

    def bad(**options):
        return [r.v for r in df.filter(quality.out_of_range(F.col("v"), 0, 100, **options)).collect()]

    assert bad() == [-1, 101]
    assert bad(inclusive=False) == [-1, 0, 100, 101]


def test_orphans_are_counted_per_key(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    assert [(r.k, r.n_rows) for r in quality.orphans(child, "k", parent, "id").collect()] == [(2, 2)]


def test_freshness_levels(spark):
    now = F.lit("2024-01-03 00:00:00").cast("timestamp")

    def status(hours, warn=6, error=24):
        at = dt.datetime(2024, 1, 3) - dt.timedelta(hours=hours)
        df = spark.createDataFrame([(at,)], "loaded_at timestamp")
        return quality.freshness(df, now, warn, error).first().status

    assert [status(1), status(6), status(7), status(25)] == ["pass", "pass", "warn", "error"]
    assert status(1000, None, None) == "pass"


def test_sequence_gaps_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(quality, "NUMBERS_PER_BLOCK", 10)
    numbers = [1, 2, 3, 9, 10, 11, 29, 30, 30, 45, None]
    df = spark.createDataFrame([(n,) for n in numbers], "session_number long")
    got = sorted(tuple(r) for r in quality.sequence_gaps(df).collect())
    assert got == [(9, 3, 6), (29, 11, 18), (45, 30, 15)]


def test_id_pattern_keeps_the_wildcard(spark):
    native = "x" * 22
    rows = [("ext_artist_1", "ext_album_1"), (native, native), ("short", native), (native, "short"),
            ("extXartistX1", native)]
    df = spark.createDataFrame(rows, "artist_id string, album_id string")
    assert sorted(r.artist_id for r in quality.malformed_ids(df).collect()) == ["short", native]


def test_report_rows(spark):
    t = spark.createDataFrame([(1, "x", 5), (1, None, 500), (2, "y", None)], "id int, c string, v int")
    parent = spark.createDataFrame([(1,)], "id int")
    declared = {
        "t": TableChecks(
            unique=("id",), not_null=("c", "id"), ranges={"v": (0, 100)}, accepted={"c": ("x",)},
            parents={"id": ("parent", "id")},
        )
    }
    got = {r.check_name: (r.failures, r.status) for r in quality.report({"t": t, "parent": parent}, declared).collect()}
    assert got == {
        "not_null:c": (1, "fail"),
        "not_null:id": (0, "pass"),
        "range:v": (1, "fail"),
        "accepted:c": (1, "fail"),
        "unique:id": (1, "fail"),
        "parent:id": (1, "fail"),
    }
