"""Properties of physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from playspan.operators import sessions
from playspan.operators.ordered import RANGE, dense_key, in_ranges


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def query(spark, folder, name):
    return plan(entry_points.queries()[name](spark, folder))


@pytest.mark.parametrize("name", ["stg_plays", "stg_artists", "dedup_latest", "topk_per_group"])
def test_ranks_are_limited_before_the_shuffle(spark, small_dir, name):
    text = query(spark, small_dir, name)
    below = text.split("Exchange hashpartitioning", 1)[1]
    assert "WindowGroupLimit" in below


@pytest.mark.parametrize("name", ["sessionize", "sessionize_per_user", "repeat_runs", "fct_history"])
def test_ordered_scans_are_written_once(spark, small_dir, name):
    """The last step reads the written scan: no sort of plays is left, and the only
    single-task exchange is above the aggregation to one row per range."""
    text = query(spark, small_dir, name)
    for part in text.split("Exchange SinglePartition")[1:]:
        assert re.search(r"Aggregate\(keys?=\[_range", part.split("FileScan")[0])
    assert "hashpartitioning(_range" in text and "reduce(" not in text


def test_one_sort_per_scan(spark, small_dir):
    """All windows of the scan share one exchange and one sort."""
    df = spark.range(1000).selectExpr(
        "timestamp_seconds(id * 60) AS played_at", "current_date() AS played_date", "string(id % 7) AS track_id",
        "string(id) AS play_id", "'a' AS data_source",
    )
    ranged = in_ranges(df, ["played_at", "play_id"], ranges=4)
    seen = ["played_at", "played_date", "track_id"]
    text = plan(sessions._scan_ranges(ranged, [], ["play_id", "data_source"], seen, (30, True), "copies"))
    text = text.split("== Initial Plan ==")[-1]
    assert len(re.findall(r"\bSort \[", text)) == 1 and text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["dense_surrogate_key", "dim_tracks"])
def test_dense_keys_are_numbered_by_range(spark, small_dir, name):
    text = query(spark, small_dir, name)
    assert "hashpartitioning(_range" in text
    for part in text.split("Exchange SinglePartition")[1:]:
        assert re.search(r"Aggregate\(keys?=\[_range", part.split("FileScan")[0])


def test_only_needed_columns_are_read(spark, small_dir):
    text = query(spark, small_dir, "filter_not_null_key")
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "user_id" not in read and "event_id" not in read


def test_many_ranges(spark):
    df = spark.range(30000).select((F.col("id") * 7919 % 30011).alias("id"))
    sizes = [r["count"] for r in in_ranges(df, ["id"], ranges=500).groupBy(RANGE).count().collect()]
    assert len(sizes) > 400 and max(sizes) < 300
    wrong = dense_key(df, "id", "n", ranges=500).join(
        df.groupBy("id").count(), "id"
    ).agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert tuple(wrong) == (1, 30000, 30000)
