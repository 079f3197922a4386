"""Dense numbering by ranges against a plain sort."""

import random

import pytest
from pyspark.sql import functions as F

from playspan.operators.ordered import RANGE, dense_key, dense_key_single_task, in_ranges


def keys(n, seed=4):
    rng = random.Random(seed)
    names = [f"ext_artist_{rng.getrandbits(40):x}" for _ in range(n // 2)]
    names += [f"{rng.getrandbits(50):x}é" for _ in range(n - len(names) - 1)]
    return [*dict.fromkeys(names), None]


@pytest.mark.parametrize("ranges", [None, 1, 2, 37])
def test_numbers_follow_the_order(spark, ranges):
    df = spark.createDataFrame([(k,) for k in keys(900)], "id string").repartition(5)
    got = {r.id: r.key for r in dense_key(df, "id", "key", ranges=ranges).collect()}
    want = {r.id: r.key for r in dense_key_single_task(df, "id", "key").collect()}
    assert got == want
    assert got[None] == len(want)
    assert sorted(got.values()) == list(range(1, len(want) + 1))


def test_ranges_are_balanced_under_a_shared_prefix(spark):
    df = spark.range(20000).select(F.concat(F.lit("same_prefix_"), F.md5(F.col("id").cast("string"))).alias("id"))
    sizes = [r["count"] for r in in_ranges(df, ["id"], ranges=20).groupBy(RANGE).count().collect()]
    assert len(sizes) == 20
    assert max(sizes) < 3 * 1000


def test_one_hot_value_is_split_by_the_next_column(spark):
    df = spark.range(12000).select(F.when(F.col("id") < 8000, 7).otherwise(F.col("id")).alias("user"), "id")
    sizes = [r["count"] for r in in_ranges(df, ["user", "id"], ranges=12).groupBy(RANGE).count().collect()]
    assert max(sizes) < 3 * 1000


def test_empty(spark):
    df = spark.createDataFrame([], "id string")
    assert dense_key(df, "id", "key").count() == 0
