"""Work on one total order of all rows without moving them to one task.

A window without PARTITION BY would put the whole table into a single task. Here Spark's
range partitioning deals the rows out in ranges of about equal size, and the rows are
written once with the number of their range, so every later stage and every retry sees the
same ranges. Rows that are equal in the order share a range. Every range is numbered on its
own and then shifted by a small table with one row per range.

The number of ranges follows the number of rows, without a limit. What is computed over the
rows per range is one row per ``ROWS_PER_RANGE`` rows; it is joined like any table, so Spark
broadcasts it only while it is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from playspan.session import stage

ROWS_PER_RANGE = 1_000_000
RANGE = "_range"


def in_ranges(
    df: DataFrame,
    columns: Sequence[str],
    *,
    rows_per_range: int = ROWS_PER_RANGE,
    ranges: int | None = None,
) -> DataFrame:
    """``df`` written in ranges of the order of ``columns`` (ascending, NULLS LAST), with the
    number of the range in ``RANGE``. ``df`` should be cheap to read several times."""
    if ranges is None:
        at_least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = max(-(-df.count() // rows_per_range), at_least)
    order = [F.col(c).asc_nulls_last() for c in columns]
    dealt = df.repartitionByRange(max(1, ranges), *order)
    return stage(dealt.withColumn(RANGE, F.spark_partition_id()), "ranges")


def dense_key(
    df: DataFrame,
    columns: Sequence[str] | str,
    name: str,
    *,
    rows_per_range: int = ROWS_PER_RANGE,
    ranges: int | None = None,
    staged: bool = False,
) -> DataFrame:
    """Number the rows 1..n in the order of ``columns`` (ascending, NULLS LAST).

    ``columns`` must be unique in ``df``. Equal to ROW_NUMBER() without a
    partition, with one task per range instead of one task.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    if not staged:
        df = stage(df, name)
    ranged = in_ranges(df, columns, rows_per_range=rows_per_range, ranges=ranges)
    order = [F.col(c).asc_nulls_last() for c in columns]
    # One row per range, so this window is over a millionth of the rows.
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy(RANGE)
        .agg(F.count("*").alias("_rows"))
        .select(RANGE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    )
    local = F.row_number().over(Window.partitionBy(RANGE).orderBy(*order))
    return (
        ranged.withColumn("_local", local)
        .join(shifts, RANGE)
        .withColumn(name, F.col("_shift") + F.col("_local"))
        .select(name, *df.columns)
    )


def dense_key_single_task(df: DataFrame, columns: Sequence[str] | str, name: str) -> DataFrame:
    """The same numbering with one un-partitioned window; for tests on small tables."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    order = [F.col(c).asc_nulls_last() for c in columns]
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long")).select(
        name, *df.columns
    )
