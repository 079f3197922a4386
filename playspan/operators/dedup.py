"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def total_order(df: DataFrame, first: Sequence[Column], skip: Sequence[str] = ()) -> list[Column]:
    """``first`` followed by every other column, so that no two different rows tie."""
    return [*first, *(F.col(c).asc_nulls_last() for c in df.columns if c not in set(skip))]


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    *,
    keep: int = 1,
    rank: str | None = None,
) -> DataFrame:
    """The first ``keep`` rows of each key.

    The rank filter sits directly on the window, so each map task keeps at most
    ``keep`` rows per key before the shuffle: a key that holds a large share of
    all rows reaches its reducer as a handful of rows per task.
    """
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= keep)
    return kept.withColumn(rank, F.col(rank).cast("long")) if rank else kept.drop(name)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest: str | Sequence[str] = "loaded_at",
) -> DataFrame:
    """The newest row of each key; equal times are decided by all other columns."""
    times = [newest] if isinstance(newest, str) else list(newest)
    order = total_order(df, [F.col(t).desc_nulls_last() for t in times], [*keys, *times])
    return first_per_key(df, keys, order)


def prefer_present(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """One row per key, rows where ``column`` is present first."""
    return first_per_key(df, keys, total_order(df, [F.col(column).isNull().asc()], keys))


def latest_values(
    df: DataFrame, key: str, values: Sequence[str], newest: Sequence[str] = ("loaded_at",)
) -> DataFrame:
    """Values of the newest row per key; a NULL in that row is kept."""
    slim = df.select(key, *values, *newest)
    return latest_per_key(slim, [key], newest).select(key, *values)


def align(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the columns and types of ``like``; missing columns become typed NULLs."""
    have = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in like.schema.fields
        )
    )
