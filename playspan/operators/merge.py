"""Keyed loads into tables without a primary key: insert-ignore, upsert, load metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from playspan.operators.dedup import align, first_per_key, latest_per_key, total_order


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail on a NULL key, as a primary key would."""
    checked = {
        k: F.when(F.col(k).isNull(), F.raise_error(F.lit(f"NULL in key column {k}"))).otherwise(
            F.col(k)
        )
        for k in keys
    }
    return df.withColumns(checked)


def new_rows(
    old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """Rows of ``new`` whose key is not in ``old``, one per key (the first by ``order``).

    The keys found in ``old`` are looked up with the batch on the small side, so a
    small batch is broadcast and the big table is scanned but not shuffled.
    """
    batch = first_per_key(require_keys(new, keys), keys, total_order(new, order, keys))
    known = old.select(*keys).join(batch.select(*keys), list(keys), "left_semi")
    return align(batch.join(known, list(keys), "left_anti"), old)


def insert_ignore(
    old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """``old`` plus the rows of ``new`` with keys not seen before. Existing rows win."""
    return old.unionByName(new_rows(old, new, keys, order))


def batch_rows(new: DataFrame, keys: Sequence[str], newest: str | Sequence[str] = "loaded_at") -> DataFrame:
    """The newest row per key of a batch; a NULL key is an error."""
    return latest_per_key(require_keys(new, keys), keys, newest)


def not_outdated(old: DataFrame, batch: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """``batch`` without rows whose key has a row of a later ``order`` in ``old``."""
    known = old.select(*keys, F.col(order).alias("_known")).filter(F.col("_known").isNotNull())
    later = F.col(f"k._known") > F.col(f"b.{order}")
    same = [F.col(f"k.{k}") == F.col(f"b.{k}") for k in keys]
    on = later
    for c in same:
        on = on & c
    return batch.alias("b").join(known.alias("k"), on, "left_anti")


def upsert_batch(old: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with rows replaced by, and extended with, those of ``batch`` (one per key)."""
    kept = old.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(align(batch, old))


def upsert(
    old: DataFrame, new: DataFrame, keys: Sequence[str], newest: str | Sequence[str] = "loaded_at"
) -> DataFrame:
    """``old`` with rows replaced by, and extended with, the newest row per key of ``new``."""
    return upsert_batch(old, batch_rows(new, keys, newest), keys)


def load_metrics(table: str, old: DataFrame, new: DataFrame, keys: Sequence[str], *, updates: bool) -> DataFrame:
    """One row: table, rows_before, rows_after, rows_added, rows_updated.

    ``updates`` says whether keys already present count as updated (upsert) or are
    left alone (insert-ignore). Either input is scanned once: keys are counted together.
    """
    marked = old.select(*keys, F.lit(1).alias("is_old")).unionAll(new.select(*keys, F.lit(0).alias("is_old")))
    per_key = marked.groupBy(*keys).agg(
        F.sum("is_old").alias("n_old"), F.count_if(F.col("is_old") == 0).alias("n_new")
    )
    both = (F.col("n_old") > 0) & (F.col("n_new") > 0)
    added = F.count_if(F.col("n_old") == 0)
    before = F.coalesce(F.sum("n_old"), F.lit(0))
    return per_key.agg(
        before.alias("rows_before"),
        (before + added).alias("rows_after"),
        added.alias("rows_added"),
        (F.count_if(both) if updates else F.lit(0).cast("long")).alias("rows_updated"),
    ).select(F.lit(table).alias("table_name"), "*")
