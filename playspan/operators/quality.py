"""Data-quality checks. A check yields the violating rows or a row with their number."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from playspan import fixed


def duplicates(df: DataFrame, keys: Sequence[str], count: str = "n_records", *, skip_null: bool = True) -> DataFrame:
    """Keys that occur more than once. NULLs form a group of their own unless skipped."""
    if skip_null:
        df = df.dropna(subset=list(keys))
    return df.groupBy(*keys).agg(F.count("*").alias(count)).filter(F.col(count) > 1)


def out_of_range(
    column: Column, low: float | None = None, high: float | None = None, *, inclusive: bool = True
) -> Column:
    """True outside the range; NULL is not a violation."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | ((column < low) if inclusive else (column <= low))
    if high is not None:
        bad = bad | ((column > high) if inclusive else (column >= high))
    return F.coalesce(bad, F.lit(False))


def not_accepted(column: Column, values: Sequence) -> Column:
    return F.coalesce(~column.isin(list(values)), F.lit(False))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign keys without a parent, with the number of child rows.

    Child rows are counted per key first, so a frequent key is one row in the join.
    """
    used = child.dropna(subset=[column]).groupBy(column).agg(F.count("*").alias("n_rows"))
    known = parent.select(F.col(parent_column).alias(column)).dropna()
    return used.join(known, column, "left_anti")


def freshness(
    df: DataFrame, now: Column, warn_hours: float | None, error_hours: float | None, at: str = "loaded_at"
) -> DataFrame:
    """Age of the newest row in hours and a status. No limits: always passes."""
    newest = df.agg(F.max(at).alias("newest"))
    hours = (F.unix_micros(now) - F.unix_micros("newest")).cast("double") / F.lit(3.6e9)
    status = F.lit("pass")
    if warn_hours is not None:
        status = F.when(F.col("age_hours") > warn_hours, "warn").otherwise(status)
    if error_hours is not None:
        stale = (F.col("age_hours") > error_hours) | F.col("age_hours").isNull()
        status = F.when(stale, "error").otherwise(status)
    return newest.withColumn("age_hours", hours).withColumn("status", status)


def count_differences(fact: DataFrame, dimension: DataFrame, key: str, total: str = "total_plays") -> DataFrame:
    """Keys whose number of fact rows is not the total stored in the dimension."""
    counted = fact.groupBy(key).agg(F.count("*").alias("fact_play_count"))
    stored = dimension.select(key, F.col(total).alias("dim_play_count"))
    difference = F.abs(F.col("fact_play_count") - F.col("dim_play_count"))
    return (
        counted.join(stored, key)
        .withColumn("difference", difference)
        .filter(F.col("difference") != 0)
    )


def malformed_ids(df: DataFrame) -> DataFrame:
    """Artist and album ids that are neither name-based nor of the native length."""

    def bad(column: str, prefix: str) -> Column:
        c = F.col(column)
        return ~c.like(prefix + "%") & (F.length(c) != fixed.NATIVE_ID_LENGTH)

    return df.filter(
        bad("artist_id", fixed.ARTIST_FALLBACK_PREFIX) | bad("album_id", fixed.ALBUM_FALLBACK_PREFIX)
    ).select("artist_id", "album_id")


NUMBERS_PER_BLOCK = 1_000_000


def sequence_gaps(df: DataFrame, number: str = "session_number", by: Sequence[str] = ()) -> DataFrame:
    """Numbers that do not follow their predecessor: (number, prev_session, gap).

    Distinct numbers are looked at in blocks of a million values, so no task holds
    more than that; a row per block carries the last number of the blocks before.
    """
    by = list(by)
    distinct = df.select(*by, number).dropna(subset=[number]).distinct()
    blocks = distinct.withColumn("_block", F.floor(F.col(number) / F.lit(NUMBERS_PER_BLOCK)))
    within = Window.partitionBy(*by, "_block").orderBy(number)
    along = Window.partitionBy(*by).orderBy("_block")
    last = (
        blocks.groupBy(*by, "_block")
        .agg(F.max(number).alias("_last"))
        .withColumn("_before", F.lag("_last").over(along))
        .drop("_last")
    )
    prev = F.coalesce(F.lag(number).over(within), F.col("_before"))
    return (
        blocks.join(last, [*by, "_block"])
        .withColumn("prev_session", prev)
        .withColumn("gap", F.col(number) - F.col("prev_session"))
        .filter(F.col("gap") > 1)
        .select(*by, number, "prev_session", "gap")
    )


@dataclass(frozen=True)
class TableChecks:
    """Declared checks of one table.

    ``where`` limits the range check of a column to rows that meet a SQL condition.
    ``warn`` names checks whose failures are a warning only.
    """

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    accepted: Mapping[str, tuple] = field(default_factory=dict)
    parents: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    where: Mapping[str, str] = field(default_factory=dict)
    warn: tuple[str, ...] = ()


Check = tuple[str, str]  # table name and check name as reported


def report(
    tables: Mapping[str, DataFrame],
    checks: Mapping[str, TableChecks],
    more_rows: Mapping[str, Mapping[Check, Column]] | None = None,
    more_unique: Mapping[str, Mapping[Check, Sequence[str]]] | None = None,
) -> DataFrame:
    """One row per declared check: table_name, check_name, failures, status.

    All row checks of a table share one scan, all uniqueness checks another and all parent
    checks a third. ``more_rows`` and ``more_unique`` add conditions of bad rows and keys
    (with NULLs as a value) to the scans of a table.
    """
    parts = []
    for name, declared in checks.items():
        if name not in tables:
            continue
        df = tables[name]
        rows = {(name, check): bad for check, bad in _row_checks(declared).items()}
        rows |= (more_rows or {}).get(name, {})
        if rows:
            parts.append(_one_scan(df, rows))
        unique = {(name, f"unique:{c}"): (c,) for c in declared.unique}
        extra = (more_unique or {}).get(name, {})
        if unique or extra:
            parts.append(_unique_keys(df, unique, extra))
        if declared.parents:
            parts.append(_parents(df, name, declared.parents, tables))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return with_status(out, [f"{t}/{c}" for t, declared in checks.items() for c in declared.warn])


def with_status(counted: DataFrame, warnings: Sequence[str] = ()) -> DataFrame:
    """Status of each check; ``warnings`` are checks (``table/check``) that only warn."""
    only_warn = F.concat_ws("/", "table_name", "check_name").isin(list(warnings))
    bad = F.when(only_warn, "warn").otherwise("fail") if warnings else F.lit("fail")
    return counted.withColumn("status", F.when(F.col("failures") > 0, bad).otherwise("pass"))


def violations(df: DataFrame, table: str, check: str) -> DataFrame:
    """A report row for an arbitrary query of violating rows."""
    return df.agg(F.count("*").alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), "failures"
    )


def _row_checks(declared: TableChecks) -> dict[str, Column]:
    found = {f"not_null:{c}": F.col(c).isNull() for c in declared.not_null}
    for column, (low, high) in declared.ranges.items():
        bad = out_of_range(F.col(column), low, high)
        if column in declared.where:
            bad = F.coalesce(F.expr(declared.where[column]), F.lit(False)) & bad
        found[f"range:{column}"] = bad
    for column, values in declared.accepted.items():
        found[f"accepted:{column}"] = not_accepted(F.col(column), values)
    return found


def _as_rows(df: DataFrame, counts: Mapping[Check, Column]) -> DataFrame:
    """One report row per entry, from a single aggregation of ``df``."""
    rows = [
        F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("check_name"), n.cast("long").alias("failures"))
        for (t, c), n in counts.items()
    ]
    return df.agg(F.array(*rows).alias("checks")).select(F.inline("checks"))


def _one_scan(df: DataFrame, found: Mapping[Check, Column]) -> DataFrame:
    return _as_rows(df, {check: F.count_if(bad) for check, bad in found.items()})


def _unique_keys(df: DataFrame, keys: Mapping[Check, Sequence[str]], with_null: Mapping[Check, Sequence[str]]) -> DataFrame:
    """Keys that occur more than once, for all keys of a table in one scan and one grouping."""
    every = [*keys.items(), *with_null.items()]
    pairs = []
    for place, (_, columns) in enumerate(every):
        key = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        if place < len(keys):
            key = F.when(F.col(columns[0]).isNotNull(), key)
        pairs.append(F.struct(F.lit(place).alias("place"), key.alias("key")))
    counted = (
        df.select(F.inline(F.array(*pairs))).where("key IS NOT NULL")
        .groupBy("place", "key").agg(F.count("*").alias("n")).where("n > 1")
    )
    return _as_rows(counted, {check: F.count_if(F.col("place") == i) for i, (check, _) in enumerate(every)})


def _parents(df: DataFrame, name: str, parents: Mapping[str, tuple[str, str]], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows without a parent, for all foreign keys of a table in one scan and one join."""
    used = (
        df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("key")) for c in parents
        ])))
        .where("key IS NOT NULL").groupBy("column", "key").agg(F.count("*").alias("n"))
    )
    known = None
    for column, (parent, key) in parents.items():
        rows = tables[parent].select(F.lit(column).alias("column"), F.col(key).cast("string").alias("key")).dropna()
        known = rows if known is None else known.union(rows)
    missing = used.join(known, ["column", "key"], "left_anti")
    n = {c: F.coalesce(F.sum(F.when(F.col("column") == c, F.col("n"))), F.lit(0)) for c in parents}
    return _as_rows(missing, {(name, f"parent:{c}"): count for c, count in n.items()})
