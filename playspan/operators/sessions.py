"""Previous play, sessions and repeat runs over an ordered play history.

A play opens a session when it is the first one, when more than the gap limit
has passed since the previous play, or when the date changes. A repeat run is
a stretch of plays of the same track; its plays are numbered from 0.

The order is global, or per user when ``by`` is given. Either way the rows are
cut into ranges of the whole order (see ``ordered``), so neither a busy day nor
a user with a third of all plays has to fit into one task. Each range is
scanned on its own, with the one sort of the whole table, and the scan is
written. What a range needs from earlier ones (the last play, the session count,
the start of an open run) is taken from the first and last rows of the written
scan: a table with a row per range, joined like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from playspan import fixed
from playspan.functions.calendar import minutes_between
from playspan.operators.ordered import RANGE, ROWS_PER_RANGE, in_ranges
from playspan.session import stage

AT = "played_at"
DAY = "played_date"
TRACK = "track_id"

@dataclass(frozen=True)
class _Play:
    """Columns of a play, or of the one before it (``exists`` is false for none)."""

    exists: Column
    columns: dict[str, Column]

    def __getitem__(self, name: str) -> Column:
        return self.columns[name]


def _opens_session(prev: _Play, row: _Play, gap_minutes: float, split_days: bool) -> Column:
    """1 when the play opens a session, 0 otherwise."""
    apart = minutes_between(prev[AT], row[AT]) > gap_minutes
    opens = ~prev.exists | prev[AT].isNull() | F.coalesce(apart, F.lit(False))
    if split_days:
        opens = opens | F.coalesce(prev[DAY] != row[DAY], F.lit(False))
    return opens.cast("int")


def _opens_run(prev: _Play, row: _Play) -> Column:
    """1 when the play starts a run. No previous track starts one; an unknown current
    track after a known one does not."""
    changed = F.coalesce(prev[TRACK] != row[TRACK], F.lit(False))
    return (~prev.exists | prev[TRACK].isNull() | changed).cast("int")


def number_plays(
    plays: DataFrame,
    *,
    by: Sequence[str] = (),
    ties: Sequence[str] = ("play_id", "data_source"),
    carry: Sequence[str] = (),
    gap_minutes: float = fixed.SESSION_GAP_MINUTES,
    split_days: bool = True,
    rows_per_range: int = ROWS_PER_RANGE,
    ranges: int | None = None,
    staged: bool = False,
    copies: str | None = None,
) -> DataFrame:
    """Add ``prev_<carry>`` and the session and run columns to ``plays``.

    ``plays`` needs played_at, played_date and track_id; (by, played_at, ties) must be a
    total order. Rows equal in (by, played_at, first tie) always share a range.
    ``staged`` says that ``plays`` is a table already and cheap to read several times.
    ``copies`` adds a column with the number of rows equal in (by, played_at, first tie).
    """
    if not staged:
        plays = stage(plays, "plays")
    by, ties, carry = list(by), list(ties), list(carry)
    seen = list(dict.fromkeys([AT, DAY, TRACK, *carry]))
    rule = (gap_minutes, split_days)
    ranged = in_ranges(plays, [*by, AT, *ties[:1]], rows_per_range=rows_per_range, ranges=ranges)
    scanned = stage(_scan_ranges(ranged, by, ties, seen, rule, copies), "scanned")
    return _shown(scanned, _carried(scanned, by, seen, rule), plays.columns, by, seen, carry, rule, copies)


def _shown(scanned: DataFrame, carried: DataFrame, columns, by, seen, carry, rule, copies=None) -> DataFrame:
    """The numbers of all plays: what was said within the ranges, moved on by what came before."""
    numbered = _join_carried(scanned, carried, by)
    first = F.col("_at") == 1
    prev = _Play(
        ~first | F.coalesce(F.col("_row_shift") > 0, F.lit(False)),
        {c: F.when(first, F.col(f"_before_{c}")).otherwise(F.col(f"_prev_{c}")) for c in seen},
    )
    row = _Play(F.lit(True), {c: F.col(c) for c in seen})
    row_shift = F.coalesce(F.col("_row_shift"), F.lit(0))
    run_start = F.coalesce(
        row_shift + F.col("_run_at"),
        F.when(F.coalesce(F.col("_first_run"), F.lit(1)) == 1, row_shift + 1),
        F.col("_open_run_at"),
    )
    return numbered.select(
        *columns,
        *(prev[c].alias(f"prev_{c}") for c in carry),
        minutes_between(prev[AT], row[AT]).alias("minutes_since_prev_play"),
        _opens_session(prev, row, *rule).alias("is_new_session"),
        (
            F.coalesce(F.col("_session_shift"), F.lit(0))
            + F.coalesce(F.col("_first_opens"), F.lit(1))
            + F.col("_sessions")
        ).alias("session_number"),
        F.coalesce(prev[TRACK] == row[TRACK], F.lit(False)).alias("is_repeat"),
        (row_shift + F.col("_at") - run_start).alias("repeat_sequence"),
        *([copies] if copies else []),
    )


def _within(by, ties):
    """Order within a range, and within a user if given."""
    order = [F.col(c).asc_nulls_last() for c in (AT, *ties)]
    return Window.partitionBy(RANGE, *by).orderBy(*order)


def _scan_ranges(ranged: DataFrame, by, ties, seen, rule, copies: str | None) -> DataFrame:
    """What can be said from within a range: the previous play, the position, whether it is
    the last one, and the sessions and runs opened so far, not counting the first play of
    the range. All of it comes from one sort."""
    within = _within(by, ties)
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    inner = F.col("_at") > 1
    prev = _Play(inner, {c: F.col(f"_prev_{c}") for c in seen})
    row = _Play(F.lit(True), {c: F.col(c) for c in seen})
    opened = F.when(inner, _opens_session(prev, row, *rule)).otherwise(0)
    run_opened = inner & (_opens_run(prev, row) == 1)
    scanned = ranged.withColumns(
        {
            **{f"_prev_{c}": F.lag(c).over(within) for c in seen},
            "_at": F.row_number().over(within).cast("long"),
            "_final": F.lead(F.lit(1)).over(within).isNull(),
        }
    ).withColumns(
        {
            "_sessions": F.sum(opened).over(so_far),
            "_run_at": F.max(F.when(run_opened, F.col("_at"))).over(so_far),
        }
    )
    if copies:
        # Copies are neighbours: counting them needs neither a shuffle nor another sort.
        place = Window.partitionBy(RANGE, *by).orderBy(*[F.col(c).asc_nulls_last() for c in (AT, *ties[:1])])
        same = place.rangeBetween(Window.currentRow, Window.currentRow)
        scanned = scanned.withColumn(copies, F.count("*").over(same))
    return scanned


CARRIED = ("_first_opens", "_first_run", "_session_shift", "_row_shift", "_open_run_at")


def _carried(scanned: DataFrame, by, seen, rule) -> DataFrame:
    """What came before each range: one row per range, and per user in several ranges."""
    first, row = F.col("_at") == 1, F.struct(*seen)
    # The first and the last row of a range say all there is to carry.
    ends = scanned.filter(first | F.col("_final"))
    if by:
        ends = _users_in_several(ends, by)
    parts = ends.groupBy(RANGE, *by).agg(
        F.max("_at").alias("_rows"),
        F.max(F.when(first, row)).alias("_first"),
        F.max(F.when(F.col("_final"), row)).alias("_last"),
        F.max("_sessions").alias("_inner_sessions"),
        F.max("_run_at").alias("_inner_run_at"),
    )
    # One row per range here, also without ``by``.
    along = Window.partitionBy(*by).orderBy(RANGE)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    prev = _Play(
        F.col("_before").isNotNull(), {c: F.col("_before").getField(c) for c in seen}
    )
    head = _Play(F.lit(True), {c: F.col("_first").getField(c) for c in seen})
    return (
        parts.withColumns(
            {
                "_before": F.lag("_last").over(along),
                "_row_shift": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
            }
        )
        .withColumns(
            {
                "_first_opens": _opens_session(prev, head, *rule).cast("long"),
                "_first_run": _opens_run(prev, head).cast("long"),
            }
        )
        .withColumn(
            "_newest_run_at",
            F.coalesce(
                F.col("_row_shift") + F.col("_inner_run_at"),
                F.when(F.col("_first_run") == 1, F.col("_row_shift") + 1),
            ),
        )
        .withColumns(
            {
                "_session_shift": F.coalesce(
                    F.sum(F.col("_inner_sessions") + F.col("_first_opens")).over(before), F.lit(0)
                ),
                "_open_run_at": F.max("_newest_run_at").over(before),
            }
        )
        .select(RANGE, *by, *(prev[c].alias(f"_before_{c}") for c in seen), *CARRIED)
    )


def _join_carried(scanned: DataFrame, carried: DataFrame, by) -> DataFrame:
    """``carried`` has a row per range, or per range of a user in several of them."""
    on = F.lit(True)
    for c in (RANGE, *by):
        on = on & F.col(f"p.{c}").eqNullSafe(F.col(f"c.{c}"))
    added = [c for c in carried.columns if c not in (RANGE, *by)]
    return (
        scanned.alias("p")
        .join(carried.alias("c"), on, "left")
        .select("p.*", *(f"c.{c}" for c in added))
    )


def _users_in_several(ends: DataFrame, by) -> DataFrame:
    """Rows of users that are in more than one range, of whom there are fewer than ranges."""
    several = (
        ends.groupBy(*by).agg(F.min(RANGE).alias("_from"), F.max(RANGE).alias("_to"))
        .filter("_from < _to").select(*by)
    )
    on = F.lit(True)
    for c in by:
        on = on & F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}"))
    return ends.alias("p").join(several.alias("s"), on, "left_semi")
