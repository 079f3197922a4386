"""Numbered plays kept as a table, and brought up to date when plays come late.

What ``sessions.number_plays`` finds within a range does not depend on other ranges; what a
range needs from earlier ones is in their first and last rows. Both are kept: the scanned
ranges, and the rows at their ends. New plays are dealt to the ranges they fall in. Those are
read, scanned again and written; no other range is read. The numbers of later plays move on by
themselves, since they are added up from the ends when the table is read. A range that has
outgrown twice its size is cut into several.

The numbers of ranges leave gaps, so that a cut range has room for its parts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from playspan import fixed
from playspan.operators import sessions
from playspan.operators.dedup import first_per_key
from playspan.operators.ordered import RANGE, ROWS_PER_RANGE, in_ranges
from playspan.session import scratch_scope, stage
from playspan.sources import tables

GAP = 1 << 32


@dataclass(frozen=True)
class NumberedPlays:
    """Plays at ``base`` with sessions and repeat runs; options as of ``number_plays``."""

    base: str
    by: Sequence[str] = ()
    ties: Sequence[str] = ("play_id", "data_source")
    carry: Sequence[str] = ()
    gap_minutes: float = fixed.SESSION_GAP_MINUTES
    split_days: bool = True
    rows_per_range: int = field(default=ROWS_PER_RANGE)

    @property
    def _seen(self) -> list[str]:
        return list(dict.fromkeys([sessions.AT, sessions.DAY, sessions.TRACK, *self.carry]))

    @property
    def _order(self) -> list[str]:
        return [*self.by, sessions.AT, *self.ties[:1]]

    def begin(self, plays: DataFrame) -> None:
        """Number all ``plays``; what was at ``base`` before must be gone."""
        with scratch_scope(plays.sparkSession, "begin"):
            staged = stage(plays, "plays")
            ranged = in_ranges(staged, self._order, rows_per_range=self.rows_per_range)
            self._write(ranged.withColumn(RANGE, F.col(RANGE).cast("long") * GAP))

    def add(self, new: DataFrame) -> None:
        """Number the plays there are together with the ``new`` ones."""
        spark = new.sparkSession
        with scratch_scope(spark, "add"):
            new = stage(self._placed(stage(new, "new")), "placed")
            touched = [r[0] for r in new.select(RANGE).distinct().collect()]  # ranges, not plays
            if not touched:
                return
            old = tables.read_buckets(spark, f"{self.base}/ranges", touched).select(*new.columns)
            self._write(self._cut(stage(old.unionByName(new), "touched")))

    def read(self, spark: SparkSession) -> DataFrame:
        """All plays with their numbers."""
        scanned = tables.read_buckets(spark, f"{self.base}/ranges")
        ends = tables.read_buckets(spark, f"{self.base}/ends")
        rule = (self.gap_minutes, self.split_days)
        carried = sessions._carried(ends, list(self.by), self._seen, rule)
        inner = {RANGE, "_at", "_final", "_sessions", "_run_at", *(f"_prev_{c}" for c in self._seen)}
        columns = [c for c in scanned.columns if c not in inner]
        return sessions._shown(scanned, carried, columns, list(self.by), self._seen, list(self.carry), rule)

    def _write(self, ranged: DataFrame) -> None:
        rule = (self.gap_minutes, self.split_days)
        scanned = sessions._scan_ranges(ranged, list(self.by), list(self.ties), self._seen, rule, None)
        scanned = stage(scanned.withColumn("bucket", F.col(RANGE)), "scanned")
        ends = scanned.filter((F.col("_at") == 1) | F.col("_final"))
        for name, rows in (("ranges", scanned), ("ends", ends)):
            tables.replace_buckets(rows, f"{self.base}/{name}")

    def _placed(self, new: DataFrame) -> DataFrame:
        """``new`` with the range each play falls in: the last one that begins at or before it."""
        order = [F.col(c).asc_nulls_last() for c in self._order]
        ends = tables.read_buckets(new.sparkSession, f"{self.base}/ends")
        lows = first_per_key(ends.filter("_at = 1").select(RANGE, *self._order), [RANGE], order)
        both = new.unionByName(lows.withColumnRenamed(RANGE, "_low"), allowMissingColumns=True)
        ranged = in_ranges(both, self._order, rows_per_range=self.rows_per_range)
        along = Window.partitionBy(RANGE).orderBy(*order, F.col("_low").asc_nulls_last())
        before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)  # a row per range
        earlier = ranged.groupBy(RANGE).agg(F.max("_low").alias("_last")).withColumn("_earlier", F.max("_last").over(before))
        inside = F.max("_low").over(along.rowsBetween(Window.unboundedPreceding, 0))
        found = ranged.withColumns({"_inside": inside, "_new": F.col("_low").isNull()}).filter("_new")
        place = F.coalesce("_inside", "_earlier", F.lit(self._first(lows)))
        return found.join(earlier.select(RANGE, "_earlier"), RANGE).select(*new.columns, place.alias(RANGE))

    @staticmethod
    def _first(lows: DataFrame) -> int:
        return lows.agg(F.min(RANGE)).first()[0]

    def _cut(self, rows: DataFrame) -> DataFrame:
        """``rows`` of some ranges, with those that are too large dealt to several."""
        spark = rows.sparkSession
        sizes = {r[RANGE]: r["count"] for r in rows.groupBy(RANGE).count().collect()}
        large = [r for r, n in sizes.items() if n > 2 * self.rows_per_range]
        if not large:
            return rows
        places = sorted(r["bucket"] for r in tables.manifest(spark, f"{self.base}/ranges") if r["bucket"] is not None)
        out = rows.filter(~F.col(RANGE).isin(large))
        for r in large:
            parts = -(-sizes[r] // self.rows_per_range)
            after = min((p for p in places if p > r), default=r + parts * GAP)
            step = (after - r) // parts
            if not step:
                raise ValueError(f"no room to cut range {r}: number all plays anew with begin()")
            dealt = in_ranges(rows.filter(F.col(RANGE) == r).drop(RANGE), self._order, ranges=parts)
            out = out.unionByName(dealt.withColumn(RANGE, F.lit(r) + F.col(RANGE).cast("long") * step))
        return out
