"""Per-entity totals.

Plays are first collapsed to one row per (entity, track, day). That happens on
the map side, so an entity with a large share of all plays is already small
when it is shuffled, and the distinct counts run on the collapsed rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def entity_stats(plays: DataFrame, entity: str) -> DataFrame:
    """Plays, distinct tracks and days, first and last play, listening time per entity.

    ``plays`` has the entity id, track_id, played_at, played_date and duration_ms.
    """
    grain = list(dict.fromkeys([entity, "track_id", "played_date"]))
    collapsed = plays.groupBy(*grain).agg(
        F.count("*").alias("n"),
        F.min("played_at").alias("low"),
        F.max("played_at").alias("high"),
        F.sum("duration_ms").alias("ms"),
    )
    return collapsed.groupBy(entity).agg(
        F.sum("n").alias("total_plays"),
        F.countDistinct("track_id").alias("unique_tracks_played"),
        F.countDistinct("played_date").alias("days_played"),
        F.min("low").alias("first_played_at"),
        F.max("high").alias("last_played_at"),
        F.sum("ms").alias("total_listen_time_ms"),
    )


def with_stats(base: DataFrame, stats: DataFrame, key: str, counts: list[str]) -> DataFrame:
    """Attach ``stats``; counts of entities without plays are 0, their times stay NULL."""
    joined = base.join(stats, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})


def playlist_stats(playlist_tracks: DataFrame) -> DataFrame:
    """Distinct tracks and first / last addition per playlist."""
    return playlist_tracks.groupBy("playlist_id").agg(
        F.countDistinct("track_id").alias("actual_track_count"),
        F.min("added_at").alias("first_track_added"),
        F.max("added_at").alias("last_track_added"),
    )


def track_plays(plays: DataFrame) -> DataFrame:
    """Play count, first and last play per track, with duration totals."""
    return plays.groupBy("track_id").agg(
        F.count("*").alias("play_count"),
        F.min("played_at").alias("first_played"),
        F.max("played_at").alias("last_played"),
        F.sum("duration_ms").alias("duration_sum"),
        F.count("duration_ms").alias("duration_rows"),
    )
