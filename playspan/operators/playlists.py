"""Playlists of a play, and coverage of playlists by plays.

Which playlists a play belongs to depends on its track alone, so ranking and
counting are done per track and joined to plays once. Plays are never expanded
to one row per playlist, nor playlists to one row per play.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from playspan import fixed
from playspan.functions.numbers import ratio, round_to
from playspan.operators.dedup import first_per_key
from playspan.operators.stats import track_plays

SLOTS = fixed.PLAYLIST_SLOTS


def slot_names(slots: int = SLOTS) -> list[str]:
    return [f"playlist_key_{i}" for i in range(1, slots + 1)]


def track_memberships(playlist_tracks: DataFrame, playlists: DataFrame) -> DataFrame:
    """(track_id, playlist_key, added_at) for known playlists."""
    keys = playlists.select("playlist_id", "playlist_key")
    return playlist_tracks.join(keys, "playlist_id").select("track_id", "playlist_key", "added_at")


def ranked_memberships(memberships: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The ``slots`` most recent playlists of each track, ties by playlist key."""
    order = [F.col("added_at").desc_nulls_last(), F.col("playlist_key").asc_nulls_last()]
    return first_per_key(memberships, ["track_id"], order, keep=slots, rank="playlist_rank")


def track_slots(memberships: DataFrame, slots: int = SLOTS) -> DataFrame:
    """One row per track: its most recent playlists as columns, and how many it is on.

    The count covers all playlists, so it is taken before the ranking cuts off.
    """
    counts = memberships.groupBy("track_id").agg(
        F.countDistinct("playlist_key").alias("playlist_count")
    )
    rank, key = F.col("playlist_rank"), F.col("playlist_key")
    pivoted = (
        ranked_memberships(memberships, slots)
        .groupBy("track_id")
        .agg(*(F.max(F.when(rank == i + 1, key)).alias(n) for i, n in enumerate(slot_names(slots))))
    )
    return pivoted.join(counts, "track_id")


def slots_of_copies(copies: Column, slots: int = SLOTS) -> list[Column]:
    """Slots of a play that is stored ``copies`` times under one id.

    Ranking per play id meets every playlist once per copy, next to each other, so
    slot i holds the playlist of track slot ceil(i / copies).
    """
    names = slot_names(slots)
    held = F.array(*names)
    return [
        F.get(held, F.ceil(F.lit(i + 1) / copies).cast("int") - 1).alias(n)
        for i, n in enumerate(names)
    ]


def playlist_coverage(
    playlists: DataFrame, playlist_tracks: DataFrame, plays: DataFrame, *, exact: bool = False
) -> DataFrame:
    """Per playlist: tracks, played share, play counts, durations and dates.

    The default keeps the numbers of a join with one row per play: a track played n
    times then counts n times, each time with n plays. These sums are computed from
    per-track totals. ``exact=True`` counts every track once.
    """
    owner = ["playlist_id", "playlist_name", "is_owner", "is_public", "is_collaborative"]
    per_track = track_plays(plays)
    n = F.coalesce(F.col("play_count"), F.lit(0))
    weight = F.lit(1) if exact else F.greatest(n, F.lit(1))
    rows = playlist_tracks.select("playlist_id", "track_id", "added_at").join(
        per_track, "track_id", "left"
    )
    track = F.col("track_id")
    totals = rows.groupBy("playlist_id").agg(
        F.countDistinct(track).alias("total_tracks"),
        F.countDistinct(F.when(n > 0, track)).alias("played_tracks"),
        F.countDistinct(F.when(F.col("play_count").isNull(), track)).alias("unplayed_tracks"),
        F.sum(n * weight).alias("total_plays"),
        F.sum(weight).alias("_rows"),
        F.max("play_count").alias("max_plays"),
        F.sum("duration_sum").alias("_ms"),
        F.sum("duration_rows").alias("_ms_rows"),
        F.min("added_at").alias("first_track_added"),
        F.max("added_at").alias("last_track_added"),
        F.min("first_played").alias("first_play_date"),
        F.max("last_played").alias("last_play_date"),
    )
    minutes = F.col("_ms").cast("double") / 1000.0 / 60.0
    mean_minutes = ratio(F.col("_ms"), F.col("_ms_rows")) / 1000.0 / 60.0
    share = F.lit(100.0) * F.col("played_tracks") / F.nullif(F.col("total_tracks").cast("double"), F.lit(0.0))
    return playlists.select(*owner).join(totals, "playlist_id").select(
        *owner,
        "total_tracks",
        "played_tracks",
        "unplayed_tracks",
        round_to(share, 1).alias("played_percentage"),
        "total_plays",
        round_to(ratio(F.col("total_plays"), F.col("_rows")), 2).alias("avg_plays_per_track"),
        "max_plays",
        round_to(minutes, 2).alias("total_duration_minutes"),
        round_to(mean_minutes, 2).alias("avg_track_duration_minutes"),
        "first_track_added",
        "last_track_added",
        "first_play_date",
        "last_play_date",
    )


def plays_per_playlist(plays: DataFrame, memberships: DataFrame) -> DataFrame:
    """How many plays fall on each playlist, and on how many of its tracks."""
    return (
        memberships.join(track_plays(plays).select("track_id", "play_count"), "track_id")
        .groupBy("playlist_key")
        .agg(F.sum("play_count").alias("plays"), F.countDistinct("track_id").alias("tracks"))
    )
