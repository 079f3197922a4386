"""Staging models: one clean row per play, artist and playlist entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from playspan import fixed
from playspan.functions.calendar import calendar_parts, leading_year
from playspan.functions.keys import (
    hash_key,
    is_track_uri,
    name_based_album_id,
    name_based_artist_id,
    track_id_of,
)
from playspan.functions.labels import mode_label, track_mood
from playspan.operators.dedup import latest_per_key, latest_values
from playspan.sources.schemas import HISTORY_TRACK_URI

# Column order of the staging models
PLAY_COLUMNS = (
    "play_id", "played_at", "track_id", "track_name", "artist_id", "artist_name", "album_id",
    "album_name", "album_release_date", "album_release_year", "duration_ms", "popularity",
    "explicit", "track_uri", "played_date", "played_year", "played_month", "played_day",
    "played_hour", "played_day_of_week", "played_day_name", "loaded_at",
)
HISTORY_COLUMNS = (
    "played_at", "played_date", "platform", "ms_played", "conn_country", "track_id", "track_name",
    "artist_id", "artist_name", "album_id", "album_name", HISTORY_TRACK_URI, "reason_start",
    "reason_end", "shuffle", "skipped", "offline", "incognito_mode", "loaded_at",
)
ARTIST_COLUMNS = ("artist_id", "artist_name", "genres", "popularity", "followers", "loaded_at")
PLAYLIST_COLUMNS = (
    "playlist_id", "playlist_name", "owner_id", "is_owner", "is_public", "is_collaborative",
    "total_tracks", "description", "snapshot_id", "extracted_at", "loaded_at",
)
PLAYLIST_TRACK_COLUMNS = (
    "playlist_id", "track_id", "added_at", "added_by", "position", "loaded_at",
)
PLAY_KEY = ("track_id", "played_at")


def plays(raw: DataFrame, min_play_ms: int = fixed.MIN_PLAY_MS) -> DataFrame:
    """Newest version of each play, if that version is long enough, with calendar columns."""
    newest = latest_per_key(raw, PLAY_KEY).filter(F.col("duration_ms") >= min_play_ms)
    return newest.withColumns(
        {
            "play_id": hash_key(*(F.col(c) for c in PLAY_KEY)),
            "album_release_year": leading_year(F.col("album_release_date")),
            **calendar_parts(F.col("played_at")),
        }
    ).select(*PLAY_COLUMNS)


def artists(raw: DataFrame) -> DataFrame:
    return latest_per_key(raw.select(*ARTIST_COLUMNS), ["artist_id"])


def playlists(raw: DataFrame) -> DataFrame:
    return raw.select(*PLAYLIST_COLUMNS)


def playlist_tracks(raw: DataFrame) -> DataFrame:
    return raw.select(*PLAYLIST_TRACK_COLUMNS)


def known_ids(raw_plays: DataFrame) -> DataFrame:
    """Artist and album id of each track as of its newest play record."""
    return latest_values(
        raw_plays, "track_id", ["artist_id", "album_id"], ["loaded_at", "played_at"]
    )


def history(raw: DataFrame, raw_plays: DataFrame) -> DataFrame:
    """Music plays of the export, newest version each, with artist and album ids taken
    from API plays of the track or else derived from the names.

    Versions are reduced before the lookup, which does not depend on them.
    """
    uri = F.col(HISTORY_TRACK_URI)
    music = raw.filter(is_track_uri(uri)).select(
        F.col("ts").alias("played_at"),
        F.to_date("ts").alias("played_date"),
        track_id_of(uri).alias("track_id"),
        F.col("master_metadata_track_name").alias("track_name"),
        F.col("master_metadata_album_artist_name").alias("artist_name"),
        F.col("master_metadata_album_album_name").alias("album_name"),
        "platform", "ms_played", "conn_country", HISTORY_TRACK_URI, "reason_start",
        "reason_end", "shuffle", "skipped", "offline", "incognito_mode", "loaded_at",
    )
    newest = latest_per_key(music, PLAY_KEY)
    return with_ids(newest, known_ids(raw_plays)).select(*HISTORY_COLUMNS)


def with_ids(named: DataFrame, ids: DataFrame) -> DataFrame:
    """Left lookup by track; unknown ids fall back to hashes of the names."""
    found = named.join(ids, "track_id", "left")
    return found.withColumns(
        {
            "artist_id": F.coalesce("artist_id", name_based_artist_id(F.col("artist_name"))),
            "album_id": F.coalesce("album_id", name_based_album_id(F.col("album_name"))),
        }
    )


def audio_features(raw: DataFrame) -> DataFrame:
    """Newest measures of each track with names for mode and mood."""
    newest = latest_per_key(raw, ["id"])
    return newest.select(
        F.col("id").alias("track_id"),
        "danceability", "energy", "key", "loudness", "mode",
        mode_label(F.col("mode")).alias("mode_name"),
        "speechiness", "acousticness", "instrumentalness", "liveness", "valence", "tempo",
        "duration_ms", "time_signature",
        track_mood(F.col("valence"), F.col("energy")).alias("mood_category"),
        "loaded_at",
    )
