"""Checks declared for the models, and the freshness limits of raw tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from playspan import fixed
from playspan.operators import quality
from playspan.operators.quality import TableChecks

PERCENT = (0, 100)
COUNT = (0, None)

# Declared checks per model
DECLARED = {
    "stg_plays": TableChecks(
        unique=("play_id",),
        not_null=("play_id", "played_at", "track_id", "duration_ms"),
        ranges={"popularity": PERCENT},
    ),
    "stg_artists": TableChecks(
        unique=("artist_id",),
        not_null=("artist_id",),
        ranges={"popularity": PERCENT, "followers": COUNT},
    ),
    "stg_playlists": TableChecks(unique=("playlist_id",), not_null=("playlist_id",)),
    "stg_playlist_tracks": TableChecks(not_null=("playlist_id", "track_id")),
    "stg_history": TableChecks(
        not_null=(
            "played_at", "platform", "ms_played", "conn_country", "track_name", "artist_name",
            "album_name",
        ),
        ranges={"ms_played": (0, fixed.MAX_STAGED_MS)},
    ),
    "fct_history": TableChecks(
        unique=("play_id",),
        not_null=("play_id", "played_at", "track_key", "artist_key", "album_key", "data_source"),
        ranges={
            "played_hour_utc": (0, 23),
            "played_hour_cst": (0, 23),
            "played_day_of_week": (0, 6),
            "track_popularity": PERCENT,
        },
        accepted={"data_source": (fixed.SOURCE_API, fixed.SOURCE_EXPORT)},
        parents={
            "track_key": ("dim_tracks", "track_key"),
            "artist_key": ("dim_artists", "artist_key"),
            "album_key": ("dim_albums", "album_key"),
        },
    ),
    "dim_tracks": TableChecks(
        unique=("track_id",),
        not_null=("track_id",),
        ranges={"popularity": PERCENT, "total_plays": COUNT},
    ),
    "dim_artists": TableChecks(
        unique=("artist_key", "artist_id"),
        not_null=("artist_key", "artist_id", "artist_name"),
        ranges={"popularity": PERCENT, "followers": COUNT, "total_plays": COUNT},
    ),
    "dim_albums": TableChecks(
        unique=("album_key", "album_id"),
        not_null=("album_key", "album_id", "album_name", "artist_id", "artist_name"),
        ranges={"total_plays": COUNT},
    ),
    "dim_playlists": TableChecks(
        unique=("playlist_key", "playlist_sk", "playlist_id"),
        not_null=("playlist_key", "playlist_sk", "playlist_id", "playlist_name"),
    ),
}

# Hours after which a raw table is stale (None: loaded once)
FRESHNESS = {
    "raw_plays": fixed.FRESHNESS_PLAYS_HOURS,
    "raw_artists": fixed.FRESHNESS_DEFAULT_HOURS,
    "raw_playlists": fixed.FRESHNESS_DEFAULT_HOURS,
    "raw_playlist_tracks": fixed.FRESHNESS_DEFAULT_HOURS,
    "raw_history": (None, None),
}


def out_of_bounds(fact: DataFrame) -> DataFrame:
    """Plays with a negative duration or one over the limit."""
    bad = quality.out_of_range(F.col("duration_ms"), 0, fixed.MAX_PLAY_MS)
    return fact.filter(bad).select("play_id", "track_key", "duration_ms")


def without_plays(daily: DataFrame) -> DataFrame:
    return daily.filter(F.col("play_count") <= 0).select("played_date", "play_count")


def repeated_events(fact: DataFrame) -> DataFrame:
    return quality.duplicates(fact, ["track_key", "played_at"], "play_count", skip_null=False)


def special_checks(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Violating rows of the checks that span tables or need an order, by name.

    The numbers of sessions are those of ``session_numbers`` if it is among the tables, and of
    the fact otherwise.
    """
    fact = tables["fct_history"]
    return {
        "counts_match": quality.count_differences(fact, tables["dim_artists"], "artist_key"),
        "ids_are_valid": quality.malformed_ids(tables["stg_history"]),
        "positive_play_count": without_plays(tables["top_artists_daily"]),
        "sessions_are_sequential": quality.sequence_gaps(tables.get("session_numbers", fact)),
    }


def full_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Declared and special checks, one row each.

    Special checks that look at rows or keys of the fact share the scans of its declared ones.
    """
    bad_duration = quality.out_of_range(F.col("duration_ms"), 0, fixed.MAX_PLAY_MS)
    out = quality.report(
        tables, DECLARED,
        {"fct_history": {("special", "valid_duration"): bad_duration}},
        {"fct_history": {("special", "no_duplicate_plays"): ("track_key", "played_at")}},
    )
    for name, bad in special_checks(tables).items():
        out = out.unionByName(quality.with_status(quality.violations(bad, "special", name)))
    return out


def freshness_report(tables: Mapping[str, DataFrame], now: Column) -> DataFrame:
    out = None
    for name, (warn, error) in FRESHNESS.items():
        row = quality.freshness(tables[name], now, warn, error).select(
            F.lit(name).alias("table_name"), "newest", "age_hours", "status"
        )
        out = row if out is None else out.unionByName(row)
    return out
