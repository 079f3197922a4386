"""Build every layer from raw tables and write it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from playspan import fixed
from playspan.operators.playlists import playlist_coverage
from playspan.plans import checks, features, reports, staging, star
from playspan.session import stage
from playspan.sources.tables import publish


def build(raw: Mapping[str, DataFrame], root: str, *, min_play_ms: int = fixed.MIN_PLAY_MS) -> dict[str, DataFrame]:
    """Staging views, dimension and fact tables, reports. Returns all of them by name.

    Staged plays and history feed every dimension and the fact, so they are written once
    instead of being computed for each of them.
    """
    out: dict[str, DataFrame] = {}

    def add(layer: str, name: str, df: DataFrame) -> DataFrame:
        out[name] = publish(df, root, layer, name)
        return out[name]

    plays = add("staging", "stg_plays", stage(staging.plays(raw["raw_plays"], min_play_ms), "stg_plays"))
    history = add(
        "staging", "stg_history",
        stage(staging.history(raw["raw_history"], raw["raw_plays"]), "stg_history"),
    )
    artists = add("staging", "stg_artists", staging.artists(raw["raw_artists"]))
    playlists = add("staging", "stg_playlists", staging.playlists(raw["raw_playlists"]))
    entries = add(
        "staging", "stg_playlist_tracks", staging.playlist_tracks(raw["raw_playlist_tracks"])
    )
    dim_tracks = add("marts", "dim_tracks", star.dim_tracks(plays, history))
    dim_artists = add("marts", "dim_artists", star.dim_artists(artists, plays, history))
    dim_albums = add("marts", "dim_albums", star.dim_albums(plays, history))
    dim_playlists = add("marts", "dim_playlists", star.dim_playlists(playlists, entries))
    fact = add(
        "marts", "fct_history",
        star.fact_plays(plays, history, dim_tracks, dim_artists, dim_albums, dim_playlists, entries),
    )
    add("analytics", "top_artists_daily", reports.top_artists_daily(fact, dim_artists, ordered=False))
    add("analytics", "top_tracks_daily", reports.top_tracks_daily(fact, dim_tracks, ordered=False))
    add("analytics", "listening_patterns_hourly", reports.listening_patterns_hourly(fact, ordered=False))
    add(
        "analytics", "consecutive_listening_daily",
        reports.stamped(reports.consecutive_listening_daily(fact, ordered=False)),
    )
    add(
        "analytics", "playlist_analysis",
        reports.stamped(playlist_coverage(dim_playlists, entries, plays)),
    )
    if "raw_audio_features" in raw:
        measured = add("staging", "stg_audio_features", staging.audio_features(raw["raw_audio_features"]))
        plays_measured = features.measured_plays(plays, measured)
        add("marts", "fct_history_wide", features.wide_history(plays, measured, artists, entries))
        add("marts", "playlist_names", features.playlist_names(entries, playlists))
        add("analytics", "audio_features_daily", features.audio_features_daily(plays_measured))
        add("analytics", "hourly_features", features.hourly_features(plays_measured))
        add("analytics", "playlist_mood", features.playlist_moods(dim_playlists, entries, plays, measured))
    return out


def check(
    tables: Mapping[str, DataFrame], raw: Mapping[str, DataFrame] | None = None, now: Column | None = None
) -> DataFrame:
    """The check report over the tables of ``build``; with ``raw`` tables also their freshness,
    as checks that fail, warn or pass and have the age in whole hours as failures."""
    out = checks.full_report(tables)
    if raw is None:
        return out
    age = checks.freshness_report(raw, F.current_timestamp() if now is None else now)
    status = F.when(F.col("status") == "error", "fail").otherwise(F.col("status"))
    return out.unionByName(
        age.select(
            "table_name", F.lit("freshness").alias("check_name"),
            F.when(status == "pass", 0).otherwise(F.coalesce(F.floor("age_hours"), F.lit(-1))).cast("long").alias("failures"),
            status.alias("status"),
        )
    )
