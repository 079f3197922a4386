"""Schemas of files and raw tables."""

from __future__ import annotations

# Columns of the landing files and raw tables

PLAYS_FILE = """
    played_at timestamp, track_id string, track_name string, artist_id string, artist_name string,
    album_id string, album_name string, album_release_date string, duration_ms int,
    popularity int, explicit boolean, track_uri string
"""
ARTISTS_FILE = """
    artist_id string, artist_name string, genres string, popularity int, followers int
"""
PLAYLISTS_FILE = """
    playlist_id string, playlist_name string, owner_id string, is_owner boolean,
    is_public boolean, is_collaborative boolean, total_tracks int, description string,
    snapshot_id string, extracted_at timestamp
"""
PLAYLIST_TRACKS_FILE = """
    playlist_id string, track_id string, added_at timestamp, added_by string, position int
"""
HISTORY_RECORD = """
    ts timestamp, platform string, ms_played int, conn_country string, ip_addr string,
    master_metadata_track_name string, master_metadata_album_artist_name string,
    master_metadata_album_album_name string, spotify_track_uri string, episode_name string,
    episode_show_name string, spotify_episode_uri string, audiobook_title string,
    audiobook_uri string, audiobook_chapter_uri string, audiobook_chapter_title string,
    reason_start string, reason_end string, shuffle boolean, skipped boolean, offline boolean,
    offline_timestamp bigint, incognito_mode boolean
"""
EXPORTED_PLAYS = """
    played_at timestamp, track_id string, track_name string, artist_name string,
    album_name string, duration_ms int, track_uri string
"""
AUDIO_FEATURES = """
    id string, danceability double, energy double, key int, loudness double, mode int,
    speechiness double, acousticness double, instrumentalness double, liveness double,
    valence double, tempo double, duration_ms int, time_signature int
"""
HISTORY_TRACK_URI = "spotify_track_uri"

# Keys of the raw tables
TABLE_KEYS = {
    "raw_plays": ("track_id", "played_at"),
    "raw_artists": ("artist_id",),
    "raw_playlists": ("playlist_id",),
    "raw_playlist_tracks": ("playlist_id", "track_id"),
    "raw_exported_plays": ("track_id", "played_at"),
    "raw_audio_features": ("id",),
}

# Shape of the API pages, as far as fields are read
PLAYS_PAGE = """
    items array<struct<
        played_at: string,
        track: struct<
            id: string, name: string, uri: string, duration_ms: int, popularity: int,
            explicit: boolean,
            artists: array<struct<id: string, name: string>>,
            album: struct<id: string, name: string, release_date: string>>>>
"""
ARTISTS_PAGE = """
    artists array<struct<
        id: string, name: string, genres: array<string>, popularity: int,
        followers: struct<total: int>>>
"""
PLAYLISTS_PAGE = """
    items array<struct<
        id: string, name: string, description: string, snapshot_id: string, public: boolean,
        collaborative: boolean, owner: struct<id: string>, tracks: struct<total: int>>>
"""
PLAYLIST_ITEMS_PAGE = """
    items array<struct<
        added_at: string, added_by: struct<id: string>, track: struct<id: string>>>
"""


def with_loaded_at(schema: str) -> str:
    return f"{schema.rstrip()}, loaded_at timestamp"
