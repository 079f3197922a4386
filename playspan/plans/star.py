"""Star schema: dimensions with dense keys, and the fact table of plays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from playspan import fixed
from playspan.functions.calendar import calendar_parts, local_time, weekday_name
from playspan.functions.keys import hash_key
from playspan.functions.numbers import hours_of, round_to
from playspan.operators.dedup import align, first_per_key, latest_per_key, prefer_present
from playspan.operators.ordered import dense_key
from playspan.operators.playlists import slot_names, slots_of_copies, track_memberships, track_slots
from playspan.operators.sessions import number_plays
from playspan.operators.stats import entity_stats, playlist_stats, with_stats
from playspan.session import stage
from playspan.sources.schemas import HISTORY_TRACK_URI

TRACK_COLUMNS = (
    "track_id", "track_name", "artist_id", "artist_name", "album_id", "album_name",
    "album_release_date", "album_release_year", "duration_ms", "popularity", "explicit",
)
ALBUM_COLUMNS = ("album_id", "album_name", "artist_id", "artist_name")

# Column order of the fact table
FACT_COLUMNS = (
    "play_id", "played_at", "played_at_cst", "played_date", "played_year", "played_month",
    "played_day", "played_hour_utc", "played_hour_cst", "played_day_of_week", "played_day_name",
    "played_day_name_cst", "track_key", "artist_key", "album_key", "playlist_key_1",
    "playlist_key_2", "playlist_key_3", "playlist_key_4", "playlist_key_5", "playlist_count",
    "duration_ms", "track_popularity", "explicit", "track_uri", "prev_track_key",
    "prev_artist_key", "minutes_since_prev_play", "is_new_session", "session_number",
    "is_repeat", "repeat_sequence", "data_source", "platform", "conn_country", "shuffle",
    "skipped", "reason_start", "reason_end", "loaded_at",
)


def history_as_plays(history: DataFrame) -> DataFrame:
    """Export plays under the column names of API plays."""
    return history.withColumnRenamed("ms_played", "duration_ms")


def both_sources(plays: DataFrame, history: DataFrame, columns: tuple[str, ...], key: str) -> DataFrame:
    """``columns`` of all plays; export rows need a ``key``, and lack what only the API has."""
    api = plays.select(*columns)
    exported = history_as_plays(history).filter(F.col(key).isNotNull())
    return api.unionByName(align(exported, api))


STATS_INPUT = ("track_id", "played_at", "played_date", "duration_ms")


def _stats(plays: DataFrame, history: DataFrame, key: str) -> DataFrame:
    columns = tuple(dict.fromkeys([key, *STATS_INPUT]))
    return entity_stats(both_sources(plays, history, columns, key), key)


def dim_tracks(plays: DataFrame, history: DataFrame) -> DataFrame:
    """Tracks as of their newest record of either source, with play totals."""
    versions = both_sources(plays, history, (*TRACK_COLUMNS, "loaded_at"), "track_id")
    newest = latest_per_key(versions, ["track_id"]).drop("loaded_at")
    stats = _stats(plays, history, "track_id").select(
        "track_id", "total_plays", "first_played_at", "last_played_at", "days_played"
    )
    return dense_key(
        with_stats(newest, stats, "track_id", ["total_plays", "days_played"]), "track_id", "track_key"
    )


def dim_albums(plays: DataFrame, history: DataFrame) -> DataFrame:
    versions = both_sources(plays, history, (*ALBUM_COLUMNS, "loaded_at"), "album_id")
    newest = latest_per_key(versions, ["album_id"]).drop("loaded_at")
    counts = ["total_plays", "unique_tracks_played", "days_played"]
    stats = _stats(plays, history, "album_id").select(
        "album_id", *counts, "first_played_at", "last_played_at"
    )
    return dense_key(with_stats(newest, stats, "album_id", counts), "album_id", "album_key")


def dim_artists(artists: DataFrame, plays: DataFrame, history: DataFrame) -> DataFrame:
    """Artists from the API, or by name from the export; rows with genres are preferred."""
    described = artists.select("artist_id", "artist_name", "genres", "popularity", "followers")
    named = history.filter(F.col("artist_id").isNotNull()).select("artist_id", "artist_name").distinct()
    best = prefer_present(described.unionByName(align(named, described)), ["artist_id"], "genres")
    counts = ["total_plays", "unique_tracks_played", "days_played", "total_listen_time_ms"]
    full = with_stats(best, _stats(plays, history, "artist_id"), "artist_id", counts)
    shown = full.withColumn(
        "total_listen_time_hours", round_to(hours_of(F.col("total_listen_time_ms")), 2)
    ).select(
        *described.columns, *counts[:3], "first_played_at", "last_played_at",
        "total_listen_time_hours",
    )
    return dense_key(shown, "artist_id", "artist_key")


def dim_playlists(playlists: DataFrame, playlist_tracks: DataFrame, updated_at=None) -> DataFrame:
    """Current state of each playlist, with counts of the tracks seen on it."""
    full = with_stats(playlists, playlist_stats(playlist_tracks), "playlist_id", ["actual_track_count"])
    shown = full.select(
        F.md5("playlist_id").alias("playlist_sk"),
        "playlist_id", "playlist_name", "owner_id", "is_owner", "is_public", "is_collaborative",
        F.col("total_tracks").alias("reported_track_count"),
        "actual_track_count", "description", "first_track_added", "last_track_added",
        "snapshot_id", "extracted_at",
        (F.current_timestamp() if updated_at is None else updated_at).alias("dbt_updated_at"),
    )
    return dense_key(shown, "playlist_id", "playlist_key")


PLAY_IDS = ("track_id", "artist_id", "album_id")


def all_plays(plays: DataFrame, history: DataFrame) -> DataFrame:
    """Plays of both sources under one set of columns, tagged with their source."""
    calendar = tuple(calendar_parts(F.col("played_at")))
    shared = (
        "play_id", "played_at", *calendar, *PLAY_IDS, "duration_ms", "track_uri", "loaded_at",
    )
    text, flag = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    api = plays.select(
        *shared,
        F.col("popularity").alias("track_popularity"),
        "explicit",
        F.lit(fixed.SOURCE_API).alias("data_source"),
        *(text.alias(c) for c in ("platform", "conn_country", "reason_start", "reason_end")),
        *(flag.alias(c) for c in ("shuffle", "skipped")),
    )
    exported = (
        history_as_plays(history)
        .filter(F.col("track_id").isNotNull())
        .withColumnRenamed(HISTORY_TRACK_URI, "track_uri")
        .withColumns(
            {
                "play_id": hash_key(F.col("track_id"), F.col("played_at")),
                **calendar_parts(F.col("played_at")),
                "data_source": F.lit(fixed.SOURCE_EXPORT),
            }
        )
    )
    return api.unionByName(align(exported, api))


def one_per_play(plays: DataFrame) -> DataFrame:
    """Plays present in both sources once, as told by the API."""
    return first_per_key(plays, ["play_id"], [F.col("data_source").asc()])


def with_dimension_keys(plays: DataFrame, tracks, artists, albums, slots: DataFrame | None = None) -> DataFrame:
    """Plays with the keys of all dimensions and, with ``slots``, the playlists of their track.

    The keys are looked up once per distinct combination of ids, and only that result is
    joined to the plays: one join of the full table instead of four.
    """
    combinations = plays.select(*PLAY_IDS).distinct()
    looked_up = combinations.join(tracks.select("track_id", "track_key"), "track_id", "left")
    if slots is not None:
        looked_up = looked_up.join(slots, "track_id", "left")
    looked_up = (
        looked_up.join(artists.select("artist_id", "artist_key"), "artist_id", "left")
        .join(albums.select("album_id", "album_key"), "album_id", "left")
    )
    # As a table its real size is known, so it is broadcast only if it is small enough.
    looked_up = stage(looked_up, "keys")
    on = F.lit(True)
    for c in PLAY_IDS:
        on = on & F.col(f"p.{c}").eqNullSafe(F.col(f"k.{c}"))
    added = [c for c in looked_up.columns if c not in PLAY_IDS]
    return (
        plays.alias("p")
        .join(looked_up.alias("k"), on, "left")
        .select("p.*", *(f"k.{c}" for c in added))
    )


def plays_of_tracks(plays: DataFrame, history: DataFrame, tracks: DataFrame) -> DataFrame:
    """The rows of the fact for reports that need neither its order nor its other keys."""
    shown = ("played_date", "duration_ms", "track_popularity", "explicit")
    union = all_plays(plays, history).select("track_id", *shown)
    keys = tracks.select("track_id", "track_key")
    return union.join(keys, "track_id", "left").select("track_key", *shown)


def checked_plays(plays: DataFrame, history: DataFrame, tracks: DataFrame, artists: DataFrame, albums: DataFrame) -> DataFrame:
    """The rows of the fact with what checks and totals per day read of them: they need neither
    its order nor its playlists, so nothing is sorted and no wide row is written."""
    shown = (
        "play_id", "played_at", "played_date", "played_hour", "played_day_of_week", *PLAY_IDS, "duration_ms",
        "track_popularity", "data_source",
    )
    keyed = with_dimension_keys(all_plays(plays, history).select(*shown), tracks, artists, albums)
    return keyed.withColumns(
        {
            "played_hour_utc": F.col("played_hour"),
            "played_hour_cst": F.hour(local_time(F.col("played_at"))).cast("long"),
        }
    ).drop("played_hour", *PLAY_IDS)


def session_numbers(plays: DataFrame, history: DataFrame, **numbering) -> DataFrame:
    """The session numbers of the fact, a row per play. ``plays`` and ``history`` are written tables.

    Plays of one time are in one session in whatever order, so ids need not be carried along.
    """
    slim = all_plays(plays, history).select("played_at", "played_date", "track_id")
    return number_plays(slim, ties=("track_id",), staged=True, **numbering).select("session_number")


def fact_plays(
    plays: DataFrame,
    history: DataFrame,
    tracks: DataFrame,
    artists: DataFrame,
    albums: DataFrame,
    playlists: DataFrame,
    playlist_tracks: DataFrame,
    *,
    dedup_sources: bool = False,
    **numbering,
) -> DataFrame:
    """One row per play and source: calendar, dimension keys, playlists, sessions, repeats.

    A play that is in both sources has two rows with the same play_id unless
    ``dedup_sources`` is set. ``numbering`` goes to ``number_plays``.
    """
    union = all_plays(plays, history)
    if dedup_sources:
        union = one_per_play(union)
    slots = track_slots(track_memberships(playlist_tracks, playlists))
    keyed = with_dimension_keys(union, tracks, artists, albums, slots)
    keyed = stage(keyed.withColumn("_row", F.monotonically_increasing_id()), "fact")
    by = list(numbering.get("by", ()))
    # Only what numbering needs is dealt in ranges and sorted; wide rows are written once
    # and meet their numbers by the row number written with them.
    slim = ["_row", "play_id", "data_source", "played_at", "played_date", "track_id", "track_key", "artist_key"]
    slim += [c for c in by if c not in slim]
    numbers = number_plays(
        keyed.select(*slim),
        ties=("play_id", "data_source"),
        carry=("track_key", "artist_key"),
        staged=True,
        copies="_copies",
        **numbering,
    )
    numbered = keyed.join(numbers.select("_row", *(c for c in numbers.columns if c not in slim)), "_row")
    local = local_time(F.col("played_at"))
    shown = numbered.withColumns(
        {
            **dict(zip(slot_names(), slots_of_copies(F.col("_copies")))),
            "playlist_count": F.coalesce("playlist_count", F.lit(0)),
            "played_at_cst": local,
            "played_hour_utc": F.col("played_hour"),
            "played_hour_cst": F.hour(local).cast("long"),
            "played_day_name_cst": weekday_name(local),
        }
    )
    extra = [c for c in by if c not in FACT_COLUMNS]
    return shown.select(*FACT_COLUMNS, *extra)
