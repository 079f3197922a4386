"""Daily and hourly reports over the fact table.

Rows are reduced to the grain of the report before dimension attributes are joined;
a dimension key determines its attributes, so grouping by them adds nothing.
Sorted results use NULLS LAST and end with a key, so that the order is total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from playspan.functions.calendar import minutes_between
from playspan.functions.numbers import minutes_of, ratio, round_to


def top_artists_daily(fact: DataFrame, artists: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Plays and listening time per day and artist."""
    daily = fact.groupBy("played_date", "artist_key").agg(
        F.count("*").alias("play_count"),
        F.countDistinct("track_key").alias("unique_tracks_played"),
        F.sum("duration_ms").alias("total_listen_time_ms"),
        F.avg("track_popularity").alias("avg_track_popularity"),
    )
    return artists_of_days(daily, artists, ordered=ordered)


def artists_of_days(daily: DataFrame, artists: DataFrame, *, ordered: bool = True) -> DataFrame:
    """The report from totals per day and artist key."""
    about = artists.select(
        "artist_key", "artist_id", "artist_name",
        F.col("genres").alias("artist_genres"),
        F.col("followers").alias("artist_followers"),
    )
    out = daily.join(about, "artist_key", "left").select(
        "played_date", "artist_key", "artist_id", "artist_name", "artist_genres", "play_count",
        "unique_tracks_played", "total_listen_time_ms",
        round_to(minutes_of(F.col("total_listen_time_ms")), 2).alias("total_listen_time_minutes"),
        "avg_track_popularity", "artist_followers",
    )
    return by_day_and_plays(out, "artist_key") if ordered else out


def top_tracks_daily(fact: DataFrame, tracks: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Plays per day and track, with the first day the track was played."""
    daily = fact.groupBy("played_date", "track_key").agg(
        F.count("*").alias("play_count"),
        F.max("track_popularity").alias("track_popularity"),
        F.max("duration_ms").alias("duration_ms"),
        F.max("explicit").alias("explicit"),
    )
    return tracks_of_days(daily, tracks, ordered=ordered)


def tracks_of_days(daily: DataFrame, tracks: DataFrame, *, ordered: bool = True) -> DataFrame:
    """The report from totals per day and track key, of all days."""
    about = tracks.select("track_key", "track_id", "track_name", "artist_name", "album_name")
    out = with_first_date(daily, "track_key").join(about, "track_key", "left").select(
        "played_date", "track_key", "track_id", "track_name", "artist_name", "album_name",
        "play_count", "track_popularity", "duration_ms", "first_played_date", "explicit",
    )
    return by_day_and_plays(out, "track_key") if ordered else out


def with_first_date(daily: DataFrame, key: str) -> DataFrame:
    """First date per key over rows that are one per key and date already."""
    first = F.min("played_date").over(Window.partitionBy(key))
    return daily.withColumn("first_played_date", first)


def by_day_and_plays(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(
        F.col("played_date").desc_nulls_last(),
        F.col("play_count").desc_nulls_last(),
        F.col(key).asc_nulls_last(),
    )


HOUR_GRAIN = (
    "played_date", "played_hour_cst", "played_hour_utc", "played_day_of_week", "played_day_name",
)


def listening_patterns_hourly(fact: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Volume per UTC day and hour; the local hour is shown next to the UTC date.

    Plays are reduced to (hour, track, artist) first, for two distinct counts at once.
    """
    reduced = fact.groupBy(*HOUR_GRAIN, "track_key", "artist_key").agg(
        F.count("*").alias("n"), F.sum("duration_ms").alias("ms")
    )
    return hours_of_days(reduced, ordered=ordered)


def hours_of_days(reduced: DataFrame, *, ordered: bool = True) -> DataFrame:
    """The report from plays (n) and listening time (ms) per hour, track and artist."""
    hourly = reduced.groupBy(*HOUR_GRAIN).agg(
        F.sum("n").alias("play_count"),
        F.countDistinct("track_key").alias("unique_tracks"),
        F.countDistinct("artist_key").alias("unique_artists"),
        F.sum("ms").alias("total_listen_time_ms"),
    )
    out = hourly.withColumn(
        "total_listen_time_minutes", round_to(minutes_of(F.col("total_listen_time_ms")), 2)
    )
    if not ordered:
        return out
    return out.orderBy(
        F.col("played_date").desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in HOUR_GRAIN[1:])
    )


def consecutive_listening_daily(fact: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Sessions per day: songs, minutes and length.

    Minutes are rounded per session before they are added up, as whole hundredths, so the
    result does not depend on the order of the additions.
    """
    return sessions_of_days(session_totals(fact), ordered=ordered)


def session_totals(fact: DataFrame) -> DataFrame:
    """Songs, whole hundredths of minutes, start and end of the sessions of each day."""
    return (
        fact.groupBy("played_date", "session_number")
        .agg(
            F.count("*").alias("songs"),
            F.sum("duration_ms").alias("ms"),
            F.min("played_at").alias("start"),
            F.max("played_at").alias("end"),
        )
        .withColumn("hundredths", F.round(minutes_of(F.col("ms")) * 100.0, 0).cast("long"))
    )


def sessions_of_days(sessions: DataFrame, *, ordered: bool = True) -> DataFrame:
    """The report from the totals of sessions."""
    sessions = sessions.withColumn("length", minutes_between(F.col("start"), F.col("end")))
    days = sessions.groupBy("played_date").agg(
        F.countDistinct("session_number").alias("total_sessions"),
        F.sum("songs").alias("total_consecutive_songs"),
        F.max("songs").alias("max_consecutive_songs"),
        F.count("*").alias("_rows"),
        F.sum("hundredths").alias("_hundredths"),
        F.count("hundredths").alias("_timed"),
        F.max("hundredths").alias("_most"),
        F.max("length").alias("_longest"),
        F.min("start").alias("first_session_start"),
        F.max("end").alias("last_session_end"),
    )
    total = F.col("_hundredths").cast("double") / 100.0
    out = days.select(
        "played_date",
        "total_sessions",
        "total_consecutive_songs",
        "max_consecutive_songs",
        round_to(ratio(F.col("total_consecutive_songs"), F.col("_rows")), 2).alias(
            "avg_consecutive_songs_per_session"
        ),
        total.alias("total_consecutive_time_minutes"),
        (F.col("_most").cast("double") / 100.0).alias("max_consecutive_time_minutes"),
        round_to(ratio(total, F.col("_timed")), 2).alias("avg_consecutive_time_minutes"),
        round_to(F.col("_longest"), 2).alias("longest_session_length_minutes"),
        round_to(ratio(total, F.col("total_sessions")), 2).alias("avg_time_per_session_minutes"),
        "first_session_start",
        "last_session_end",
    )
    return out.orderBy(F.col("played_date").desc_nulls_last()) if ordered else out


def playlist_order(df: DataFrame) -> DataFrame:
    return df.orderBy(
        F.col("total_plays").desc_nulls_last(),
        F.col("total_tracks").desc_nulls_last(),
        F.col("playlist_id").asc_nulls_last(),
    )


def stamped(report: DataFrame) -> DataFrame:
    """Reports carry the time they were computed."""
    return report.withColumn("analyzed_at", F.current_timestamp())
