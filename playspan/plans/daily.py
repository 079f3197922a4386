"""Daily reports kept up to date day by day.

Kept are reduced plays: one row per day, hour, track and artist, and one per session, in
folders by day. When plays come late, the days they touch are reduced again from their plays
and their folders are replaced; other days are not read. Reports are made from the reduced
rows, which are far fewer than plays, and from the dimensions as they are now.

A session never goes over midnight, so the sessions of a day depend on its plays only. Ids are
kept and not surrogate keys, since a new track moves the keys of others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from playspan.functions.calendar import local_time
from playspan.operators.sessions import number_plays
from playspan.plans import reports
from playspan.session import scratch_scope, stage

PLAYS = (
    "played_date date, played_hour_cst long, played_hour_utc long, played_day_of_week long, played_day_name string,"
    " track_id string, artist_id string, n long, ms long, longest int, popularity long, n_popularity long,"
    " most_popular int, explicit boolean"
)
SESSIONS = "played_date date, session_number long, songs long, ms long, start timestamp, end timestamp, hundredths long"
# Plays of one time are in one session in whatever order, so ids need not be carried along.
ORDERED = ("played_at", "played_date", "track_id", "duration_ms")
NEEDED = (
    *ORDERED, "played_hour", "played_day_of_week", "played_day_name", "artist_id", "track_popularity", "explicit",
)


def touched_days(new_plays: DataFrame, ids_before: DataFrame, ids_after: DataFrame, history: DataFrame) -> DataFrame:
    """Days to refresh when ``new_plays`` of the API were added: theirs, and those on which the
    export has plays of tracks whose artist or album is known better now."""
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ids_after.columns]
    same = on[0] & on[1] & on[2]
    changed = ids_after.alias("a").join(ids_before.alias("b"), same, "left_anti").select("track_id")
    days = history.join(changed, "track_id", "left_semi").select("played_date")
    return days.union(new_plays.select(F.to_date("played_at"))).distinct()


def refresh(plays: DataFrame, root: str, days: DataFrame | None = None, kept: tuple[str, ...] = ("plays", "sessions")) -> None:
    """Reduce the plays of ``days`` (all, if None) and replace what is kept of these days.

    ``plays`` are those of both sources (``star.all_plays``). A day without plays any more is
    kept as empty. ``kept`` limits it to the reduced rows that the wanted reports read.
    """
    spark = plays.sparkSession
    with scratch_scope(spark, "refresh"):
        if days is not None:
            touched = [r[0] for r in days.collect()]  # dates
            if not touched:
                return
            of_day = F.col("played_date").isin([d for d in touched if d is not None])
            plays = plays.filter(of_day | F.col("played_date").isNull() if None in touched else of_day)
            emptied = spark.createDataFrame([(d,) for d in touched], "played_date date")
        # Only what is reduced is written, and only what sessions need is dealt in ranges.
        plays = stage(plays.select(*NEEDED), "plays")
        local = local_time(F.col("played_at"))
        reduced = (
            plays.withColumns({"played_hour_utc": F.col("played_hour"), "played_hour_cst": F.hour(local).cast("long")})
            .groupBy(*reports.HOUR_GRAIN, "track_id", "artist_id")
            .agg(
                F.count("*").alias("n"), F.sum("duration_ms").alias("ms"), F.max("duration_ms").alias("longest"),
                F.sum("track_popularity").alias("popularity"), F.count("track_popularity").alias("n_popularity"),
                F.max("track_popularity").alias("most_popular"), F.max("explicit").alias("explicit"),
            )
        )
        written = [("plays", reduced, PLAYS)] if "plays" in kept else []
        if "sessions" in kept:
            numbered = number_plays(plays.select(*ORDERED), ties=("track_id", "duration_ms"), staged=True)
            written.append(("sessions", reports.session_totals(numbered), SESSIONS))
        for name, rows, schema in written:
            if days is not None:
                rows = rows.unionByName(emptied, allowMissingColumns=True)
            (
                rows.select(*spark.createDataFrame([], schema).columns)
                .hint("rebalance", "played_date")
                .write.mode("overwrite").option("partitionOverwriteMode", "static" if days is None else "dynamic")
                .partitionBy("played_date").parquet(f"{root}/{name}")
            )


def _kept(spark: SparkSession, root: str, name: str, schema: str, counted: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/{name}").filter(F.col(counted) > 0)


def _with_keys(spark: SparkSession, root: str, tracks: DataFrame, artists: DataFrame) -> DataFrame:
    reduced = _kept(spark, root, "plays", PLAYS, "n")
    keyed = reduced.join(tracks.select("track_id", "track_key"), "track_id", "left")
    return keyed.join(artists.select("artist_id", "artist_key"), "artist_id", "left")


def top_artists(root: str, tracks: DataFrame, artists: DataFrame, *, ordered: bool = True) -> DataFrame:
    n = F.sum("n_popularity")
    daily = _with_keys(artists.sparkSession, root, tracks, artists).groupBy("played_date", "artist_key").agg(
        F.sum("n").alias("play_count"), F.countDistinct("track_key").alias("unique_tracks_played"),
        F.sum("ms").alias("total_listen_time_ms"),
        (F.sum("popularity").cast("double") / F.when(n > 0, n)).alias("avg_track_popularity"),
    )
    return reports.artists_of_days(daily, artists, ordered=ordered)


def top_tracks(root: str, tracks: DataFrame, artists: DataFrame, *, ordered: bool = True) -> DataFrame:
    daily = _with_keys(artists.sparkSession, root, tracks, artists).groupBy("played_date", "track_key").agg(
        F.sum("n").alias("play_count"), F.max("most_popular").alias("track_popularity"),
        F.max("longest").alias("duration_ms"), F.max("explicit").alias("explicit"),
    )
    return reports.tracks_of_days(daily, tracks, ordered=ordered)


def patterns(root: str, tracks: DataFrame, artists: DataFrame, *, ordered: bool = True) -> DataFrame:
    return reports.hours_of_days(_with_keys(artists.sparkSession, root, tracks, artists), ordered=ordered)


def sessions(spark: SparkSession, root: str, *, ordered: bool = True) -> DataFrame:
    return reports.sessions_of_days(_kept(spark, root, "sessions", SESSIONS, "songs"), ordered=ordered)
