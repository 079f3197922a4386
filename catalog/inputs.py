"""The test tables in the roles of the raw inputs. Every role covers its whole table.

events       API plays, and the export (shifted two weeks back, other track numbers, except
             purchases, which stay as they are and so are present in both sources)
customer     artist records, several versions per artist
supplier     playlists;  lineitem  their entries
embeddings   audio features, several versions per track
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playspan import fixed
from playspan.operators.dedup import align
from playspan.plans import reports, staging, star
from playspan.session import stage
from playspan.sources import schemas


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; zone-less timestamps become ordinary ones."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    naive = [n for n, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in naive}) if naive else df


def text(prefix: str, *parts) -> Column:
    return F.concat(F.lit(prefix), *(p.cast("string") for p in parts))


def raw_plays(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("k")
    events = table(spark, folder, "events").withColumn(
        "k", F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    )
    return events.select(
        F.col("ts").alias("played_at"),
        text("t", k).alias("track_id"),
        text("Track ", k).alias("track_name"),
        text("a", k % 20).alias("artist_id"),
        text("Artist ", k % 20).alias("artist_name"),
        text("l", k % 40).alias("album_id"),
        text("Album ", k % 40).alias("album_name"),
        F.concat((F.lit(1980) + k % 40).cast("string"), F.lit("-06-01")).alias("album_release_date"),
        F.floor(F.col("value") * 1000).cast("int").alias("duration_ms"),
        k.alias("popularity"),
        (k % 2 == 0).alias("explicit"),
        text(fixed.TRACK_URI_PREFIX + "t", k).alias("track_uri"),
        (F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY")).alias("loaded_at"),
        "user_id",
    )


def raw_history(spark: SparkSession, folder: str) -> DataFrame:
    """Key-less: views were loaded a second time a day later with another duration."""
    kind, k, n, user = F.col("event_type"), F.col("k"), F.col("n"), F.col("user_id")
    bought = kind == "purchase"
    numbered = (
        table(spark, folder, "events")
        .withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("int"))
        .withColumn("n", F.when(bought, k).otherwise(k + 20))
    )
    uri = (
        F.when(kind == "signup", text(fixed.EPISODE_URI_PREFIX + "e", k))
        .when((kind == "error") & (k % 10 == 0), F.lit(None))
        .otherwise(text(fixed.TRACK_URI_PREFIX + "t", n))
    )
    first = numbered.select(
        F.when(bought, F.col("ts")).otherwise(F.col("ts") - F.expr("INTERVAL 15 DAYS")).alias("ts"),
        kind.alias("platform"),
        F.floor(F.col("value") * 1000).cast("int").alias("ms_played"),
        text("C", user % 5).alias("conn_country"),
        text("Track ", n).alias("master_metadata_track_name"),
        F.when(n % 20 != 7, text("Artist ", n % 20)).alias("master_metadata_album_artist_name"),
        text("Album ", n % 40).alias("master_metadata_album_album_name"),
        uri.alias(schemas.HISTORY_TRACK_URI),
        F.when(F.col("value") > 100, "clickrow").otherwise("trackdone").alias("reason_start"),
        F.when(F.col("value") > 50, "trackdone").otherwise("fwdbtn").alias("reason_end"),
        (k % 3 == 0).alias("shuffle"),
        (kind == "error").alias("skipped"),
        F.lit(False).alias("offline"),
        F.col("event_id").alias("offline_timestamp"),
        (user % 7 == 0).alias("incognito_mode"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("loaded_at"),
        user.alias("user_id"),
    )
    again = first.filter(F.col("platform") == "view").withColumns(
        {
            "ms_played": F.col("ms_played") + 1,
            "loaded_at": F.col("loaded_at") + F.expr("INTERVAL 1 DAY"),
        }
    )
    return first.unionByName(again)


def raw_artists(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    # nation and region are fixed small tables (25 and 5 rows)
    where = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), "r_name"
    )
    genres = F.when(
        F.col("r_name") != "ASIA", F.concat(F.lower("r_name"), F.lit(","), F.lower("c_mktsegment"))
    )
    hours = F.floor(F.col("c_custkey") / 10)
    return table(spark, folder, "customer").join(where, "c_nationkey").select(
        text("a", F.col("c_nationkey")).alias("artist_id"),
        text("Artist ", F.col("c_nationkey")).alias("artist_name"),
        genres.alias("genres"),
        (F.col("c_custkey") % 101).cast("int").alias("popularity"),
        F.floor("c_acctbal").cast("int").alias("followers"),
        F.timestamp_seconds(F.lit(1704067200) + hours * 3600).alias("loaded_at"),
    )


def raw_playlists(spark: SparkSession, folder: str) -> DataFrame:
    at, nation = F.lit("2024-02-01 06:00:00").cast("timestamp"), F.col("s_nationkey")
    return table(spark, folder, "supplier").select(
        text("p", F.col("s_suppkey")).alias("playlist_id"),
        F.col("s_name").alias("playlist_name"),
        text("u", nation).alias("owner_id"),
        (nation == 0).alias("is_owner"),
        (F.col("s_acctbal") > 0).alias("is_public"),
        (nation % 2 == 1).alias("is_collaborative"),
        (nation * 3).cast("int").alias("total_tracks"),
        F.when(F.col("s_acctbal") >= 0, text("mix ", F.col("s_suppkey"))).alias("description"),
        F.md5("s_name").alias("snapshot_id"),
        at.alias("extracted_at"),
        at.alias("loaded_at"),
    )


def raw_playlist_tracks(spark: SparkSession, folder: str) -> DataFrame:
    # Grouped by the numbers, which are shorter to shuffle than their texts.
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", (F.col("l_partkey") % 120).alias("track"))
        .agg(
            F.min("l_shipdate").alias("added_at"),
            text("u", F.min("l_linenumber")).alias("added_by"),
            F.min("l_quantity").cast("int").alias("position"),
            F.max("l_shipdate").alias("loaded_at"),
        )
        .select(
            text("p", F.col("l_suppkey")).alias("playlist_id"), text("t", F.col("track")).alias("track_id"),
            "added_at", "added_by", "position", "loaded_at",
        )
    )


def raw_features(spark: SparkSession, folder: str) -> DataFrame:
    vec, label = F.col("vec_id"), F.col("label")

    def measure(place: int) -> Column:
        return F.abs(F.element_at("embedding", place).cast("double")) * 5

    return table(spark, folder, "embeddings").select(
        text("t", vec % 120).alias("id"),
        measure(1).alias("danceability"),
        measure(2).alias("energy"),
        label.alias("key"),
        measure(3).alias("loudness"),
        F.when(label == 9, 2).otherwise(label % 2).alias("mode"),
        measure(4).alias("speechiness"),
        measure(5).alias("acousticness"),
        measure(6).alias("instrumentalness"),
        measure(7).alias("liveness"),
        measure(8).alias("valence"),
        measure(9).alias("tempo"),
        (vec * 100).cast("int").alias("duration_ms"),
        F.lit(4).alias("time_signature"),
        F.timestamp_seconds(F.lit(1704067200) + F.floor(vec / 120) * 3600).alias("loaded_at"),
    )


class Models:
    """The models over one folder, each computed when first asked for.

    Marts are tables and are written once per session, as they would be in use. Staging
    models are staged too where several marts read them.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def _make(self, name: str) -> DataFrame:
        if name.startswith("raw_"):
            raw = globals()[name](self.spark, self.folder)
            # derived by grouping here, but a stored table in use
            return stage(raw, name) if name == "raw_playlist_tracks" else raw
        made = getattr(self, f"_{name}")()
        return made if name in VIEWS else stage(made, name)

    def _stg_plays(self):
        return staging.plays(self.raw_plays)

    def _stg_history(self):
        return staging.history(self.raw_history, self.raw_plays)

    def _stg_artists(self):
        return staging.artists(self.raw_artists)

    def _stg_playlists(self):
        return staging.playlists(self.raw_playlists)

    def _stg_playlist_tracks(self):
        return staging.playlist_tracks(self.raw_playlist_tracks)

    def _stg_features(self):
        return staging.audio_features(self.raw_features)

    def _dim_tracks(self):
        return star.dim_tracks(self.stg_plays, self.stg_history)

    def _dim_artists(self):
        return star.dim_artists(self.stg_artists, self.stg_plays, self.stg_history)

    def _dim_albums(self):
        return star.dim_albums(self.stg_plays, self.stg_history)

    def _dim_playlists(self):
        return star.dim_playlists(self.stg_playlists, self.stg_playlist_tracks)

    def _fct_history(self):
        return star.fact_plays(
            self.stg_plays, self.stg_history, self.dim_tracks, self.dim_artists, self.dim_albums,
            self.dim_playlists, self.stg_playlist_tracks,
        )

    def _checked_plays(self):
        return star.checked_plays(self.stg_plays, self.stg_history, self.dim_tracks, self.dim_artists, self.dim_albums)

    def _session_numbers(self):
        return star.session_numbers(self.stg_plays, self.stg_history)

    def _top_artists_daily(self):
        return reports.top_artists_daily(self.fct_history, self.dim_artists, ordered=False)

    def _user_plays(self):
        """Plays of both sources with their user, for orders per user."""
        api = self.raw_plays.select("user_id", "played_at", "track_id")
        exported = self.raw_history.select(
            "user_id", F.col("ts").alias("played_at"),
            F.element_at(F.split(schemas.HISTORY_TRACK_URI, ":"), -1).alias("track_id"),
        )
        both = api.unionByName(align(exported, api)).distinct()
        return both.withColumns(
            {
                "played_date": F.to_date("played_at"),
                "play_id": F.concat_ws("/", "user_id", F.coalesce("track_id", F.lit("-"))),
            }
        )


VIEWS = {"stg_artists", "stg_playlists", "stg_playlist_tracks", "stg_features", "checked_plays", "session_numbers"}

_models: dict[tuple[str, str], Models] = {}


def models(spark: SparkSession, folder: str) -> Models:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _models:
        _models[key] = Models(spark, folder)
    return _models[key]


def forget(name: str | None = None) -> None:
    """Compute all models, or the named one, anew when they are next asked for."""
    if name is None:
        _models.clear()
    for made in _models.values():
        made._made.pop(name, None)
