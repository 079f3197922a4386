"""Landed API pages (nested JSON) to flat rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playspan.sources import schemas
from playspan.sources.landing import BATCH, batch_name


def read_pages(spark: SparkSession, path: str, schema: str, *extra: str) -> DataFrame:
    """JSON lines, one page per line; ``extra`` are further columns as DDL."""
    ddl = ", ".join([schema.strip(), *extra])
    return spark.read.schema(ddl).json(path)


@dataclass(frozen=True)
class Kind:
    """Landed pages of one category: their schema, the list they must have, and their rows."""

    schema: str
    items: str
    flatten: Callable[[DataFrame], DataFrame]
    extra: tuple[str, ...] = ()


def kinds(user_id: str | Column, at: Column) -> dict[str, Kind]:
    """What pages land per category; playlists are those of ``user_id`` as of ``at``."""
    return {
        "plays": Kind(schemas.PLAYS_PAGE, "items", flatten_plays),
        "artists": Kind(schemas.ARTISTS_PAGE, "artists", flatten_artists),
        "playlists": Kind(schemas.PLAYLISTS_PAGE, "items", lambda p: flatten_playlists(p, user_id, at)),
        "playlist_tracks": Kind(
            schemas.PLAYLIST_ITEMS_PAGE, "items", flatten_playlist_tracks, ("playlist_id string", "offset int")
        ),
    }


def read_landed(spark: SparkSession, paths: Sequence[str], category: str, kind: Kind) -> DataFrame:
    """Pages with their batch (``BATCH``); a line that is no page of this kind is in ``_body``."""
    ddl = ", ".join([kind.schema.strip(), *kind.extra, "_body string"])
    read = spark.read.schema(ddl).option("columnNameOfCorruptRecord", "_body").option("recursiveFileLookup", True)
    return read.json(paths).withColumn(BATCH, batch_name(F.col("_metadata.file_path"), category))


def is_broken(kind: Kind) -> Column:
    return F.col("_body").isNotNull() | F.col(kind.items).isNull()


def parse_pages(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Pages held as JSON text in ``column``, next to the other columns."""
    others = [c for c in df.columns if c != column]
    page = F.from_json(F.col(column), f"struct<{_struct_body(schema)}>")
    return df.select(*others, page.alias("_page")).select(*others, "_page.*")


def _struct_body(schema: str) -> str:
    name, _, kind = schema.strip().partition(" ")
    return f"{name}: {kind}"


def _batch(pages: DataFrame) -> list[str]:
    """The batch of a page goes along with its rows, if it is known."""
    return [BATCH] if BATCH in pages.columns else []


def flatten_plays(pages: DataFrame) -> DataFrame:
    """One row per played item with a track that has artists; the first artist counts."""
    track = F.col("item.track")
    lead = F.get(track["artists"], 0)
    rows = pages.select(*_batch(pages), F.explode("items").alias("item"))
    return rows.filter(track.isNotNull() & (F.size(track["artists"]) > 0)).select(
        *_batch(pages),
        F.col("item.played_at").cast("timestamp").alias("played_at"),
        track["id"].alias("track_id"),
        track["name"].alias("track_name"),
        lead["id"].alias("artist_id"),
        lead["name"].alias("artist_name"),
        track["album"]["id"].alias("album_id"),
        track["album"]["name"].alias("album_name"),
        track["album"]["release_date"].alias("album_release_date"),
        track["duration_ms"].alias("duration_ms"),
        track["popularity"].alias("popularity"),
        track["explicit"].alias("explicit"),
        track["uri"].alias("track_uri"),
    )


def flatten_artists(pages: DataFrame) -> DataFrame:
    """One row per artist; genres joined by commas, none is an empty text."""
    artist = F.col("artist")
    genres = F.coalesce(artist["genres"], F.array().cast("array<string>"))
    return (
        pages.select(*_batch(pages), F.explode("artists").alias("artist"))
        .filter(artist.isNotNull())
        .select(
            *_batch(pages),
            artist["id"].alias("artist_id"),
            artist["name"].alias("artist_name"),
            F.array_join(genres, ",").alias("genres"),
            artist["popularity"].alias("popularity"),
            artist["followers"]["total"].alias("followers"),
        )
    )


def flatten_playlists(pages: DataFrame, user_id: str | Column, extracted_at: Column | None = None) -> DataFrame:
    """One row per playlist; ``user_id`` is the user whose playlists were listed."""
    user = F.lit(user_id) if isinstance(user_id, str) else user_id
    item = F.col("item")
    return (
        pages.select(*_batch(pages), F.explode("items").alias("item"))
        .filter(item.isNotNull())
        .select(
            *_batch(pages),
            item["id"].alias("playlist_id"),
            item["name"].alias("playlist_name"),
            item["owner"]["id"].alias("owner_id"),
            (item["owner"]["id"] == user).alias("is_owner"),
            item["public"].alias("is_public"),
            item["collaborative"].alias("is_collaborative"),
            item["tracks"]["total"].alias("total_tracks"),
            F.coalesce(item["description"], F.lit("")).alias("description"),
            F.coalesce(item["snapshot_id"], F.lit("")).alias("snapshot_id"),
            (F.current_timestamp() if extracted_at is None else extracted_at).alias("extracted_at"),
        )
    )


def flatten_playlist_tracks(pages: DataFrame) -> DataFrame:
    """One row per playlist item with a track id. ``pages`` has playlist_id and offset;
    the position is the offset of the page plus the place within the page."""
    item = F.col("item")
    return (
        pages.select(*_batch(pages), "playlist_id", "offset", F.posexplode("items").alias("place", "item"))
        .filter(item["track"]["id"].isNotNull() & (item["track"]["id"] != ""))
        .select(
            *_batch(pages),
            "playlist_id",
            item["track"]["id"].alias("track_id"),
            item["added_at"].cast("timestamp").alias("added_at"),
            item["added_by"]["id"].alias("added_by"),
            (F.col("offset") + F.col("place")).cast("int").alias("position"),
        )
    )


def artist_ids(plays: DataFrame) -> DataFrame:
    """Distinct artist ids of a batch of plays."""
    return plays.select("artist_id").dropna().distinct()
