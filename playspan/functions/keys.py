"""Ids and hash keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from playspan import fixed


def hash_key(*parts: Column) -> Column:
    """md5 over the text of all parts; NULL parts take part as a marker."""
    texts = [F.coalesce(p.cast("string"), F.lit(fixed.SURROGATE_NULL_TEXT)) for p in parts]
    return F.md5(F.concat_ws(fixed.SURROGATE_SEPARATOR, *texts))


def name_based_id(name: Column, prefix: str, length: int) -> Column:
    """Stable id for an entity known by name only."""
    digest = F.md5(F.coalesce(name, F.lit(fixed.UNKNOWN_NAME)))
    return F.concat(F.lit(prefix), F.substring(digest, 1, length))


def name_based_artist_id(name: Column) -> Column:
    return name_based_id(name, fixed.ARTIST_FALLBACK_PREFIX, fixed.ARTIST_FALLBACK_LENGTH)


def name_based_album_id(name: Column) -> Column:
    return name_based_id(name, fixed.ALBUM_FALLBACK_PREFIX, fixed.ALBUM_FALLBACK_LENGTH)


def is_track_uri(uri: Column) -> Column:
    return F.coalesce(uri.startswith(fixed.TRACK_URI_PREFIX), F.lit(False))


def track_id_of(uri: Column) -> Column:
    """Text after the track prefix, NULL for any other URI."""
    return F.when(is_track_uri(uri), F.substr(uri, F.lit(len(fixed.TRACK_URI_PREFIX) + 1)))


def last_uri_piece(uri: Column) -> Column:
    """Text after the last colon."""
    return F.element_at(F.split(uri, ":"), -1)
