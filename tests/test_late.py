"""Late plays: numbered plays and daily reports brought up to date, against a full build."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from playspan.operators.late import NumberedPlays
from playspan.operators.sessions import number_plays
from playspan.plans import daily, reports, staging, star
from playspan.sources import tables

from test_sessions import START, make, result

OPTIONS = {"ties": ("play_id",), "carry": ("track_key",)}


def some_plays(n, seed):
    rng = random.Random(seed)
    plays = []
    for _ in range(n):
        at = START + dt.timedelta(minutes=rng.choice([rng.randrange(6000), 777]))
        plays.append((rng.choice([1, 1, 1, 2, 3]), at, rng.choice(["A", "A", "B", None])))
    return plays


@pytest.mark.parametrize("by", [(), ("user_id",)])
def test_late_plays_are_numbered_as_in_a_full_build(spark, tmp_path, by):
    plays = make(spark, some_plays(240, 4)).cache()
    n = F.substring("play_id", 2, 9).cast("int")
    kept = NumberedPlays(str(tmp_path / "t"), by=by, rows_per_range=12, **OPTIONS)
    kept.begin(plays.filter(n < 150))
    kept.add(plays.filter(n.between(150, 155)))
    kept.add(plays.filter(n > 155))  # many: ranges are cut
    kept.add(plays.limit(0))
    want = number_plays(plays, by=by, staged=True, **OPTIONS)
    assert result(kept.read(spark)) == result(want)
    assert set(kept.read(spark).columns) == set(want.columns)


def test_untouched_ranges_are_not_read(spark, tmp_path, monkeypatch):
    plays = make(spark, [(1, START + dt.timedelta(hours=i), "AB"[i % 2]) for i in range(80)]).cache()
    n = F.substring("play_id", 2, 9).cast("int")
    kept = NumberedPlays(str(tmp_path / "t"), rows_per_range=5, **OPTIONS)
    kept.begin(plays.filter(n != 50))
    before = {r["bucket"]: r["part"] for r in tables._newest(tables.manifest(spark, f"{kept.base}/ranges"))}
    asked, read = [], tables.read_buckets
    monkeypatch.setattr(tables, "read_buckets", lambda s, b, some=None: asked.append((b, some)) or read(s, b, some))
    kept.add(plays.filter(n == 50))
    assert [len(some) for b, some in asked if b.endswith("ranges")] == [1]
    after = {r["bucket"]: r["part"] for r in tables._newest(tables.manifest(spark, f"{kept.base}/ranges"))}
    assert len(before) >= 8 and sum(after[b] != before[b] for b in before) == 1
    assert result(kept.read(spark)) == result(number_plays(plays, staged=True, **OPTIONS))


RAW = (
    "played_at timestamp, track_id string, track_name string, artist_id string, artist_name string, album_id string,"
    " album_name string, album_release_date string, duration_ms int, popularity int, explicit boolean, track_uri string,"
    " loaded_at timestamp"
)


def raw(spark, *plays):
    rows = [
        (START + dt.timedelta(hours=h), t, t, f"a{t}", "A", "al", "Al", "2001", ms, p, True, "u", START + dt.timedelta(days=9, hours=v))
        for h, t, ms, p, v in plays
    ]
    return spark.createDataFrame(rows, RAW)


def test_days_are_refreshed(spark, tmp_path):
    """A late play, a day that becomes empty, and an export play whose artist becomes known."""
    root, uri = str(tmp_path / "daily"), "spotify:track:"
    first = raw(spark, (1, "A", 60000, 5, 0), (30, "B", 60000, 7, 0), (55, "A", 60000, 9, 0))
    new = raw(spark, (2, "C", 90000, 3, 0), (30, "B", 10, 7, 1), (80, "D", 50000, 1, 0))
    exported = spark.createDataFrame(
        [(START + dt.timedelta(hours=100), uri + "D", "D", "Artist D", "Al", 70000, START)],
        "ts timestamp, spotify_track_uri string, master_metadata_track_name string, master_metadata_album_artist_name string,"
        " master_metadata_album_album_name string, ms_played int, loaded_at timestamp",
    )
    for c, kind in (("platform", "string"), ("conn_country", "string"), ("reason_start", "string"), ("reason_end", "string"),
                    ("shuffle", "boolean"), ("skipped", "boolean"), ("offline", "boolean"), ("incognito_mode", "boolean")):
        exported = exported.withColumn(c, F.lit(None).cast(kind))
    whole = first.unionByName(new)
    daily.refresh(star.all_plays(staging.plays(first), staging.history(exported, first)), root)
    plays, history = staging.plays(whole).cache(), staging.history(exported, whole).cache()
    days = daily.touched_days(new, staging.known_ids(first), staging.known_ids(whole), history)
    assert sorted(str(r[0]) for r in days.collect()) == ["2024-01-01", "2024-01-02", "2024-01-04", "2024-01-05"]
    daily.refresh(star.all_plays(plays, history), root, days)
    tracks, artists = star.dim_tracks(plays, history).cache(), star.dim_artists(staging.artists(spark.createDataFrame(
        [], "artist_id string, artist_name string, genres string, popularity int, followers int, loaded_at timestamp")), plays, history).cache()
    empty_lists = staging.playlists(spark.createDataFrame([], ", ".join(f"{c} string" for c in staging.PLAYLIST_COLUMNS)))
    entries = spark.createDataFrame([], "playlist_id string, track_id string, added_at timestamp, added_by string, position int, loaded_at timestamp")
    fact = star.fact_plays(plays, history, tracks, artists, star.dim_albums(plays, history), star.dim_playlists(empty_lists, entries), entries).cache()

    def rows(df):
        return [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]

    assert rows(daily.top_artists(root, tracks, artists)) == rows(reports.top_artists_daily(fact, artists))
    assert rows(daily.top_tracks(root, tracks, artists)) == rows(reports.top_tracks_daily(fact, tracks))
    assert rows(daily.patterns(root, tracks, artists)) == rows(reports.listening_patterns_hourly(fact))
    assert rows(daily.sessions(spark, root)) == rows(reports.consecutive_listening_daily(fact))
    assert not [r for r in daily.sessions(spark, root).collect() if str(r.played_date) == "2024-01-02"]


def test_sessions_are_numbered_on_slim_rows(spark, tmp_path, monkeypatch):
    dealt, number = [], daily.number_plays

    def number_plays(plays, **options):
        dealt.append(set(plays.columns))
        return number(plays, **options)

    monkeypatch.setattr(daily, "number_plays", number_plays)
    raw = spark.range(3).selectExpr(
        "timestamp_seconds(1704067200 + id * 600) AS played_at", "'t1' AS track_id", "'T' AS track_name", "'a' AS artist_id",
        "'A' AS artist_name", "'l' AS album_id", "'L' AS album_name", "'2001-01-01' AS album_release_date",
        "60000 AS duration_ms", "5 AS popularity", "true AS explicit", "'u' AS track_uri", "current_timestamp() AS loaded_at",
    )
    plays = staging.plays(raw)
    exported = plays.limit(0).selectExpr(
        "played_at AS ts", "'' AS platform", "duration_ms AS ms_played", "'' AS conn_country", "'' AS master_metadata_track_name",
        "'' AS master_metadata_album_artist_name", "'' AS master_metadata_album_album_name", "track_uri AS spotify_track_uri",
        "'' AS reason_start", "'' AS reason_end", "true AS shuffle", "true AS skipped", "true AS offline", "'' AS offline_timestamp",
        "true AS incognito_mode", "loaded_at",
    )
    daily.refresh(star.all_plays(plays, staging.history(exported, raw)), str(tmp_path / "d"))
    assert daily.sessions(spark, str(tmp_path / "d")).first()["max_consecutive_songs"] == 3
    assert dealt == [{"played_at", "played_date", "track_id", "duration_ms"}]
    dealt.clear()
    daily.refresh(star.all_plays(plays, staging.history(exported, raw)), str(tmp_path / "e"), kept=("plays",))
    assert not dealt and not (tmp_path / "e" / "sessions").exists()
