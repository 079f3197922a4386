"""Staging and star models on small hand-made inputs."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from playspan import fixed
from playspan.operators.playlists import playlist_coverage
from playspan.plans import checks, features, reports, staging, star
from playspan.sources import schemas

T0 = dt.datetime(2024, 1, 1, 10)
LOADED = dt.datetime(2024, 1, 2)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def raw_plays(spark, rows):
    """rows: (played_at, track, duration_ms, loaded_at)"""
    full = [
        (p, t, f"name {t}", f"artist_{t}", f"Artist {t}", "al1", "Album", "2001-05", d, 50, True, f"u:{t}", l)
        for p, t, d, l in rows
    ]
    return spark.createDataFrame(full, schemas.with_loaded_at(schemas.PLAYS_FILE))


def raw_history(spark, rows):
    """rows: (ts, uri, artist, album, ms_played, loaded_at)"""
    full = [
        (ts, "web", ms, "DE", None, "name", artist, album, uri, None, None, None, None, None, None,
         None, "start", "end", True, False, False, 1, False, loaded)
        for ts, uri, artist, album, ms, loaded in rows
    ]
    return spark.createDataFrame(full, schemas.with_loaded_at(schemas.HISTORY_RECORD))


def uri(track):
    return fixed.TRACK_URI_PREFIX + track


def artists(spark, rows=()):
    schema = schemas.with_loaded_at(schemas.ARTISTS_FILE)
    return staging.artists(spark.createDataFrame(list(rows), schema))


def playlists(spark, names):
    rows = [(n, f"name {n}", "me", True, True, False, 3, None, "s", LOADED, LOADED) for n in names]
    return staging.playlists(
        spark.createDataFrame(rows, schemas.with_loaded_at(schemas.PLAYLISTS_FILE))
    )


def entries(spark, rows):
    full = [(p, t, added, "me", 0, LOADED) for p, t, added in rows]
    return staging.playlist_tracks(
        spark.createDataFrame(full, schemas.with_loaded_at(schemas.PLAYLIST_TRACKS_FILE))
    )


class Star:
    def __init__(self, spark, plays, history=(), names=("p1",), on=(), described=(), **options):
        raw = raw_plays(spark, plays)
        self.plays = staging.plays(raw)
        self.history = staging.history(raw_history(spark, history), raw)
        self.artists = artists(spark, described)
        self.entries = entries(spark, on)
        self.tracks = star.dim_tracks(self.plays, self.history)
        self.dim_artists = star.dim_artists(self.artists, self.plays, self.history)
        self.albums = star.dim_albums(self.plays, self.history)
        self.playlists = star.dim_playlists(playlists(spark, names), self.entries)
        self.fact = star.fact_plays(
            self.plays, self.history, self.tracks, self.dim_artists, self.albums, self.playlists,
            self.entries, **options,
        )


def test_short_newest_version_removes_the_play(spark):
    raw = raw_plays(spark, [(T0, "A", 200000, LOADED), (T0, "A", 20000, LOADED + dt.timedelta(1))])
    assert staging.plays(raw).count() == 0


def test_duration_limit_is_inclusive(spark):
    raw = raw_plays(spark, [(at(0), "A", 30000, LOADED), (at(1), "A", 29999, LOADED)])
    assert [r.played_at for r in staging.plays(raw).collect()] == [at(0)]


def test_equal_load_times_are_decided_the_same_way(spark):
    rows = [(T0, "A", 40000 + i, LOADED) for i in range(20)]
    one = staging.plays(raw_plays(spark, rows).repartition(7)).first()
    two = staging.plays(raw_plays(spark, rows[::-1]).repartition(2)).first()
    assert one == two and one.duration_ms == 40000


def test_history_keeps_music_and_falls_back_to_names(spark):
    raw = raw_plays(spark, [(T0, "A", 40000, LOADED)])
    history = raw_history(
        spark,
        [
            (at(1), uri("A"), "x", "y", 0, LOADED),
            (at(2), uri("B"), None, None, 5, LOADED),
            (at(3), fixed.EPISODE_URI_PREFIX + "e", "x", "y", 5, LOADED),
            (at(4), None, "x", "y", 5, LOADED),
        ],
    )
    rows = {r.track_id: r for r in staging.history(history, raw).collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"].artist_id == "artist_A" and rows["A"].ms_played == 0
    assert rows["B"].artist_id == "ext_artist_ad921d604863662588"
    assert rows["B"].album_id == "ext_album_" + hashlib.md5(b"unknown").hexdigest()[:19]


def test_play_in_both_sources_has_two_rows_with_one_id(spark):
    made = Star(
        spark, [(T0, "A", 40000, LOADED)], [(T0, uri("A"), "x", "y", 5, LOADED)],
        names=["p1", "p2", "p3"], on=[("p1", "A", at(1)), ("p2", "A", at(2)), ("p3", "A", at(3))],
    )
    rows = made.fact.orderBy("data_source").collect()
    assert [r.data_source for r in rows] == ["api", "extended_history"]
    assert rows[0].play_id == rows[1].play_id
    # every playlist is met once per copy
    assert [rows[0][f"playlist_key_{i}"] for i in range(1, 6)] == [3, 3, 2, 2, 1]
    assert rows[0].playlist_count == 3
    assert [r.is_repeat for r in rows] == [False, True]
    found = {(r.check_name, r.failures) for r in quality_rows(made, "play_id")}
    assert ("unique:play_id", 1) in found


def quality_rows(made, column):
    from playspan.operators import quality

    declared = {"fct_history": quality.TableChecks(unique=(column,))}
    return quality.report({"fct_history": made.fact}, declared).collect()


def test_both_sources_can_be_merged(spark):
    made = Star(
        spark, [(T0, "A", 40000, LOADED)], [(T0, uri("A"), "x", "y", 5, LOADED)],
        dedup_sources=True,
    )
    assert [r.data_source for r in made.fact.collect()] == ["api"]


def test_more_than_five_playlists(spark):
    names = [f"p{i}" for i in range(7)]
    made = Star(
        spark, [(T0, "A", 40000, LOADED), (at(5), "B", 40000, LOADED)], names=names,
        on=[(n, "A", at(i)) for i, n in enumerate(names)],
    )
    first, second = made.fact.orderBy("played_at").collect()
    assert [first[f"playlist_key_{i}"] for i in range(1, 6)] == [7, 6, 5, 4, 3]
    assert first.playlist_count == 7
    assert second.playlist_key_1 is None and second.playlist_count == 0


def test_copies_of_plays_split_over_ranges(spark):
    plays = [(at(i // 3), f"t{i % 3}", 40000, LOADED) for i in range(60)]
    history = [(p, uri(t), "x", "y", 5, LOADED) for p, t, _, _ in plays[::2]]
    on = [(f"p{j}", f"t{i}", at(j)) for i in range(3) for j in range(4)]
    names = [f"p{j}" for j in range(4)]
    wide = Star(spark, plays, history, names=names, on=on, ranges=25).fact
    single = Star(spark, plays, history, names=names, on=on, ranges=1).fact
    order = ["played_at", "play_id", "data_source"]
    assert wide.orderBy(*order).collect() == single.orderBy(*order).collect()


def test_artist_with_genres_is_preferred_and_unplayed_artist_has_zero(spark):
    described = [
        ("artist_A", "Described", "pop", 1, 2, LOADED), ("quiet", "Quiet", None, 1, 2, LOADED),
    ]
    made = Star(
        spark, [(T0, "A", 40000, LOADED)], [(at(1), uri("A"), "By name", "y", 5, LOADED)],
        described=described,
    )
    rows = {r.artist_id: r for r in made.dim_artists.collect()}
    assert rows["artist_A"].artist_name == "Described" and rows["artist_A"].total_plays == 2
    assert rows["quiet"].total_plays == 0 and rows["quiet"].first_played_at is None


def test_newest_record_wins_in_tracks(spark):
    later = LOADED + dt.timedelta(days=1)
    made = Star(spark, [(T0, "A", 40000, LOADED)], [(at(1), uri("A"), "x", "y", 7, later)])
    (row,) = made.tracks.collect()
    assert row.duration_ms == 7 and row.popularity is None and row.total_plays == 2


def test_unknown_artist_has_no_key_and_is_reported(spark):
    made = Star(spark, [(T0, "A", 40000, LOADED)])
    assert made.fact.first().artist_key is None


def coverage(made, **options):
    return playlist_coverage(made.playlists, made.entries, made.plays, **options).first()


def test_play_weighted_and_exact_coverage(spark):
    made = Star(
        spark, [(at(i), "A", 40000, LOADED) for i in range(3)], names=["p1"],
        on=[("p1", "A", at(1)), ("p1", "Z", at(2))],
    )
    assert coverage(made).total_plays == 9
    assert coverage(made).avg_plays_per_track == pytest.approx(2.25)
    assert coverage(made, exact=True).total_plays == 3
    assert coverage(made).unplayed_tracks == 1 and coverage(made).played_percentage == 50.0


def test_empty_inputs(spark):
    made = Star(spark, [], names=[])
    assert made.fact.count() == 0 and tuple(made.fact.columns) == star.FACT_COLUMNS
    for report in (
        reports.top_artists_daily(made.fact, made.dim_artists),
        reports.top_tracks_daily(made.fact, made.tracks),
        reports.listening_patterns_hourly(made.fact),
        reports.consecutive_listening_daily(made.fact),
        playlist_coverage(made.playlists, made.entries, made.plays),
    ):
        assert report.count() == 0


def test_session_minutes_are_rounded_before_they_are_added(spark):
    # two sessions of 0.0026 minutes each would add up to 0.01, rounded first they are 0
    rows = [(T0, 1, 156), (at(60), 2, 156)]
    fact = spark.createDataFrame(rows, "played_at timestamp, session_number long, duration_ms int")
    day = reports.consecutive_listening_daily(fact.withColumn("played_date", F.to_date("played_at")))
    (row,) = day.collect()
    assert row.total_consecutive_time_minutes == 0.0 and row.total_sessions == 2


def test_values_that_break_checks_are_counted(spark):
    fact = spark.createDataFrame(
        [("a", 1, -1), ("b", 2, 3600000), ("c", 3, 3600001)],
        "play_id string, track_key long, duration_ms int",
    )
    assert sorted(r.play_id for r in checks.out_of_bounds(fact).collect()) == ["a", "c"]


def test_checks_need_no_numbered_plays(spark, small_dir):
    import __spark_entry__ as entry_points
    from catalog import inputs

    inputs.forget()
    found = sorted(entry_points.queries()["dq_report"](spark, small_dir).collect(), key=repr)
    m = inputs.models(spark, small_dir)
    assert "fct_history" not in m._made
    made = {name: getattr(m, name) for name in checks.DECLARED} | {"top_artists_daily": m.top_artists_daily}
    assert found == sorted(checks.full_report(made).collect(), key=repr)


def test_checked_plays_and_sessions_are_those_of_the_fact(spark):
    plays = [(at(0), "A", 40000, LOADED), (at(1), "B", 50000, LOADED), (at(90), "A", 40000, LOADED), (at(90), "B", 40000, LOADED)]
    made = Star(spark, plays)
    found = star.checked_plays(made.plays, made.history, made.tracks, made.dim_artists, made.albums)
    assert sorted(found.collect(), key=repr) == sorted(made.fact.select(*found.columns).collect(), key=repr)
    plain = made.plays.unionByName(made.plays.limit(2).withColumn("played_at", F.lit(None).cast("timestamp")), True)
    plain = plain.withColumn("played_date", F.to_date("played_at")).localCheckpoint()
    keys = (made.tracks, made.dim_artists, made.albums, made.playlists, made.entries)
    numbers = star.session_numbers(plain, made.history, ranges=3)
    fact = star.fact_plays(plain, made.history, *keys)
    assert sorted(numbers.collect()) == sorted(fact.select("session_number").collect())


def test_names_of_a_track_are_written_once(spark, tmp_path):
    from playspan.session import long_texts_once

    key, before = "parquet.dictionary.page.size", spark.conf.get("parquet.dictionary.page.size", None)
    names = spark.range(40_000).selectExpr("'A' AS track_id", "id AS playlist_id", "md5(string(id)) AS playlist_name")
    wide = spark.range(50).selectExpr("'A' AS track_id", "0 AS playlist_count", "id").coalesce(1)
    try:
        long_texts_once(spark)
        features.with_names(wide, names).write.parquet(f"{tmp_path}/wide")
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    assert spark.read.parquet(f"{tmp_path}/wide").agg(F.min(F.length("playlists_containing_track"))).first()[0] == 40_000 * 34 - 2
    assert sum(f.stat().st_size for f in (tmp_path / "wide").iterdir()) < 3_000_000  # each text in full is 68 MB


def test_statistics_of_shared_texts_are_not_written(spark, tmp_path):
    import pyarrow.parquet as pq

    from playspan.session import long_texts_once

    keys = ("parquet.dictionary.page.size", f"parquet.column.statistics.enabled#{features.NAMES}")
    before = {key: spark.conf.get(key, None) for key in keys}
    wide = spark.range(20).selectExpr("'A' AS track_id", "0 AS playlist_count", "id").coalesce(1)
    names = spark.createDataFrame([("A", 1, "x"), ("A", 2, "y")], "track_id string, playlist_id long, playlist_name string")
    try:
        long_texts_once(spark, features.NAMES)
        features.with_names(wide, names).coalesce(1).write.parquet(f"{tmp_path}/wide")
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    (file,) = (f for f in (tmp_path / "wide").iterdir() if f.name.startswith("part-"))
    group = pq.ParquetFile(file).metadata.row_group(0)
    found = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert not found[features.NAMES].is_stats_set and found["id"].is_stats_set
    assert {r[0] for r in spark.read.parquet(f"{tmp_path}/wide").select(features.NAMES).collect()} == {"x, y"}


def test_plays_of_a_track_with_a_long_text_are_cut_into_slices(spark):
    plays = [("A", i % 90) for i in range(100)] + [("B", 1), ("C", 2), ("D", 3), (None, 4), (None, 5)]
    wide = spark.createDataFrame(plays, "track_id string, id long").withColumn("playlist_count", F.lit(0))
    named = [("A", i, f"name {i % 50:03d}") for i in range(60)] + [
        ("B", 1, "b"), ("B", 2, None), ("C", 1, None), (None, 1, "lost"), ("E", 1, "unplayed"),
    ]
    names = spark.createDataFrame(named, "track_id string, playlist_id long, playlist_name string")
    text = ", ".join(f"name {i:03d}" for i in range(50))
    want = sorted(((t, i, {"A": text, "B": "b"}.get(t)) for t, i in plays), key=repr)
    for counted in (None, wide):
        whole = features.with_names(wide, names, counted)
        cut = features.with_names(wide, names, counted, slice_bytes=20_000)
        assert whole.columns == cut.columns == ["track_id", "id", features.NAMES, "playlist_count"]
        for found in (whole, cut):
            assert sorted(((r.track_id, r.id, r[features.NAMES]) for r in found.collect()), key=repr) == want
        per_task = cut.filter("track_id = 'A'").groupBy(F.spark_partition_id()).count().collect()
        assert len(per_task) > 1 and max(r["count"] for r in per_task) < 100


def test_track_report_needs_no_numbered_plays(spark, small_dir):
    import __spark_entry__ as entry_points
    from catalog import inputs

    inputs.forget()
    found = entry_points.queries()["top_tracks_daily"](spark, small_dir)
    m = inputs.models(spark, small_dir)
    assert "fct_history" not in m._made
    assert sorted(found.collect(), key=repr) == sorted(reports.top_tracks_daily(m.fct_history, m.dim_tracks).collect(), key=repr)
