"""Files, pages and keyed loads."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from playspan import fixed
from playspan.operators import merge
from playspan.plans import build, load
from playspan.sources import landing, pages, schemas, tables
from playspan.streaming import landing as incremental


def stamp():
    return F.lit("2024-03-01 00:00:00").cast("timestamp")


def csv_line(values):
    return ",".join("" if v is None else str(v) for v in values)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


PLAY_HEADER = (
    "played_at,track_id,track_name,artist_id,artist_name,album_id,album_name,"
    "album_release_date,duration_ms,popularity,explicit,track_uri"
)


def play_file(root, day, hour, tracks):
    """A landing file as dropped by an hourly pull."""
    name = f"plays_202401{day:02d}_{hour:02d}0000.csv"
    rows = [
        f"2024-01-{day:02d}T{hour:02d}:{i:02d}:00.123456Z,{t},Name {t},a{t},Artist,al,Album,2001,180000,5,True,u:{t}"
        for i, t in enumerate(tracks)
    ]
    write(root / "plays" / "2024" / "01" / f"{day:02d}" / name, "\n".join([PLAY_HEADER, *rows]) + "\n")


def test_latest_file_or_all(spark, tmp_path):
    play_file(tmp_path, 1, 5, "AB")
    play_file(tmp_path, 2, 3, "C")
    play_file(tmp_path, 2, 9, "DE")

    def tracks(**options):
        df = landing.read_batches(spark, str(tmp_path), "plays", schemas.PLAYS_FILE, **options)
        return sorted(r.track_id for r in df.collect())

    assert tracks() == ["D", "E"]
    assert tracks(mode="all") == ["A", "B", "C", "D", "E"]
    assert landing.read_batches(spark, str(tmp_path), "artists", schemas.ARTISTS_FILE) is None


def test_csv_types(spark, tmp_path):
    play_file(tmp_path, 1, 5, "A")
    row = landing.read_csv(spark, str(tmp_path), schemas.PLAYS_FILE, stamp()).first()
    assert row.played_at == dt.datetime(2024, 1, 1, 5, 0, 0, 123456)
    assert row.explicit is True and row.duration_ms == 180000


def record(uri, ms=40000, minute=0):
    return {
        "ts": f"2024-01-01T00:{minute:02d}:00Z", "ms_played": ms, schemas.HISTORY_TRACK_URI: uri,
        "master_metadata_track_name": "n", "platform": "web", "shuffle": False,
    }


def test_broken_file_is_left_out_whole(spark, tmp_path):
    good = [record(fixed.TRACK_URI_PREFIX + "A"), record(fixed.EPISODE_URI_PREFIX + "E"), record(None)]
    broken = json.dumps([record(fixed.TRACK_URI_PREFIX + "B", minute=i) for i in range(3)])
    write(tmp_path / "Streaming_History_Audio_1.json", json.dumps(good))
    write(tmp_path / "Streaming_History_Audio_2.json", broken[:-40])
    write(tmp_path / "other.json", json.dumps([record(fixed.TRACK_URI_PREFIX + "C")]))
    rows = landing.read_history(spark, str(tmp_path), loaded_at=stamp()).collect()
    assert [r[schemas.HISTORY_TRACK_URI] for r in rows] == [fixed.TRACK_URI_PREFIX + "A"]
    assert rows[0].ts == dt.datetime(2024, 1, 1) and rows[0].reason_end is None


def test_other_export_path(spark, tmp_path):
    uri = fixed.TRACK_URI_PREFIX
    data = [record(uri + "A", minute=2), record(uri + "A", minute=2), record(uri + "B", 29999),
            record(fixed.EPISODE_URI_PREFIX + "E", minute=1)]
    write(tmp_path / "endsong_0.json", json.dumps(data))
    rows = landing.read_exported_plays(spark, str(tmp_path)).collect()
    assert [r.track_id for r in rows] == ["E", "A"]
    with pytest.raises(FileNotFoundError):
        landing.read_exported_plays(spark, str(tmp_path / "nowhere"))


def test_export_with_missing_columns(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 40000)], "ts string, ms_played int")
    assert landing.exported_plays(df).columns == ["played_at", "duration_ms"]


def test_pages(spark, tmp_path):
    track = {"id": "t", "name": "n", "uri": "u", "duration_ms": 1, "popularity": 2, "explicit": False}
    plays = {
        "items": [
            {"played_at": "2024-01-01T00:00:00.5Z",
             "track": {**track, "artists": [{"id": "a1", "name": "A"}, {"id": "a2"}], "album": {"id": "al"}}},
            {"played_at": "2024-01-01T00:00:00Z", "track": None},
            {"played_at": "2024-01-01T00:00:00Z", "track": {**track, "artists": []}},
            {"played_at": "2024-01-01T00:00:00Z", "track": track},
        ]
    }
    write(tmp_path / "plays.json", json.dumps(plays))
    (row,) = pages.flatten_plays(pages.read_pages(spark, str(tmp_path), schemas.PLAYS_PAGE)).collect()
    assert row.artist_id == "a1" and row.album_id == "al" and row.album_name is None


def test_artist_pages_keep_missing_genres_as_empty_text(spark):
    body = json.dumps({"artists": [{"id": "a", "genres": None}, None, {"id": "b", "genres": ["x", "y"]}]})
    df = pages.parse_pages(spark.createDataFrame([(body,)], "body string"), "body", schemas.ARTISTS_PAGE)
    assert [(r.artist_id, r.genres) for r in pages.flatten_artists(df).collect()] == [("a", ""), ("b", "x,y")]


def test_positions_continue_over_pages(spark):
    items = [{"track": {"id": "x"}, "added_by": {"id": "u"}}, None, {"track": {"id": None}}, {"track": {"id": "y"}}]
    rows = [("p", 0, json.dumps({"items": items})), ("p", 100, json.dumps({"items": items}))]
    df = spark.createDataFrame(rows, "playlist_id string, offset int, body string")
    flat = pages.flatten_playlist_tracks(pages.parse_pages(df, "body", schemas.PLAYLIST_ITEMS_PAGE))
    assert sorted((r.position, r.track_id) for r in flat.collect()) == [
        (0, "x"), (3, "y"), (100, "x"), (103, "y"),
    ]


PAIR = "k string, v int, loaded_at timestamp"


def pairs(spark, *rows):
    return spark.createDataFrame([(k, v, dt.datetime(2024, 1, d)) for k, v, d in rows], PAIR)


def test_insert_ignore_keeps_old_rows(spark):
    old, new = pairs(spark, ("a", 1, 1)), pairs(spark, ("a", 9, 2), ("b", 2, 2), ("b", 3, 2))
    got = sorted((r.k, r.v) for r in merge.insert_ignore(old, new, ["k"]).collect())
    assert got == [("a", 1), ("b", 2)]
    (m,) = merge.load_metrics("t", old, new, ["k"], updates=False).collect()
    assert tuple(m) == ("t", 1, 2, 1, 0)


def test_upsert_takes_the_last_version(spark):
    old = pairs(spark, ("a", 1, 1), ("c", 5, 1))
    new = pairs(spark, ("a", 9, 3), ("a", 8, 2), ("b", 2, 2))
    assert sorted((r.k, r.v) for r in merge.upsert(old, new, ["k"]).collect()) == [("a", 9), ("b", 2), ("c", 5)]
    (m,) = merge.load_metrics("t", old, new, ["k"], updates=True).collect()
    assert tuple(m) == ("t", 2, 3, 1, 1)


def test_null_keys_are_refused(spark):
    new = pairs(spark, ("a", 1, 1)).withColumn("k", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="NULL in key column k"):
        merge.insert_ignore(pairs(spark), new, ["k"]).collect()


def test_load_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.load_once(spark, path, lambda: pairs(spark))
    assert tables.load_once(spark, path, lambda: pairs(spark, ("a", 1, 1)))  # was empty
    assert not tables.load_once(spark, path, lambda: pairs(spark, ("b", 1, 1)))
    assert [r.k for r in tables.read_current(spark, path).collect()] == ["a"]


def test_unfinished_version_is_not_read(spark, tmp_path):
    base = str(tmp_path / "t")
    tables.upsert_version(spark, pairs(spark, ("a", 1, 1)), base, ["k"])
    tables.upsert_version(spark, pairs(spark, ("a", 2, 2)), base, ["k"])
    pairs(spark, ("a", 3, 3)).write.parquet(str(tmp_path / "t" / "part=2-broken"))
    assert tables.versions(spark, base) == [0, 1]
    assert [r.v for r in tables.read_current(spark, base).collect()] == [2]


def test_stream_takes_new_files_only(spark, tmp_path):
    source, table, check = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "check")
    keys = schemas.TABLE_KEYS["raw_plays"]

    def run():
        stream = incremental.landing_stream(spark, str(source), schemas.PLAYS_FILE)
        incremental.ingest_new(stream, table, keys, check, loaded_at=stamp())
        return tables.read(spark, table).count()

    play_file(source, 1, 5, "AB")
    assert run() == 2
    assert run() == 2
    play_file(source, 1, 6, "C")
    write(source / "copy.csv", next((source / "plays").rglob("plays_20240101_05*.csv")).read_text())
    assert run() == 3


def test_load_and_build(spark, tmp_path):
    """Landing files to raw tables, models and the check report."""
    files, root = tmp_path / "in", str(tmp_path / "out")
    play_file(files, 1, 5, "AB")
    play_file(files, 1, 6, "BC")
    write(files / "artists" / "artists_1.csv",
          "artist_id,artist_name,genres,popularity,followers\naA,Artist,pop,5,10\naB,Artist,,5,10\n")
    write(files / "playlists" / "playlists_1.csv",
          "playlist_id,playlist_name,owner_id,is_owner,is_public,is_collaborative,total_tracks,"
          "description,snapshot_id,extracted_at\np1,One,me,True,True,False,2,,s,2024-01-01 00:00:00\n")
    write(files / "playlist_tracks" / "playlist_tracks_1.csv",
          "playlist_id,track_id,added_at,added_by,position\np1,B,2024-01-01T00:00:00Z,me,0\n")
    first = {r.table_name: tuple(r)[1:] for r in load.load_landing(spark, str(files), root, mode="latest", loaded_at=stamp()).collect()}
    assert first["raw_plays"] == (0, 2, 2, 0) and first["raw_artists"] == (0, 2, 2, 0)
    again = {
        r.table_name: tuple(r)[1:]
        for r in load.load_landing(spark, str(files), root, loaded_at=stamp()).collect()
    }
    assert again["raw_plays"] == (2, 4, 2, 0) and "raw_artists" not in again  # a batch is taken once

    export = tmp_path / "export"
    write(export / "Streaming_History_Audio_0.json", json.dumps([record(fixed.TRACK_URI_PREFIX + "A", 0)]))
    assert load.load_history(spark, str(export), root, loaded_at=stamp())
    assert not load.load_history(spark, str(export), root, loaded_at=stamp())

    made = build.build(load.raw_tables(spark, root), root)
    fact = made["fct_history"].orderBy("played_at").collect()
    assert [r.data_source for r in fact] == ["extended_history", "api", "api", "api", "api"]
    assert [r.session_number for r in fact] == [1, 2, 2, 3, 3]
    assert tables.read_current(spark, f"{root}/analytics/top_tracks_daily").count() == 3
    failed = {r.check_name for r in build.check(made).collect() if r.status == "fail"}
    assert failed >= {"not_null:artist_key", "not_null:conn_country"}
    assert not failed & {"unique:play_id", "sessions_are_sequential", "parent:track_key"}


PLAYLIST_HEADER = (
    "playlist_id,playlist_name,owner_id,is_owner,is_public,is_collaborative,total_tracks,description,"
    "snapshot_id,extracted_at"
)
QUOTED = PLAYLIST_HEADER + '\np1,"My ""best"", mix",me,True,False,,7.0,"two\nlines, "" and \\",s,2024-01-01 00:00:00\n'


def test_csv_of_another_writer(spark, tmp_path):
    write(tmp_path / "a.csv", QUOTED)
    (row,) = landing.read_csv(spark, str(tmp_path), schemas.PLAYLISTS_FILE, stamp()).collect()
    assert row.playlist_name == 'My "best", mix' and row.description == 'two\nlines, " and \\'
    assert (row.total_tracks, row.is_owner, row.is_public, row.is_collaborative) == (7, True, False, None)


@pytest.mark.parametrize("line", ["p1,n,me,True,True,False,seven,,s,2024-01-01 00:00:00", "p1,n,me", "p1,n,me,maybe,,,,,,"])
def test_csv_that_does_not_convert_is_an_error(spark, tmp_path, line):
    write(tmp_path / "a.csv", f"{PLAYLIST_HEADER}\n{line}\n")
    with pytest.raises(Exception):
        landing.read_csv(spark, str(tmp_path), schemas.PLAYLISTS_FILE, stamp()).collect()


def test_stream_reads_the_same_dialect(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", QUOTED)
    stream = incremental.landing_stream(spark, str(tmp_path / "in"), schemas.PLAYLISTS_FILE)
    table = str(tmp_path / "table")
    incremental.ingest_upsert(stream, table, ["playlist_id"], str(tmp_path / "check"), loaded_at=stamp())
    (row,) = tables.read_current(spark, table).collect()
    assert row.playlist_name == 'My "best", mix' and row.total_tracks == 7


def test_written_text_is_read_back(spark, tmp_path):
    texts = ['a "b"', "c,d", "e\nf", " g ", "\\", '""', "h\\\"i"]
    df = spark.createDataFrame([(t, dt.datetime(2024, 1, 1)) for t in texts], "track_name string, at timestamp")
    landing.write_csv(df, str(tmp_path / "x"))
    back = landing.read_csv(spark, str(tmp_path / "x"), "track_name string, at timestamp", stamp())
    assert sorted(r.track_name for r in back.collect()) == sorted(texts)


def test_landing_batches_stay(spark, tmp_path):
    root = str(tmp_path / "l")
    for batch, rows in (("1", pairs(spark, ("a", 1, 1))), ("2", pairs(spark, ("b", 2, 2))), ("3", pairs(spark, ("c", 3, 2)))):
        landing.write_landing(rows, root, "things", "loaded_at", batch)
    schema = "k string, v int, loaded_at timestamp"

    def found(mode):
        df = landing.read_batches(spark, root, "things", schema, mode=mode)
        return sorted((r.k, r.v) for r in df.collect())

    assert found("all") == [("a", 1), ("b", 2), ("c", 3)] and found("latest") == [("c", 3)]


def test_odd_numbers_keep_their_file(spark, tmp_path):
    uri = fixed.TRACK_URI_PREFIX
    data = [record(uri + "A", 3000.5), record(uri + "B", "41000"), record(uri + "C", None)]
    write(tmp_path / "Streaming_History_Audio_1.json", json.dumps(data))
    write(tmp_path / "Streaming_History_Audio_2.json", json.dumps(data)[:-3])
    rows = landing.read_history(spark, str(tmp_path), loaded_at=stamp()).collect()
    assert sorted((r.ms_played or 0) for r in rows) == [0, 3000, 41000]
    files = {r.file[-6:]: (r.skipped, r.n_records) for r in landing.history_files(spark, str(tmp_path)).collect()}
    assert files == {"1.json": (False, 3), "2.json": (True, 0)}
    with pytest.raises(ValueError, match="not JSON"):
        landing.read_exported_plays(spark, str(tmp_path))


def test_exported_plays_are_loaded_once(spark, tmp_path):
    root = str(tmp_path / "raw")
    data = [record(fixed.TRACK_URI_PREFIX + "A", minute=2), record(fixed.TRACK_URI_PREFIX + "B", minute=3), record(None)]
    write(tmp_path / "endsong_0.json", json.dumps(data))
    counts = [tuple(load.load_exported_plays(spark, str(tmp_path), root, loaded_at=stamp()).first())[1:] for _ in range(2)]
    assert counts == [(0, 2, 2, 0), (2, 2, 0, 0)]


def test_success_markers_do_not_matter(spark, tmp_path):
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    spark.conf.set(key, "false")
    try:
        for _ in range(2):
            tables.append_new(spark, pairs(spark, ("a", 1, 1)), str(tmp_path / "t"), ["k"])
    finally:
        spark.conf.unset(key)
    assert tables.read(spark, str(tmp_path / "t")).count() == 1


def test_stream_upsert_goes_on_after_a_new_checkpoint(spark, tmp_path):
    table, schema = str(tmp_path / "t"), "k string, v int, loaded_at timestamp"
    for n, rows in enumerate((("a", 1, 1), ("b", 2, 2), ("c", 3, 3))):
        landing.write_csv(pairs(spark, rows), str(tmp_path / f"in{n}"))
        stream = incremental.landing_stream(spark, str(tmp_path / f"in{n}"), schema)
        incremental.ingest_upsert(stream, table, ["k"], str(tmp_path / f"check{n % 2}-{n}"))
    tables.upsert_version(spark, pairs(spark, ("d", 4, 4)), table, ["k"])
    assert sorted(r.k for r in tables.read_current(spark, table).collect()) == ["a", "b", "c", "d"]
    tables.upsert_version(spark, pairs(spark, ("e", 5, 5)), table, ["k"], "again")
    tables.upsert_version(spark, pairs(spark, ("f", 6, 6)), table, ["k"], "again")
    assert tables.read_current(spark, table).count() == 5


def test_late_plays_are_kept(spark, tmp_path):
    table, keys = str(tmp_path / "t"), schemas.TABLE_KEYS["raw_plays"]
    for hour, tracks in ((9, "AB"), (5, "C"), (9, "AB")):
        play_file(tmp_path / "in", 1, hour, tracks)
        stream = incremental.landing_stream(spark, str(tmp_path / "in"), schemas.PLAYS_FILE)
        incremental.without_repeats(stream, table, keys, str(tmp_path / "check"))
    assert sorted(r.track_id for r in tables.read(spark, table).collect()) == ["A", "B", "C"]


def test_range_condition_and_warning(spark):
    from playspan.operators import quality

    t = spark.createDataFrame([(1, 500, "x"), (2, 600, "y")], "id int, v int, kind string")
    declared = {"t": quality.TableChecks(ranges={"v": (0, 100)}, where={"v": "kind = 'x'"}, warn=("range:v",))}
    (r,) = quality.report({"t": t}, declared).collect()
    assert (r.failures, r.status) == (1, "warn")
