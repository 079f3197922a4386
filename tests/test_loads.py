"""Loads in several steps: batch order, batches taken once, buckets, merged parts, pages."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from playspan import fixed
from playspan.plans import build, load
from playspan.session import scratch_root, scratch_scope, stage
from playspan.sources import landing, schemas, tables
from playspan.streaming import landing as incremental
from test_sources import play_file, record, stamp, write

ARTISTS = "artist_id,artist_name,genres,popularity,followers\n"


def artist_file(root, day, *rows):
    lines = "".join(f"{a},Artist,pop,{p},1\n" for a, p in rows)
    write(root / "artists" / "2024" / "01" / f"{day:02d}" / f"artists_202401{day:02d}_000000.csv", ARTISTS + lines)


def popularity(spark, root):
    return {r.artist_id: r.popularity for r in load.read_raw(spark, root, "raw_artists").collect()}


def test_later_batches_win(spark, tmp_path):
    files, root = tmp_path / "in", str(tmp_path / "out")
    for day, p in ((1, 10), (2, 90), (3, 50)):
        artist_file(files, day, ("a", p))
    load.load_landing(spark, str(files), root)
    assert popularity(spark, root) == {"a": 50}


def test_an_old_batch_that_comes_late_changes_nothing_newer(spark, tmp_path):
    files, root = tmp_path / "in", str(tmp_path / "out")
    artist_file(files, 1, ("a", 10), ("b", 11))
    artist_file(files, 3, ("a", 50))
    load.load_landing(spark, str(files), root, mode="latest")
    artist_file(files, 2, ("a", 90), ("b", 12))
    (counts,) = load.load_landing(spark, str(files), root, mode="all").collect()
    assert popularity(spark, root) == {"a": 50, "b": 12}
    assert tuple(counts)[1:] == (1, 2, 1, 0)


def test_stream_follows_the_order_of_batches(spark, tmp_path):
    for day, p in ((3, 50), (1, 10), (2, 90)):
        artist_file(tmp_path / "in", day, ("a", p))
    table, check = str(tmp_path / "t"), str(tmp_path / "check")

    def run():
        stream = incremental.landing_stream(spark, str(tmp_path / "in" / "artists"), schemas.ARTISTS_FILE)
        incremental.ingest_upsert(stream, table, ["artist_id"], check, loaded_at=stamp())
        return [r.popularity for r in tables.read_current(spark, table).collect()]

    assert run() == [50]
    write(tmp_path / "in" / "artists" / "2024" / "01" / "02" / "artists_20240102_100000.csv", ARTISTS + "a,Artist,pop,70,1\n")
    assert run() == [50]
    artist_file(tmp_path / "in", 4, ("a", 20))
    assert run() == [20]


def test_taken_batches_are_not_opened(spark, tmp_path, monkeypatch):
    files, root = tmp_path / "in", str(tmp_path / "out")
    play_file(files, 1, 5, "AB")
    artist_file(files, 1, ("a", 1))
    load.load_landing(spark, str(files), root, loaded_at=stamp())
    opened = []
    read = landing.read_csv
    monkeypatch.setattr(landing, "read_csv", lambda s, paths, *a: opened.extend(paths) or read(s, paths, *a))
    for path in glob.glob(f"{files}/**/*.csv", recursive=True):
        write(type(files)(path), "not,the\nsame,file,any,more")  # would be an error
    assert load.load_landing(spark, str(files), root).count() == 0 and not opened
    play_file(files, 2, 5, "C")
    (counts,) = load.load_landing(spark, str(files), root).collect()
    assert tuple(counts) == ("raw_plays", 2, 3, 1, 0)
    assert len(opened) == 1 and opened[0].endswith("plays_20240102_050000.csv")


def test_empty_batches_are_taken(spark, tmp_path):
    files, root = tmp_path / "in", str(tmp_path / "out")
    artist_file(files, 1)
    assert load.load_landing(spark, str(files), root).count() == 0
    path = tables.layer_path(root, "raw", "raw_artists")
    assert tables.taken_batches(spark, path).count() == 1 and not tables.exists(spark, path)
    assert popularity(spark, root) == {}
    artist_file(files, 2, ("a", 1))
    load.load_landing(spark, str(files), root)
    assert popularity(spark, root) == {"a": 1}


def test_first_play_of_the_first_batch_stays(spark, tmp_path):
    files, root = tmp_path / "in", str(tmp_path / "out")
    play_file(files, 1, 5, "B")
    play_file(files, 1, 5, "A")
    path = files / "plays" / "2024" / "01" / "01" / "plays_20240101_050000.csv"
    write(path.with_name("plays_20240101_060000.csv"), path.read_text().replace("Artist", "Aaa"))
    load.load_landing(spark, str(files), root)
    (row,) = load.read_raw(spark, root, "raw_plays").collect()
    assert row.artist_name == "Artist" and landing.BATCH not in row.asDict()


def test_last_batch_lists_one_branch(spark, tmp_path):
    play_file(tmp_path, 1, 5, "A")
    play_file(tmp_path, 2, 7, "A")
    (tmp_path / "plays" / "2024" / "01" / "03").mkdir()
    (tmp_path / "plays" / "2024" / "02").mkdir()
    assert landing.last_batch(spark, str(tmp_path), "plays").endswith("/02/plays_20240102_070000.csv")
    assert landing.last_batch(spark, str(tmp_path), "artists") is None


KEYED = "k int, v int, loaded_at timestamp"


def keyed(spark, values, day=1):
    return spark.createDataFrame([(k, v, dt.datetime(2024, 1, day)) for k, v in values.items()], KEYED)


def test_upsert_leaves_other_buckets_alone(spark, tmp_path, monkeypatch):
    base, want = str(tmp_path / "t"), {k: 0 for k in range(200)}
    tables.upsert_version(spark, keyed(spark, want), base, ["k"], rows_per_bucket=20)
    tables.upsert_version(spark, keyed(spark, {500: 1}), base, ["k"], rows_per_bucket=20)  # dealt anew
    read, opened = tables._read_parts, []
    monkeypatch.setattr(tables, "_read_parts", lambda s, b, parts: opened.append(len(parts)) or read(s, b, parts))
    before = {r["bucket"]: r["part"] for r in tables._newest(tables.manifest(spark, base))}
    assert len(before) == 16
    done = tables.upsert_version(spark, keyed(spark, {7: 5, 501: 6}, 2), base, ["k"], rows_per_bucket=20)
    assert done == {"before": 201, "after": 202, "added": 1, "updated": 1}
    after = {r["bucket"]: r["part"] for r in tables._newest(tables.manifest(spark, base))}
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 2 and opened[-1] <= 2
    monkeypatch.undo()
    want |= {500: 1, 7: 5, 501: 6}
    assert {r.k: r.v for r in tables.read_current(spark, base).collect()} == want
    tables.replace_version(keyed(spark, {1: 1}), base)
    assert {r.k: r.v for r in tables.read_current(spark, base).collect()} == {1: 1}
    tables.upsert_version(spark, keyed(spark, {2: 2}), base, ["k"], rows_per_bucket=20)
    assert {r.k: r.v for r in tables.read_current(spark, base).collect()} == {1: 1, 2: 2}


def test_upsert_with_other_types_finds_its_bucket(spark, tmp_path):
    base = str(tmp_path / "t")
    for _ in range(2):
        tables.upsert_version(spark, keyed(spark, {k: 0 for k in range(30)}), base, ["k"], rows_per_bucket=4)
    long = keyed(spark, {k: 1 for k in range(30)}, 2).withColumn("k", F.col("k").cast("long"))
    done = tables.upsert_version(spark, long, base, ["k"], rows_per_bucket=4)
    assert done["after"] == 30 and {r.v for r in tables.read_current(spark, base).collect()} == {1}


def test_parts_are_merged_and_old_ones_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FAN", 3)
    monkeypatch.setattr(tables, "MANIFEST_FILES", 4)
    path = str(tmp_path / "t")
    held = None
    for i in range(14):
        part = keyed(spark, {2 * i: i, 2 * i + 1: i, 0: 99})
        tables.append_new(spark, part, path, ["k"], tag=f"tag{i}", batches=[f"b{i:02d}"])
        if i == 11:
            held = tables.read(spark, path)  # a reader from before the next loads
        if i == 12:
            assert held.count() == 24
    assert {r.k: r.v for r in tables.read(spark, path).collect()} == {0: 99} | {k: k // 2 for k in range(1, 28)}
    rows = tables.manifest(spark, path)
    live = tables._appended(rows)
    assert len(live) <= 2 * 4 and sum(r["n_rows"] for r in live) == 28
    folders = os.listdir(path)
    assert len(folders) <= len(live) + 2 * tables.FAN < 14
    assert len([f for f in os.listdir(f"{path}.manifest") if f.startswith("part-")]) <= 6
    assert tables.taken_batches(spark, path).distinct().count() == 14
    assert tables.append_new(spark, keyed(spark, {1000: 1}), path, ["k"], tag="tag3")["added"] == 0


def test_old_versions_are_removed(spark, tmp_path):
    base = str(tmp_path / "t")
    for i in range(6):
        tables.replace_version(keyed(spark, {i: i}), base)
    write(tmp_path / "t" / "part=9-unfinished" / "x", "")
    tables.replace_version(keyed(spark, {6: 6}), base)
    assert len(os.listdir(base)) == tables.KEEP + 1  # what is in no manifest stays
    assert [r.k for r in tables.read_current(spark, base).collect()] == [6]


def test_scope_removes_what_was_staged(spark):
    before = set(os.listdir(f"{scratch_root(spark).removeprefix('file:')}/playspan")) if os.path.exists(
        f"{scratch_root(spark).removeprefix('file:')}/playspan") else set()
    with scratch_scope(spark, "scope"):
        assert stage(spark.range(5).toDF("x"), "a").count() == 5
    assert set(os.listdir(f"{scratch_root(spark).removeprefix('file:')}/playspan")) == before


def test_repeats_on_the_stream(spark, tmp_path, monkeypatch):
    """Repeats are dropped before the table is looked at; late ones and older repeats are right."""
    table, keys, check = str(tmp_path / "t"), schemas.TABLE_KEYS["raw_plays"], str(tmp_path / "check")
    looked, append = [], tables.append_new
    monkeypatch.setattr(tables, "append_new", lambda s, b, *a, **k: looked.append(b.count()) or append(s, b, *a, **k))

    def run(hour, tracks, name=None, remember="6 hours", check=check):
        play_file(tmp_path / "in", 1, hour, tracks)
        if name:
            source = next((tmp_path / "in").rglob(f"plays_20240101_{hour:02d}0000.csv"))
            write(source.with_name(name), source.read_text())
        stream = incremental.landing_stream(spark, str(tmp_path / "in"), schemas.PLAYS_FILE)
        incremental.without_repeats(stream, table, keys, check, remember=remember)
        return sorted(r.track_id for r in tables.read(spark, table).collect())

    assert run(9, "AB", "again.csv") == ["A", "B"] and looked == [2]
    assert run(9, "AB", "again2.csv") == ["A", "B"] and looked == [2]
    assert run(5, "C") == ["A", "B", "C"] and looked == [2, 1]  # earlier than all before it
    # another checkpoint knows no keys: the table does
    assert run(6, "D", check=str(tmp_path / "other")) == ["A", "B", "C", "D"] and looked[-1] == 4
    assert run(7, "E", remember=None, check=str(tmp_path / "third")) == ["A", "B", "C", "D", "E"]


def page(day, hour, *tracks):
    return json.dumps({"items": [
        {"played_at": f"2024-01-{day:02d}T{hour:02d}:{i:02d}:00Z",
         "track": t and {"id": t, "name": t, "uri": "u", "duration_ms": 60000, "popularity": 2, "explicit": False,
                         "artists": [{"id": "a1", "name": "A"}], "album": {"id": "al"}}}
        for i, t in enumerate(tracks)
    ]})


def test_pages_to_models(spark, tmp_path):
    files, root = tmp_path / "in", str(tmp_path / "out")
    bad = ['{"items": [', '{"error": {"status": 429}}', '{"items": "none"}']
    keyless = page(1, 3, "x").replace('"id": "x", ', "")
    write(files / "plays" / "2024" / "01" / "01" / "p1.json", "\n".join([page(1, 1, "A", None, "B"), *bad, keyless]))
    write(files / "artists" / "x.json", json.dumps({"artists": [{"id": "a1", "name": "A", "genres": ["pop"], "popularity": 3}, None]}))
    write(files / "playlists" / "x.json", json.dumps({"items": [{"id": "p", "name": "P", "owner": {"id": "me"}}]}))
    write(files / "playlist_tracks" / "x.json", json.dumps(
        {"playlist_id": "p", "offset": 100, "items": [{"added_at": "2024-01-01T00:00:00Z", "track": {"id": "A"}}]}))

    def run():
        return {r.category: tuple(r)[1:] for r in load.load_pages(spark, str(files), root, user_id="me", loaded_at=stamp()).collect()}

    assert run() == {"plays": (5, 3, 2, 1), "artists": (1, 0, 1, 0), "playlists": (1, 0, 1, 0), "playlist_tracks": (1, 0, 1, 0)}
    assert run() == {}
    kept = tables.read(spark, tables.layer_path(root, "raw", "broken_pages")).collect()
    assert len(kept) == 3 and {r.batch for r in kept} == {"2024/01/01/p1.json"}
    assert bad[0] in {r.body for r in kept}
    write(files / "plays" / "2024" / "01" / "02" / "p2.json", page(2, 1, "C"))
    assert run() == {"plays": (1, 0, 1, 0)}
    raw = load.raw_tables(spark, root)
    assert sorted(r.track_id for r in raw["raw_plays"].collect()) == ["A", "B", "C"]
    assert [(r.is_owner, r.playlist_id) for r in raw["raw_playlists"].collect()] == [(True, "p")]
    assert [r.position for r in raw["raw_playlist_tracks"].collect()] == [100]
    assert build.build(raw, root)["fct_history"].count() == 3


def test_audio_features_are_loaded(spark, tmp_path):
    files, root = tmp_path / "in", str(tmp_path / "out")
    assert "raw_audio_features" not in load.raw_tables(spark, root)
    header = ",".join(c.split()[0] for c in schemas.AUDIO_FEATURES.replace("\n", " ").split(","))
    for day, energy in ((1, 0.9), (2, 0.1)):
        line = f"A,0.5,{energy},1,-5,1,0.1,0.1,0,0.1,0.8,120,180000,4"
        write(files / "audio_features" / "2024" / "01" / f"{day:02d}" / "f.csv", f"{header}\n{line}\n")
    play_file(files, 1, 5, "AB")
    load.load_landing(spark, str(files), root, loaded_at=stamp())
    raw = load.raw_tables(spark, root)
    assert [r.energy for r in raw["raw_audio_features"].collect()] == [0.1]
    made = build.build(raw, root)
    assert made["fct_history_wide"].count() == 2 and made["audio_features_daily"].count() == 1


@pytest.mark.parametrize("value, want", [(3000.5, 3000), ("1e3", 1000), (7.0, 7), (None, None), ("41000", 41000)])
def test_numbers_of_exports_as_text(spark, tmp_path, value, want):
    shown = json.dumps([record(fixed.TRACK_URI_PREFIX + "A", 0)]).replace('"ms_played": 0', f'"ms_played": {"null" if value is None else value}')
    write(tmp_path / "Streaming_History_Audio_1.json", shown.replace("true", "true"))
    key = "spark.sql.json.enableExactStringParsing"
    before = spark.conf.get(key)
    (row,) = landing.read_history(spark, str(tmp_path), loaded_at=stamp()).collect()
    assert row.ms_played == want and spark.conf.get(key) == before


def test_long_numbers_of_exports(spark, tmp_path):
    item = record(fixed.TRACK_URI_PREFIX + "A") | {"offline_timestamp": 12345678901234567}
    write(tmp_path / "Streaming_History_Audio_1.json", json.dumps([item]))
    (row,) = landing.read_history(spark, str(tmp_path), loaded_at=stamp()).collect()
    assert row.offline_timestamp == 12345678901234567


def test_many_buckets_are_listed_by_few_tasks(spark, tmp_path):
    base = str(tmp_path / "t")
    rows = spark.range(2000).selectExpr("id", "1 AS v", "current_timestamp() AS loaded_at")
    tables.upsert_version(spark, rows, base, ["id"], rows_per_bucket=1)
    tables.upsert_version(spark, rows, base, ["id"], rows_per_bucket=5)
    assert len({r["bucket"] for r in tables.manifest(spark, base) if r["version"] == 1}) > 100
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        found = tables.read_current(spark, base)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    tasks = [tracker.getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) <= 64
    assert found.count() == 2000
