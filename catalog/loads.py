"""Registered queries of loads in several steps: batches, buckets, pages, late plays."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from catalog.inputs import models, table, text
from catalog.queries import _balances, _events, _play_pages, load_time, query
from playspan.operators import late
from playspan.plans import daily, load, staging, star
from playspan.session import scratch_path
from playspan.sources import landing, schemas, tables
from playspan.streaming import landing as incremental


def _artist_batches(spark, folder) -> DataFrame:
    """Orders as artist records in three batches, one record per customer and batch."""
    key = F.col("o_orderkey")
    return (
        table(spark, folder, "orders")
        .groupBy("o_custkey", (key % 3).cast("int").alias("b"))
        .agg(F.max_by(F.struct("*"), key).alias("o"))
        .select(
            "b", text("a", F.col("o_custkey")).alias("artist_id"), text("Artist ", F.col("o_custkey")).alias("artist_name"),
            F.lower("o.o_orderpriority").alias("genres"), (F.col("o.o_orderkey") % 101).cast("int").alias("popularity"),
            F.floor("o.o_totalprice").cast("int").alias("followers"),
        )
    )


def _land(rows: DataFrame, root: str, category: str, batch: int) -> None:
    """The rows of one batch as CSV below the folder of its day."""
    part = rows.filter(F.col("b") == batch).drop("b")
    part.write.options(**landing.CSV_OUT).csv(f"{root}/{category}/2024/01/{batch + 1:02d}/batch")


def _loads(spark, folder):
    """Two batches landed and the last one loaded, then the third landed and all loaded, twice."""
    landed, root, rows = scratch_path(spark, "landing"), scratch_path(spark, "raw"), _artist_batches(spark, folder)
    counts = []
    for new, mode in (((0, 2), "latest"), ((1,), "all"), ((), "all")):
        for b in new:
            _land(rows, landed, "artists", b)
        counts.append(load.load_landing(spark, landed, root, mode=mode, loaded_at=load_time()))
    return root, counts


@query
def load_batches_upsert(spark, folder):
    """The later batch wins, in whatever order batches are loaded."""
    root, _ = _loads(spark, folder)
    return load.read_raw(spark, root, "raw_artists")


@query
def load_batches_metrics(spark, folder):
    """Counts of three loads; the third one finds nothing new."""
    _, counts = _loads(spark, folder)
    first, second, third = (c.withColumn("load", F.lit(n)) for n, c in enumerate(counts, 1))
    return first.unionByName(second).unionByName(third)


@query
def stream_batches_upsert(spark, folder):
    """All three batches in one micro-batch, landed last one first."""
    landed, path, rows = scratch_path(spark, "landing"), scratch_path(spark, "artists"), _artist_batches(spark, folder)
    for b in (2, 1, 0):
        _land(rows, landed, "artists", b)
    stream = incremental.landing_stream(spark, f"{landed}/artists", schemas.ARTISTS_FILE)
    check = scratch_path(spark, "stream")
    incremental.ingest_upsert(stream, path, schemas.TABLE_KEYS["raw_artists"], check, loaded_at=load_time())
    return tables.read_current(spark, path)


@query
def upsert_bucketed(spark, folder):
    """Balances upserted into a table of many buckets, of which each load rewrites some."""
    base = scratch_path(spark, "balances")
    old, new = _balances(spark, folder)
    late = F.col("c_custkey") % 2 == 0
    for part in (old, new.filter(~late), new.filter(late)):
        tables.upsert_version(spark, part, base, ["c_custkey"], rows_per_bucket=200)
    return tables.read_current(spark, base)


def _load_play_pages(spark, folder):
    """Pages of plays landed as JSON lines; some are cut off, some are error bodies."""
    landed, root = scratch_path(spark, "pages"), scratch_path(spark, "raw")
    n, body = F.col("page"), F.col("body")
    line = (
        F.when(n % 7 == 0, F.expr("left(body, length(body) - 20)"))
        .when(n % 11 == 3, F.lit('{"error": {"status": 500}}')).otherwise(body)
    )
    day = F.format_string("%02d", n % 3 + 1)
    _play_pages(spark, folder).select(line.alias("value"), day.alias("day")).write.partitionBy("day").text(f"{landed}/plays")
    done = load.load_pages(spark, landed, root, user_id="u7", loaded_at=load_time(), suffix=".txt")
    return root, done


@query
def load_pages_plays(spark, folder):
    """From landed pages to staged plays."""
    root, _ = _load_play_pages(spark, folder)
    return staging.plays(load.read_raw(spark, root, "raw_plays"))


@query
def load_pages_broken(spark, folder):
    """Counts of a load of pages, and the broken pages that were kept."""
    root, done = _load_play_pages(spark, folder)
    kept = tables.read(spark, tables.layer_path(root, "raw", "broken_pages"))
    n = kept.groupBy("category").agg(F.count(F.lit(1)).alias("n_kept"))
    return done.join(n, "category", "left").withColumn("n_kept", F.coalesce("n_kept", F.lit(0)))


@query
def load_audio_features(spark, folder):
    """Audio features in three landed batches to staged ones: the last batch of a track wins."""
    landed, root = scratch_path(spark, "landing"), scratch_path(spark, "raw")
    names = T.StructType.fromDDL(schemas.AUDIO_FEATURES.strip()).fieldNames()
    rows = (
        models(spark, folder).raw_features
        .withColumn("b", (F.floor(F.unix_seconds("loaded_at") / 3600) % 3).cast("int"))
        .groupBy("id", "b").agg(F.max_by(F.struct("*"), "duration_ms").alias("r")).select("b", *(f"r.{c}" for c in names))
    )
    for b in range(3):
        _land(rows, landed, "audio_features", b)
    load.load_landing(spark, landed, root, loaded_at=load_time())
    return staging.audio_features(load.raw_tables(spark, root)["raw_audio_features"])


# ---------------------------------------------------------------- late plays


def _with_late_events(spark, folder, name, **options) -> DataFrame:
    """Events numbered without those of some hours, then with them, added in two steps."""
    events = _events(spark, folder)
    hour = F.hour("played_at")
    kept = late.NumberedPlays(scratch_path(spark, name), ties=("event_id",), carry=("track_id",), rows_per_range=20_000, **options)
    kept.begin(events.filter((hour != 5) & (hour != 17)))
    kept.add(events.filter(hour == 17))
    kept.add(events.filter(hour == 5))
    return kept.read(spark)


@query
def sessionize_late(spark, folder):
    return _with_late_events(spark, folder, "sessions", gap_minutes=5).select("event_id", "is_new_session", "session_number")


@query
def sessionize_per_user_late(spark, folder):
    return _with_late_events(spark, folder, "user-sessions", by=("user_id",), gap_minutes=240).select(
        "event_id", "user_id", "is_new_session", "session_number"
    )


@query
def repeat_runs_late(spark, folder):
    return _with_late_events(spark, folder, "runs").select("event_id", "is_repeat", "repeat_sequence")


def _refreshed(spark, folder, name="plays") -> str:
    """What is kept for daily reports (``plays`` or ``sessions``): of all plays but those of some
    hours, then the days of the late ones refreshed. Made once per session and folder."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _kept:
        m, root = models(spark, folder), scratch_path(spark, "daily")
        is_late = (F.dayofmonth("played_at") % 5 == 2) & (F.hour("played_at") < 8)
        early, new = m.raw_plays.filter(~is_late), m.raw_plays.filter(is_late)
        daily.refresh(star.all_plays(staging.plays(early), staging.history(m.raw_history, early)), root, kept=(name,))
        days = daily.touched_days(new, staging.known_ids(early), staging.known_ids(m.raw_plays), m.stg_history)
        daily.refresh(star.all_plays(m.stg_plays, m.stg_history), root, days, (name,))
        _kept[key] = root
    return _kept[key]


_kept: dict[tuple[str, str, str], str] = {}


@query
def refreshed_top_artists(spark, folder):
    m = models(spark, folder)
    return daily.top_artists(_refreshed(spark, folder), m.dim_tracks, m.dim_artists)


@query
def refreshed_top_tracks(spark, folder):
    m = models(spark, folder)
    return daily.top_tracks(_refreshed(spark, folder), m.dim_tracks, m.dim_artists)


@query
def refreshed_patterns(spark, folder):
    m = models(spark, folder)
    return daily.patterns(_refreshed(spark, folder), m.dim_tracks, m.dim_artists)


@query
def refreshed_sessions(spark, folder):
    return daily.sessions(spark, _refreshed(spark, folder, "sessions"))
