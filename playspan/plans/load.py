"""Load landing files into raw tables, as a scheduled run does."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playspan.session import scratch_scope, stage
from playspan.sources import landing, pages, schemas, tables

# category: (table, schema of its files, whether known keys are replaced)
CATEGORIES = {
    "plays": ("raw_plays", schemas.PLAYS_FILE, False),
    "artists": ("raw_artists", schemas.ARTISTS_FILE, True),
    "playlists": ("raw_playlists", schemas.PLAYLISTS_FILE, True),
    "playlist_tracks": ("raw_playlist_tracks", schemas.PLAYLIST_TRACKS_FILE, True),
    "audio_features": ("raw_audio_features", schemas.AUDIO_FEATURES, True),
}
METRICS = "table_name string, rows_before long, rows_after long, rows_added long, rows_updated long"


def read_raw(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A raw table, empty when nothing was loaded yet."""
    path = tables.layer_path(root, "raw", table)
    replaced = {t: schema for t, schema, replaces in CATEGORIES.values() if replaces}
    if table in replaced:
        found = tables.read_current(spark, path)
    else:
        found = tables.read(spark, path)
    if found is not None:
        return found
    known = {t: schema for t, schema, _ in CATEGORIES.values()}
    known |= {"raw_history": schemas.HISTORY_RECORD, "raw_exported_plays": schemas.EXPORTED_PLAYS}
    return spark.createDataFrame([], schemas.with_loaded_at(known[table]))


def load_landing(
    spark: SparkSession,
    landing_root: str,
    root: str,
    *,
    mode: str = "all",
    loaded_at: Column | None = None,
) -> DataFrame:
    """Merge the batches (or the last one, ``mode="latest"``) of every category into its raw table.

    A batch is taken once: those in the manifest of a table are not opened again, so a load
    reads what landed since the last one, and a run that was missed is made up for. Plays
    already known are left alone, the other categories are replaced by key; there the later
    batch wins, in whatever order batches are taken. Returns a row of counts per category; a
    category without new batches, or with empty ones, has none.
    """
    counted = spark.createDataFrame([], METRICS)
    for category, (table, schema, replaces) in CATEGORIES.items():
        path = tables.layer_path(root, "raw", table)
        found = landing.new_batches(spark, landing_root, category, tables.taken_batches(spark, path), mode)
        if not found:
            continue
        batch = landing.read_csv(spark, sorted(found.values()), schema, loaded_at, category)
        done = _merge(spark, batch, path, table, replaces, found)
        if done:
            counted = counted.unionByName(_metrics(spark, table, done))
    return counted


def _merge(spark: SparkSession, batch: DataFrame, path: str, table: str, replaces: bool, found: dict[str, str]) -> dict[str, int] | None:
    """Merge rows that tell their batch into a raw table; None if there are no rows."""
    if batch.isEmpty():
        tables.mark_taken(spark, path, found)
        return None
    keys = schemas.TABLE_KEYS[table]
    if replaces:
        return tables.upsert_version(spark, batch, path, keys, batches=found)
    first = [F.col(landing.BATCH).asc()]
    return tables.append_new(spark, batch, path, keys, order=first, batches=found)


def load_pages(
    spark: SparkSession, pages_root: str, root: str, *, user_id: str, loaded_at: Column | None = None,
    suffix: str = ".json",
) -> DataFrame:
    """Landed API pages (JSON lines) to the raw tables, batch by batch as ``load_landing``.

    Lines that are not JSON, and pages without their list (an error body), are kept in the raw
    table ``broken_pages`` with their batch, and the rest is loaded. Rows without a key cannot
    be loaded and are counted. Returns per category: n_pages, n_broken, n_rows, n_without_key.
    """
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    counted = spark.createDataFrame([], "category string, n_pages long, n_broken long, n_rows long, n_without_key long")
    broken_path = tables.layer_path(root, "raw", "broken_pages")
    for category, kind in pages.kinds(user_id, stamp).items():
        table, _, replaces = CATEGORIES[category]
        path = tables.layer_path(root, "raw", table)
        found = landing.new_batches(spark, pages_root, category, tables.taken_batches(spark, path), suffix=suffix)
        if not found:
            continue
        with scratch_scope(spark, "pages"):
            landed = stage(pages.read_landed(spark, sorted(found.values()), category, kind), "landed")
            broken = landed.filter(pages.is_broken(kind)).select(
                F.lit(category).alias("category"), landing.BATCH, F.coalesce("_body", F.to_json(F.struct("*"))).alias("body")
            )
            # The same page of the same batch is kept once, also if a load is tried again.
            broken = broken.withColumnRenamed(landing.BATCH, "batch").withColumn("loaded_at", stamp)
            tables.append_new(spark, broken, broken_path, ("category", "batch", "body"))
            keys = schemas.TABLE_KEYS[table]
            rows = kind.flatten(landed.filter(~pages.is_broken(kind))).withColumn("loaded_at", stamp)
            rows = stage(rows, "rows")
            whole = rows.dropna(subset=list(keys))
            n_pages, n_broken = landed.agg(F.count(F.lit(1)), F.count_if(pages.is_broken(kind))).first()
            n_rows, n_whole = rows.count(), whole.count()
            _merge(spark, whole, path, table, replaces, found)
        counted = counted.unionByName(
            spark.createDataFrame([(category, n_pages, n_broken, n_whole, n_rows - n_whole)], counted.schema)
        )
    return counted


def _metrics(spark: SparkSession, table: str, done: dict[str, int]) -> DataFrame:
    return spark.createDataFrame([(table, *(done[k] for k in ("before", "after", "added", "updated")))], METRICS)


def load_exported_plays(
    spark: SparkSession, folder: str, root: str, *, loaded_at: Column | None = None, **options
) -> DataFrame:
    """Load the other export path: insert-ignore into its raw table. Returns its counts.

    Plays without a time or track have no key and are left out.
    """
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    keys = schemas.TABLE_KEYS["raw_exported_plays"]
    plays = landing.read_exported_plays(spark, folder, **options).dropna(subset=list(keys))
    path = tables.layer_path(root, "raw", "raw_exported_plays")
    done = tables.append_new(spark, plays.withColumn("loaded_at", stamp), path, keys)
    return _metrics(spark, "raw_exported_plays", done)


def load_history(
    spark: SparkSession, folder: str, root: str, *, loaded_at: Column | None = None
) -> bool:
    """Load a history export unless it is loaded already. True if it was loaded now."""
    path = tables.layer_path(root, "raw", "raw_history")
    return tables.load_once(
        spark, path, lambda: landing.read_history(spark, folder, loaded_at=loaded_at)
    )


def raw_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All raw tables, ready for ``build``."""
    names = [table for table, _, _ in CATEGORIES.values()] + ["raw_history"]
    if not tables.exists(spark, tables.layer_path(root, "raw", "raw_audio_features")):
        names.remove("raw_audio_features")  # no audio models without measurements
    return {name: read_raw(spark, root, name) for name in names}
