"""Landing files: CSV batches under a date tree, JSON history exports."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from playspan import fixed
from playspan.functions.keys import is_track_uri, last_uri_piece
from playspan.session import file_system, stage
from playspan.sources import schemas

BATCH_PARTS = ("year", "month", "day", "batch")
BATCH = "_batch"  # column with the name of a row's batch; later batches have greater names
ROWS_PER_FILE = 500_000  # files with newlines in quotes are read by one task each

# One dialect for files, streams and writers: doubled quotes, newlines inside quotes, blanks
# and microseconds kept; a row with too many or too few fields is an error.
CSV_IN = {"header": "true", "escape": '"', "multiLine": "true", "mode": "FAILFAST"}
CSV_OUT = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def as_text(schema: str) -> T.StructType:
    """The columns of ``schema``, all as text, for files whose values are converted later."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in T.StructType.fromDDL(schema.strip())])


def converted(value: Column, kind: T.DataType, name: str) -> Column:
    """Text as ``kind``, as a SQL cast converts it: ``7.0`` is the integer 7, ``3000.5`` the
    even one next to it. Empty text is NULL for all but texts; other text that has no such
    value is an error."""
    if isinstance(kind, T.StringType):
        return value
    text = F.trim(value)
    if isinstance(kind, (T.IntegerType, T.LongType)):
        found = F.bround(text.try_cast("decimal(38,10)"), 0).try_cast(kind)
    else:
        found = text.try_cast(kind)
    wrong = F.raise_error(F.concat(F.lit(f"{name}: not {kind.simpleString()}: "), value))
    return F.when(value.isNull() | (text == ""), F.lit(None)).when(found.isNull(), wrong).otherwise(found).cast(kind)


def typed(rows: DataFrame, schema: str) -> DataFrame:
    """Text columns of ``rows`` converted to the types of ``schema``; other columns stay."""
    kinds = T.StructType.fromDDL(schema.strip())
    return rows.withColumns({f.name: converted(F.col(f.name), f.dataType, f.name) for f in kinds})


def no_such_path(error: Exception) -> bool:
    return getattr(error, "getCondition", error.getErrorClass)() == "PATH_NOT_FOUND"


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str,
    loaded_at: Column | None = None,
    category: str | None = None,
) -> DataFrame:
    """Typed CSV with header; ``loaded_at`` is the load time unless given. With a ``category``
    each row also has the name of its batch (``BATCH``)."""
    rows = spark.read.schema(as_text(schema)).options(**CSV_IN).option("recursiveFileLookup", True).csv(paths)
    if category is not None:
        rows = rows.withColumn(BATCH, batch_name(F.col("_metadata.file_path"), category))
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    return typed(rows, schema).withColumn("loaded_at", stamp)


def batch_name(file: Column, category: str | None = None) -> Column:
    """The batch of a file: the file itself, or its folder for part files of a writer; below
    the folder of the category, if given. In a date tree later batches have greater names."""
    batch = F.regexp_replace(file, r"/part-[^/]*$", "")
    return batch if category is None else F.regexp_replace(batch, f"^.*/{re.escape(category)}/", "")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, microseconds kept."""
    df.write.mode("overwrite").options(**CSV_OUT).csv(path)


def write_landing(df: DataFrame, root: str, category: str, at: str, batch: str | None = None) -> str:
    """Add a batch as CSV under category/year/month/day of the ``at`` column and its own name.

    Batches written before stay. The name is the time of writing unless given, so the last
    batch of a day sorts last. Rows of a day are gathered into few files; a day that is
    much larger than others is split over several tasks. Returns the batch name.
    """
    batch = batch or f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}"
    when = F.col(at)
    parts = {
        "year": F.date_format(when, "yyyy"),
        "month": F.date_format(when, "MM"),
        "day": F.date_format(when, "dd"),
        "batch": F.lit(batch),
    }
    (
        df.withColumns(parts)
        .hint("rebalance", *BATCH_PARTS)
        .write.mode("append")
        .partitionBy(*BATCH_PARTS)
        .options(**CSV_OUT, maxRecordsPerFile=ROWS_PER_FILE)
        .csv(f"{root}/{category}")
    )
    return batch


def batches(spark: SparkSession, root: str, category: str, suffix: str = ".csv") -> DataFrame:
    """Batches of a category, (name, batch): a batch folder, or a file named after the
    category, and its path. Lists files without opening them."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(f"{root}/{category}")
        .select("path", "_metadata.file_path")
    )
    return files.select(batch_name(F.col("file_path"), category).alias("name"), batch_name(F.col("path")).alias("batch")).distinct()


def last_batch(spark: SparkSession, root: str, category: str, suffix: str = ".csv") -> str | None:
    """Path of the last batch of a category: down the tree by the greatest names, so that one
    folder per level is listed and not the whole history. None without folder or files."""

    def last_file(where, files) -> str | None:
        for found in sorted(files.listStatus(where), key=lambda f: f.getPath().getName(), reverse=True):
            name = found.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            inner = last_file(found.getPath(), files) if found.isDirectory() else None
            if inner or (found.isFile() and name.endswith(suffix)):
                return inner or found.getPath().toString()
        return None

    where, files = file_system(spark, f"{root}/{category}")
    last = last_file(where, files) if files.exists(where) else None
    return last and re.sub(r"/part-[^/]*$", "", last)


def new_batches(
    spark: SparkSession, root: str, category: str, taken: DataFrame | None, mode: str = "all", suffix: str = ".csv"
) -> dict[str, str]:
    """Batches that were not taken yet, name to path: all of them, or the last one.

    ``taken`` has the names of the others (column ``name``). Nothing is opened.
    """
    last = last_batch(spark, root, category, suffix)
    if last is None:
        return {}
    if mode == "latest":
        spark_path = spark.createDataFrame([(last,)], "batch string")
        found = spark_path.select(batch_name(F.col("batch"), category).alias("name"), "batch")
    else:
        found = batches(spark, root, category, suffix)
    if taken is not None:
        found = found.join(taken, "name", "left_anti")
    return {r["name"]: r["batch"] for r in found.collect()}


def read_batches(
    spark: SparkSession,
    root: str,
    category: str,
    schema: str,
    *,
    mode: str = "latest",
    loaded_at: Column | None = None,
) -> DataFrame | None:
    """Rows of the last batch of a category, or of all batches with ``mode="all"``.

    Returns None when the category has no folder or no files, so that a missing category is
    a warning for the caller and not an error. Any other problem is raised.
    """
    last = last_batch(spark, root, category)
    if last is None:
        return None
    return read_csv(spark, f"{root}/{category}" if mode == "all" else last, schema, loaded_at)


def read_history(
    spark: SparkSession,
    folder: str,
    *,
    pattern: str = fixed.HISTORY_FILE_GLOB,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Music plays of a history export: files hold one JSON array of records each.

    A file that is not valid JSON is left out whole, the others are loaded (see
    ``history_files``). Values are read as text and converted, so an odd number is no
    reason to leave out anything; one that does not convert is an error.
    """
    return plays_of_history(_read_arrays(spark, folder, pattern), loaded_at)


def plays_of_history(records: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    # One row per broken file, written first, so that Spark knows how small it is.
    broken = stage(broken_files(records), "broken")
    music = records.join(broken, "_file", "left_anti").filter(is_track_uri(F.col(schemas.HISTORY_TRACK_URI)))
    return typed(music.drop("_file", "_broken"), schemas.HISTORY_RECORD).withColumn("loaded_at", stamp)


def broken_files(records: DataFrame) -> DataFrame:
    return records.filter(F.col("_broken").isNotNull()).select("_file").distinct()


def history_files(spark: SparkSession, folder: str, pattern: str = fixed.HISTORY_FILE_GLOB) -> DataFrame:
    """What a history load takes: file, skipped (not JSON), n_records, n_music."""
    skipped = F.count(F.col("_broken")) > 0
    music = F.count_if(is_track_uri(F.col(schemas.HISTORY_TRACK_URI)))
    return (
        _read_arrays(spark, folder, pattern)
        .groupBy(F.col("_file").alias("file"))
        .agg(skipped.alias("skipped"), F.count("*").alias("n"), music.alias("m"))
        .select(
            "file", "skipped", F.when(F.col("skipped"), 0).otherwise(F.col("n")).alias("n_records"),
            F.when(F.col("skipped"), 0).otherwise(F.col("m")).alias("n_music"),
        )
    )


@contextmanager
def plain_numbers(spark: SparkSession) -> Iterator[None]:
    """JSON numbers asked for as text come from the parser, not from a read of the file at the
    place of each value, which would be one request per number."""
    key = "spark.sql.json.enableExactStringParsing"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _read_arrays(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    schema = as_text(schemas.HISTORY_RECORD).add("_broken", T.StringType())
    parsed = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_broken")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .json(folder)
    )
    with plain_numbers(spark):
        return stage(parsed.withColumn("_file", F.col("_metadata.file_path")), "history")


EXPORT_NAMES = {
    # Export field -> column
    "ts": "played_at",
    "master_metadata_track_name": "track_name",
    "master_metadata_album_artist_name": "artist_name",
    "master_metadata_album_album_name": "album_name",
    "spotify_track_uri": "track_uri",
    "ms_played": "duration_ms",
}


def exported_plays(records: DataFrame, min_play_ms: int = fixed.MIN_PLAY_MS) -> DataFrame:
    """The other export path: long enough plays of any kind, without exact duplicates.

    Works on whatever columns ``records`` has; the id is the last piece of the URI.
    """
    named = records.withColumnsRenamed(EXPORT_NAMES)
    if "track_uri" in named.columns:
        named = named.withColumn("track_id", last_uri_piece(F.col("track_uri")))
    if "played_at" in named.columns:
        named = named.withColumn("played_at", F.col("played_at").cast("timestamp"))
    if "duration_ms" in named.columns:
        named = named.filter(F.col("duration_ms") >= min_play_ms)
    wanted = T.StructType.fromDDL(schemas.EXPORTED_PLAYS.strip()).fieldNames()
    return named.select(*(c for c in wanted if c in named.columns)).distinct()


def read_exported_plays(
    spark: SparkSession, folder: str, min_play_ms: int = fixed.MIN_PLAY_MS,
    patterns: Sequence[str] = (fixed.HISTORY_FILE_GLOB, fixed.HISTORY_FILE_GLOB_ALT),
) -> DataFrame:
    """Exported plays of a folder, under the first file name that is found, oldest first.

    A file that is not JSON is an error here.
    """
    records = None
    for pattern in patterns:
        try:
            found = _read_arrays(spark, folder, pattern)
        except AnalysisException as error:
            if no_such_path(error):
                continue
            raise
        if not found.isEmpty():
            records = found
            break
    if records is None:
        raise FileNotFoundError(f"no history files in {folder}")
    broken = [r[0] for r in broken_files(records).limit(5).collect()]
    if broken:
        raise ValueError(f"not JSON: {', '.join(broken)}")
    records = typed(records.drop("_file", "_broken"), schemas.HISTORY_RECORD)
    return exported_plays(records, min_play_ms).orderBy("played_at")
