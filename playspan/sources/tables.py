"""Tables as parquet folders with a manifest: layers, load-once, append, replace and upsert.

A table is a set of parts (``part=<name>`` folders) and a manifest next to it, a small table
with a row per part. A part counts once its row is in the manifest, which is written after
the part, so a broken write is never read and committer settings do not matter.

Appended tables read all their parts; small ones are merged as they add up, so that their
number grows with the logarithm of the loads. Replaced tables read the newest version. A table
that is upserted is cut into buckets by a hash of its key once it is large: a version then
holds the buckets that it changed, and the newest of each is read.

A manifest row can carry a tag and names of landed batches. A write whose tag is there already
is left out, which makes the batches of a stream safe to repeat, under any checkpoint; batches
that are there were taken, and are not opened again. What no version of the last ``KEEP`` reads
any more is removed after a commit, so readers that began before can finish.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from playspan.operators.dedup import align
from playspan.operators.merge import batch_rows, new_rows, not_outdated, upsert_batch
from playspan.session import few_listing_tasks, file_system, remove, scratch_scope, stage
from playspan.sources.landing import BATCH, no_such_path

LAYERS = ("raw", "staging", "marts", "analytics")
MANIFEST = (
    "part string, version long, n_rows long, tag string, low timestamp, high timestamp,"
    " bucket long, buckets long, batches array<string>, replaces array<string>"
)
FAN = 8  # so many parts of about one size are merged into one
KEEP = 3  # versions whose parts stay
MANIFEST_FILES = 50
ROWS_PER_BUCKET = 1_000_000


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}.manifest")
    except AnalysisException as error:
        if no_such_path(error):
            return None
        raise


def manifest(spark: SparkSession, path: str) -> list[Row]:
    """All that was written to a table, in the order of versions: a row per part, or bucket."""
    found = _manifest(spark, path)
    rows = {(r["version"], r["part"], r["bucket"]): r for r in found.collect()} if found is not None else {}
    return sorted(rows.values(), key=lambda r: (r["version"], r["bucket"] or 0))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a completed write is at ``path``."""
    return any(r["part"] for r in manifest(spark, path))


def taken_batches(spark: SparkSession, path: str) -> DataFrame | None:
    """Names of the landed batches that a table holds (column ``name``)."""
    found = _manifest(spark, path)
    return None if found is None else found.select(F.explode("batches").alias("name"))


def _next(rows: Sequence[Row]) -> int:
    return rows[-1]["version"] + 1 if rows else 0


def _record(spark: SparkSession, path: str, rows: Iterable[dict]) -> None:
    fields = T.StructType.fromDDL(MANIFEST).fieldNames()
    filled = [tuple(r.get(f) for f in fields) for r in rows]
    spark.createDataFrame(filled, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}.manifest")


def mark_taken(spark: SparkSession, path: str, batches: Iterable[str]) -> None:
    """Batches without rows were taken too."""
    rows = manifest(spark, path)
    _record(spark, path, [{"version": _next(rows), "n_rows": 0, "batches": sorted(batches)}])


def _write_part(df: DataFrame, path: str, version: int, time: str | None = None, **more) -> dict:
    """Write a part, then its row in the manifest; returns that row."""
    spark, part = df.sparkSession, f"{version}-{uuid.uuid4().hex}"
    folder = f"{path}/part={part}"
    df.write.parquet(folder)
    written = spark.read.schema(df.schema).parquet(folder)
    ends = (F.min(time), F.max(time)) if time else (F.lit(None).cast("timestamp"),) * 2
    n, low, high = written.agg(F.count(F.lit(1)), *ends).first()
    row = {"part": part, "version": version, "n_rows": n, "low": low, "high": high, **more}
    _record(spark, path, [row])
    return row


def _folder(path: str, row: Row) -> str:
    return f"{path}/part={row['part']}" + ("" if row["bucket"] is None else f"/bucket={row['bucket']}")


def _read_parts(spark: SparkSession, path: str, parts: Sequence[Row]) -> DataFrame:
    with few_listing_tasks(spark):
        return spark.read.parquet(*[_folder(path, r) for r in parts])


def _bucket_sizes(spark: SparkSession, folder: str) -> list[Row]:
    """The buckets of a part and their numbers of rows."""
    with few_listing_tasks(spark):
        written = spark.read.parquet(folder)
    return written.groupBy("bucket").count().collect()


def _appended(rows: Sequence[Row], upto: int | None = None) -> list[Row]:
    """Parts of an appended table (as of a version) that were not merged into others."""
    rows = [r for r in rows if upto is None or r["version"] <= upto]
    merged = {p for r in rows for p in r["replaces"] or ()}
    return [r for r in rows if r["part"] and r["part"] not in merged]


def _newest(rows: Sequence[Row], upto: int | None = None) -> list[Row]:
    """Parts of a replaced table (as of a version): the newest, or the newest of each bucket."""
    rows = [r for r in rows if r["part"] and (upto is None or r["version"] <= upto)]
    if not rows or rows[-1]["bucket"] is None:
        return rows[-1:]
    whole = max((r["version"] for r in rows if r["bucket"] is None), default=-1)
    same = [r for r in rows if r["version"] > whole and r["buckets"] == rows[-1]["buckets"]]
    return list({r["bucket"]: r for r in same}.values())


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """All parts of an appended table, or None if there is none."""
    parts = _appended(manifest(spark, path))
    return _read_parts(spark, path, parts) if parts else None


def layer_path(root: str, layer: str, name: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer}")
    return f"{root.rstrip('/')}/{layer}/{name}"


def publish(df: DataFrame, root: str, layer: str, name: str) -> DataFrame:
    """Make a model available: staging models stay lazy views, the rest become tables.

    A table is a new version beside the one being read, which stays until the new one is
    complete.
    """
    if layer == "staging":
        df.createOrReplaceTempView(f"{layer}_{name}")
        return df
    path = layer_path(root, layer, name)
    replace_version(df, path)
    return read_current(df.sparkSession, path).select(*df.columns)


def load_once(spark: SparkSession, path: str, load: Callable[[], DataFrame]) -> bool:
    """Write ``load()`` to ``path`` unless rows are there already. True if it was written."""
    if any(r["n_rows"] for r in manifest(spark, path)):
        return False
    replace_version(load(), path)
    return True


def _seen(rows: Sequence[Row], tag: str | None) -> bool:
    return tag is not None and any(r["tag"] == tag for r in rows)


def _unchanged(before: int) -> dict[str, int]:
    return {"before": before, "after": before, "added": 0, "updated": 0}


def append_new(
    spark: SparkSession, new: DataFrame, path: str, keys: Sequence[str], tag: str | None = None,
    *, order: Sequence[Column] = (), batches: Iterable[str] = (),
) -> dict[str, int]:
    """Insert-ignore into the table at ``path`` by appending only rows with new keys.

    Rows already there are not rewritten, and running it again adds nothing. Of equal keys in
    ``new`` the first by ``order`` is added; a batch column is for ordering only. Known keys
    are only looked for in parts that overlap the batch's span of the key's time, and within
    that span. Returns the row counts before and after, added and updated.
    """
    rows = manifest(spark, path)
    parts = _appended(rows)
    before, version = sum(r["n_rows"] for r in parts), _next(rows)
    if _seen(rows, tag):
        return _unchanged(before)
    with scratch_scope(spark, "append"):
        new = stage(new, "batch")
        old = spark.createDataFrame([], new.drop(BATCH).schema)
        times = [k for k in keys if isinstance(new.schema[k].dataType, T.TimestampType)]
        time = times[0] if times else None
        if time and parts:
            low, high = new.agg(F.min(time), F.max(time)).first()
            parts = [
                r for r in parts
                if r["n_rows"] and (r["low"] is None or low is None or (r["low"] <= high and r["high"] >= low))
            ]
        if parts:
            old = within_span(_read_parts(spark, path, parts), new, keys)
        row = _write_part(
            new_rows(old, new, keys, order), path, version, time, tag=tag, batches=sorted(batches) or None
        )
    merge_parts(spark, path, time)
    return {"before": before, "after": before + row["n_rows"], "added": row["n_rows"], "updated": 0}


def merge_parts(spark: SparkSession, path: str, time: str | None = None) -> None:
    """Merge ``FAN`` or more parts of about one size into one, until there are fewer of each
    size. A row is rewritten once per power of ``FAN`` in the size of the table."""
    while True:
        rows = manifest(spark, path)
        sizes: dict[int, list[Row]] = {}
        for r in _appended(rows):
            sizes.setdefault(int(math.log(max(r["n_rows"], 1), FAN) + 1e-9), []).append(r)
        many = [s for s in sorted(sizes) if len(sizes[s]) >= FAN]
        if not many:
            break
        some = sizes[many[0]]
        rebalanced = _read_parts(spark, path, some).hint("rebalance")
        _write_part(rebalanced, path, _next(rows), time, replaces=[r["part"] for r in some])
    tidy(spark, path, _appended)


def tidy(spark: SparkSession, path: str, read_by: Callable[..., list[Row]], keep: int = KEEP) -> None:
    """Remove parts that none of the last ``keep`` versions reads, and merge manifest files.

    Folders that are in no manifest row may be writes under way and stay.
    """
    rows = manifest(spark, path)
    versions_ = sorted({r["version"] for r in rows})[-keep:]
    needed = {_folder(path, r) for v in versions_ for r in read_by(rows, v)}
    where, files = file_system(spark, path)
    if files.exists(where):
        there = {f.getPath().getName() for f in files.listStatus(where)}
        for r in rows:
            folder = _folder(path, r)
            if r["part"] and f"part={r['part']}" in there and folder not in needed:
                whole = f"{path}/part={r['part']}"
                unused = not any(f == whole or f.startswith(whole + "/") for f in needed)
                remove(spark, whole if unused else folder)
    where, files = file_system(spark, f"{path}.manifest")
    old = [f.getPath() for f in files.listStatus(where) if f.getPath().getName().startswith("part-")]
    if len(old) > MANIFEST_FILES:
        _record(spark, path, [r.asDict() for r in rows])  # rows may be there twice for a while
        for file in old:
            files.delete(file, False)


def within_span(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` without rows that cannot have a key of ``new``: those outside its times."""
    times = [k for k in keys if isinstance(new.schema[k].dataType, T.TimestampType)]
    if not times:
        return old
    ends = {
        f"{end}_{k}": F.unix_micros(f(k))
        for k in times
        for end, f in (("low", F.min), ("high", F.max))
    }
    span = new.agg(*(c.alias(n) for n, c in ends.items())).first()
    for k in times:
        low, high = (F.timestamp_micros(F.lit(span[f"{end}_{k}"])) for end in ("low", "high"))
        old = old.filter(F.col(k).between(low, high))
    return old


def versions(spark: SparkSession, base: str) -> list[int]:
    """Completed versions of a replaced table, oldest first."""
    return sorted({r["version"] for r in manifest(spark, base) if r["part"]})


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    """The newest completed version, or None."""
    parts = _newest(manifest(spark, base))
    return _read_parts(spark, base, parts).drop(BATCH) if parts else None


def replace_version(df: DataFrame, base: str, tag: str | None = None) -> int:
    """Write the next version next to the ones being read; returns its number of rows."""
    spark = df.sparkSession
    row = _write_part(df, base, _next(manifest(spark, base)), tag=tag)
    tidy(spark, base, _newest)
    return row["n_rows"]


def replace_buckets(df: DataFrame, base: str) -> None:
    """Write the buckets that are in ``df`` (column ``bucket``) anew, as the next version."""
    spark, version = df.sparkSession, _next(manifest(df.sparkSession, base))
    part = f"{version}-{uuid.uuid4().hex}"
    folder = f"{base}/part={part}"
    df.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(folder)
    counts = _bucket_sizes(spark, folder)
    _record(spark, base, [
        {"part": part, "version": version, "n_rows": r["count"], "bucket": r["bucket"], "buckets": 0} for r in counts
    ])
    tidy(spark, base, _newest)


def read_buckets(spark: SparkSession, base: str, buckets: Iterable[int] | None = None) -> DataFrame:
    """The newest version of the named buckets, or of all."""
    parts = _newest(manifest(spark, base))
    wanted = None if buckets is None else set(buckets)
    return _read_parts(spark, base, [r for r in parts if wanted is None or r["bucket"] in wanted])


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert_version(
    spark: SparkSession, new: DataFrame, base: str, keys: Sequence[str], tag: str | None = None,
    newest: str = "loaded_at", *, batches: Iterable[str] = (), rows_per_bucket: int | None = None,
) -> dict[str, int]:
    """Upsert into a replaced table: the next version is the one before plus ``new``.

    Of equal keys the row of the later batch wins, if ``new`` tells its batches (column
    ``BATCH``), and then the ``newest``. A batch that comes late does not replace rows of
    later ones. Only buckets with keys of ``new`` are read and written; there is one per
    ``ROWS_PER_BUCKET`` rows, and when the table has outgrown twice that, all are dealt anew.
    Returns the row counts before and after, added and updated, taken from what is written.
    """
    rows = manifest(spark, base)
    parts = _newest(rows)
    before = sum(r["n_rows"] for r in parts)
    if _seen(rows, tag):
        return _unchanged(before)
    have = parts[0]["buckets"] if parts else None
    want = 1 << max(0, math.ceil(math.log2(max(before, 1) / (rows_per_bucket or ROWS_PER_BUCKET))))
    n = have if have and want <= 2 * have else want
    with scratch_scope(spark, "upsert"):
        order = [BATCH, newest] if BATCH in new.columns else newest
        batch = batch_rows(new, keys, order)
        if parts:
            like = _read_parts(spark, base, parts)
            if BATCH in batch.columns and BATCH not in like.columns:
                like = like.withColumn(BATCH, F.lit(None).cast("string"))
            batch = align(batch, like)
        batch = stage(batch.withColumn("bucket", bucket_of(keys, n)), "batch")
        if have == n:
            touched = {r["bucket"] for r in batch.select("bucket").distinct().collect()}  # at most ``n``
            parts = [r for r in parts if r["bucket"] in touched]
        batch = batch.drop("bucket")
        old = _read_parts(spark, base, parts) if parts else spark.createDataFrame([], batch.schema)
        old = align(old, batch)
        if BATCH in batch.columns:
            batch = stage(not_outdated(old, batch, keys, BATCH), "batch")
        version = _next(rows)
        part = f"{version}-{uuid.uuid4().hex}"
        merged = upsert_batch(old, batch, keys).withColumn("bucket", bucket_of(keys, n))
        merged.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{base}/part={part}")
        counts = []
        if parts or not batch.isEmpty():
            counts = _bucket_sizes(spark, f"{base}/part={part}")
        written = [
            {"part": part, "version": version, "n_rows": r["count"], "tag": tag, "bucket": r["bucket"], "buckets": n}
            for r in counts
        ] or [{"version": version, "n_rows": 0, "tag": tag}]
        written[0]["batches"] = sorted(batches) or None
        _record(spark, base, written)
        added = sum(r["n_rows"] for r in written) - sum(r["n_rows"] for r in parts)
        updated = batch.count() - added
    tidy(spark, base, _newest)
    return {"before": before, "after": before + added, "added": added, "updated": updated}
