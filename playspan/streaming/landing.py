"""Landing folders as a file stream, merged into raw tables batch by batch.

A run takes the files that arrived since the last one and stops (availableNow), so
it can be scheduled hourly. Pulls overlap; merging by key makes that harmless.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playspan.session import scratch_scope, stage
from playspan.sources import landing, tables


def landing_stream(spark: SparkSession, folder: str, schema: str, max_files: int | None = None) -> DataFrame:
    """Landing CSV files as they arrive, in the dialect and types of batch loads, each row with
    the name of its batch below ``folder`` (``BATCH``), the one that batch loads give it."""
    reader = (
        spark.readStream.schema(landing.as_text(schema)).options(**landing.CSV_IN)
        .option("recursiveFileLookup", True)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    inside = folder.rstrip("/").rsplit("/", 1)[-1]
    rows = reader.csv(folder).withColumn(landing.BATCH, landing.batch_name(F.col("_metadata.file_path"), inside))
    return landing.typed(rows, schema)


def _first_batch(rows: DataFrame) -> list[Column]:
    return [F.col(landing.BATCH).asc()] if landing.BATCH in rows.columns else []


def ingest_new(
    stream: DataFrame, table: str, keys: Sequence[str], checkpoint: str, *, loaded_at: Column | None = None
) -> None:
    """Insert-ignore each batch into ``table``. A repeated batch adds nothing."""
    stamp = F.current_timestamp() if loaded_at is None else loaded_at

    def merge(batch: DataFrame, number: int) -> None:
        stamped = batch.withColumn("loaded_at", stamp)
        tables.append_new(
            batch.sparkSession, stamped, table, keys, f"{checkpoint}#{number}", order=_first_batch(batch)
        )

    _run(stream, merge, checkpoint)


def ingest_upsert(
    stream: DataFrame, table: str, keys: Sequence[str], checkpoint: str, *, newest: str = "loaded_at",
    loaded_at: Column | None = None,
) -> None:
    """Upsert each micro-batch as the next version of the table, tagged with checkpoint and
    number, so that a repeated one is left out and batch loads may come in between. Of equal
    keys the later landed batch wins, then the ``newest``, also over several micro-batches."""
    stamp = F.current_timestamp() if loaded_at is None else loaded_at

    def merge(batch: DataFrame, number: int) -> None:
        stamped = batch if "loaded_at" in batch.columns else batch.withColumn("loaded_at", stamp)
        tables.upsert_version(batch.sparkSession, stamped, table, keys, f"{checkpoint}#{number}", newest)

    _run(stream, merge, checkpoint)


def _run(stream: DataFrame, merge, checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def without_repeats(
    stream: DataFrame, table: str, keys: Sequence[str], checkpoint: str, *, remember: str | None = "6 hours"
) -> None:
    """Each play once, however often and late it is landed.

    Repeats within ``remember`` of their arrival are dropped by keys held in the state store,
    which expire by arrival and not by the time of the play, so no play is ever too late. What
    gets through is looked up among the parts of ``table`` that overlap it in time: that finds
    older repeats. If nothing gets through, the table is not touched.
    """
    if remember:
        arrived = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remember)
        stream = arrived.dropDuplicatesWithinWatermark(list(keys)).drop("_arrived")

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with scratch_scope(spark, "batch"):
            fresh = stage(batch, "fresh")  # the state is read and written once
            if not fresh.isEmpty():
                tables.append_new(spark, fresh, table, keys, f"{checkpoint}#{number}", order=_first_batch(batch))

    _run(stream, merge, checkpoint)
