"""Exact dedup by two passes over Bloom filters.

Texts are equal when they are identical without blanks. The texts are read once: a slim table
holds the SHA-256 of each bare text and 64 bits of it, 31 of which deal the hashes to blocks of
a filter, so that all places of a hash lie in one block.

*First pass.* Each task counts, for what it reads, how many rows hit each place: once, or more
often. Per block these counts are added, and the filter keeps the places hit twice or more.
Only places travel, and of a text copied a million times only one note per task.

*Second pass.* A row whose places were all hit twice may be repeated; any other row is alone
and passes straight through. Only the rows that may be repeated are grouped by their full
SHA-256, so a false alarm costs a shuffled row and never a wrong group.

Filters take ``BITS`` bits a row. One is broadcast in parts of at most ``MOST_BLOCKS`` blocks
(128 MB, 67 million rows); with more rows there are more parts, each a round of its own over
the rows of its blocks, which lie together in the slim table, so a round skips the rest.
Groups above one in ten thousand of all rows are at most ten thousand, so they are looked up by
a broadcast and their rows are never gathered; rows of smaller groups meet by a shuffle.

Null counts as an empty text; all empty and blank texts are one group. Of equal texts the row
with the most code points stays, then the one with the smallest id, null ids last; of rows
that are alike in both, one stays. An empty table gives an empty table. Columns of other
names pass through untouched, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from playspan.llm.common import free_name, quoted
from playspan.session import scratch_path, stage

BLANKS = " \t\n\x0b\x0c\r"
PLACES = 1 << 14  # of a block: 14 bits of a hash are a place in it
PER_HASH = 4
BITS = 16
MOST_BLOCKS = 1 << 16
FEW_GROUPS = 10_000
FLUSH = 1 << 18


def marked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with a struct column (the last one): keep_id, group_size, kept, text_sha256.

    Without ``keep_text`` the text column is left out, and no text is written or shuffled.
    """
    spark, name = docs.sparkSession, free_name(docs, "mark")
    row, sha, points = (free_name(docs, x) for x in ("row", "sha", "points"))
    u, z, maybe = (free_name(docs, x) for x in ("u", "z", "maybe"))
    columns = [c for c in docs.columns if keep_text or c != text]
    full = F.coalesce(quoted(text), F.lit(""))
    rows = docs.select(
        *map(quoted, columns),
        F.length(full).alias(points),
        F.unhex(F.sha2(F.translate(full, BLANKS, ""), 256)).alias(sha),
    ).withColumns({row: F.monotonically_increasing_id(), u: F.shiftrightunsigned(F.xxhash64(sha), 33),
                   z: F.xxhash64(sha, F.lit(1))})
    rows = stage(rows.sortWithinPartitions(u), "hashes")
    total = rows.count()
    blocks = max(1, -(-total * BITS // PLACES))
    rows = rows.withColumn(maybe, F.shiftright(F.col(u) * F.lit(blocks), 31))  # the block for now

    paths = []
    for first in range(0, blocks, MOST_BLOCKS):
        last = min(first + MOST_BLOCKS, blocks)
        low, high = -(-(first << 31) // blocks), -(-(last << 31) // blocks)
        part = rows.where((F.col(u) >= low) & (F.col(u) < high))
        filter_ = repeated_places(part.select(F.col(maybe).alias("block"), F.col(z).alias("z")))
        paths.append(scratch_path(spark, "passed"))
        _tested(part, filter_, maybe, z).drop(u, z).write.parquet(paths[-1])
    passed = spark.read.schema(spark.read.parquet(paths[0]).schema).parquet(*paths)

    alone = F.struct(
        quoted(doc_id).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        F.lower(F.hex(sha)).alias("text_sha256"),
    )
    out = [*map(quoted, columns)]
    straight = passed.where(~F.col(maybe)).select(*out, alone.alias(name))
    suspects = passed.where(F.col(maybe))
    first = F.min(F.struct(
        (-F.col(points)).alias("p"), quoted(doc_id).isNull().alias("n"), quoted(doc_id).alias("id"), F.col(row).alias("row")
    ))
    g, size, top = (free_name(docs, x) for x in ("g", "size", "top"))
    groups = suspects.groupBy(F.col(sha).alias(g)).agg(F.count(F.lit(1)).alias(size), first.alias(top))
    groups = stage(groups.where(F.col(size) > 1), "groups")
    hot = F.col(size) > max(1, total // FEW_GROUPS)
    few = F.broadcast(groups.where(hot))  # fewer than FEW_GROUPS rows, since their sizes add up to ``total``
    together = F.struct(
        F.col(f"{top}.id").alias("keep_id"), F.col(size).alias("group_size"),
        (F.col(row) == F.col(f"{top}.row")).alias("kept"), F.lower(F.hex(sha)).alias("text_sha256"),
    )
    of_hot = suspects.join(few, F.col(sha) == F.col(g)).select(*out, together.alias(name))
    others = suspects.join(few, F.col(sha) == F.col(g), "left_anti")
    others = others.join(groups.where(~hot), F.col(sha) == F.col(g), "left")
    others = others.select(*out, F.when(F.col(g).isNull(), alone).otherwise(together).alias(name))
    return straight.unionByName(of_hot).unionByName(others)


def repeated_places(hashes: DataFrame) -> DataFrame:
    """The filter: per block (column ``block``) the places hit by two rows or more, as 64-bit words."""
    notes = hashes.mapInArrow(_notes, "block long, once binary, more binary")
    return notes.groupBy("block").applyInArrow(_added, "block long, words array<long>")


def _notes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block, the places hit once and those hit more often by the rows of a task."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= FLUSH:
            yield _noted(held)
            held, n = [], 0
    if n:
        yield _noted(held)


def _noted(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches)
    blocks, z = (np.asarray(table[c].combine_chunks(), np.int64) for c in ("block", "z"))
    places = (z.view(np.uint64)[:, None] >> np.arange(PER_HASH, dtype=np.uint64) * np.uint64(14)) & np.uint64(PLACES - 1)
    places = np.sort(places.astype(np.int64), axis=1)
    new = np.ones(places.shape, bool)
    new[:, 1:] = places[:, 1:] != places[:, :-1]  # a hash hits a place once
    keys, n = np.unique((blocks[:, None] * PLACES + places)[new], return_counts=True)
    block, place = keys // PLACES, (keys % PLACES).astype("<u2")
    cut = np.flatnonzero(np.diff(block, prepend=-1))
    ends = np.append(cut[1:], len(keys))
    once = n == 1
    notes = [(place[a:b][once[a:b]].tobytes(), place[a:b][~once[a:b]].tobytes()) for a, b in zip(cut, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(block[cut]), pa.array([x for x, _ in notes], pa.binary()), pa.array([y for _, y in notes], pa.binary())],
        ["block", "once", "more"],
    )


def _added(notes: pa.Table) -> pa.Table:
    places = [np.frombuffer(b"".join(notes[c].to_pylist()), "<u2") for c in ("once", "more")]
    hits = np.bincount(places[0], minlength=PLACES) + 2 * np.bincount(places[1], minlength=PLACES)
    words = np.packbits(hits > 1, bitorder="little").view("<i8")
    kept = notes["block"].combine_chunks().slice(0, 1 if words.any() else 0)
    return pa.table({"block": kept, "words": pa.array([words.tolist()] * len(kept), pa.list_(pa.int64()))})


def _tested(rows: DataFrame, filter_: DataFrame, maybe: str, z: str) -> DataFrame:
    """``rows`` with column ``maybe`` (their block before) telling whether all places were hit twice."""
    block, words = (free_name(rows, x) for x in ("block", "words"))
    filter_ = F.broadcast(filter_.withColumnsRenamed({"block": block, "words": words}))  # MOST_BLOCKS rows of 2 KB at most
    hit = F.lit(True)
    for i in range(PER_HASH):
        place = F.shiftrightunsigned(F.col(z), 14 * i).bitwiseAND(PLACES - 1)
        word = F.get(F.col(words), F.shiftright(place, 6).cast("int"))
        hit = hit & (F.getbit(word, place.bitwiseAND(63).cast("int")) == 1)
    joined = rows.join(filter_, F.col(maybe) == F.col(block), "left")
    return joined.withColumn(maybe, F.coalesce(hit, F.lit(False))).drop(block, words)


def keep_one_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    found = marked(docs, doc_id, text)
    return found.where(F.col(f"{found.columns[-1]}.kept")).select(*map(quoted, docs.columns))


def digest(docs: DataFrame) -> DataFrame:
    found = marked(docs.select("doc_id", "text"), keep_text=False)
    return found.select("doc_id", f"{found.columns[-1]}.*")
