"""Helpers shared by the operators: Arrow slices, values kept per worker, hashing."""

from __future__ import annotations

import sys
import time
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType

#: Words everywhere in this package: runs without space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

IDLE = 20

U = np.uint64
_A, _B, _C = U(0x9E3779B97F4A7C15), U(0x632BE59BD9B4E019), U(0xBF58476D1CE4E5B9)


def kept_in_worker(key: tuple, build: Callable[[], object]) -> object:
    """``build()`` once per Python worker: what tasks of one worker can share.

    What was not asked for in ``IDLE`` seconds is dropped, so that a later operator in the
    same worker has its memory.
    """
    home = sys.modules.setdefault("_playspan_worker", types.ModuleType("_playspan_worker"))
    if not hasattr(home, "kept"):
        home.kept = {}
    now = time.monotonic()
    for other in [k for k, (used, _) in home.kept.items() if k != key and now - used > IDLE]:
        del home.kept[other]
    value = home.kept[key][1] if key in home.kept else build()
    home.kept[key] = now, value
    return value


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(column: pa.Array, most_bytes: int, most_rows: int) -> Iterator[tuple[int, int]]:
    """Cut a string column into row ranges of bounded size; a longer text is a range alone."""
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    yield from slices_by_size(sizes, most_bytes, most_rows)


def slices_by_size(sizes: np.ndarray, most_bytes: int, most_rows: int) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and (held + n > most_bytes or i - start >= most_rows):
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def gathered(batches: Iterator[pa.RecordBatch], most_bytes: int, most_rows: int) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts (first and second column) of a task in blocks of bounded size.

    A text above ``most_bytes`` is a block alone.
    """
    ids, texts, held = [], [], 0
    for batch in batches:
        for lo, hi in slices(batch.column(1), most_bytes, most_rows):
            some = texts_of(batch.column(1).slice(lo, hi - lo))
            size = sum(map(len, some))
            if texts and (held + size > most_bytes or len(texts) + len(some) > most_rows):
                yield ids, texts
                ids, texts, held = [], [], 0
            ids += batch.column(0).slice(lo, hi - lo).to_pylist()
            texts += some
            held += size
    if texts:
        yield ids, texts


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One well-spread 64-bit hash of two arrays of 64-bit values, in order."""
    x = a * _A
    x ^= b + _B
    x ^= x >> U(29)
    x *= _C
    x ^= x >> U(32)
    return x


def pieces(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Index of every element of the ranges [start, start + length), range after range."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def remainder_of_id(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.pmod(F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")), F.lit(divisor))


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


@arrow_udf(BinaryType())
def packed(column: pa.Array) -> pa.Array:
    """Texts as compressed UTF-8 bytes, for shuffles and written tables; null is empty."""
    import zstandard

    press, out = zstandard.ZstdCompressor(level=3).compress, []
    for i in range(0, len(column), 64):
        out += [press(x) for x in texts_of(column.slice(i, 64))]
    return pa.array(out, pa.binary())


def unpacked(column: pa.Array) -> list[bytes]:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(x) for x in column.to_pylist()]


#: Tables with a row per group, as languages or sources, are broadcast up to so many rows;
#: with more they are joined like any table.
FEW = 20_000


def if_few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, marked for a broadcast if its counted ``rows`` are few."""
    return F.broadcast(df) if rows <= FEW else df


def small_batches(spark) -> None:
    """Fewer rows per Arrow batch: rows hold whole documents, and workers little memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
