"""Language ID: nearest of several centroids per language over TF-IDF character n-grams.

Letters are lower-cased and everything else is one blank; the 2- and 3-grams of the whole
text are hashed to ``WIDTH`` places, weighed by log(1 + tf) * idf and normalised. Each
language has up to ``PER_LANGUAGE`` centroids (spherical k-means). A text gets the language
of the centroid with the highest cosine, ties to the first in code-point order. It is
rejected when its distance 1 - cosine is beyond the limit of its length band, learned from
all labelled rows: ``MARGIN`` of the cosine to their own language that all but 0.1 % of the
texts of the band reach. A band with fewer than ``LEAST`` texts is widened by its neighbours
until it has as many. A cosine of 0 is always rejected.

The centroids are fitted on a bounded sample of labelled rows (about ``sample_rows``, drawn
row by row from all of them, so repeated rows are drawn one by one); limits and predictions
read whole texts of all rows. A null text, an empty one and one without a letter get ``und``
with score 0 and are rejected; without any labelled row everything is ``und``. Repeated rows and rows with null ids are predicted like others;
other columns are passed through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from playspan.llm.common import free_name, kept_in_worker, quoted, remainder_of_id, slices
from playspan.session import stage

WIDTH = 4096
PER_LANGUAGE = 4
SAMPLE_ROWS = 12_000
ROUNDS = 3
BANDS = 24
FIT_PARTS = 12
LEAST = 200
MARGIN = 0.9


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # (languages * PER_LANGUAGE, WIDTH); an unused one is all zero
    least_cosine: np.ndarray  # per band


def _folded() -> np.ndarray:
    """Code point -> folded letter, or 32 for what is not a letter."""

    def build():
        table = np.full(0x110000, 32, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        return table

    return kept_in_worker(("letters",), build)


def counts_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-gram counts (texts, WIDTH) and the number of letters of each text."""
    lengths = np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts))
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _folded()[codes]
    owner = np.repeat(np.arange(len(texts)), lengths)
    letter = codes != 32
    letters = np.bincount(owner[letter], minlength=len(texts))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one blank after each word
    codes, owner = codes[keep].astype(np.uint32), owner[keep]
    counts = np.zeros(len(texts) * WIDTH, np.float32)
    if len(codes) > 2:
        two = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] * np.uint32(0xC2B2AE3D) + codes[2:] * np.uint32(0x27D4EB2F)
        for grams, n in ((two, 2), (three, 3)):
            same = owner[: len(grams)] == owner[n - 1 :]
            place = ((grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(20)
            counts += np.bincount(owner[: len(grams)][same] * WIDTH + place[same], minlength=len(counts))
    return counts.reshape(len(texts), WIDTH), letters


def _weighed(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts, dtype=np.float32) * idf
    size = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.maximum(size, 1e-9)[:, None]


def _band(letters: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(letters, 1)).astype(np.int64), BANDS - 1)


def _vectors(column: pa.Array, idf: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for a, b in slices(column, 1 << 19, 128):
        counts, letters = counts_of([x or "" for x in column.slice(a, b - a).to_pylist()])
        yield a, b, _weighed(counts, idf), letters


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on ``rows`` (all of them labelled rows); at most about ``sample_rows`` are used."""
    rows = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    total = rows.count()
    if not total:
        return Model([], np.ones(WIDTH, np.float32), np.zeros((0, WIDTH), np.float32), np.ones(BANDS))
    drawn = rows.where(F.rand(17) < sample_rows / total) if total > sample_rows else rows
    sample = stage(drawn.repartition(FIT_PARTS), "langid")
    if not sample.count():
        sample = stage(rows.limit(sample_rows), "langid")
    languages = sorted(r[0] for r in sample.select("lang").distinct().collect())
    if not languages:
        return Model([], np.ones(WIDTH, np.float32), np.zeros((0, WIDTH), np.float32), np.ones(BANDS))
    place = {x: i for i, x in enumerate(languages)}
    k = len(languages) * PER_LANGUAGE

    def frequencies(batches):
        seen, n = np.zeros(WIDTH), 0
        for batch in batches:
            column = batch.column("text")
            for a, b in slices(column, 1 << 19, 128):
                counts, _ = counts_of([x or "" for x in column.slice(a, b - a).to_pylist()])
                seen += (counts > 0).sum(axis=0)
                n += b - a
        yield pa.RecordBatch.from_pydict({"n": [n], "seen": [seen.tobytes()]})

    found = sample.mapInArrow(frequencies, "n long, seen binary").collect()
    seen = sum(np.frombuffer(r["seen"]) for r in found)
    idf = (np.log((1 + sum(r["n"] for r in found)) / (1 + seen)) + 0.1).astype(np.float32)

    def one_pass(centroids):
        """Sums per centroid of the texts next to it."""

        def gather(batches):
            sums = np.zeros((k, WIDTH), np.float32)
            for batch in batches:
                own = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
                for a, b, x, letters in _vectors(batch.column("text"), idf):
                    some = letters > 0
                    if centroids is None:
                        best = np.abs(np.round(x.sum(axis=1) * 1e4)).astype(np.int64) % PER_LANGUAGE
                    else:
                        scores = (x @ centroids.T).reshape(b - a, len(languages), PER_LANGUAGE)
                        best = scores[np.arange(b - a), own[a:b]].argmax(axis=1)
                    np.add.at(sums, (own[a:b] * PER_LANGUAGE + best)[some], x[some])
            yield pa.RecordBatch.from_pydict({"sums": [sums.tobytes()]})

        parts = sample.mapInArrow(gather, "sums binary").collect()
        sums = sum(np.frombuffer(r["sums"], np.float32).reshape(k, WIDTH) for r in parts)
        size = np.sqrt((sums**2).sum(axis=1))
        return (sums / np.maximum(size, 1e-9)[:, None]).astype(np.float32)

    centroids = one_pass(None)
    for _ in range(ROUNDS):
        centroids = one_pass(centroids)

    def near(batches):
        """(band, thousandths of the cosine to the own language, texts): a histogram per task."""
        counts = np.zeros((BANDS, 1001), np.int64)
        for batch in batches:
            own = np.array([place.get(x, -1) for x in batch.column("lang").to_pylist()], np.int64)
            for a, b, x, letters in _vectors(batch.column("text"), idf):
                scores = (x @ centroids.T).reshape(b - a, len(languages), PER_LANGUAGE)
                cosine = scores[np.arange(b - a), own[a:b]].max(axis=1)
                some = (letters > 0) & (own[a:b] >= 0)
                at = np.clip(cosine * 1000, 0, 1000).astype(np.int64)
                np.add.at(counts, (_band(letters)[some], at[some]), 1)
        band, at = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({"band": band, "at": at, "n": counts[band, at]})

    histogram = rows.mapInArrow(near, "band long, at long, n long").groupBy("band", "at").agg(F.sum("n").alias("n"))
    counts = np.zeros((BANDS, 1001), np.int64)
    for r in histogram.collect():  # BANDS * 1001 rows at most
        counts[r["band"], r["at"]] = r["n"]
    return Model(languages, idf, centroids, limits(counts))


def limits(counts: np.ndarray) -> np.ndarray:
    """Least cosine per band from counts of texts by band and thousandths of the cosine."""
    least = np.zeros(BANDS)
    for band in range(BANDS):
        for reach in range(BANDS):
            own = counts[max(0, band - reach) : band + reach + 1].sum(axis=0)
            if own.sum() >= LEAST:
                break
        so_far = np.cumsum(own)
        if so_far[-1]:
            least[band] = MARGIN * float(np.searchsorted(so_far, 0.001 * so_far[-1], side="right")) / 1000
    return least


def predict(model: Model):
    """A column function: text -> struct(lang, score, rejected)."""
    kind = "struct<lang:string,score:double,rejected:boolean>"

    @arrow_udf(kind)
    def predicted(column: pa.Array) -> pa.Array:
        lang, score, rejected = [], [], []
        for a, b, x, letters in _vectors(column, model.idf):
            if model.languages:
                cosines = x @ model.centroids.T
                best = cosines.argmax(axis=1)
                top = np.clip(cosines.max(axis=1).astype(float), 0.0, 1.0)
            else:
                best, top, letters = np.zeros(b - a, np.int64), np.zeros(b - a), letters * 0
            some = letters > 0
            lang += [model.languages[i // PER_LANGUAGE] if s else "und" for i, s in zip(best, some)]
            score += np.where(some, top, 0.0).tolist()
            rejected += (~some | (top <= 0) | (top < model.least_cosine[_band(letters)])).tolist()
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
            ["lang", "score", "rejected"],
        )

    return predicted


def identify(docs: DataFrame, training: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column (lang, score, rejected) appended, and its name."""
    name = free_name(docs, "language")
    return docs.withColumn(name, predict(fit(training))(quoted(text))), name


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows whose language label may be learned from."""
    return docs.where(remainder_of_id("doc_id", 4) != 2)


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that language ID rejects, columns unchanged."""
    found, name = identify(docs, training_rows(docs))
    return found.where(~F.col(f"{name}.rejected")).drop(name)


def digest(docs: DataFrame) -> DataFrame:
    found, name = identify(docs.select("doc_id", "text", "lang"), training_rows(docs))
    held_out: Column = F.coalesce(remainder_of_id("doc_id", 4) == 2, F.lit(False))
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col(f"{name}.lang").alias("lang_pred"),
        F.col(f"{name}.score").alias("score"),
        F.col(f"{name}.rejected").alias("rejected"),
    )
