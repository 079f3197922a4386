"""Quality by Bradley-Terry ranking: scores learned from preference pairs.

A text has a vector of plain features (lengths, shares of character classes, repetition,
variety), each with its square. Pairs of a preferred and another labelled text give the
logistic loss of the difference of their scores, linear in the difference of their
features; Newton steps with a ridge solve it. The cut is a score quantile of the training
rows: the share of label 0 among them lies below it. Scores are then carried to 0..1 by a
logistic curve that is ``LEVEL`` at the cut.

The classifier is fitted on all labelled rows, each of them in about ``MEET`` pairs. Rows of
the more frequent label are dealt to groups by hash, ``MEET`` in a group, and rows of the
other label to as many groups as gives each group ``MEET`` of them; all pairs in a group
count, each with the weight that gives every row of the first kind the same. The groups are
written once. A Newton step is one pass over them that sends back sums per task, and the cut
is found by counting scores in ever narrower bins. Every row is scored on its whole text.
Null and empty texts have features of zero and get a score like any other. Labels other
than 0 and 1, and ids that are null, teach nothing; without both labels all scores are
``LEVEL``. Repeated rows get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType

from playspan.llm.common import quoted, remainder_of_id, slices, texts_of
from playspan.llm.words import Batch, per_text, repeated_lines
from playspan.session import stage

MEET = 64
STEPS = 12
BINS = 4096
LEVEL = 0.3
RIDGE = 1e-3

_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b".,;:", b"!?", b"|", b"\n", b"-_/\\@()[]{}\"'=+~^`", b"aeiou"]
N_FEATURES = 18


def features_of(texts: list[bytes]) -> np.ndarray:
    batch = Batch(texts)
    n = batch.n_words.astype(float)
    size = np.maximum(batch.ends - batch.starts, 1).astype(float)
    words = np.maximum(n, 1)
    shares = []
    for group in _CLASSES:
        table = np.zeros(256, bool)
        table[list(group)] = True
        shares.append(per_text(table[batch.bytes], batch.starts, batch.ends) / size)
    hashes = batch.word_hashes()
    keys = np.sort(hashes ^ (batch.owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    lines = np.array([t.count(b"\n") + 1 for t in texts], float)
    lengths = (batch.word_ends - batch.word_starts).astype(float)
    mean = np.bincount(batch.owner, lengths, len(texts)) / words
    spread = np.sqrt(np.maximum(np.bincount(batch.owner, lengths**2, len(texts)) / words - mean**2, 0))
    variety = np.array(
        [len(np.unique(hashes[a:b])) / max(b - a, 1) for a, b in zip(batch.first, batch.last)], float
    ) if len(keys) else np.zeros(len(texts))
    return np.stack(
        [
            np.log1p(n), mean, spread, variety, np.log1p(lines), np.log1p(n / lines),
            np.fromiter(map(repeated_lines, texts), float, len(texts)) / lines,
            batch.repeated_window_words(hashes) / words,
            per_text(batch.bytes >= 0x80, batch.starts, batch.ends) / size,
            *(np.sqrt(x) for x in shares),
        ],
        axis=1,
    )


@arrow_udf(ArrayType(DoubleType()))
def features(column: pa.Array) -> pa.Array:
    parts = [features_of(texts_of(column.slice(a, b - a))) for a, b in slices(column, 1 << 18, 256)]
    flat = np.concatenate(parts).ravel() if parts else np.zeros(0)
    return pa.ListArray.from_arrays(np.arange(len(column) + 1, dtype=np.int32) * N_FEATURES, flat)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float


def expanded(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -4, 4)
    return np.concatenate([z, z * z], axis=1)


def groups_of(rows: DataFrame, n_good: int, n_bad: int) -> DataFrame:
    """Labelled rows (id, x, quality) by group: lists of the features of either label."""
    most, least = max(n_good, n_bad), min(n_good, n_bad)
    groups = -(-most // MEET)
    copies = min(groups, -(-MEET * groups // least))
    frequent = F.col("quality") == (1 if n_good >= n_bad else 0)
    at = F.pmod(F.xxhash64("doc_id", "x"), F.lit(groups))
    turns = F.sequence(F.lit(0), F.when(frequent, 0).otherwise(copies - 1))
    dealt = rows.select("x", "quality", at.alias("at"), F.explode(turns).alias("turn"))
    group = F.pmod(F.col("at") + F.col("turn"), F.lit(groups))
    lists = [
        F.array_sort(F.collect_list(F.when(F.col("quality") == q, F.col("x")))).alias(name)
        for q, name in ((1, "good"), (0, "bad"))
    ]
    return dealt.groupBy(group.alias("group")).agg(*lists)


def _sums_of_pairs(mean: np.ndarray, scale: np.ndarray, w: np.ndarray):
    """Groups -> per task the weight, slope and curve of the logistic loss of their pairs."""

    def run(batches):
        size = len(w)
        total, slope, curve = 0.0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            for pair in zip(*(batch.column(c) for c in ("good", "bad"))):
                good, bad = (expanded(np.array(p.as_py(), float).reshape(-1, N_FEATURES), mean, scale) for p in pair)
                if not len(good) or not len(bad):
                    continue
                more, less, sign = (good, bad, 1) if len(good) >= len(bad) else (bad, good, -1)
                for a in range(0, len(more), 1024):  # copies of one row share a group
                    some = more[a : a + 1024]
                    p = 1 / (1 + np.exp(np.clip(sign * ((some @ w)[:, None] - (less @ w)[None, :]), -30, 30)))
                    q = p * (1 - p)
                    total += len(some)
                    slope += sign * (some.T @ p.sum(axis=1) - less.T @ p.sum(axis=0)) / len(less)
                    cross = some.T @ q @ less
                    here = (some.T * q.sum(axis=1)) @ some + (less.T * q.sum(axis=0)) @ less
                    curve += (here - cross - cross.T) / len(less)
        yield pa.RecordBatch.from_arrays(
            [pa.array([np.concatenate([[total], slope, curve.ravel()]).tolist()], pa.list_(pa.float64()))], ["sums"]
        )

    return run


def _moments(batches):
    """Features -> their number, sums and sums of squares per task, for ``_standard``."""
    n, total, squares = 0, np.zeros(N_FEATURES), np.zeros(N_FEATURES)
    for batch in batches:
        x = np.asarray(batch.column("x").flatten()).reshape(-1, N_FEATURES)
        n, total, squares = n + len(x), total + x.sum(axis=0), squares + (x * x).sum(axis=0)
    yield pa.RecordBatch.from_arrays(
        [pa.array([np.concatenate([[n], total, squares]).tolist()], pa.list_(pa.float64()))], ["sums"]
    )


def _summed(rows: DataFrame, sums) -> np.ndarray:
    """Sums per task added up in one order, so that reruns agree."""
    return np.sum(sorted(r["sums"] for r in rows.mapInArrow(sums, "sums array<double>").collect()), axis=0)


def quantile(values: DataFrame, name: str, share: float) -> float:
    """The quantile of a column as ``numpy.quantile`` has it, found by counts in bins."""
    low, high, n = values.agg(F.min(name), F.max(name), F.count(name)).first()
    place = share * (n - 1)
    wanted = [int(np.floor(place)), int(np.ceil(place))]

    def ranked(k: int, low: float, high: float, below: int) -> float:
        """The value of rank ``k``; ``below`` values are under ``low``."""
        while low < high:
            inside = values.where(F.col(name).between(F.lit(low), F.lit(high)))
            width = (high - low) / BINS
            bin_ = F.least(F.floor((F.col(name) - F.lit(low)) / F.lit(width or 1.0)), F.lit(BINS - 1))
            found = inside.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("low"), F.max(name).alias("high"))
            for r in sorted(found.collect(), key=lambda r: r["bin"]):
                if k < below + r["n"]:
                    if (low, high) == (r["low"], r["high"]):  # neighbouring numbers
                        return low if k == below else high
                    low, high = r["low"], r["high"]
                    break
                below += r["n"]
        return low

    a = ranked(wanted[0], low, high, 0)
    b = a if wanted[0] == wanted[1] else ranked(wanted[1], low, high, 0)
    return float(a + (b - a) * (place - wanted[0]))


def fit(rows: DataFrame) -> Model:
    """Weights from pairs of rows labelled 1 and 0, of all ``rows`` (doc_id, x, quality)."""
    counts = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(2 * N_FEATURES), 0.0)
    sums = _summed(rows.select("x"), _moments)
    mean = sums[1 : 1 + N_FEATURES] / sums[0]
    scale = np.sqrt(np.maximum(sums[1 + N_FEATURES :] / sums[0] - mean**2, 0)) + 1e-6
    groups = stage(groups_of(rows, counts[1], counts[0]), "groups")
    size = 2 * N_FEATURES
    w = np.zeros(size)
    for _ in range(STEPS):
        sums = _summed(groups, _sums_of_pairs(mean, scale, w))
        n = max(sums[0], 1.0)
        slope = sums[1 : 1 + size] / n - RIDGE * w
        curve = sums[1 + size :].reshape(size, size) / n + RIDGE * np.eye(size)
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-10:
            break
    model = Model(mean, scale, w, 0.0)
    raw = stage(rows.select(raw_score(model)("x").alias("s")), "scores")
    model.cut = quantile(raw, "s", counts[0] / (counts[0] + counts[1]))
    return model


def raw_score(model: Model):
    """A column function: array of features -> score before the cut."""

    @arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        x = np.asarray(column.flatten()).reshape(-1, N_FEATURES)
        return pa.array(expanded(x, model.mean, model.scale) @ model.weights)

    return run


def scored(model: Model, x: str):
    """Score from 0 to 1 of a column of features."""
    logit = raw_score(model)(x) - F.lit(model.cut) + F.lit(float(np.log(LEVEL / (1 - LEVEL))))
    return 1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(40.0)), F.lit(-40.0))))


def rank(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id and score, learned from ``labels`` (doc_id, quality)."""
    table = stage(docs.select(quoted(doc_id).alias("doc_id"), features(quoted(text)).alias("x")), "features")
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).select("doc_id", "quality")
    rows = stage(table.join(labels, "doc_id").select("doc_id", "x", "quality"), "labelled")
    return table.select("doc_id", scored(fit(rows), "x").alias("score"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    teach = labels.where(remainder_of_id("doc_id", 5) != 0)
    found = rank(docs.select("doc_id", "text"), teach.select("doc_id", "quality"))
    return found.select(
        "doc_id",
        F.coalesce(remainder_of_id("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= LEVEL).cast("int").alias("predicted"),
    )
