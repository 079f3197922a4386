"""Language-model scoring with a weighted backoff automaton.

Counts: tokens are words (A-Z lower-cased) and one end per text; the training rows give the
counts c(w) of tokens and c(h, w) of pairs, with a start before each text. The base
distribution is P(w) = (c + 0.1) / (N + 0.1 (V + 1)). A state is a context h; it has an arc
for each pair seen in training (``LEAST`` times or more), with the discounted and interpolated probability
(c(h, w) - D) / c(h) + B(h) P(w), and a failure arc of weight B(h), the mass that is left,
to the root, where every token has P(w). All distributions sum to 1. A text is scored in one
walk from left to right that carries its state and adds log10 weights.

Nothing of the model is held in one place. Rows are cut in runs of at most ``BLOCK`` rows
and about ``RUN`` bytes in written order, known by the number of their first row. A run sends its different pairs, by
context, to the bucket of the context's hash, where they are added up over all runs: the sum
over a context's pairs is the count of that word, those seen in training are its arcs. What
comes back are only numbers, in the order of the run's own pairs: the count of each pair, the
count and mass of each context. The run finds its pairs again from its texts and has the part
of the automaton that it needs. A pair that is everywhere is sent once per run. There is a
bucket per ``BUCKET`` training tokens or more. Contexts with more than a ``HOT_SHARE``-th of
all tokens (so at most that many) are spread over ``SALTS`` buckets, and their sums, a row
per context, collected on the driver.

Null and empty texts have the end as their only token. Rows with a null id teach nothing and
are not held out. Without training rows all tokens are unknown (c = 0, N = 0, V = 0). Words
are told apart by 64-bit hashes, the second word of a pair by 48 bits of it. Other columns
may have any names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from playspan.llm.common import U, mix, packed, quoted, remainder_of_id, slices_by_size
from playspan.llm.words import Batch
from playspan.session import stage

BLOCK = 2048
RUN = 1 << 24
BUCKET = 1 << 22
STRIDE = 1 << 17
LEAST = 1
DISCOUNT = 0.75
HOT_SHARE = 512
SALTS = 64
_WORD48 = U((1 << 48) - 1)
_END, _START = U(0x5DEECE66D1234567), U(0x2545F4914F6CDD1D)


def _press(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, the first bytes of all numbers together, then the second ones."""
    import zstandard

    head = np.array([len(a) for a in arrays], np.int64).tobytes()
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def _release(data: bytes, *kinds) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    at, out = 8 * len(kinds), []
    for n, kind in zip(np.frombuffer(raw[:at], np.int64).tolist(), kinds):
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(raw[at : at + n * size], np.uint8).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * size
    return out


def _steps(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers, which are smaller; undone by a cumulated sum."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts, the end of each included; first token and number per text."""
    batch = Batch(texts)
    n = batch.n_words + 1
    first = np.cumsum(n) - n
    out = np.full(int(n.sum()), _END, np.uint64)
    out[np.arange(len(batch.owner)) + batch.owner] = batch.word_hashes()
    return out, first, n


def _before(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The context of each token: the token before it, or the start."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[first] = _START
    return out


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    new = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(counts[order], new) if len(new) else counts[:0]


def _runs(batches, most: int):
    """(number of the first row, texts, training flags) for runs of rows of one block."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    held, run, texts, flags, size = None, None, [], [], 0
    for batch in batches:
        for block, t, z, train in zip(*(batch.column(c).to_pylist() for c in ("block", "t", "z", "train"))):
            if texts and (block != held or size > most):
                yield run, texts, np.array(flags, bool)
                texts, flags, size = [], [], 0
            if not texts:
                held, run = block, t
            texts.append(unpack(z))
            flags.append(train)
            size += len(texts[-1])
    if texts:
        yield run, texts, np.array(flags, bool)


def _in_slices(texts: list[bytes]):
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    for a, b in slices_by_size(sizes, 1 << 20, 1024):
        yield (a, b, *_tokens(texts[a:b]))


_SENT = "bucket int, t long, data binary"
_SUMMED = "bucket int, t long, data binary, word long, times long, mass long"


def _rows(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bucket": pa.int32(), "data": pa.binary()}
    kinds |= dict.fromkeys(("t", "word", "times", "mass"), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[n]) for i, n in enumerate(names)], names)


def _frequent(batches):
    """Words with a ``HOT_SHARE``-th of a run's training tokens; all of them as word null."""
    for _, texts, train in _runs(batches, RUN):
        parts, total = [], 0
        for a, b, tokens, _, n in _in_slices(texts):
            own = tokens[np.repeat(train[a:b], n)]
            total += len(own)
            parts.append(_summed(own, np.ones(len(own), np.int64)))
        k, c = _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        often = c * HOT_SHARE > total
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *k[often].view(np.int64).tolist()], pa.int64()),
                pa.array([total, *c[often].tolist()], pa.int64()),
            ],
            ["word", "n"],
        )


def _by_bucket(batches, *kinds):
    """(bucket, runs, arrays per run) for sorted rows."""
    held, runs, data = None, [], []
    for batch in batches:
        for bucket, t, raw in zip(*(batch.column(c).to_pylist() for c in ("bucket", "t", "data"))):
            if runs and bucket != held:
                yield held, runs, data
                runs, data = [], []
            held = bucket
            runs.append(t)
            data.append(_release(raw, *kinds))
    if runs:
        yield held, runs, data


def _changes(*arrays: np.ndarray) -> np.ndarray:
    """Where a new combination begins in sorted arrays."""
    new = np.zeros(max(len(arrays[0]) - 1, 0), bool)
    for a in arrays:
        new |= a[1:] != a[:-1]
    return np.flatnonzero(np.append(True, new))


def _pairs(texts: list[bytes], train: np.ndarray, buckets: int, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different pairs of a run in order of (bucket, context, word), and their training counts."""
    parts = []
    for a, b, tokens, first, n in _in_slices(texts):
        h, w, flags = _before(tokens, first), tokens & _WORD48, np.repeat(train[a:b], n)
        order = np.lexsort((w, h))
        h, w, c = h[order], w[order], flags[order].astype(np.int64)
        new = _changes(h, w)
        parts.append((h[new], w[new], np.add.reduceat(c, new)))
    h, w, c = (np.concatenate([p[i] for p in parts]) for i in range(3))
    del parts
    salt = np.where(np.isin(h, hot), U(1) + (w >> U(40)) % U(SALTS), U(0))
    place = np.where(salt > 0, mix(h, salt), h)
    to = ((place >> U(32)) * U(buckets) >> U(32)).astype(np.int64)
    order = np.lexsort((w, h, to))
    to, h, w, c = to[order], h[order], w[order], c[order]
    new = _changes(to, h, w)
    return to[new], h[new], w[new], np.add.reduceat(c, new)


def _send_pairs(buckets: int, hot: np.ndarray, most: int):
    """Per bucket: contexts, pairs of each, the pairs' other words, training counts."""

    def run(batches):
        for t, texts, train in _runs(batches, most):
            to, h, w, c = _pairs(texts, train, buckets, hot)
            cut, rows = _changes(to), []
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(to)]):
                starts = _changes(h[a:b])
                each = np.diff(np.append(starts, b - a)).astype(np.uint32)
                data = _press(_steps(h[a:b][starts]), each, w[a:b], c[a:b].astype(np.uint32))
                rows.append((int(to[a]), t, data))
            yield _rows(["bucket", "t", "data"], rows)

    return run


_BACK = (np.int64, np.int64, np.int64)


def _add_pairs(hot: np.ndarray):
    """Sums of a bucket back to its runs, in the order of their pairs; sums of hot contexts.

    A run gets the count of each of its pairs (0 below ``LEAST``), and for each of its
    contexts the count and four times the discounted counts of its arcs (whole numbers).
    Rows without a run are sums of the bucket: a hot context (``word``) each, and one with the
    number of other contexts with a count (``word`` null).
    """

    def run(batches):
        for bucket, runs, data in _by_bucket(batches, np.uint64, np.uint32, np.uint64, np.uint32):
            data = [(np.cumsum(h, dtype=np.uint64), n, w, c) for h, n, w, c in data]
            keys = [mix(np.repeat(h, n), w) for h, n, w, _ in data]
            total, counts = _summed(np.concatenate(keys), np.concatenate([c for *_, c in data]).astype(np.int64))
            kept = counts >= LEAST
            total, counts = total[kept], counts[kept]
            context, times, mass, found, seen = [], [], [], [], np.zeros(len(total), bool)
            for (h, n, _, c), k in zip(data, keys):
                at, mine = _found_in(total, k)
                found.append((at, mine))
                once = mine.copy()
                once[mine] = ~seen[at[mine]]
                seen[at[once]] = True
                own = np.zeros(len(k), np.int64)
                own[once] = 4 * counts[at[once]] - round(4 * DISCOUNT)
                first = np.cumsum(n, dtype=np.int64) - n
                context.append(h)
                times.append(np.add.reduceat(c.astype(np.int64), first))
                mass.append(np.add.reduceat(own, first))
            every = np.concatenate(context)
            context, times = _summed(every, np.concatenate(times))
            _, mass = _summed(every, np.concatenate(mass))
            spread = np.isin(context, hot)
            rows = [(bucket, None, None, None, int((times[~spread] > 0).sum()), 0)]
            for word, n, m in zip(context[spread].view(np.int64).tolist(), times[spread].tolist(), mass[spread].tolist()):
                rows.append((bucket, None, None, word, n, m))
            for t, (h, *_), (at, mine) in zip(runs, data, found):
                back = np.zeros(len(at), np.int64)
                back[mine] = counts[at[mine]]
                place = np.searchsorted(context, h)
                rows.append((bucket, t, _press(back, times[place], mass[place]), None, None, None))
            yield _rows(["bucket", "t", "data", "word", "times", "mass"], rows)

    return run


def _found_in(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted value in the sorted ``keys``, and whether it is there."""
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


class Automaton:
    """The part of the automaton that a run needs: its words, arcs and failure weights."""

    def __init__(self, words, times, mass, arcs, arc_counts, n: int, v: int, ends: int):
        """``words`` are contexts, the start among them, with counts and discounted arc counts."""
        order = np.argsort(words)
        words, times, mass = words[order], times[order], mass[order]
        real = words != _START
        self.words = np.append(words[real], _END)
        self.counts = np.append(times[real], ends)
        order = np.argsort(self.words)
        self.words, self.counts = self.words[order], self.counts[order]
        self.log_p = np.log10((self.counts + 0.1) / (n + 0.1 * (v + 1)))
        state = mass > 0
        self.contexts, self.times = words[state], times[state].astype(float)
        self.left = np.maximum(1 - mass[state] / self.times, 1e-12)
        self.fail = np.log10(self.left)
        self.arcs, self.arc_counts = arcs, arc_counts

    def state_of(self, tokens: np.ndarray) -> np.ndarray:
        """The state of each context; -1 is the root."""
        if not len(self.contexts):
            return np.full(len(tokens), -1)
        at = np.minimum(np.searchsorted(self.contexts, tokens), len(self.contexts) - 1)
        return np.where(self.contexts[at] == tokens, at, -1)

    def walk(self, tokens: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per text: log10 probability, base score, tokens with a count.

        Texts stand one after the other and are walked in strides of ``STRIDE`` tokens. A token
        leads to its own state from any state, so the states of a stride are those its tokens lead
        to, one place later; the last one is carried to the next stride, and each text starts anew.
        """
        begins = np.zeros(len(tokens), bool)
        begins[first] = True
        start = carried = self.state_of(np.array([_START]))[0]
        weight, base, known = np.empty(len(tokens)), np.empty(len(tokens)), np.empty(len(tokens), bool)
        for a in range(0, len(tokens), STRIDE):
            here = slice(a, a + STRIDE)
            read = tokens[here]
            word = np.minimum(np.searchsorted(self.words, read), len(self.words) - 1)
            after = self.state_of(read)
            state = np.where(begins[here], start, np.append(carried, after[:-1]))
            carried = after[-1]
            low, known[here] = self.log_p[word], self.counts[word] > 0
            added = low.copy()
            inside = np.flatnonzero(state >= 0)
            s = state[inside]
            added[inside] += self.fail[s]  # the failure arc to the root, where no arc fits
            arc, has = _found_in(self.arcs, mix(self.contexts[s], read[inside] & _WORD48))
            s, inside = s[has], inside[has]
            p = (self.arc_counts[arc[has]] - DISCOUNT) / self.times[s] + self.left[s] * 10 ** low[inside]
            added[inside] = np.log10(p)
            weight[here], base[here] = added, low
        return np.add.reduceat(weight, first), np.add.reduceat(base, first), np.add.reduceat(known, first, dtype=np.int64)


_SCORED = "t long, n_tokens long, n_known long, base_score double, score double"


def _score(n: int, v: int, ends: int, buckets: int, hot: np.ndarray, hot_times: np.ndarray, hot_mass: np.ndarray):
    """Rows sorted by (block, t, kind, bucket): what came back for a run (0), then its texts (1)."""

    def built(parts, texts):
        back = [_release(x, *_BACK) for x in parts]
        counts, times, mass = (np.concatenate([b[i] for b in back]) for i in range(3))
        to, h, w, _ = _pairs(texts, np.zeros(len(texts), bool), buckets, hot)
        has, words = counts > 0, h[_changes(to, h)]
        arcs, arc_counts = mix(h[has], w[has]), counts[has]
        order = np.argsort(arcs)
        words, where = np.unique(words, return_index=True)  # a hot context comes once per salt
        times, mass = times[where], mass[where]
        at, spread = _found_in(hot, words)  # the sums of these come from the driver
        times[spread], mass[spread] = hot_times[at[spread]], hot_mass[at[spread]]
        return Automaton(words, times, mass / 4, arcs[order], arc_counts[order], n, v, ends)

    def scored(parts, ts, texts):
        model, out = built(parts, texts), []
        for a, b, tokens, first, size in _in_slices(texts):
            score, base, known = model.walk(tokens, first, size)
            out.append((ts[a:b], size, known, base, score))
        kinds = (np.int64, np.int64, np.int64, np.float64, np.float64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([o[i] for o in out]).astype(k)) for i, k in enumerate(kinds)],
            ["t", "n_tokens", "n_known", "base_score", "score"],
        )

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        parts, ts, texts = [], [], []
        for batch in batches:
            for kind, t, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "t", "data"))):
                if kind == 0:
                    if ts:
                        yield scored(parts, ts, texts)
                        parts, ts, texts = [], [], []
                    parts.append(data)
                else:
                    ts.append(t)
                    texts.append(unpack(data))
        if ts:
            yield scored(parts, ts, texts)

    return run


def score_texts(docs: DataFrame, train, text: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """Scores of all rows of ``docs``, learned from those where the column ``train`` is true.

    Returns the written rows (other columns of ``docs`` under ``row``, and a number ``t``),
    the scores by ``t``, and the number of training tokens.
    """
    spark = docs.sparkSession
    others = [quoted(c) for c in docs.columns if c != text]
    rows = docs.select(
        F.struct(*others, F.lit(0).alias("_")).alias("row"), F.coalesce(train, F.lit(False)).alias("train"),
        packed(F.coalesce(quoted(text).cast("string"), F.lit(""))).alias("z"),
        F.monotonically_increasing_id().alias("t"),
    )
    rows = stage(rows.withColumn("block", F.floor(F.col("t") / BLOCK)), "texts")
    texts = rows.select("block", "t", "z", "train")

    def met(sent: DataFrame) -> DataFrame:
        return sent.repartition("bucket").sortWithinPartitions("bucket", "t")

    frequent = stage(texts.mapInArrow(_frequent, "word long, n long"), "frequent")
    n = frequent.where("word IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = frequent.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    often = [r["word"] for r in often.where(F.col("n") * HOT_SHARE > n).collect()]
    hot = np.unique(np.array([*often, *np.array([_START, _END]).view(np.int64).tolist()], np.int64).view(np.uint64))
    ends = rows.where("train").count()
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKET))
    sent = met(texts.mapInArrow(_send_pairs(buckets, hot, RUN), _SENT))
    pairs = stage(sent.mapInArrow(_add_pairs(hot), _SUMMED), "pairs")
    hot_times, hot_mass, v = np.zeros(len(hot), np.int64), np.zeros(len(hot), np.int64), int(ends > 0)
    sums = pairs.where("t IS NULL").groupBy("word").agg(F.sum("times").alias("times"), F.sum("mass").alias("mass"))
    for r in sums.collect():  # a row per hot context
        if r["word"] is None:
            v += r["times"]
        else:
            at = np.searchsorted(hot, np.int64(r["word"]).view(np.uint64))
            hot_times[at], hot_mass[at] = r["times"], r["mass"]
    v += int((hot_times[hot != _START] > 0).sum())
    back = pairs.where("t IS NOT NULL").select(
        F.floor(F.col("t") / BLOCK).alias("block"), "t", F.lit(0).alias("kind"), "bucket", "data"
    )
    together = back.union(rows.select("block", "t", F.lit(1), F.lit(None).cast("int"), "z"))
    together = together.repartition("block").sortWithinPartitions("block", "t", "kind", "bucket")
    return rows, together.mapInArrow(_score(n, v, ends, buckets, hot, hot_times, hot_mass), _SCORED), n


def digest(docs: DataFrame) -> DataFrame:
    remainder = remainder_of_id("doc_id", 10)
    rows, scores, n = score_texts(docs.select("doc_id", "text"), remainder != 0)
    ids = rows.select("t", "row.doc_id")
    return ids.join(scores, "t").select(
        "doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"), "base_score", "score",
    )
