"""Ranked lexical search with the Best Position Algorithm over block indexes.

*Index.* Each task turns the documents it reads into blocks of bounded size. A block is one row
of a written table: ids, lengths, terms, and per term the documents that hold it with their
frequencies. It holds all terms and is not tied to any items. Frequencies over the corpus are
sums over blocks, of the terms of the items only.

*Search.* Items go to the blocks in groups of about ``GROUP`` terms, so what is broadcast does
not grow with them; there is a run over the index per group. In a block, a term's list is its
documents by falling impact. All lists of an item are read in parallel; a document that shows
up is looked up in the other lists at once (direct access), which gives its score and its
position in each list. The best position of a list is the end of the positions seen without a
gap, by reading or by direct access. No document not yet seen can score more than the sum of
the impacts at the best positions, and the search of a block ends when that is strictly below
the k-th score, so that equal scores are all seen and the smaller id can win. The k-th score is
carried from block to block of a task, so later blocks often end at once. Each task returns k
documents per item, and the last step ranks these.

Null and empty texts and those without terms have no rank. An item without a known term, null
or empty, returns nothing. Repeated rows of documents and items each count as rows of their
own; equal scores go by id, null ids last. Extra columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from playspan.llm.common import gathered, pieces, quoted
from playspan.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_IN_TERM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
BLOCK_BYTES, BLOCK_ROWS = 16 << 20, 8192
GROUP = 200_000
FIRST_STEP = 8

BLOCK = (
    "ids array<long>, lengths array<int>, n_with long, n_terms long, terms array<string>, df array<int>,"
    " docs binary, tfs binary"
)


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The blocks of ``docs``, written to the shared folder."""
    slim = docs.select(quoted(doc_id).cast("long").alias("id"), quoted(text).alias("text"))
    return stage(slim.mapInArrow(_blocks, BLOCK), "blocks")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    for ids, texts in gathered(batches, BLOCK_BYTES, BLOCK_ROWS):
        number: dict[bytes, int] = {}
        put, keys, tfs, lengths = number.setdefault, [], [], []
        for i, text in enumerate(texts):
            words = text.translate(_IN_TERM).split()
            lengths.append(len(words))
            counts = Counter(words)
            of_text = np.fromiter((put(w, len(number)) for w in counts), np.int64, len(counts))
            keys.append(of_text << 32 | i)
            tfs.append(np.fromiter(counts.values(), np.uint32, len(counts)))
        keys, tfs = np.concatenate(keys), np.concatenate(tfs)
        order = np.argsort(keys)
        keys, tfs = keys[order], tfs[order]
        press = zstandard.ZstdCompressor(level=3).compress
        df = np.bincount(keys >> 32, minlength=len(number))
        row = {
            "ids": [ids], "lengths": [lengths], "n_with": [sum(n > 0 for n in lengths)], "n_terms": [sum(lengths)],
            "terms": [[w.decode("utf-8") for w in number]], "df": [df.tolist()],
            "docs": [press((keys & 0xFFFFFFFF).astype("<u2").tobytes())], "tfs": [press(tfs.tobytes())],
        }
        kinds = (pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.list_(pa.string()),
                 pa.list_(pa.int32()), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds)], list(row))


def terms_of(text: Column) -> Column:
    """All terms of a text, with repeats."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def search(blocks: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each row of ``items``."""
    spark = items.sparkSession
    named = items.select(quoted(item_id).alias("item_id"), quoted(text).alias("text"))
    named = stage(named.withColumn("item", F.monotonically_increasing_id()), "items")
    asked = named.select("item", F.explode(terms_of(F.col("text"))).alias("term")).groupBy("item", "term")
    asked = stage(asked.agg(F.count(F.lit(1)).alias("times")), "asked")
    n_docs, n_terms = blocks.agg(F.sum("n_with"), F.sum("n_terms")).first()
    known = blocks.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select(F.col("t.terms").alias("term"), "t.df")
    known = known.join(asked.select("term").distinct(), "term", "left_semi")
    df = known.groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * F.lit(n_docs or 0) + 2.0) / (2.0 * F.col("df") + 1.0)))
    groups = max(1, -(-asked.count() // GROUP))
    weighed = asked.join(df, "term").withColumn("weight", (weight * F.col("times")).cast("long")).where("weight > 0")
    per_item = weighed.groupBy("item").agg(F.collect_list(F.struct("term", "weight")).alias("asked"))
    per_item = stage(per_item.withColumn("group", F.pmod(F.xxhash64("item"), F.lit(groups))), "weighed")
    found = []
    for g in range(groups):
        part = per_item.where(F.col("group") == g).select("item", "asked").collect()  # about GROUP terms
        sent = spark.sparkContext.broadcast(
            (k, int(n_docs or 0), int(n_terms or 0), [(r.item, {t.term: t.weight for t in r.asked}) for r in part])
        )
        slim = blocks.select("ids", "lengths", "terms", "df", "docs", "tfs")
        found.append(stage(slim.mapInArrow(_searcher(sent), "item long, doc_id long, score long"), "found"))
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _searcher(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, n_docs, n_terms, items = sent.value
        wanted = {t for _, asked in items for t in asked}
        held = {}  # item -> scores, ids, whether the id is null: the best so far
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.slice(i, 1), wanted, n_docs, n_terms)
                for item, asked in items:
                    scores, docs = block.best(asked, k, held[item][0][-1] if len(held.get(item, [()])[0]) == k else 0)
                    if len(scores):
                        held[item] = _better(held.get(item), scores, block.ids[docs], block.null[docs], k)
        rows = [(item, None if n else int(d), int(s)) for item, best in held.items() for s, d, n in zip(*best)]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    return run


def _better(old, scores, ids, null, k):
    if old:
        scores, ids, null = (np.concatenate(x) for x in zip(old, (scores, ids, null)))
    order = np.lexsort((ids, null, -scores))[:k]
    return scores[order], ids[order], null[order]


class Block:
    """Impact lists of the wanted terms of one block, and direct access to them."""

    def __init__(self, row: pa.RecordBatch, wanted: set[str], n_docs: int, n_terms: int):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        get = lambda name: row.column(name)[0]
        ids = get("ids").values
        self.null = np.asarray(ids.is_null().to_numpy(zero_copy_only=False))
        self.ids = np.asarray(ids.fill_null(0).to_numpy(zero_copy_only=False), np.int64)
        n, df = (np.asarray(get(c).values, np.int64) for c in ("lengths", "df"))
        terms = get("terms").as_py()
        here = [i for i, t in enumerate(terms) if t in wanted]
        self.number = {terms[i]: j for j, i in enumerate(here)}
        self.n = len(n)
        self.length = df[here]
        self.start = np.cumsum(self.length) - self.length
        at = pieces(df, (np.cumsum(df) - df)[here], self.length)
        docs = np.frombuffer(unpack(get("docs").as_py()), "<u2").astype(np.int64)[at]
        tf = np.frombuffer(unpack(get("tfs").as_py()), "<u4").astype(np.int64)[at]
        term = np.repeat(np.arange(len(here)), self.length)
        m = 75 + 25 * n * n_docs // max(n_terms, 1)
        impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[docs])
        #: By term and document, for direct accesses: places in the lists, and impacts there.
        self.keys = term * self.n + docs
        order = np.lexsort((docs, -impact, term))
        self.position = np.empty(len(order), np.int64)
        self.position[order] = np.arange(len(order)) - self.start[term]
        self.impact = impact
        #: By term and falling impact.
        self.listed, self.falling = docs[order], impact[order]

    def best(self, asked: dict[str, int], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and places of the ``k`` best documents, and of all that tie with the last one.

        ``least`` is a score that k documents elsewhere have: nothing below it is returned.
        """
        lists = np.array([self.number[t] for t in asked if t in self.number], np.int64)
        none = np.zeros(0, np.int64)
        if not len(lists):
            return none, none
        weight = np.array([w for t, w in asked.items() if t in self.number], np.int64)
        start, length = self.start[lists], self.length[lists]
        ends = np.cumsum(length + 1)  # one place more than the list has, never seen
        offset = ends - length - 1
        seen = np.zeros(int(ends[-1]), bool)
        known = np.zeros(self.n, bool)
        position = np.zeros(len(lists), np.int64)  # places seen without a gap
        scores, docs, depth, step = none, none, 0, FIRST_STEP
        while True:
            at = start + np.minimum(np.maximum(position - 1, 0), length - 1)
            limit = int((weight * self.falling[at] * (position < length)).sum())
            if len(scores) >= k:
                least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            if limit <= 0 or limit < least:
                break
            keep = scores >= least
            scores, docs = scores[keep], docs[keep]
            count = np.clip(length - depth, 0, step)
            read = self.listed[pieces(self.listed, start + depth, count)]
            read = np.unique(read[~known[read]])
            known[read] = True
            depth, step = depth + step, 2 * step
            if len(read):
                ask = (lists[:, None] * self.n + read).ravel()
                place = np.minimum(np.searchsorted(self.keys, ask), len(self.keys) - 1)
                hit = (self.keys[place] == ask).reshape(len(lists), -1)
                place = place.reshape(hit.shape)
                scores = np.concatenate([scores, (weight[:, None] * self.impact[place] * hit).sum(0)])
                docs = np.concatenate([docs, read])
                seen[(offset[:, None] + self.position[place])[hit]] = True
            gaps = np.flatnonzero(~seen)
            position = gaps[np.searchsorted(gaps, offset)] - offset
        keep = scores >= max(least, 1)
        return scores[keep], docs[keep]


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(index(docs), items)
