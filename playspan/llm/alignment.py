"""Cross-tokenizer alignment: products of token-byte incidence matrices.

A text is encoded by a byte-level BPE (A, of a blank and the text) and by a piece BPE with byte
fallback (B, which puts the blank itself). Both cut the same bytes, so each has a token-byte
incidence matrix in compressed sparse rows. The rows of A Bᵀ, made by Gustavson's row-wise
product, are the B tokens that an A token overlaps, with the number of shared bytes: the links.
Offsets where both end cut the tokens into groups, which give token-group incidence matrices;
the rows of G_A G_Bᵀ are the tokens that share a group. That product is only counted (its
symbolic pass), since a long group would give the square of its length.

Texts are aligned in blocks of bounded size, in the task that reads them. A block is one row of
a written table: figures per document, the different (A id, B id) pairs with the number of
documents that hold them, and which document has which pair how often, again in sparse rows.
Only pairs per block are shuffled, to sum up documents corpus-wide and to find the highest
count of each A id (an id has at most as many partners as B has ids). The sums go back to the
blocks, where each document's sums are the product of its row with them.

Null and empty texts, and texts whose tokens of A or B do not join to the blank and the text,
have no tokens: all figures are zero and the digest is empty. Special tokens in texts are plain
text. Rows are passed through one by one, so repeated rows and null ids stay; a pair counts
once per row. An empty table gives an empty one. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from playspan.llm.bpe import PATTERN, _shown_bytes, default_vocabulary
from playspan.llm.common import gathered, kept_in_worker, pieces, quoted, slices_by_size
from playspan.session import stage

BLOCK_BYTES, BLOCK_ROWS, CHUNK = 8 << 20, 8192, 1 << 20
FIGURES = ("n_a", "n_b", "n_groups", "n_links")
BLOCK = (
    "block string, ids array<long>, " + ", ".join(f"{c} array<long>" for c in FIGURES)
    + ", sha array<string>, pairs array<long>, n_docs array<long>, ends binary, columns binary, times binary"
)
OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


@lru_cache(maxsize=None)
def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Rows:
    """A sparse matrix in compressed rows: row i holds ``columns[starts[i]:starts[i + 1]]``."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray | None = None):
        self.starts, self.columns = starts, columns
        self.values = np.ones(len(columns), np.int64) if values is None else values

    @classmethod
    def of_lengths(cls, lengths: np.ndarray) -> Rows:
        """Incidence of tokens (rows) and the bytes they cover one after the other."""
        starts = np.concatenate([[0], np.cumsum(lengths)])
        return cls(starts, np.arange(starts[-1]))

    @classmethod
    def of_labels(cls, labels: np.ndarray) -> Rows:
        """Incidence of rows and the one column of each."""
        return cls(np.arange(len(labels) + 1), labels)

    def transposed(self, n: int) -> Rows:
        """The matrix of ``n`` rows, one per column of this one."""
        order = np.argsort(self.columns, kind="stable")
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=n))])
        return Rows(starts, rows[order], self.values[order])

    def _met(self, other: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of the row of ``other`` that each entry meets."""
        return other.starts[self.columns], np.diff(other.starts)[self.columns]

    def times(self, other: Rows) -> Rows:
        """Gustavson's product: row i is the sum of the rows of ``other`` that row i's entries meet."""
        starts, lengths = self._met(other)
        at = pieces(other.columns, starts, lengths)
        rows = np.repeat(np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts)), lengths)
        columns, values = other.columns[at], np.repeat(self.values, lengths) * other.values[at]
        width = int(columns.max()) + 1 if len(columns) else 1
        keys = rows * width + columns
        if (keys[1:] < keys[:-1]).any():
            order = np.argsort(keys, kind="stable")
            keys, values = keys[order], values[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        values = np.add.reduceat(values, first) if len(first) else values
        n = np.bincount(keys[first] // width, minlength=len(self.starts) - 1)
        return Rows(np.concatenate([[0], np.cumsum(n)]), keys[first] % width, values)

    def sizes_times(self, other: Rows) -> np.ndarray:
        """Entries per row of the product, for rows of one entry each: its symbolic pass."""
        return self._met(other)[1]

    def dot(self, vector: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(self.values * vector[self.columns])])
        return total[self.starts[1:]] - total[self.starts[:-1]]


class Pair:
    """Both tokenizers, the bytes of their tokens, and alignments of texts."""

    def __init__(self, vocabulary: str, model: bytes):
        import sentencepiece
        import tiktoken

        spec, shown = json.loads(vocabulary), _shown_bytes()
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(shown[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a = a.encode_ordinary
        b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.b = lambda texts: b.encode(texts, num_threads=1)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = []
        for i in range(b.get_piece_size()):
            piece = b.id_to_piece(i)
            fallback = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            self.b_bytes.append(bytes.fromhex(fallback[1]) if fallback else piece.replace("▁", " ").encode())
        self.a_length, self.b_length = (np.array([len(x) for x in y]) for y in (self.a_bytes, self.b_bytes))
        self.shown = [[b"%d%c" % (i, c) for c in b",|;"] for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.shown = [x for three in self.shown for x in three]

    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B of each text; none where their bytes are not those of the text."""
        a, b = [], self.b(texts)
        for i, text in enumerate(texts):
            ids = self.a(" " + text) if text else []
            raw = (" " + text).encode("utf-8")
            whole = text and all(
                b"".join(map(of.__getitem__, found)) == raw for of, found in ((self.a_bytes, ids), (self.b_bytes, b[i]))
            )
            a.append(ids if whole else [])
            if not whole:
                b[i] = []
        return a, b

    def align(self, texts: list[str]) -> Alignment:
        return Alignment(self, *self.tokens(texts))


class Alignment:
    """Tokens of some texts, all in one: ids, links, groups, and the text of each."""

    def __init__(self, use: Pair, a: list[list[int]], b: list[list[int]]):
        self.use = use
        self.n_a, self.n_b = (np.array([len(x) for x in y], np.int64) for y in (a, b))
        self.a, self.b = (np.fromiter((i for x in y for i in x), np.int64) for y in (a, b))
        a_bytes, b_bytes = Rows.of_lengths(use.a_length[self.a]), Rows.of_lengths(use.b_length[self.b])
        n = int(a_bytes.starts[-1])
        self.links = a_bytes.times(b_bytes.transposed(n))
        both = np.intersect1d(a_bytes.starts[1:], b_bytes.starts[1:], assume_unique=True)
        self.a_group, self.b_group = (np.searchsorted(both, x.starts[1:]) for x in (a_bytes, b_bytes))
        self.n_all_groups = len(both)
        self.a_text, self.b_text = (np.repeat(np.arange(len(n)), n) for n in (self.n_a, self.n_b))

    def shared(self) -> np.ndarray:
        """Per A token, how many B tokens share its group."""
        return Rows.of_labels(self.a_group).sizes_times(Rows.of_labels(self.b_group).transposed(self.n_all_groups))

    def n_groups(self) -> np.ndarray:
        last = np.flatnonzero(np.diff(self.a_group, append=-1))
        return np.bincount(self.a_text[last], minlength=len(self.n_a))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Text and pair (A id, then 32 bits of B id) of each link."""
        a = np.repeat(np.arange(len(self.a)), np.diff(self.links.starts))
        return self.a_text[a], self.a[a] << 32 | self.b[self.links.columns]

    def written_groups(self) -> list[bytes]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        out = []
        for ids, group, mark in ((self.a, self.a_group, 1), (self.b, self.b_group, 2)):
            ends = np.diff(group, append=-1) != 0
            out.append((3 * ids + mark * ends, 2 * group + (mark - 1)))
        codes, order = np.concatenate([x for x, _ in out]), np.argsort(np.concatenate([y for _, y in out]), kind="stable")
        codes = codes[order].tolist()
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        show = self.use.shown.__getitem__
        return [b"".join(map(show, codes[i:j]))[:-1] for i, j in zip([0, *ends], ends)]


def blocks(docs: DataFrame, vocabulary: str | None = None, model: str | None = None, doc_id="doc_id", text="text") -> DataFrame:
    """The blocks of ``docs``, written to the shared folder."""
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        words = f.read()
    with open(model or default_pieces(), "rb") as f:
        cut = f.read()
    key = hashlib.sha256(words.encode() + cut).hexdigest()
    sent = docs.sparkSession.sparkContext.broadcast((words, cut))  # two files of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = kept_in_worker(("align", key), lambda: Pair(*sent.value))
        for ids, texts in gathered(batches, BLOCK_BYTES, BLOCK_ROWS):
            yield _block(use, ids, texts)

    slim = docs.select(quoted(doc_id).cast("long").alias("id"), quoted(text).alias("text"))
    return stage(slim.mapInArrow(run, BLOCK), "aligned")


def _block(use: Pair, ids: list, texts: list[bytes]) -> pa.RecordBatch:
    import zstandard

    figures = {c: [] for c in FIGURES}
    sha, keys, times = [], [], []
    for lo, hi in slices_by_size(np.array([len(t) for t in texts]), CHUNK, BLOCK_ROWS):
        found = use.align([t.decode("utf-8") for t in texts[lo:hi]])
        of, pair = found.pairs()
        figures["n_a"].append(found.n_a)
        figures["n_b"].append(found.n_b)
        figures["n_groups"].append(found.n_groups())
        figures["n_links"].append(np.bincount(of, minlength=hi - lo))
        sha += [hashlib.sha256(x).hexdigest() if x else "" for x in found.written_groups()]
        order = np.lexsort((pair, of))
        of, pair = of[order] + lo, pair[order]
        first = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(pair, prepend=-1) != 0))
        keys.append((of[first], pair[first]))
        times.append(np.diff(np.append(first, len(of))))
    of, pair = (np.concatenate(x) for x in zip(*keys))
    different, columns = np.unique(pair, return_inverse=True)
    press = zstandard.ZstdCompressor(level=3).compress
    ends = np.cumsum(np.bincount(of, minlength=len(texts)))
    row = {
        "block": pa.array([uuid.uuid4().hex]), "ids": _list(ids),
        **{c: _list(np.concatenate(v)) for c, v in figures.items()},
        "sha": pa.array([sha], pa.list_(pa.string())), "pairs": _list(different),
        "n_docs": _list(np.bincount(columns, minlength=len(different))),
    }
    for name, values in (("ends", ends), ("columns", columns), ("times", np.concatenate(times))):
        row[name] = pa.array([press(values.astype("<u4").tobytes())], pa.binary())
    return pa.RecordBatch.from_arrays(list(row.values()), list(row))


def _list(values) -> pa.Array:
    values = pa.array(values, pa.int64())
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def counted(aligned: DataFrame) -> DataFrame:
    """(pair, n_docs, best): documents that hold a pair linked, and whether that is its A id's highest."""
    pairs = aligned.select(F.explode(F.arrays_zip("pairs", "n_docs")).alias("p"))
    counts = pairs.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.n_docs").alias("n_docs"))
    counts = stage(counts, "pairs")
    a_id = F.shiftright("pair", 32)
    highest = counts.groupBy(a_id.alias("a")).agg(F.max("n_docs").alias("highest"))
    return counts.join(highest, a_id == F.col("a")).select("pair", "n_docs", (F.col("n_docs") == F.col("highest")).alias("best"))


def digest(docs: DataFrame, vocabulary: str | None = None, model: str | None = None) -> DataFrame:
    aligned = blocks(docs, vocabulary, model)
    places = aligned.select("block", F.posexplode("pairs").alias("place", "pair"))
    back = places.join(counted(aligned), "pair").groupBy("block").agg(
        F.collect_list(F.struct("place", (2 * F.col("n_docs") + F.col("best").cast("long")).alias("v"))).alias("sums")
    )
    back = back.select("block", F.col("sums.place").alias("places"), F.col("sums.v").alias("sums"))
    whole = aligned.select("block", "ids", *FIGURES, "sha", "ends", "columns", "times").join(back, "block", "left")
    return whole.mapInArrow(_summed, OUT)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for i in range(batch.num_rows):
            get = lambda name: batch.column(name)[i]  # noqa: B023, E731
            ends, columns, times = (np.frombuffer(unpack(get(c).as_py()), "<u4").astype(np.int64) for c in ("ends", "columns", "times"))
            sums = np.zeros(0, np.int64)
            if get("places").is_valid:
                places = np.asarray(get("places").values)
                sums = np.zeros(len(places), np.int64)
                sums[places] = np.asarray(get("sums").values)
            held = Rows(np.concatenate([[0], ends]), columns, times)
            yield pa.RecordBatch.from_arrays(
                [get("ids").values, *(get(c).values for c in FIGURES), pa.array(held.dot(sums & 1)),
                 pa.array(held.dot(sums >> 1)), get("sha").values],
                [c.split()[0] for c in OUT.split(", ")],
            )
