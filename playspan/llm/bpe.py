"""Byte-level BPE with a contiguous rank array, and decoding.

A text is cut at special tokens, then into words by the pattern of the vocabulary. For a
short word the part boundaries and the ranks of adjacent parts lie in two plain arrays: the
smallest rank is found by a scan, its boundary is deleted and the two ranks beside it are
looked up again, until no adjacent pair is in the merge table. Words above ``SHORT`` bytes
take the same merges off a heap, since repeated scans would be quadratic. Words met before
are kept per Python worker, twice ``kept`` at most: more memory means fewer merges done
again, and nothing else. A blank between two other characters
always begins a word of the pattern, so a text is looked up blank by blank first, and the
pattern is only run on what was not met yet. Ids are decoded once per such chunk too: the
bytes of a text are those of its ids one after another, and become characters as a whole.

Null and empty texts have no tokens and decode to an empty text. Whole texts are encoded,
whatever their length; rows and other columns are passed through.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from playspan.llm.common import free_name, kept_in_worker, quoted

#: Fixed value: the word pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHORT = 128
KEPT = 800_000
LATIN, MARKS = "\u024f", "!\"#$%&()*+,-./:;<=>?@[]^_{|}~"  # the apostrophe can begin an ending


@lru_cache(maxsize=None)
def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _shown_bytes() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Words to ids and ids to bytes for one vocabulary (the text of its JSON file)."""

    def __init__(self, vocabulary: str, kept: int = KEPT):
        import regex

        self.kept = kept

        spec = json.loads(vocabulary)
        shown = _shown_bytes()
        raw = lambda token: bytes(shown[c] for c in token)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.bytes = {b: self.ids[bytes([b])] for b in range(256) if bytes([b]) in self.ids}
        self.ranks, self.made = {}, []  # two ids in one number to their rank, rank to id
        for a, b in pairs:
            a, b = raw(a), raw(b)
            self.ranks[self.ids[a] << 32 | self.ids[b]] = len(self.made)
            self.made.append(self.ids[a + b])
        tokens = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in special.items()}
        self.special = special
        self.decoded = {b"%d" % i: t for i, t in tokens.items()}
        self.split = regex.compile(PATTERN).findall
        longest = sorted(special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")").split if special else None
        self.blanks = regex.compile(r"\s | \s|^ | $").search
        self.met, self.old = {}, {}  # words to their ids as decimals, a comma after each
        self.chunks, self.old_chunks = {}, {}  # the same for what stands from blank to blank
        self.backs, self.old_backs = {}, {}  # and the bytes that those ids stand for

    def merged(self, word: bytes) -> list[int]:
        return self._scan(word) if len(word) <= SHORT else self._heap(word)

    def _scan(self, word: bytes) -> list[int]:
        rank, made, none = self.ranks.get, self.made, len(self.made)
        parts = [self.bytes[b] for b in word]
        ranks = [rank(a << 32 | b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            del parts[i], ranks[i]
            parts[i] = part = made[least]
            if i < len(ranks):
                ranks[i] = rank(part << 32 | parts[i + 1], none)
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 32 | part, none)
        return parts

    def _heap(self, word: bytes) -> list[int]:
        rank, n = self.ranks.get, len(word)
        parts = [self.bytes[b] for b in word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (r := rank(parts[i] << 32 | parts[j])) is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            r, i, left, right = heapq.heappop(heap)
            if parts[i] != left or (j := after[i]) >= n or parts[j] != right:
                continue
            parts[i], parts[j], after[i] = self.made[r], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [part for part in parts if part >= 0]

    def of_word(self, word: str) -> bytes:
        """The ids as decimal text, a comma after each."""
        out = self.old.get(word)
        if out is None:
            out = b"".join([b"%d," % i for i in self.merged(word.encode("utf-8"))])
        if len(self.met) >= self.kept:
            self.met, self.old = {}, self.met
        self.met[word] = out
        return out

    def of_words(self, text: str) -> bytes:
        met = self.met
        return b"".join([met.get(word) or self.of_word(word) for word in self.split(text)])

    def of_chunk(self, chunk: str) -> bytes:
        # Latin letters after at most one blank are a word of the pattern, and so are marks after them.
        letters = chunk.rstrip(MARKS)
        if not letters.removeprefix(" ").isalpha() or max(letters) > LATIN:
            return self.of_words(chunk)
        found = self.met.get(letters) or self.of_word(letters)
        if len(letters) < len(chunk):
            marks = chunk[len(letters):]
            found += self.met.get(marks) or self.of_word(marks)
        return found

    def of_chunks(self, chunks: list[str]) -> tuple[bytes, bytes]:
        """The ids of chunks that stand one after another, and the bytes they stand for."""
        known, backs = self.chunks, self.backs
        missing = set(chunks).difference(known)
        for c in missing:
            if c in self.old_chunks:
                known[c], backs[c] = self.old_chunks[c], self.old_backs[c]
            else:
                known[c] = found = self.of_chunk(c)
                backs[c] = self.raw(found)
        out = b"".join(map(known.__getitem__, chunks)), b"".join(map(backs.__getitem__, chunks))
        for c in missing:
            if len(c) > SHORT:
                del known[c], backs[c]
        if 3 * len(known) >= self.kept:
            self.chunks, self.old_chunks = {}, known
            self.backs, self.old_backs = {}, backs
        return out

    def of_text(self, text: str) -> tuple[bytes, bytes]:
        """All ids of a text as decimals, each followed by a comma, and the bytes they stand for."""
        out = []
        for piece in self.cut(text) if self.cut else [text]:
            if piece in self.special:
                ids = b"%d," % self.special[piece]
                out.append((ids, self.raw(ids)))
            elif "\0" in piece or not piece or self.blanks(piece):
                ids = self.of_words(piece)
                out.append((ids, self.raw(ids)))
            else:
                out.append(self.of_chunks(piece.replace(" ", "\0 ").split("\0")))
        return out[0] if len(out) == 1 else (b"".join([ids for ids, _ in out]), b"".join([back for _, back in out]))

    def encode(self, text: str) -> bytes:
        """All ids of a text as decimals, each followed by a comma."""
        return self.of_text(text)[0]

    def raw(self, ids: bytes) -> bytes:
        """The bytes that ids stand for, given as ``encode`` returns them."""
        return b"".join(map(self.decoded.__getitem__, ids[:-1].split(b","))) if ids else b""

    def decode(self, ids: bytes) -> str:
        """The text of ids given as ``encode`` returns them."""
        return self.raw(ids).decode("utf-8", "replace")


def encoder(vocabulary: str, key: str, kept: int) -> Encoder:
    return kept_in_worker(("bpe", key, kept), lambda: Encoder(vocabulary, kept))


def encoded(vocabulary: str | None = None, with_ids: bool = False, kept: int = KEPT):
    """A column function: text -> struct of counts and digests, and the ids if asked for."""
    vocabulary = read_vocabulary(vocabulary or default_vocabulary())
    key = hashlib.sha256(vocabulary.encode()).hexdigest()
    fields = "n_tokens:long,ids_sha256:string,decoded_sha256:string" + ",ids:array<int>" * with_ids
    sent = _spread(vocabulary)

    @arrow_udf(f"struct<{fields}>")
    def run(column: pa.Array) -> pa.Array:
        use = encoder(sent.value, key, kept)
        n, ids_sha, decoded_sha, ids = [], [], [], []
        for text in column:
            found, back = use.of_text(text.as_py() or "")
            n.append(found.count(b","))
            ids_sha.append(hashlib.sha256(found[:-1]).hexdigest())
            decoded_sha.append(hashlib.sha256(back.decode("utf-8", "replace").encode("utf-8")).hexdigest())
            if with_ids:
                ids.append([int(x) for x in found[:-1].split(b",")] if found else [])
        out = [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
        names = ["n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            out.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        return pa.StructArray.from_arrays(out, names)

    return run


def _spread(vocabulary: str):
    """The vocabulary as a broadcast: a file of fixed size, sent once per executor."""
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession().sparkContext.broadcast(vocabulary)


def encode(docs: DataFrame, vocabulary: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with their token ids (column ``ids``, renamed if that name is taken)."""
    name = free_name(docs, "encoded")
    found = docs.withColumn(name, encoded(vocabulary, with_ids=True)(quoted(text)))
    return found.withColumn(free_name(docs, "ids"), F.col(f"{name}.ids")).drop(name)


def digest(docs: DataFrame, vocabulary: str | None = None, kept: int = KEPT) -> DataFrame:
    found = docs.select("doc_id", encoded(vocabulary, kept=kept)("text").alias("e"))
    return found.select("doc_id", "e.n_tokens", "e.ids_sha256", "e.decoded_sha256")
