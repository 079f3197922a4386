"""Quality rules by tokeniser fertility, with rejection bands per script and length.

Two public vocabularies measure every whole text, word by word with a blank before each:
a byte-level BPE gives characters per token and the entropy of the text's tokens (as a
share of log2 of their number), a piece vocabulary with byte fallback gives the share of
characters that fall back to bytes, which are those without a piece of their own. Words met
before are kept per Python worker.

The bands are learned from all texts that pass the base rules: per group (the language
label where there is one, else the script of most letters) and length class (log2 of the
tokens) the quartiles of each measure, widened by ``REACH`` interquartile ranges
and a small slack. A text outside a band is rejected. Where fewer than
``LEAST`` texts are alike, wider bands hold: those of the whole group, of the script and
length class, of the script, of the nearest length class, at last of all texts. Entropy
depends on length, so it skips bands of all lengths. So every text is judged. The band
tables have a row per language or script and length class and are small whatever the input.
Percentiles come from mergeable sketches; nothing is sampled.

A null or empty text has no words, fails the base rules (fewer than 20 words) and is not
kept. Repeated rows and null ids are treated like other rows; an empty table gives none.
"""

from __future__ import annotations

import array
import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from playspan.llm.bpe import PATTERN
from playspan.llm.common import if_few, kept_in_worker, quoted, slices, texts_of
from playspan.llm.words import Batch, repeated_lines
from playspan.session import stage

REACH = 3.0
SLACK = 0.02
LEAST = 50
KEPT = 300_000

#: First code points of letter ranges and the script they begin.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0780, "Other"), (0x0900, "Devanagari"), (0x0980, "Indic"), (0x0E00, "Thai"),
    (0x0E80, "Other"), (0x1100, "Hangul"), (0x1200, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"),
    (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Other"), (0x20000, "Han"), (0x30000, "Other"),
)
_NAMES = sorted({name for _, name in SCRIPTS}) + ["none"]
_STARTS = np.array([start for start, _ in SCRIPTS])
_CODES = np.array([_NAMES.index(name) for _, name in SCRIPTS])


@lru_cache(maxsize=None)
def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


class Meter:
    """Token ids of words, and which characters fall back to bytes."""

    def __init__(self, ranks: bytes, pieces: bytes):
        import sentencepiece
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.tokens = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        known = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.falls_back = np.ones(0x110000, bool)
        single = [known.IdToPiece(i) for i in range(known.GetPieceSize()) if not known.IsByte(i)]
        self.falls_back[[ord(p) for p in single if len(p) == 1]] = False
        self.met, self.old = {}, {}

    def of_word(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            found = self.tokens.encode_ordinary(" " + word.decode("utf-8", "replace"))
            ids = array.array("H", found).tobytes()
        if len(self.met) >= KEPT:
            self.met, self.old = {}, self.met
        self.met[word] = ids
        return ids

    def measure(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and the number of ids of each word."""
        met = self.met
        found = [met.get(w) or self.of_word(w) for w in words]
        n = np.fromiter(map(len, found), np.int64, len(found)) >> 1
        return np.frombuffer(b"".join(found), np.uint16), n


def entropy_share(ids: np.ndarray, owner: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Entropy of each text's ids in bits, over log2 of their number; 1 for one id or none."""
    keys = np.sort(owner << 16 | ids)
    cut = np.flatnonzero(np.diff(keys, prepend=-1))
    counts = np.diff(np.append(cut, len(keys))).astype(float)
    text = keys[cut] >> 16
    p = counts / n[text]
    bits = np.bincount(text, -p * np.log2(p), len(n))
    return np.where(n > 1, bits / np.log2(np.maximum(n, 2)), 1.0)


def _characters(texts: list[str], falls_back: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Script of each text, and its number of characters that fall back to bytes."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    found = _CODES[np.searchsorted(_STARTS, codes, side="right") - 1]
    letter = (codes >= 0xAA) | ((codes | 32) - 97 < 26)
    owner = np.repeat(np.arange(len(texts)), lengths)
    k = len(_NAMES)
    counts = np.bincount((owner * k + found)[letter], minlength=len(texts) * k).reshape(len(texts), k)
    names = [_NAMES[i] if m else "none" for i, m in zip(counts.argmax(axis=1), counts.max(axis=1))]
    back = falls_back[codes] & (codes > 32)
    return names, np.bincount(owner[back], minlength=len(texts))


MEASURES = ("chars_per_token", "byte_share", "entropy_share")
_FIELDS = (
    "n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,"
    "n_tokens:long,chars_per_token:double,byte_share:double,entropy_share:double,script:string"
)


def measured(spark, vocabularies: tuple[str, str] | None = None):
    """A column function: text -> struct of the base counts and the measures."""
    paths = vocabularies or default_vocabularies()
    files = []
    for path in paths:
        with open(path, "rb") as f:
            files.append(f.read())
    sent = spark.sparkContext.broadcast(files)

    @arrow_udf(f"struct<{_FIELDS}>")
    def run(column: pa.Array) -> pa.Array:
        meter = kept_in_worker(("meter", *paths), lambda: Meter(*sent.value))
        parts = []
        for a, b in slices(column, 1 << 18, 256):
            texts = texts_of(column.slice(a, b - a))
            batch = Batch(texts)
            words = [w for t in texts for w in t.split()]
            ids, n = meter.measure(words)
            owner, chars = batch.owner, batch.word_chars()
            tokens = np.bincount(owner, n, len(texts)).astype(np.int64)
            scripts, back = _characters([t.decode("utf-8", "replace") for t in texts], meter.falls_back)
            parts.append((
                batch.n_words, chars, batch.symbols(), np.fromiter(map(repeated_lines, texts), np.int64),
                batch.repeated_window_words(batch.word_hashes(lower=False)), tokens,
                chars / np.maximum(tokens, 1), back / np.maximum(chars, 1),
                entropy_share(ids.astype(np.int64), np.repeat(owner, n), tokens), scripts,
            ))
        names = [f.split(":") for f in _FIELDS.split(",")]
        kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}
        columns = [
            pa.array(np.concatenate([p[i] for p in parts]) if parts else [], kinds[kind])
            for i, (_, kind) in enumerate(names)
        ]
        return pa.StructArray.from_arrays(columns, [name for name, _ in names])

    return run


def _bands(rows: DataFrame, keys: list[str], measures: tuple[str, ...], least: int) -> DataFrame:
    """Keys and the low and high limit of each measure, for groups with enough rows."""
    quartiles = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(m, [0.25, 0.75], 1000).alias(m) for m in measures])
        .where(F.col("n") >= least)
    )
    limits = []
    for m in measures:
        first, third = F.col(m)[0], F.col(m)[1]
        for quartile, sign in ((first, -1), (third, 1)):
            slack = SLACK * F.greatest(quartile, F.lit(1.0))
            limits.append(quartile + sign * (REACH * (third - first) + slack))
    return quartiles.select(*keys, *limits)


#: Where the bands of a text come from: the first of these with ``LEAST`` texts that passed.
LEVELS = {
    "class": ["group", "length_class"], "group": ["group"], "like": ["script", "length_class"], "script": ["script"],
    "length": ["length_class"],
}


def _nearest(bands: DataFrame, level: str) -> DataFrame:
    """Bands of all length classes: those without their own have the nearest one's."""
    rows = {r[0]: tuple(r)[1:] for r in bands.collect()}  # a row per power of two of tokens
    if not rows:
        return bands
    filled = [(c, *rows[min(rows, key=lambda x: (abs(x - c), x))]) for c in range(64)]
    return bands.sparkSession.createDataFrame(filled, bands.schema)


def judge(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str | None = None, vocabularies=None
) -> DataFrame:
    """Per row: id, base counts, measures, base_failed and kept."""
    spark = docs.sparkSession
    label = quoted(lang).cast("string") if lang else F.lit(None).cast("string")
    raw = docs.select(
        quoted(doc_id).alias("doc_id"), label.alias("label"), measured(spark, vocabularies)(quoted(text)).alias("m")
    )
    rows = stage(raw.select("doc_id", F.coalesce("label", "m.script").alias("group"), "m.*"), "fertility")
    rows = rows.withColumn(
        "base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    ).withColumn("length_class", F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).cast("int"))
    passed = rows.where("NOT base_failed")
    found = rows
    for level, keys in LEVELS.items():
        measures = MEASURES if "length_class" in keys else MEASURES[:2]
        bands = _bands(passed, keys, measures, LEAST).toDF(
            *[f"{level}_{k}" for k in keys], *[f"{level}_{m}_{side}" for m in measures for side in ("low", "high")]
        )
        bands = stage(bands, "bands")
        if keys == ["length_class"]:
            bands = _nearest(bands, level)
        same = [F.col(k) == F.col(f"{level}_{k}") for k in keys]
        found = found.join(if_few(bands, bands.count()), same, "left")
    last = _bands(passed, [], MEASURES, 1).first() or [None] * 2 * len(MEASURES)
    outside = F.lit(False)
    for i, m in enumerate(MEASURES):
        levels = [x for x, keys in LEVELS.items() if m in MEASURES[:2] or "length_class" in keys]
        low, high = (
            F.coalesce(*[F.col(f"{level}_{m}_{side}") for level in levels], F.lit(last[2 * i + j]).cast("double"))
            for j, side in enumerate(("low", "high"))
        )
        outside = outside | F.coalesce(~F.col(m).between(low, high), F.lit(False))
    return found.withColumn("kept", ~F.col("base_failed") & ~outside)


def digest(docs: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text", "lang"), lang="lang").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *MEASURES, "script",
    )
