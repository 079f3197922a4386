"""Lexical search, exact dedup and tokenizer alignment, against plain versions of them."""

import hashlib
import math
import os
import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest

from playspan.llm import alignment, bestposition, bloom
from playspan.llm.common import small_batches

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from test_documents import CLASHING, LOWER, SCHEMA, made  # noqa: E402

ODD = [
    "<|endoftext|> and <s> [INST] <unk>", "two  blanks", " lead", "trail ", "a\tb\r\nc", "naïve café — “quoted”",
    "漢字かな交じり文です。" * 5, "é combining", " nbsp  em", "x" * 3000, "ﬁ ligature ①", "🤦🏼‍♂️👍", "▁ bar", "0" * 50,
]


@pytest.fixture(scope="module")
def rows():
    return made(7) + [(1000 + i, t, "en", "a", 0) for i, t in enumerate(ODD)] + [(None, ODD[0], None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    small_batches(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- exact dedup


def kept_of(rows):
    """(doc_id, keep_id, group_size, kept, sha) of each row."""
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        text = r[1] or ""
        groups[re.sub(r"[\x20\x09-\x0D]", "", text)].append((-len(text), r[0] is None, r[0], i))
    out = []
    for bare, members in groups.items():
        first = min(members, key=lambda m: (m[0], m[1], m[2] or 0, m[3]))
        sha = hashlib.sha256(bare.encode()).hexdigest()
        out += [(m[2], first[2], len(members), m[3] == first[3], sha) for m in members]
    return sorted(out, key=repr)


def spaced(rows):
    """With copies that differ in blanks, alike in length or not."""
    more = [(500 + i, (r[1] or "").replace(" ", "\n" if i % 2 else "  "), *r[2:]) for i, r in enumerate(rows[:20])]
    return rows + more + [rows[4], rows[4], (None, rows[4][1], None, None, None)]


@pytest.mark.parametrize("most_blocks, few", [(1 << 16, 10_000), (1, 10_000), (3, 3)])
def test_bloom(spark, rows, monkeypatch, most_blocks, few):
    """Also with filters in several rounds and with hot groups."""
    monkeypatch.setattr(bloom, "MOST_BLOCKS", most_blocks)
    monkeypatch.setattr(bloom, "FEW_GROUPS", few)
    monkeypatch.setattr(bloom, "BITS", 16 if most_blocks > 3 else 400)
    all_rows = spaced(rows)
    df = spark.createDataFrame(all_rows, SCHEMA).repartition(4)
    assert sorted_rows(bloom.digest(df)) == kept_of(all_rows)


def test_bloom_hot_group(spark):
    rows = [(i, "the same text" if i % 2 else f"text {i}", None, None, None) for i in range(4000)]
    found = bloom.digest(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert sorted_rows(found) == kept_of(rows)


def test_bloom_tells_lone_rows_apart(spark):
    """Nearly all rows without a copy pass straight; all with a copy are found."""
    n, copies = 20_000, 500
    rows = spark.range(n + copies).selectExpr(f"xxhash64(id % {n}) z", "0L block")
    rows = rows.selectExpr("z", f"shiftright(shiftrightunsigned(xxhash64(z), 33) * {n * 16 // bloom.PLACES}, 31) m")
    filter_ = bloom.repeated_places(rows.selectExpr("m AS block", "z"))
    found = bloom._tested(rows, filter_, "m", "z").groupBy("m").count().collect()
    flagged = {r.m: r["count"] for r in found}
    assert 2 * copies <= flagged[True] <= 2 * copies + n // 100


def test_bloom_keeps_columns(spark, docs, rows, none):
    clashing = docs.selectExpr("*", *(f"1 AS {c}" for c in (*CLASHING, "mark", "row", "SHA", "u", "maybe", "words", "block", "g", "size", "first")))
    kept = bloom.keep_one_each(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == len({re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in rows})
    assert bloom.digest(none).count() == 0 and bloom.keep_one_each(none).count() == 0


# ---------------------------------------------------------------- lexical search


def terms(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().translate(LOWER))


def ranking_of(rows, items, k=20):
    texts = [(r[0], terms(r[1])) for r in rows]
    texts = [(i, t) for i, t in texts if t]
    n_docs, n_terms = len(texts), sum(len(t) for _, t in texts)
    df = Counter(w for _, t in texts for w in set(t))
    out = []
    for item, text in items:
        scored = []
        for i, t in texts:
            tf, score = Counter(t), 0
            m = 75 + 25 * len(t) * n_docs // n_terms
            for w in terms(text):
                if tf[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += weight * (1_000_000_000 * tf[w] // (1000 * tf[w] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, n, None if no else i, -s) for n, (s, no, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, group, k", [(8192, 200_000, 20), (7, 40, 3), (40, 200_000, 1)])
def test_best_positions(spark, rows, monkeypatch, block, group, k):
    """Also with many blocks in a task, items in several groups, and ties at the last rank."""
    monkeypatch.setattr(bestposition, "BLOCK_ROWS", block)
    monkeypatch.setattr(bestposition, "GROUP", group)
    rng = random.Random(3)
    items = [(i, " ".join(rng.choices((rng.choice(rows)[1] or "?").split() or ["?"], k=rng.randint(1, 30)))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "nowhere zzzz"), (103, "THE the The of"), (103, "THE the The of"), (None, "und nicht das")]
    rows = rows + [(2000 + i, "equal score in each", "en", "a", 0) for i in range(60)] + [(2000, "equal score in each", None, None, None)]
    items.append((104, "equal score"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 AS id", "2 AS item", "3 AS terms")
    found = bestposition.search(bestposition.index(df), spark.createDataFrame(items, "item_id long, text string"), k=k)
    assert sorted_rows(found) == ranking_of(rows, items, k)


def test_best_positions_stop_early(spark, monkeypatch):
    """A block is left once nothing unseen can come up to the k-th score."""
    looked = []
    searchsorted = np.searchsorted
    monkeypatch.setattr(bestposition.np, "searchsorted", lambda a, v, *o, **k: looked.append(np.size(v)) or searchsorted(a, v, *o, **k))
    rng = random.Random(5)
    ids = list(range(4000))
    texts = [" ".join(["rare"] * (i < 30) + rng.choices(["and", "or", "but", "not"], k=20)).encode() for i in ids]
    import pyarrow as pa

    (block,) = bestposition._blocks(iter([pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts).cast(pa.string())], ["id", "text"])]))
    asked = {"rare": 4000, "and": 3, "or": 3}
    looked.clear()
    scores, docs = bestposition.Block(block, set(asked), 4000, 80_000).best(asked, 5, 0)
    assert len(scores) >= 5 and set(docs.tolist()) <= set(range(30))
    assert sum(looked) < 3 * 1000


def test_best_positions_empty(spark, docs, none):
    items = spark.createDataFrame([(1, "the"), (2, "of")], "item_id long, text string")
    assert bestposition.digest(none, items).count() == 0
    assert bestposition.digest(docs, items.limit(0)).count() == 0


# ---------------------------------------------------------------- alignment


def aligned(rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = alignment._shown_bytes()

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes.fromhex(piece[3:5]) if re.fullmatch("<0x..>", piece) else piece.replace("▁", " ").encode()

    def spans(ids, raw):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(raw(i))))
            at += len(raw(i))
        return out

    texts = []
    for r in rows:
        text, none = r[1], (r[0], [], [], [], [])
        if not text:
            texts.append(none)
            continue
        ids = a.encode(" " + text, add_special_tokens=False).ids
        a_bytes = lambda i: bytes(shown[c] for c in a.id_to_token(i))
        other, raw = b.encode(text), (" " + text).encode()
        if b"".join(map(a_bytes, ids)) != raw or b"".join(map(b_bytes, other)) != raw:
            texts.append(none)
            continue
        sa, sb = spans(ids, a_bytes), spans(other, b_bytes)
        links, j = [], 0
        for i, (lo, hi) in zip(ids, sa):
            while sb[j][1] <= lo:
                j += 1
            at = j
            while at < len(sb) and sb[at][0] < hi:
                links.append((i, other[at]))
                at += 1
        ends = {x for _, x in sa} & {x for _, x in sb}
        groups = []
        for end in sorted(ends):
            groups.append(([i for i, s in zip(ids, sa) if s[1] <= end], [i for i, s in zip(other, sb) if s[1] <= end]))
        groups = [(g[0][len(p[0]):], g[1][len(p[1]):]) for p, g in zip([([], []), *groups], groups)]
        texts.append((r[0], ids, other, groups, links))
    held = Counter(p for t in texts for p in set(t[4]))
    highest = defaultdict(int)
    for (i, _), n in held.items():
        highest[i] = max(highest[i], n)
    out = []
    for doc_id, ids, other, groups, links in texts:
        written = ";".join("|".join(",".join(map(str, x)) for x in g) for g in groups)
        out.append((
            doc_id, len(ids), len(other), len(groups), len(links), sum(held[p] == highest[p[0]] for p in links),
            sum(held[p] for p in links), hashlib.sha256(written.encode()).hexdigest() if written else "",
        ))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_rows, chunk", [(8192, 1 << 20), (11, 2000)])
def test_alignment(docs, rows, none, monkeypatch, block_rows, chunk):
    monkeypatch.setattr(alignment, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    found = alignment.digest(docs.selectExpr("*", "1 AS block", "2 AS pairs", "3 AS id"))
    assert sorted_rows(found) == aligned(rows)
    assert alignment.digest(none).count() == 0


def test_products():
    rng = np.random.default_rng(2)
    for _ in range(30):
        a, b = rng.integers(0, 3, (7, 9)) * (rng.random((7, 9)) < 0.4), rng.integers(0, 3, (9, 5)) * (rng.random((9, 5)) < 0.4)

        def sparse(m):
            return alignment.Rows(np.concatenate([[0], np.cumsum((m != 0).sum(1))]), np.nonzero(m)[1], m[m != 0])

        def dense(s, shape):
            out = np.zeros(shape, np.int64)
            out[np.repeat(np.arange(shape[0]), np.diff(s.starts)), s.columns] = s.values
            return out

        assert (dense(sparse(a).times(sparse(b)), (7, 5)) == a @ b).all()
        assert (dense(sparse(a).transposed(9), (9, 7)) == a.T).all()
        v = rng.integers(0, 100, 9)
        assert (sparse(a).dot(v) == a @ v).all()


def test_links_and_groups():
    with open(alignment.default_vocabulary(), encoding="utf-8") as f, open(alignment.default_pieces(), "rb") as g:
        use = alignment.Pair(f.read(), g.read())
    texts = ["unbelievable naïve tokenization", "漢字", "", "plain words here"]
    found = use.align(texts)
    assert found.links.values.sum() == sum(len((" " + t).encode()) for t in texts if t)  # each byte is in one link
    whole = alignment.Rows.of_labels(found.a_group).times(alignment.Rows.of_labels(found.b_group).transposed(found.n_all_groups))
    assert (np.diff(whole.starts) == found.shared()).all()
    assert (found.shared() >= np.diff(found.links.starts)).all()


def test_very_long_text(spark):
    """A text far above the size of a block, without a blank, stays whole."""
    text = "abcdefgh" * 150_000
    df = spark.createDataFrame([(1, text), (2, "abcdefgh"), (3, " " * 30_000)], "doc_id long, text string")
    found = {r.doc_id: r for r in alignment.digest(df).collect()}
    assert found[1].n_a > 150_000 and found[1].n_links >= found[1].n_a
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert [(r.doc_id, r.rank) for r in bestposition.digest(df, items).collect()] == [(1, 1)]
    assert all(r.group_size == 1 for r in bloom.digest(df).collect())
