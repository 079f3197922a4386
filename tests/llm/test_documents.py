"""Operators on document tables: hand-made edge cases and brute-force versions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from playspan.llm import automaton, bpe, fertility, forest, langid, mixing, ranking, suffix
from playspan.llm.common import small_batches

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves, some in other case.
CLASHING = ("T", "z", "mix", "copy", "language", "encoded", "repeat_of", "m", "kept_id")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

WORDS = {
    "en": "the of and to in that with from this was for are not have which their would there been".split(),
    "de": "der die und das nicht von mit sich auch werden einer haben über sind wird durch oder nach".split(),
    "fr": "les des que une dans pour pas sur avec être plus cette sont mais leur nous même où".split(),
}


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "en", "e", ","]) for _ in range(n))


def made(seed=1, n=90):
    """Documents with copies, near copies, shared passages, odd texts, nulls and repeated rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        rows.append((i, prose(rng, lang, rng.choice([3, 30, 120, 300])), lang, rng.choice("abc"), 0))
    passage = prose(rng, "en", 60)
    for i in range(n, n + 12):
        rows.append((i, f"{prose(rng, 'en', 40)} {passage}\n{prose(rng, 'en', 20)}", "en", "a", 0))
    for i in range(n + 12, n + 30):
        words = rows[i % 20][1].split()
        if words and i % 3:
            words[len(words) // 2] = "changed"
        rows.append((i, " ".join(words), rows[i % 20][2], None, 0))
    odd = [None, "", " \t\n", "1234 !!", "é", "É\x85é x", "a", "A  b\n\nc", "x" * 700, "ab " * 500, "\U0001f600 " * 90]
    for i, text in enumerate(odd, n + 30):
        rows.append((i, text, None, "d" if i % 2 else None, 0))
    rows.append(rows[3])
    rows.append((None, rows[5][1], "en", "b", 0))
    rows.append((None, None, None, None, None))
    return rows


@pytest.fixture(scope="module")
def rows():
    return made()


@pytest.fixture(scope="module")
def docs(spark, rows):
    small_batches(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def held(doc_id, divisor, remainder):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % divisor == remainder


def words_of(text, lower=True):
    raw = (text or "").encode()
    return (raw.translate(LOWER) if lower else raw).split()


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- language ID


def test_language(docs, rows, none):
    found = langid.digest(docs).collect()
    assert len(found) == len(rows)
    lang = {r[0]: r[2] for r in rows}
    right = [r.lang_pred == lang[r.doc_id] for r in found if r.doc_id is not None and r.doc_id < 90]
    assert sum(right) >= 0.95 * len(right)
    text = {r[0]: r[1] for r in rows}
    for r in found:
        assert 0 <= r.score <= 1 and r.held_out == held(r.doc_id, 4, 2)
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text[r.doc_id] or ""))
            assert r.rejected or r.lang_pred != "und"
    assert langid.digest(none).count() == 0


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, lang, rng.choice([2, 5, 12, 30, 80, 200, 600])), lang, "a", 0) for i in range(250) for lang in WORDS]
    return langid.fit(spark.createDataFrame(rows, SCHEMA).repartition(4))


@pytest.mark.parametrize("n", [40, 150, 600, 3000, 20_000])
def test_language_rejects_junk_and_unseen_scripts(spark, model, n):
    rng = random.Random(n)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(n)) for _ in range(4)]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for _ in range(4)]
    good = [prose(rng, lang, max(4, n // 6)) for lang in WORDS]
    df = spark.createDataFrame([(t,) for t in texts + good], "text string").coalesce(1)
    found = [r.p.rejected for r in df.select(langid.predict(model)("text").alias("p")).collect()]
    assert found == [True] * len(texts) + [False] * len(good)


def test_language_of_short_unseen_scripts(spark, model):
    df = spark.createDataFrame([("漢",), ("漢字かな交",), ("",), (None,)], "text string").coalesce(1)
    assert all(r.p.rejected for r in df.select(langid.predict(model)("text").alias("p")).collect())


def test_language_draws_equal_rows_one_by_one(spark):
    rows = [(i, "the same text in each of them", "en", "a", 0) for i in range(60)]
    fitted = langid.fit(spark.createDataFrame(rows, SCHEMA).repartition(5), sample_rows=5)
    assert fitted.languages == ["en"]


def test_language_limits_of_thin_bands():
    counts = langid.np.zeros((langid.BANDS, 1001), int)
    counts[5, 400], counts[6, 500], counts[9, 800] = 1000, 10, 1
    least = langid.limits(counts)
    assert least[5] == pytest.approx(0.36) and least[6] == pytest.approx(0.36) and least[9] == pytest.approx(0.36)
    assert (langid.limits(counts * 0) == 0).all()


def test_language_without_labels(spark):
    df = spark.createDataFrame([(1, "some text", None, "a", 0)], SCHEMA)
    (r,) = langid.digest(df).collect()
    assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)


def test_language_keeps_columns(spark, docs, rows):
    clashing = docs.selectExpr("*", *(f"1 AS {c}" for c in CLASHING))
    kept = langid.keep_identified(clashing)
    assert kept.columns == clashing.columns
    texts = [r.text for r in kept.collect()]
    assert None not in texts and "1234 !!" not in texts
    assert sum(1 for r in rows if r[1] and len(r[1]) > 40 and r[0] is not None and r[0] < 120) <= len(texts)


# ---------------------------------------------------------------- fertility and ranking


def base_counts(text):
    words = words_of(text, lower=False)
    lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    n = len(words)
    return (
        n, sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n,
    )


def test_fertility(docs, rows, none):
    found = fertility.digest(docs).collect()
    text = {r[0]: r[1] for r in rows if r[0] is not None}
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None:
            want = base_counts(text[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
            assert not (r.kept and r.base_failed)
        assert 0 <= r.byte_share <= 1 and 0 <= r.entropy_share <= 1.0001
    assert fertility.digest(none).count() == 0


def test_fertility_bands(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, "en", 100), "en", "a", 0) for i in range(80)]
    rows += [(100 + i, " ".join(w + "%%%" for w in prose(rng, "en", 60).split()), "en", "a", 0) for i in range(2)]
    rows += [(200, "\U0001f9ff\U0001fa90 " * 25 + prose(rng, "en", 40), "en", "a", 0)]
    kept = {r.doc_id: r.kept for r in fertility.digest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(kept[i] for i in range(80)) >= 78 and not kept[100] and not kept[101]


@pytest.mark.parametrize("others", [5, 47, 60])
def test_fertility_judges_small_groups(spark, others):
    """The same text is judged alike beside few and many texts of its language."""
    rng = random.Random(6)
    rows = [(i, prose(rng, "en", 100), "en", "a", 0) for i in range(90)]
    rows += [(1000 + i, prose(rng, "fr", 100), "fr", "a", 0) for i in range(others)]
    rows += [(5000, " ".join(w + "%%%" for w in prose(rng, "fr", 60).split()), "fr", "a", 0)]
    kept = {r.doc_id: r.kept for r in fertility.digest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not kept[5000] and sum(kept.values()) >= len(rows) - 4


def test_ranking(spark, docs, none):
    rng = random.Random(6)
    rows = [
        (i, prose(rng, "en", 80) if i % 3 else " | ".join(prose(rng, "en", 60).upper().split()), "en", "a", 0)
        for i in range(150)
    ] + [(999, None, None, None, None), (1000, "", "en", "a", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0), 0) for i in range(150)] + [(3, None, 0), (None, 1, 0), (4, 7, 1)],
        "doc_id long, quality int, toxic int",
    )
    found = {r.doc_id: r for r in ranking.digest(df, labels).collect()}
    assert len(found) == len(rows)
    right = [r.predicted == int(i % 3 > 0) for i, r in found.items() if i < 150 and r.held_out]
    assert len(right) > 10 and sum(right) >= 0.9 * len(right)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())
    assert ranking.digest(none, labels).count() == 0
    unlabelled = ranking.digest(docs, labels.limit(0)).collect()
    assert {round(r.score, 9) for r in unlabelled} == {0.3}


def test_every_labelled_row_teaches(spark):
    import numpy as np

    n, rng = 50_000, np.random.default_rng(2)
    labelled = spark.range(n).selectExpr(
        "id AS doc_id", f"transform(sequence(1, {ranking.N_FEATURES}), i -> double(id * i % 101)) AS x", "int(id % 5 > 0) AS quality"
    )
    sizes = ranking.groups_of(labelled, 40_000, 10_000).selectExpr("size(good) AS good", "size(bad) AS bad").toPandas()
    assert sizes.good.sum() == 40_000 and sizes.bad.sum() >= 40_000
    assert sizes.good.max() < 4 * ranking.MEET and sizes.bad.max() < 4 * ranking.MEET
    assert set(ranking.groups_of(labelled.where("doc_id < 10"), 8, 2).select("good", "bad").first()[1][0]) <= set(range(101))
    for values in (rng.normal(size=9_000), np.repeat([1.0, 2.0], [10, 30]), np.array([3.0])):
        df = spark.createDataFrame([(float(v),) for v in values], "s double")
        for share in (0.0, 0.137, 0.25, 0.5, 1.0):
            assert ranking.quantile(df, "s", share) == pytest.approx(np.quantile(values, share), abs=1e-12)


# ---------------------------------------------------------------- near-duplicates


def components_of(rows, n):
    sets = {}
    for doc_id, text, *_ in rows:
        w = words_of(text)
        s = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
        sets.setdefault(doc_id, s)
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(i for i in sets if i is not None)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                a1, b1 = top(a), top(b)
                up[max(a1, b1)] = min(a1, b1)
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_forest(docs, rows, none):
    want = components_of(rows, 4)
    found = forest.digest(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)
        else:
            assert r.kept
    assert sum(c != i for i, (_, c) in want.items()) >= 10
    assert forest.digest(none).count() == 0


def test_forest_dense_regions(spark, monkeypatch):
    """Many near copies of one text, in regions cut down to the full depth."""
    monkeypatch.setattr(forest, "REGION", 8)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):
        own = list(words)
        own[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(own), "en", "a", 0))
    rows += [(200 + i, " ".join(f"y{i}-{k}" for k in range(50)), "en", "a", 0) for i in range(20)]
    found = {r.doc_id: r.component_id for r in forest.digest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {found[i] for i in range(120)} == {0} and all(found[i] == i for i in range(200, 220))


def test_forest_parts_of_one_path(spark, monkeypatch):
    """More than REGION copies of one body with own text at the end: most have equal full paths."""
    monkeypatch.setattr(forest, "REGION", 60)
    body = " ".join(f"w{i}" for i in range(400))
    rows = [(i, f"{body} " + " ".join(f"x{i}-{k}" for k in range(5)), "en", "a", 0) for i in range(120)]
    found = forest.digest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component_id for r in found} == {0} and sum(r.kept for r in found) == 1


def test_forest_many_of_one_template(spark, monkeypatch):
    """One pair at 80.3 % among documents at 77.8 % with each other, more than the neighbours reach."""
    monkeypatch.setattr(forest, "NEIGHBOURS", 1)
    body = " ".join(f"w{i}" for i in range(283))
    rows = [(i, f"{body} " + " ".join(f"x{i}-{k}" for k in range(40)), "en", "a", 0) for i in range(300)]
    pairs = [(17, 240), (3, 99), (150, 151), (60, 299)]
    for a, b in pairs:
        own = [f"x{a}-{k}" if k < 5 else f"x{b}-{k}" for k in range(40)]
        rows[b] = (b, f"{body} " + " ".join(own), "en", "a", 0)
    found = {r.doc_id: r.component_id for r in forest.digest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {i: dict((b, a) for a, b in pairs).get(i, i) for i in range(300)}


def test_forest_keeps_one_each(docs, rows):
    kept = forest.keep_one_each(docs.selectExpr("*", *(f"1 AS {c}" for c in CLASHING)))
    assert kept.columns == [*SCHEMA.replace(",", " ").split()[::2], *CLASHING]
    ids = [r.doc_id for r in kept.collect()]
    firsts = {c for _, c in components_of(rows, 5).values()}
    # one null id has no text; the other row is a copy of one with an id
    assert sorted(i for i in ids if i is not None) == sorted(firsts) and ids.count(None) == 1


# ---------------------------------------------------------------- repeated passages


def removed_of(texts, length):
    starts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if starts[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        left = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("most", [suffix.MOST_PIECES, 2])
def test_suffixes(docs, rows, none, monkeypatch, most):
    monkeypatch.setattr(suffix, "MOST_PIECES", most)
    want = sorted(zip((r[0] for r in rows), *zip(*removed_of([(r[1] or "").encode() for r in rows], 200))), key=repr)
    assert by_id(suffix.digest(docs)) == want
    assert sum(w[2] for w in want) > 1000
    assert suffix.digest(none).count() == 0


def test_strings_that_differ_in_few_regular_places(spark, monkeypatch):
    """Two bytes, 8 apart: sums and products of 8-byte words are equal for some pairs."""
    monkeypatch.setattr(suffix, "MOST_PIECES", 2)
    line = "The quick brown fox jumps over the lazy dog while nobody looks at it, as was said. "
    texts = [f"{line}{chr(97 + i % 26)}bcdefgh{chr(97 + i // 26)}jklmnop{line}{line}" for i in range(26 * 26)]
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], SCHEMA)
    want = sorted(zip(range(len(texts)), *zip(*removed_of([t.encode() for t in texts], 200))), key=repr)
    assert by_id(suffix.digest(df)) == want


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array_and_pieces(seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    for n in (0, 1, 2, 3, 4, 7, 50, 333):
        s = rng.integers(1, 4, n)
        assert suffix.suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())
    texts = [bytes(rng.integers(97, 99, rng.integers(0, 90)).astype(np.uint8)) for _ in range(30)]
    of, first, number, _, _ = suffix.cut(texts, 16, 8)
    got = sorted((o, f + k) for o, f, m in zip(of.tolist(), first.tolist(), number.tolist()) for k in range(m))
    assert got == [(i, k) for i, t in enumerate(texts) for k in range(len(t) - 15)]
    whole = [t for t in texts if len(t) >= 16]
    starts = Counter(t[i : i + 16] for t in whole for i in range(len(t) - 15))
    for t, mask in zip(whole, suffix.repeated_starts(whole, 16)):
        assert mask.tolist() == [starts[t[i : i + 16]] > 1 for i in range(len(t) - 15)]


def test_very_long_text(spark):
    import numpy as np

    raw = np.random.default_rng(3).integers(97, 123, 700_000).astype(np.uint8)
    raw[::6] = 32
    raw[500_000:500_600] = raw[100:700]
    text = raw.tobytes().decode()
    df = spark.createDataFrame([(1, text, "en", "a", 0)], SCHEMA)
    ((_, n, gone, spans, sha),) = by_id(suffix.digest(df))
    left = text[:100] + text[700:500_000] + text[500_600:]
    assert (n, gone, spans, sha) == (len(text), 1200, 2, hashlib.sha256(left.encode()).hexdigest())
    (r,) = automaton.digest(df).collect()
    assert r.n_tokens == len(text.split()) + 1


def test_removed_texts(docs, rows):
    cut = suffix.remove_repeats(docs.selectExpr("*", *(f"1 AS {c}" for c in CLASHING)))
    assert cut.columns[-len(CLASHING) :] == list(CLASHING)
    got = Counter(len(r.text.encode()) for r in cut.collect())
    want = Counter(n - gone for n, gone, *_ in removed_of([(r[1] or "").encode() for r in rows], 200))
    assert sum((got - want).values()) <= 3  # characters that were cut


# ---------------------------------------------------------------- mixing


def test_mix_of_many_equal_rows(spark):
    rows = [(1, "word", "en", "a", 0)] * 1000 + [(2, "one two three", "en", "b", 0)]
    found = mixing.digest(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    taken = sum(r.taken for r in found if r.doc_id == 1)
    (target,) = {r.target for r in found if r.doc_id == 1}
    assert abs(taken - target) < 80 and all(r.taken <= 2 * r.size for r in found)


def test_forest_groups_null_ids(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(None, text, "en", "a", 0)] * 3 + [(None, text + " more", "en", "a", 0), (4, text, "en", "b", 0)]
    rows += [(None, " ".join(f"other{i}" for i in range(60)), "en", "a", 0)] * 2
    kept = forest.keep_one_each(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted((r.doc_id or 0, r.text[:5]) for r in kept) == [(0, "other"), (4, "word0")]


def test_targets():
    got = mixing.targets({"a": 100, "b": 100, "c": 100, None: 10})
    assert got[None] == 20.0 and got["a"] == 200.0
    assert math.isclose(sum(got.values()), 465) and math.isclose(got["b"], 2 * got["c"])
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0.0}


def test_mix(docs, rows, none):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    goal = mixing.targets(dict(sizes))
    found = mixing.digest(docs).collect()
    assert len(found) == len(rows) and by_id(mixing.digest(docs.repartition(5))) == sorted(map(tuple, found), key=repr)
    taken = Counter()
    source = {r[0]: r[3] for r in rows if r[0] is not None}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        if r.doc_id is not None:
            assert (r.source_size, r.target) == (sizes[source[r.doc_id]], goal[source[r.doc_id]])
            taken[source[r.doc_id]] += r.taken
    for s in ("a", "c", "d"):
        # repeated rows at the cut share what is left by whole words
        assert goal[s] - 3 <= taken[s] <= goal[s]
    mixed = mixing.mix(docs.selectExpr("*", *(f"1 AS {c}" for c in CLASHING)))
    assert mixed.columns[-len(CLASHING) :] == list(CLASHING)
    assert sum(len(words_of(r.text)) for r in mixed.collect()) == sum(r.taken for r in found)
    assert mixing.digest(none).count() == 0 and mixing.mix(none).count() == 0


# ---------------------------------------------------------------- BPE


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(bpe.default_vocabulary())


ODD_TEXTS = [
    "", " ", "  a  b ", "a\n b", "it's we'LL they'd", "x<|endoftext|> y <|endoftext|>", "1234567 ٣٤ ½", "naïve café x",
    "a\0b \0 c", "ab" * 300, "é" * 200, "=" * 90 + " end", "　全角　空白", "\U0001f468‍\U0001f469 zwj", "tab\t\tend\r\n",
]


def test_bpe_words(library):
    use = bpe.Encoder(bpe.read_vocabulary(bpe.default_vocabulary()))
    rng = random.Random(2)
    more = ["".join(rng.choice("abé \n'.,0xX<|>-") for _ in range(rng.randrange(60))) for _ in range(300)]
    for text in ODD_TEXTS + more:
        want = library.encode(text, add_special_tokens=False).ids
        ids = use.encode(text)
        assert [int(i) for i in ids.split(b",") if i] == want
        assert use.decode(ids) == library.decode(want, skip_special_tokens=False)
    for word in more[:80]:
        raw = word.replace(" ", "").encode() * 3
        assert use._scan(raw) == use._heap(raw)


def test_bpe_chunks_met_before(library, monkeypatch):
    text = "the naïve, cat's (end). ɐb x-y Straße!! 9% the'll " * 40 + "q" * 300 + " the"
    want = library.encode(text, add_special_tokens=False).ids
    for kept in (3, 30, bpe.KEPT):  # caches that are full after some chunks, and ones that never are
        use, decoded = bpe.Encoder(bpe.read_vocabulary(bpe.default_vocabulary()), kept), []
        monkeypatch.setattr(use, "raw", lambda ids, raw=use.raw: decoded.append(ids) or raw(ids))
        for _ in range(3):
            ids, back = use.of_text(text)
            assert [int(i) for i in ids.split(b",") if i] == want and back == text.encode()
    assert len(decoded) <= len(set(text.split(" "))) + 6  # each chunk once, long ones each time


def test_bpe(docs, rows, none, library):
    want = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        want.append((r[0], len(ids), *sha))
    assert by_id(bpe.digest(docs)) == sorted(want, key=repr)
    encoded = bpe.encode(docs.selectExpr("*", "1 AS ids", "2 AS encoded"))
    assert encoded.columns[-1] == "ids_" and {len(r["ids_"]) for r in encoded.collect()} == {w[1] for w in want}
    assert bpe.digest(none).count() == 0


# ---------------------------------------------------------------- language model


def test_automaton(docs, rows, none):
    texts = [(r[0], [*words_of(r[1]), 0]) for r in rows]
    learn = [w for i, w in texts if i is not None and not held(i, 10, 0)]
    c = Counter(x for w in learn for x in w)
    pairs = Counter(p for w in learn for p in zip([1, *w], w))
    before = Counter(x for w in learn for x in [1, *w[:-1]])
    n, v = sum(c.values()), len(c)
    mass = Counter()
    for (h, _), k in pairs.items():
        if k >= automaton.LEAST:
            mass[h] += k - automaton.DISCOUNT
    low = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))

    def p(h, w):
        left = max(1 - mass[h] / before[h], 1e-12) if before[h] else 1
        seen = pairs[h, w]
        return (seen - automaton.DISCOUNT) / before[h] + left * low(w) if seen >= automaton.LEAST else left * low(w)

    for h in list(before)[:20]:  # every state's distribution sums to 1, with one unknown token
        assert math.isclose(sum(p(h, w) for w in c) + p(h, None), 1, rel_tol=1e-9)
    want = Counter()
    for i, w in texts:
        base, score = sum(math.log10(low(x)) for x in w), sum(math.log10(p(h, x)) for h, x in zip([1, *w], w))
        want[i, held(i, 10, 0), len(w), sum(c[x] > 0 for x in w), n, round(base, 5), round(score, 5)] += 1
    got = Counter((*r[:5], round(r[5], 5), round(r[6], 5)) for r in by_id(automaton.digest(docs)))
    assert got == want
    assert automaton.digest(none).count() == 0


def test_automaton_blocks_and_hot_words(spark, docs, monkeypatch):
    whole = by_id(automaton.digest(docs))
    monkeypatch.setattr(automaton, "BLOCK", 7)
    monkeypatch.setattr(automaton, "HOT_SHARE", 40)
    parts = by_id(automaton.digest(docs))
    assert [r[:5] for r in parts] == [r[:5] for r in whole]
    assert all(math.isclose(a[6], b[6], rel_tol=1e-9) for a, b in zip(parts, whole))


def test_automaton_many_runs_and_buckets(spark, docs, monkeypatch):
    """A block that is cut by bytes, and more buckets than pairs in a run."""
    whole = by_id(automaton.digest(docs))
    monkeypatch.setattr(automaton, "RUN", 2000)
    monkeypatch.setattr(automaton, "BUCKET", 100)
    parts = by_id(automaton.digest(docs))
    assert [r[:5] for r in parts] == [r[:5] for r in whole]
    assert all(math.isclose(a[6], b[6], rel_tol=1e-9) for a, b in zip(parts, whole))


def test_automaton_strides_carry_the_state(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abcdef"), n)).encode() for n in (0, 9, 1, 30, 0, 4)]
    _, h, w, c = automaton._pairs(texts, np.ones(len(texts), bool), 3, np.zeros(0, np.uint64))
    words, at = np.unique(h, return_inverse=True)
    times, kinds = np.bincount(at, c).astype(int), np.bincount(at)
    arcs = automaton.mix(h, w)
    order = np.argsort(arcs)
    model = automaton.Automaton(words, times, times - kinds * 0.25, arcs[order], c[order], 50, 7, len(texts))
    tokens, first, n = automaton._tokens(texts)
    whole = model.walk(tokens, first, n)
    for stride in (1, 2, 7):
        monkeypatch.setattr(automaton, "STRIDE", stride)
        assert all(np.allclose(a, b, rtol=1e-12) for a, b in zip(whole, model.walk(tokens, first, n)))


def test_automaton_pairs_seen_once(spark):
    """A context whose pairs are all single has a state: all pairs of the only training text."""
    taught = next(i for i in range(100) if not held(i, 10, 0))
    (r,) = automaton.digest(spark.createDataFrame([(taught, "a b c", "en", "a", 0)], SCHEMA)).collect()
    low = (1 + 0.1) / (4 + 0.1 * 5)
    each = (1 - automaton.DISCOUNT) + automaton.DISCOUNT * low
    assert math.isclose(r.score, 4 * math.log10(each), rel_tol=1e-9)
    assert math.isclose(r.base_score, 4 * math.log10(low), rel_tol=1e-9)


def test_automaton_knows_nothing(spark):
    df = spark.createDataFrame([(None, "a b", "en", "a", 0)], SCHEMA)
    (r,) = automaton.digest(df).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (3, 0, 0, False)
    assert r.score == r.base_score == 0.0  # N = V = 0: all mass on the unknown token
