"""Near-duplicates by an LSH forest of MinHash signatures, confirmed on full shingle sets.

Documents with equal shingle sets are one class from the start, so thousands of copies cost
one row each. Each class has ``TREES`` signatures of ``DEPTH`` minhashes. In every tree the
classes stand in the sorted order of their signature, and those next to each other with a
common prefix of ``LEAST_DEPTH`` values or more are candidates, ``NEIGHBOURS`` to each side.
A region (a common prefix) with more than ``REGION`` classes is cut by one value more, again
and again to the full depth: depth adapts to how dense a region is. Classes with one full path
are dealt into parts by a hash beyond that, so no region becomes one task's unbounded group;
the first class of each part is a candidate with the first of the path, so parts stay joined.

Pairs whose full signatures agree in fewer than ``LEAST_EQUAL`` values are dropped (a pair at
the threshold falls below with a chance of 2e-6). Links are confirmed by the exact Jaccard
similarity of the full sets: first the best partner to either side of each class, then,
within what is still apart, all other candidates. Components are the connected components
of the confirmed links.

Regions (of ``LEAST_DEPTH`` values) with more classes than the neighbours reach are crowded.
The classes of those that are not one component by then are joined exactly: by the shingles
of their prefixes, rare ones first, every pair that can reach the similarity is confirmed.
So a pair is missed only if no tree has both in one region: 0.36 ** 16 at the threshold.

Words: runs without ASCII white space, A-Z lower-cased. A document's set: its distinct
n-word shingles; with fewer words the whole sequence; none for a null, empty or blank text,
which is linked with nothing and kept. Rows with a null id take part under the other ids
of their class and stand alone in their own. Repeated rows share a class; rows with one id
and different texts count as one document, linked by the id. Very long texts are read whole.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import IntegerType

from playspan.llm.common import U, free_name, mix, packed, quoted, slices, texts_of, unpacked
from playspan.llm.components import components
from playspan.llm.words import Batch
from playspan.session import stage

SHINGLE = 5
SIMILAR = 80  # per cent
TREES = 16
DEPTH = 6
LEAST_DEPTH = 2
NEIGHBOURS = 3
REGION = 512
LEAST_EQUAL = 58  # of TREES * DEPTH


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    batch = Batch(texts)
    words = batch.word_hashes()
    whole = words
    for k in range(1, n):
        whole = mix(whole[:-1], words[k:]) if len(whole) > 1 else whole[:0]
    out = []
    for a, b in zip(batch.first.tolist(), batch.last.tolist()):
        if b - a >= n:
            out.append(np.unique(whole[a : b - n + 1]))
        elif b > a:
            one = words[a : a + 1]
            for k in range(a + 1, b):
                one = mix(one, words[k : k + 1])
            out.append(one ^ U(b - a))
        else:
            out.append(words[:0])
    return out


def _multipliers() -> np.ndarray:
    return np.random.default_rng(23).integers(1, 1 << 62, TREES * DEPTH, np.uint64) * U(2) + U(1)


def minhashes(shingles: np.ndarray) -> np.ndarray:
    times = _multipliers()[:, None]
    least = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        least = np.minimum(least, (times * shingles[None, i : i + 1024]).min(axis=1))
    return (least >> U(32)).astype(">u4")


def signed(n: int):
    """A column function: text -> struct(n_shingles, key1, key2, signature)."""

    @arrow_udf("struct<n_shingles:long,key1:long,key2:long,signature:binary>")
    def run(column: pa.Array) -> pa.Array:
        sizes, one, two, signatures = [], [], [], []
        for a, b in slices(column, 1 << 18, 256):
            for s in shingle_sets(texts_of(column.slice(a, b - a)), n):
                sizes.append(len(s))
                again = mix(s, s >> U(7))
                one.append(int(again.sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                two.append(int(np.bitwise_xor.reduce(mix(again, s)).view(np.int64)) if len(s) else 0)
                signatures.append(minhashes(s).tobytes() if len(s) else None)
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(signatures, pa.binary())],
            ["n_shingles", "key1", "key2", "signature"],
        )

    return run


def similar(n: int, per_cent: int):
    """A column function: two packed texts -> whether their sets reach the similarity."""

    @arrow_udf("boolean")
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for i in range(0, len(left), 32):
            x, y = (unpacked(side.slice(i, 32)) for side in (left, right))
            for a, b in zip(shingle_sets(x, n), shingle_sets(y, n)):
                both = len(np.intersect1d(a, b, assume_unique=True))
                out.append(100 * both >= per_cent * (len(a) + len(b) - both) and both > 0)
        return pa.array(out, pa.bool_())

    return run


@arrow_udf(IntegerType())
def agreeing(left: pa.Array, right: pa.Array) -> pa.Array:
    x, y = (
        np.frombuffer(b"".join(side.to_pylist()), np.uint32).reshape(len(side), -1) for side in (left, right)
    )
    return pa.array((x == y).sum(axis=1).astype(np.int32))


def _regions(rows: DataFrame) -> DataFrame:
    """``rows`` (tree, path, id) with the region each is looked up in, and whether it is a part of one path."""
    rows = rows.withColumn("depth", F.lit(LEAST_DEPTH))
    head = lambda d: F.substring("path", 1, 4 * d)
    hot = rows
    for depth in range(LEAST_DEPTH, DEPTH + 1):
        sizes = hot.groupBy("tree", head(depth).alias("head")).agg(F.count(F.lit(1)).alias("size"))
        dense = stage(sizes.where(F.col("size") > REGION), "regions")
        if not dense.count():
            break
        last = depth == DEPTH
        dense = dense.select(
            F.col("tree").alias("d_tree"), F.col("head").alias("d_head"),
            F.lit(depth if last else depth + 1).alias("d_depth"), F.ceil(F.col("size") / REGION).alias("d_parts"),
        )
        at = (F.col("tree") == F.col("d_tree")) & (head(depth) == F.col("d_head")) & (F.col("depth") == depth)
        joined = rows.join(dense, at, "left")
        part = F.pmod(F.xxhash64("id"), F.col("d_parts")) if last else F.lit(None)
        rows = joined.select(
            "tree", "path", "id", F.coalesce("d_depth", "depth").alias("depth"),
            *([part.alias("part")] if last else []),
        )
        rows = stage(rows, "paths")
        hot = rows.where(F.col("depth") == depth + 1)
    part = F.coalesce("part", F.lit(0)) if "part" in rows.columns else F.lit(0)
    region = F.expr("substring(path, 1, 4 * depth)")
    dealt = F.col("part").isNotNull() if "part" in rows.columns else F.lit(False)
    return rows.select(
        "tree", "path", "id", F.xxhash64("depth", region, part).alias("region"), region.alias("head"), dealt.alias("dealt")
    )


def candidates(classes: DataFrame) -> DataFrame:
    """Pairs (a < b) of neighbours in the trees; ``classes`` has id and signature."""
    paths = F.array(*[F.substring("signature", 1 + 4 * DEPTH * t, 4 * DEPTH) for t in range(TREES)])
    rows = classes.select("id", F.posexplode(paths).alias("tree", "path"))
    order = Window.partitionBy("tree", "region", "head").orderBy("path", "id")
    rows = _regions(rows)
    near = rows.select(
        "id", F.array(*[F.lead("id", k).over(order) for k in range(1, NEIGHBOURS + 1)]).alias("next")
    )
    firsts = rows.where("dealt").groupBy("tree", "path", "region").agg(F.min("id").alias("id"))
    across = firsts.select("id", F.min("id").over(Window.partitionBy("tree", "path")).alias("other"))
    pairs = near.select("id", F.explode("next").alias("other")).union(across).where("other IS NOT NULL AND id <> other")
    return pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def crowded(classes: DataFrame) -> DataFrame:
    """(id, region) of the regions in which ``NEIGHBOURS`` following classes are not all pairs."""
    heads = [F.xxhash64(F.lit(t), F.substring("signature", 1 + 4 * DEPTH * t, 4 * LEAST_DEPTH)) for t in range(TREES)]
    rows = classes.select("id", F.explode(F.array(*heads)).alias("region"))
    sizes = rows.groupBy("region").agg(F.count(F.lit(1)).alias("size"))
    return rows.join(sizes.where(F.col("size") > NEIGHBOURS + 1).select("region"), "region")


def shingled(n: int):
    """A column function: packed text -> its distinct shingle hashes."""

    @arrow_udf("array<long>")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for i in range(0, len(column), 32):
            out += [s.view(np.int64) for s in shingle_sets(unpacked(column.slice(i, 32)), n)]
        ends = np.cumsum([0, *map(len, out)]).astype(np.int32)
        return pa.ListArray.from_arrays(ends, np.concatenate(out) if out else np.zeros(0, np.int64))

    return run


def exact_candidates(crowds: DataFrame, found: DataFrame, texts: DataFrame, n: int, per_cent: int) -> DataFrame:
    """All pairs (a, b) of different components in crowded regions that can reach the similarity.

    A class's shingles stand in one order for all, rare ones first. A pair has a first common
    shingle, and at most as many from there on as the one with fewer left; so the smaller
    set is found by its first ninth (at 80 %) and the larger one by its first fifth.
    """
    named = crowds.join(found, "id", "left").select("id", "region", F.coalesce("component", "id").alias("component"))
    several = named.groupBy("region").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    apart = named.join(several.select("region"), "region", "left_semi").select("id", "component").distinct()
    sets = texts.join(apart, "id").select("id", "component", shingled(n)("z").alias("s"))
    posts = stage(sets.select("id", "component", F.size("s").alias("n"), F.explode("s").alias("s")), "shingles")
    shared = posts.groupBy("s").agg(
        F.count(F.lit(1)).alias("times"), (F.min("component") != F.max("component")).alias("across")
    ).where("times > 1")
    backwards = Window.partitionBy("id").orderBy(F.desc("times"), F.desc("s"))
    ranked = posts.join(shared, "s").withColumn("left", F.row_number().over(backwards))
    reach = (100 + per_cent) * F.col("left")
    ranked = stage(ranked.where(F.col("across") & (100 * F.col("left") >= per_cent * F.col("n"))).select(
        "s", "id", "component", "n", "left"
    ), "prefixes")
    small = ranked.where(reach >= 2 * per_cent * F.col("n")).alias("p")
    pair = (
        (F.col("p.s") == F.col("q.s")) & (F.col("p.component") != F.col("q.component"))
        & (F.struct("p.n", "p.id") < F.struct("q.n", "q.id"))
        & ((100 + per_cent) * F.least("p.left", "q.left") >= per_cent * (F.col("p.n") + F.col("q.n")))
    )
    both = small.join(ranked.alias("q"), pair)
    return both.select(F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b")).distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, n: int, per_cent: int) -> DataFrame:
    a = texts.select(F.col("id").alias("a"), F.col("z").alias("za"))
    b = texts.select(F.col("id").alias("b"), F.col("z").alias("zb"))
    both = pairs.select("a", "b").join(a, "a").join(b, "b")
    return both.where(similar(n, per_cent)("za", "zb")).select("a", "b")


def link(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = SHINGLE, per_cent: int = SIMILAR) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id."""
    slim = docs.select(quoted(doc_id).alias("doc_id"), signed(n)(quoted(text)).alias("s"))
    rows = stage(slim.select("doc_id", "s.*"), "signatures")
    key = ["n_shingles", "key1", "key2"]
    classes = stage(
        rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key)
        .agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature")),
        "classes",
    )
    signatures = classes.select("id", "signature")
    pairs = candidates(signatures)
    left = signatures.select(F.col("id").alias("a"), F.col("signature").alias("sa"))
    right = signatures.select(F.col("id").alias("b"), F.col("signature").alias("sb"))
    # Not deterministic for the optimizer, which would run it in the filter and again for the column.
    equal = agreeing.asNondeterministic()("sa", "sb")
    pairs = pairs.join(left, "a").join(right, "b").select("a", "b", equal.alias("equal"))
    pairs = stage(pairs.where(F.col("equal") >= LEAST_EQUAL), "pairs")

    # Never broadcast: the candidates' texts are shuffled alike at every size.
    crowds = stage(crowded(signatures), "crowded")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).union(crowds.select("id")).distinct()
    source = docs.select(quoted(doc_id).alias("id"), packed(quoted(text)).alias("z"))
    texts = stage(source.join(ends.hint("merge"), "id").groupBy("id").agg(F.min("z").alias("z")), "texts")
    best = lambda one, other: (
        pairs.groupBy(one).agg(F.max_by(other, F.struct("equal", -F.col(other))).alias(other)).select("a", "b")
    )
    first = stage(_confirmed(best("a", "b").union(best("b", "a")).distinct(), texts, n, per_cent), "links")
    found = components(first)
    of = lambda c: found.select(F.col("id").alias(c), F.col("component").alias(f"c{c}"))
    apart = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").where(
        F.coalesce("ca", "a") != F.coalesce("cb", "b")
    )
    more = stage(_confirmed(apart, texts, n, per_cent), "links")
    links = first.union(more)
    if more.limit(1).count():
        found = components(links)
    rest = exact_candidates(crowds, found, texts, n, per_cent).join(pairs.select("a", "b"), ["a", "b"], "left_anti")
    rest = stage(_confirmed(rest, texts, n, per_cent), "links")
    if rest.limit(1).count():
        found = components(links.union(rest))
    named = stage(
        classes.select(*key, "id").join(found, "id", "left").select(
            *[F.col(k).alias(f"c_{k}") for k in key], F.coalesce("component", "id").alias("component_id")
        ),
        "named",
    )
    same = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"c_{k}") for k in key])
    return rows.join(named, same, "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id; columns unchanged.

    Of rows with one id, one stays. A row with a null id counts under a number of its text,
    above all ids in use: equal texts are one row, and rows with an id are preferred to it.
    """
    columns, own = docs.columns, quoted("doc_id")
    name, of = free_name(docs, "kept_id"), free_name(docs, "of")
    number = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(F.coalesce(quoted("text"), F.lit(""))), 2)
    docs = docs.withColumn(of, own).withColumn("doc_id", F.coalesce(own.cast("long"), number))
    linked = stage(link(docs, **options), "linked")
    keep = linked.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(name)).distinct()
    kept = docs.join(keep, F.col("doc_id") == F.col(name), "left_semi")
    repeated = linked.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL")
    repeated = stage(repeated.select(F.col("doc_id").alias(name)), "repeated")
    if repeated.limit(1).count():
        same = F.col("doc_id") == F.col(name)
        once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id"])
        kept = kept.join(repeated, same, "left_anti").unionByName(once)
    return kept.withColumn("doc_id", F.col(of)).select(*map(quoted, columns))


def digest(docs: DataFrame) -> DataFrame:
    found = link(docs.select("doc_id", "text"), n=4)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return found.withColumn("kept", kept)
