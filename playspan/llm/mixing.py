"""Mixing sources to target weights with exact word budgets.

Every row has a hash-random key. The key space of a source is cut into equal ranges, about
the square root of its rows, so a source with a third of all rows is spread as well. Sums
of sizes per range and their prefix sums show in which range the budget ends; only the rows
of that range are sorted by key to find the row at the cut. A row is then taken by its key
alone: below the cut in full, at the cut for what is left, above it not. Whole epochs come
on top when the target is above the source's size.

Sizes are numbers of words; a null text has 0 and takes nothing. A null source is a source
of its own, last in order. Rows with one key are equal rows (key: id and text), which share
what is left at the cut evenly: each takes the whole words of its share, and one word more
with the probability of the rest, so many small equal rows come near the target together. An empty table gives an empty result. One
row per source goes to the driver: a mix is configured per source. Reruns agree, as keys
are hashes of the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from playspan.llm.common import free_name, if_few, n_words, quoted
from playspan.session import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2.0
_BITS = 31


def targets(sizes: dict[str | None, int], weights=WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> dict:
    """Target words per source: by weight, at most ``epochs`` times its size.

    The excess of sources at their limit is shared by weight among the rest, again and
    again until none is above its limit.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), list(order), {}
    while open_:
        per = left / sum(weigh[s] for s in open_)
        over = [s for s in open_ if weigh[s] * per > epochs * sizes[s]]
        if not over:
            return out | {s: weigh[s] * per for s in open_}
        for s in over:
            out[s] = epochs * float(sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def _key(id_: Column, text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(id_, text), 64 - _BITS).cast("long")


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``docs`` with a struct column appended: size, source_size, target, epochs, taken.

    ``taken`` counts words: ``epochs`` whole copies and what the cut adds.
    """
    spark = docs.sparkSession
    slim = docs.select(
        quoted(source).cast("string").alias("source"),
        _key(quoted(doc_id), quoted(text)).alias("key"),
        n_words(quoted(text)).alias("size"),
    )
    slim = stage(slim, "sizes")
    totals = slim.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    sizes = {r["source"]: r["size"] for r in totals}
    goal = targets(sizes, **options)
    rows = []
    for r in totals:
        whole = min(int(goal[r["source"]] // r["size"]), 1 << 30) if r["size"] else 0
        budget = int(math.floor(goal[r["source"]])) - whole * r["size"]
        shift = _BITS - max(0, math.ceil(math.log2(max(1, r["n"])) / 2))
        rows.append((r["source"], r["size"], float(goal[r["source"]]), whole, budget, shift))
    per_source = spark.createDataFrame(
        rows, "s_source string, source_size long, target double, epochs long, budget long, shift int"
    )

    # Ranges of keys, their sums, and the range in which the budget of the source ends.
    per_source = if_few(per_source, len(rows))
    ranged = slim.join(per_source, F.equal_null(F.col("source"), F.col("s_source"))).select(
        "source", "key", "size", "budget", F.expr("shiftright(key, shift)").alias("range")
    )
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("size"), F.first("budget").alias("budget"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        sums.withColumn("before", F.coalesce(F.sum("size").over(upto), F.lit(0)))
        .where("before <= budget and budget < before + size")
        .select("source", "range", "before")
        .collect()  # a row per source
    )
    ends = spark.createDataFrame(ends, "e_source string, e_range long, before long")
    last = ranged.join(
        if_few(ends, len(rows)),
        F.equal_null(F.col("source"), F.col("e_source")) & (F.col("range") == F.col("e_range")),
    ).select("source", "key", "size", "budget", "before")
    # One row per key in that range; the rows of a range are about the root of the source's.
    keys = last.groupBy("source", "key").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("copies"), F.first("budget").alias("budget"),
        F.first("before").alias("before"),
    )
    upto = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        keys.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(upto), F.lit(0)))
        .where("before <= budget and budget < before + size")
        .select("source", "key", "copies", (F.col("budget") - F.col("before")).alias("left"))
        .collect()
    )
    at = {r["source"]: (r["key"], r["left"] // r["copies"], r["left"] % r["copies"] / r["copies"]) for r in cuts}
    final = spark.createDataFrame(
        [(*r[:4], *at.get(r[0], ((1 << _BITS) if r[4] > 0 else -1, 0, 0.0))) for r in rows],
        "m_source string, source_size long, target double, epochs long, cut long, rest long, more double",
    )
    name, n, k, m = (free_name(docs, x) for x in ("mix", "mix_size", "mix_key", "mix_source"))
    of = lambda field: F.col(f"{m}.{field}")
    sized = docs.withColumn(n, n_words(quoted(text))).withColumn(k, _key(quoted(doc_id), quoted(text)))
    share = of("rest") + (F.rand(29) < of("more")).cast("long")
    rest = F.when(F.col(k) < of("cut"), F.col(n)).when(F.col(k) == of("cut"), F.least(share, F.col(n)))
    mixed = sized.join(
        if_few(final.select(F.struct("*").alias(m)), len(rows)),
        F.equal_null(quoted(source).cast("string"), of("m_source")),
        "left",
    )
    return mixed.withColumn(
        name,
        F.struct(
            F.col(n).alias("size"), of("source_size"), of("target"), of("epochs"),
            (of("epochs") * F.col(n) + F.coalesce(rest, F.lit(0))).alias("taken"),
        ),
    ).select(*[quoted(c) for c in docs.columns], F.col(name))


def mix(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mixed table: each row once per epoch it is taken in, columns unchanged.

    The row at the cut is also taken for its first words only, as many as are left.
    """
    mixed = plan(docs, text=text, **options)
    name = mixed.columns[-1]
    copy, size, taken = free_name(mixed, "copy"), F.col(f"{name}.size"), F.col(f"{name}.taken")
    n = F.when(size > 0, F.ceil(taken / size)).otherwise(0).cast("int")
    copies = mixed.where(n > 0).withColumn(copy, F.explode(F.sequence(F.lit(0), n - 1)))
    left = (taken - F.col(copy) * size).cast("int")
    words = F.filter(F.split(quoted(text), "[ \\t-\\r]+"), lambda w: w != "")
    head = F.array_join(F.slice(words, F.lit(1), left), " ")
    cut = F.when(left < size, head).otherwise(quoted(text))
    return copies.withColumn(text, cut).drop(name, copy)


def digest(docs: DataFrame) -> DataFrame:
    mixed = plan(docs.select("doc_id", "text", "source"))
    name = mixed.columns[-1]
    return mixed.select(
        "doc_id", F.col(f"{name}.size").alias("size"), F.col(f"{name}.source_size").alias("source_size"),
        F.col(f"{name}.target").alias("target"), F.col(f"{name}.taken").alias("taken"),
    )
