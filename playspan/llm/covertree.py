"""Exact top-k by inner product: a dual search of cover trees over queries and data.

Each component x becomes the integer floor(SCALE * x). Rows with equal vectors are one
point that keeps its k + 1 smallest ids, which is all that a ranking can need of them, and
equal queries are searched once for k + 1 results, so copies cost nothing.

The upper levels of the tree are tables. Cells of more than ``BLOCK`` points are split by the
nearest of up to ``PIVOTS`` of their own points, level by level; a node has its pivot as
centre and the radius of the ball that covers it. Cells are split in parts of bounded size, so
a cell with most points is no single task, and what is still too large after ``LEVELS`` splits is
cut by a hash under one ball. The lower levels are cover trees in memory, one per block.

Queries stay in the block of their point. Each block searches its own queries first, which
gives each a k-th score. Then groups of queries, one per block, descend the node tables:
children below the worst k-th score of the group are left out, so a group meets only the
blocks that its bound lets through, and of these each query only those that its own bound
lets through. In a block, points and queries are searched by a dual descent of two cover
trees: children shrink by ``SHRINK``.

For a pair of balls no inner product exceeds <q, p> + rq |p| + rp |q| + rq rp; the pair is left
out if that is below the worst k-th score of the queries. Bounds are floating point with a
margin, scores are exact integers.

Ranks go by score, then by smaller id; equal ids of repeated rows are ranked one after the
other, each query row leaving out itself only. Null ids, null vectors and vectors with a
null or non-finite component take no part; vectors of different lengths are never compared.
An empty table has an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType, DoubleType

from playspan.llm.common import quoted
from playspan.session import stage

SCALE = 1024
BLOCK = 4096
PIVOTS = 64
LEVELS = 8
#: Points of a cell that one task splits, and queries that one task asks of a block.
SHARE = 65536
LEAF = 32
SHRINK = 0.7


class Tree:
    """A cover tree of the rows of ``x``: nodes as (centre row, radius, children, rows)."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.norm = np.sqrt((x**2).sum(axis=1))
        self.nodes: list[tuple[int, float, list[int], np.ndarray | None]] = []
        if len(x):
            rows = np.arange(len(x))
            self._add(rows, 0, self._distances(0, rows))

    def _distances(self, centre: int, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.x[rows] - self.x[centre]) ** 2).sum(axis=1))

    def _add(self, rows: np.ndarray, centre: int, distances: np.ndarray) -> int:
        radius, me = float(distances.max()), len(self.nodes)
        self.nodes.append((centre, radius, [], rows))
        if len(rows) <= LEAF or radius == 0:
            return me
        # Centres far apart until all rows are within the smaller radius of one of them.
        least, owner, centres = distances.copy(), np.zeros(len(rows), np.int64), [centre]
        own = [distances]
        while len(centres) <= len(rows) // 4 and least.max() > SHRINK * radius:
            at = int(least.argmax())
            new = self._distances(int(rows[at]), rows)
            closer = new < least
            least[closer], owner[closer] = new[closer], len(centres)
            centres.append(int(rows[at]))
            own.append(new)
        if len(centres) == 1 or len(centres) > len(rows) // 4:
            return me  # rows are about equally far from each other: one leaf
        children = []
        for k, c in enumerate(centres):
            mine = owner == k
            if mine.any():
                children.append(self._add(rows[mine], c, own[k][mine]))
        self.nodes[me] = (centre, radius, children, None)
        return me


class Best:
    """The k best (score, id) of each query so far; ``floor`` is a k-th score known before."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.worst, self.found = k, floor.astype(float), [[] for _ in range(n)]

    def offer(self, q: int, score: int, ids: list[int], rows: list[int], own: int) -> None:
        mine = self.found[q]
        mine += [(-score, i, t) for i, t in zip(ids, rows) if t != own]
        if len(mine) >= self.k:
            mine.sort()
            del mine[self.k :]
            self.worst[q] = max(self.worst[q], -mine[-1][0])


def search(queries: Tree, own: np.ndarray, data: Tree, ids: list, rows: list, k: int, floor: np.ndarray) -> Best:
    best = Best(len(own), k, floor)
    if not queries.nodes or not data.nodes:
        return best
    below: dict[int, np.ndarray] = {}

    def rows_of(node: int) -> np.ndarray:
        if node not in below:
            _, _, children, here = queries.nodes[node]
            below[node] = here if here is not None else np.concatenate([rows_of(c) for c in children])
        return below[node]

    def bound(q: int, d: int) -> float:
        cq, rq, _, _ = queries.nodes[q]
        cd, rd, _, _ = data.nodes[d]
        nq, nd = queries.norm[cq], data.norm[cd]
        top = float(queries.x[cq] @ data.x[cd]) + rq * nd + rd * nq + rq * rd
        return top + 1e-6 * (1 + (nq + rq) * (nd + rd))

    todo = [(0, 0)]
    while todo:
        q, d = todo.pop()
        mine = rows_of(q)
        if bound(q, d) < best.worst[mine].min():
            continue
        _, rq, q_children, _ = queries.nodes[q]
        _, rd, d_children, points = data.nodes[d]
        if q_children and (rq > rd or not d_children):
            todo += [(c, d) for c in q_children]
        elif d_children:
            todo += sorted(((q, c) for c in d_children), key=lambda pair: bound(*pair))
        else:
            scores = queries.x[mine] @ data.x[points].T
            for i, j in np.argwhere(scores >= best.worst[mine][:, None]):
                if scores[i, j] >= best.worst[mine[i]]:
                    p = points[j]
                    best.offer(mine[i], int(scores[i, j]), ids[p], rows[p], own[mine[i]])
    return best


def _floats(vectors: list[bytes]) -> np.ndarray:
    """Rows of integers of one length."""
    return np.frombuffer(b"".join(vectors), np.int64).astype(float).reshape(len(vectors), len(vectors[0]) // 8)


@arrow_udf(BinaryType())
def _integers(column: pa.Array) -> pa.Array:
    out = []
    for v in column.to_pylist():
        x = None if v is None or None in v else np.array(v, float)
        out.append(None if x is None or not np.isfinite(x).all() else np.floor(SCALE * x).astype(np.int64).tobytes())
    return pa.array(out, pa.binary())


@arrow_udf(DoubleType())
def _bound(q: pa.Array, rq: pa.Array, p: pa.Array, rp: pa.Array) -> pa.Array:
    """No inner product of a point within rq of q and one within rp of p is greater."""
    out = np.empty(len(q))
    q, p = q.to_pylist(), p.to_pylist()
    rq, rp = rq.to_numpy(zero_copy_only=False), rp.to_numpy(zero_copy_only=False)
    for size in {len(v) for v in q}:
        at = np.array([i for i, v in enumerate(q) if len(v) == size])
        x, y = _floats([q[i] for i in at]), _floats([p[i] for i in at])
        nx, ny = np.sqrt((x**2).sum(axis=1)), np.sqrt((y**2).sum(axis=1))
        rx, ry = rq[at], rp[at]
        out[at] = (x * y).sum(axis=1) + rx * ny + ry * nx + rx * ry + 1e-6 * (1 + (nx + rx) * (ny + ry))
    return pa.array(out)


_PLACED = "cell string, parent string, v binary, ids array<long>, rows array<long>, asked boolean, dist double"


def _split(batches):
    """Rows of one part of a cell together: pivots (kind 0), then points (kind 1)."""
    held, pivots, x = None, [], None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("cell", "part", "kind"))))
        vectors = batch.column("v").to_pylist()
        child, dist, at = [], [], 0
        while at < len(keys):
            cell, part, kind = keys[at]
            end = at
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            if kind == 0:
                if held != (cell, part):
                    held, pivots = (cell, part), []
                pivots, x = pivots + vectors[at:end], None
            else:
                x = _floats(pivots) if x is None else x
                own = _floats(vectors[at:end])
                near = ((x**2).sum(axis=1)[None, :] - 2 * own @ x.T).argmin(axis=1)
                child += [f"{cell}.{i}" for i in near]
                dist += np.sqrt(((own - x[near]) ** 2).sum(axis=1)).tolist()
            at = end
        points = batch.filter(pa.array([k[2] == 1 for k in keys], pa.bool_()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(child, pa.string()), *(points.column(c) for c in ("cell", "v", "ids", "rows", "asked")),
             pa.array(dist, pa.float64())],
            ["cell", "parent", "v", "ids", "rows", "asked", "dist"],
        )


def _parts(size: int):
    return F.ceil(F.col("n") / F.lit(size)).cast("int")


def cells(points: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Points with the block they are in, and the nodes (cell, parent, centre, radius, n) per level.

    The first cells hold the vectors of one length.
    """
    cell = points.withColumn("cell", F.length("v").cast("string")).withColumn("dist", F.lit(None).cast("double"))
    whole = ["cell", "v", "ids", "rows", "asked", "dist"]
    counts = stage(cell.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "cells")
    levels, done = [], []
    for level in range(LEVELS):
        big = counts.where(F.col("n") > BLOCK).select("cell", "n")
        if big.isEmpty():
            break
        done.append(cell.join(big, "cell", "left_anti").select(*whole, F.lit(0).alias("part")))
        wide = cell.join(big, "cell")
        drawn = Window.partitionBy("cell").orderBy(F.xxhash64("v", F.lit(level)), "v")
        pivots = wide.withColumn("i", F.row_number().over(drawn)).where(F.col("i") <= PIVOTS)
        pivots = pivots.where(F.col("i") <= 1 + F.ceil(4 * F.col("n") / BLOCK)).withColumn(
            "part", F.explode(F.sequence(F.lit(0), _parts(SHARE) - 1))
        )
        dealt = ["cell", "part", "kind", "v", "ids", "rows", "asked"]
        both = pivots.withColumn("kind", F.lit(0)).select(dealt).unionByName(
            wide.withColumn("part", F.pmod(F.xxhash64("v"), _parts(SHARE)).cast("int"))
            .withColumn("kind", F.lit(1)).select(dealt)
        )
        sorted_ = both.repartition("cell", "part").sortWithinPartitions("cell", "part", "kind")
        cell = stage(sorted_.mapInArrow(_split, _PLACED), "split")
        counts = stage(
            cell.groupBy("cell", "parent").agg(
                F.min_by("v", "dist").alias("centre"), F.max("dist").alias("radius"), F.count(F.lit(1)).alias("n")
            ),
            "nodes",
        )
        levels.append(counts)
    rest = cell.join(counts.select("cell", "n"), "cell")
    done.append(rest.withColumn("part", F.pmod(F.xxhash64("v"), _parts(BLOCK)).cast("int")).select(*whole, "part"))
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    return placed, levels


def descend(groups: DataFrame, levels: list[DataFrame]) -> DataFrame | None:
    """(home, cell, n, centre, radius): the cells without children that a group's bound lets through.

    A group has home, cell, q (centre), rq (radius) and worst (k-th score, null if one has none).
    """
    at = groups.select("home", "q", "rq", "worst", F.element_at(F.split("cell", "[.]"), 1).alias("parent"))
    found = None
    for level, nodes in enumerate(levels):
        met = at.join(nodes, "parent").withColumn("most", _bound("q", "rq", "centre", "radius"))
        met = stage(met.where("worst IS NULL OR most >= worst").drop("most"), "met")
        leaf = F.lit(True) if level + 1 == len(levels) else F.col("n") <= BLOCK
        ends = met.where(leaf).select("home", "cell", "n", "centre", "radius")
        found = ends if found is None else found.unionByName(ends)
        at = met.where(~leaf).select("home", "q", "rq", "worst", F.col("cell").alias("parent"))
    return found


_FOUND = "q long, score long, vec_id long, t long"


def _search_blocks(k: int):
    """Rows of one block together: points (kind 0), then queries (kind 1), all of one length."""

    def searched(tree, ids, row_ids, rows):
        floor = np.array([-np.inf if f is None else f for _, _, f in rows])
        best = search(Tree(_floats([v for _, v, _ in rows])), np.full(len(rows), -1), tree, ids, row_ids, k, floor)
        out = [(q, -s, i, t) for (q, _, _), found in zip(rows, best.found) for s, i, t in sorted(found)[:k]]
        return pa.RecordBatch.from_arrays(
            [pa.array([o[i] for o in out], pa.int64()) for i in range(4)], ["q", "score", "vec_id", "t"]
        )

    def run(batches):
        held, points, model, rows = None, [], None, []
        names = ("block", "part", "kind", "v", "ids", "rows", "q", "floor")
        for batch in batches:
            for block, part, kind, v, ids, row_ids, q, floor in zip(*(batch.column(c).to_pylist() for c in names)):
                if (block, part) != held:
                    if rows:
                        yield searched(*model, rows)
                    held, points, model, rows = (block, part), [], None, []
                if kind == 0:
                    points.append((v, ids, row_ids))
                else:
                    if model is None:
                        model = Tree(_floats([p[0] for p in points])), [p[1] for p in points], [p[2] for p in points]
                    rows.append((q, v, floor))
                    if len(rows) >= 1024:
                        yield searched(*model, rows)
                        rows = []
        if rows:
            yield searched(*model, rows)

    return run


def search_blocks(placed: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    """(q, score, vec_id, t): the best k of each block for the queries (block, q, v, floor) sent to it."""
    asks = stage(asks, "asks")
    shares = asks.groupBy("block").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("block").alias("b"), _parts(SHARE).alias("shares")
    )
    shares = stage(shares, "shares")
    held = F.col("block") == F.col("b")
    none = lambda kind: F.lit(None).cast(kind)
    data = placed.join(shares, held).select(
        "block", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("part"), F.lit(0).alias("kind"),
        "v", "ids", "rows", none("long").alias("q"), none("long").alias("floor"),
    )
    queries = asks.join(shares, held).select(
        "block", F.pmod(F.xxhash64("q"), F.col("shares")).cast("int").alias("part"), F.lit(1).alias("kind"),
        "v", none("array<long>").alias("ids"), none("array<long>").alias("rows"), "q", "floor",
    )
    together = data.union(queries).repartition("block", "part").sortWithinPartitions("block", "part", "kind", "q")
    return stage(together.mapInArrow(_search_blocks(k), _FOUND), "found")


def away(queries: DataFrame, levels: list[DataFrame]) -> DataFrame | None:
    """(block, q, v, floor): the blocks other than its own that the bound of a query lets through.

    None if no cell was split, so no vector has others of its length in another block.
    """
    if not levels:
        return None
    nodes = levels[0].select(F.col("cell").alias("c"), "centre")
    for more in levels[1:]:
        nodes = nodes.unionByName(more.select(F.col("cell").alias("c"), "centre"))
    # Queries without a k-th score are a group of their own: they would open all ways for the rest.
    queries = queries.withColumn("home", F.struct("cell", "block", F.col("floor").isNull().alias("free")))
    groups = queries.groupBy("home").agg(F.max("dist").alias("rq"), F.min("floor").alias("worst"))
    groups = groups.withColumn("cell", F.col("home.cell"))
    groups = groups.join(nodes, F.col("cell") == F.col("c")).withColumnRenamed("centre", "q")
    met = descend(stage(groups.select("home", "cell", "q", "rq", "worst"), "groups"), levels)
    met = met.select("home", F.col("cell").alias("to"), "n", "centre", "radius")
    pairs = queries.select("home", "block", "q", "v", "floor").join(met, "home")
    pairs = pairs.withColumn("most", _bound("v", F.lit(0.0), "centre", "radius"))
    pairs = pairs.where("floor IS NULL OR most >= floor").withColumn(
        "other", F.explode(F.sequence(F.lit(0), _parts(BLOCK) - 1))
    )
    pairs = pairs.withColumn("other", _block("to", "other")).where("other <> block")
    return pairs.select(F.col("other").alias("block"), "q", "v", "floor")


def _block(cell: str, part: str):
    return F.concat_ws("#", F.col(cell), F.col(part).cast("string"))


def top_k(table: DataFrame, is_query, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for rows where the column ``is_query`` is true."""
    rows = table.select(
        quoted(vec_id).cast("long").alias("vec_id"), is_query.alias("query"),
        _integers(quoted(vector)).alias("v"), F.monotonically_increasing_id().alias("t"),
    )
    rows = stage(rows.where("v IS NOT NULL AND vec_id IS NOT NULL"), "vectors")
    same = Window.partitionBy("v").orderBy("vec_id", "t")
    few = rows.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1)
    points = few.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("vec_id", "t"))).alias("of"))
    asked = rows.where("query").select(F.col("v").alias("a")).distinct()
    points = points.join(asked, F.col("v") == F.col("a"), "left").select(
        "v", F.col("of.vec_id").alias("ids"), F.col("of.t").alias("rows"), F.col("a").isNotNull().alias("asked")
    )
    placed, levels = cells(stage(points, "points"))
    placed = stage(placed.withColumn("block", _block("cell", "part")), "placed")
    # One query per vector, with one result more than asked: each of its rows leaves out itself.
    queries = placed.where("asked").select("cell", "block", "v", "dist", F.element_at("rows", 1).alias("q"))
    home = search_blocks(placed, queries.withColumn("floor", F.lit(None).cast("long")).select("block", "q", "v", "floor"), k + 1)
    floors = home.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")).where(F.col("n") == k + 1)
    others = away(queries.join(floors.select("q", "floor"), "q", "left"), levels)
    found = home if others is None else home.unionByName(search_blocks(placed, others, k + 1))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "t")
    found = found.withColumn("i", F.row_number().over(order)).where(F.col("i") <= k + 1)
    of = queries.select("q", F.col("v").alias("a"))
    asks = rows.where("query").select(F.col("vec_id").alias("query_id"), F.col("t").alias("own"), "v")
    asks = asks.join(of, F.col("v") == F.col("a")).select("query_id", "own", "q")
    ranked = Window.partitionBy("own").orderBy("i")
    return (
        asks.join(found, "q").where("t <> own")
        .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def digest(table: DataFrame) -> DataFrame:
    return top_k(table, F.coalesce(F.pmod("vec_id", F.lit(100)) == 0, F.lit(False)))
