"""Search and URL filters, the registered queries with SQL, and the pipeline."""

import importlib
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from playspan.llm import covertree, urlfilter
from playspan.llm.queries import QUERIES, SQL

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k=10):
    good = [
        (i, t, [math.floor(1024 * x) for x in v])
        for t, (i, v, _) in enumerate(rows)
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, t, q in good:
        if i % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, u, v in good if u != t and len(v) == len(q))
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def float32(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


@pytest.mark.parametrize("block", [covertree.BLOCK, 64])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(covertree, "BLOCK", block)
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = []
    for i in range(700):
        c = rng.choice(centres)
        rows.append((i, [float32(x + rng.gauss(0, 0.1)) for x in c], 0))
    rows += [(1000 + i, rows[7][1], 0) for i in range(120)]  # copies: ties by id
    rows += [(300, rows[300][1], 0), (None, rows[1][1], 0), (2000, None, 0), (2100, [1.0, None] * 4, 0)]
    rows += [(2200, [float("nan")] * 8, 0), (2300, [float("inf")] + [0.0] * 7, 0), (2400, [1.0, 2.0], 0), (2500, [], 0)]
    df = spark.createDataFrame(rows, VECTORS).repartition(4).withColumn("block", F.lit(1))
    got = sorted(tuple(r) for r in covertree.digest(df).collect())
    assert got == brute(rows)
    assert covertree.digest(df.limit(0)).count() == 0


@pytest.mark.parametrize("levels,share", [(8, 65536), (1, 40)])
def test_top_k_sends_queries_where_bounds_let_them(spark, monkeypatch, levels, share):
    """Two lengths, many cells: only a few blocks are asked; also if cells are cut by hash, parts are small."""
    import numpy as np

    rng = np.random.default_rng(2)
    rows = []
    for size, centres in ((8, rng.normal(size=(30, 8))), (6, rng.normal(size=(5, 6)))):
        for c in centres:
            near = (c + rng.normal(size=(60, size)) * 0.02).astype(np.float32)
            rows += [(len(rows) + i, [float(x) for x in v], 0) for i, v in enumerate(near)]
    rows += [(100 * (100 + i), rows[0][1], 0) for i in range(90)]  # many equal queries
    for name, value in (("BLOCK", 64), ("LEVELS", levels), ("SHARE", share)):
        monkeypatch.setattr(covertree, name, value)
    sent = {}

    def noted(queries, nodes, plain=covertree.away):
        out = plain(queries, nodes)
        sent.update(pairs=out.count(), queries=queries.count(), levels=len(nodes))
        sent["blocks"] = sum(n.count() for n in nodes[:1])
        return out

    monkeypatch.setattr(covertree, "away", noted)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    assert sorted(tuple(r) for r in covertree.digest(df).collect()) == brute(rows)
    assert sent["queries"] < 40 and sent["levels"] >= 1  # equal queries are one
    assert sent["pairs"] < 0.5 * sent["queries"] * sent["blocks"]


def test_cover_tree_balls():
    import numpy as np

    x = np.random.default_rng(1).normal(size=(900, 6))
    tree = covertree.Tree(x)

    def below(node):
        _, _, children, rows = tree.nodes[node]
        return rows if rows is not None else np.concatenate([below(c) for c in children])

    assert sorted(below(0).tolist()) == list(range(900)) and len(tree.nodes) > 1
    for node, (centre, radius, _, _) in enumerate(tree.nodes):
        assert (np.sqrt(((x[below(node)] - x[centre]) ** 2).sum(axis=1)) <= radius + 1e-9).all()


def test_url_filter(spark):
    entries = spark.createDataFrame(
        [
            ("bad.org", 10, "block"), ("bad.org", 20, "allow"), ("bad.org", 30, "block"), ("bad.org", 30, "allow"),
            ("ok.bad.org", 12, "allow"), ("Evil.example.com", 0, "block"), (None, 1, "block"), ("x.org", None, "block"),
            ("x.org", 3, None),
        ],
        "name string, day int, action string",
    )
    captures = [
        (1, "http://bad.org/a", 9, True, None), (2, "https://user@www.BAD.org.:80/a?b", 10, False, "bad.org"),
        (3, "http://ok.bad.org/", 11, False, "bad.org"), (4, "http://ok.bad.org/", 12, True, "ok.bad.org"),
        (5, "http://bad.org", 25, True, "bad.org"), (6, "http://a.b.evil.example.com#x", 99, False, "evil.example.com"),
        (7, "http://notbad.org/", 15, True, None), (8, None, 15, True, None), (9, "mailto:a@bad.org", 15, True, None),
        (10, "http://bad.org/", None, True, None), (11, "", 1, True, None), (12, "http://x.org", 5, True, None),
        (13, "http://bad.org/", 30, False, "bad.org"), (13, "http://bad.org/", 30, False, "bad.org"),
    ]
    df = spark.createDataFrame([c[:3] for c in captures], "id int, url string, day int")
    clashing = df.selectExpr("*", "1 AS host", "2 AS hit0", "3 AS filter", "4 AS name")
    found = urlfilter.as_of(clashing, entries)
    assert found.columns == [*clashing.columns, "filter_"]
    got = sorted((r.id, r["filter_"].kept, r["filter_"].name) for r in found.collect())
    assert got == sorted((c[0], c[3], c[4]) for c in captures)
    assert urlfilter.as_of(df.limit(0), entries).count() == 0
    assert all(r["filter"].kept for r in urlfilter.as_of(df, entries.limit(0)).collect())


def test_url_filter_deep_hosts(spark):
    entries = spark.createDataFrame(
        [("evil.com", 5, "block"), ("g.f.e.d.c.evil.com", 5, "allow"), ("com", 5, "block")], "name string, day int, action string"
    )
    deep = ".".join("abcdefghij" * 10)
    captures = [
        (1, "http://a.b.c.d.evil.com/", 9, False, "evil.com"), (2, f"http://{deep}.evil.com/", 5, False, "evil.com"),
        (3, "http://x.y.g.f.e.d.c.evil.com/", 9, True, "g.f.e.d.c.evil.com"), (4, f"http://{deep}.evil.com/", 4, True, None),
        (5, "http://a.b.c.d.notevil.com/", 9, True, None), (6, "http://com/", 9, False, "com"),
    ]
    found = urlfilter.as_of(spark.createDataFrame([c[:3] for c in captures], "id int, url string, day int"), entries)
    got = sorted((r.id, r["filter"].kept, r["filter"].name) for r in found.collect())
    assert got == [(c[0], c[3], c[4]) for c in captures]


def test_url_filter_odd_authorities(spark):
    urls = {
        "http://a@b@evil.com/": "evil.com", "http://u:p@ss@evil.com/x": "evil.com", " http://evil.com/": "evil.com",
        "http://evil.com../": "evil.com", "http://%65vil.com/": "evil.com", "http://evil.com\\@good.org/": "evil.com",
        "http://evil\u3002com/": "evil.com", "http://evil.com:80/": "evil.com", "HTTP://EVIL.com?x": "evil.com",
        "http://good.org/@evil.com": "good.org", "http://good.org#@evil.com": "good.org", "http://ev\til.com/\n": "evil.com",
        "http://e%zzvil.com/": "e%zzvil.com", "http://[::1]/": None, "http:///x": None, "ftp://evil.com/": None, "": None, None: None,
    }
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string").coalesce(1)
    found = df.select("i", urlfilter.host_of(df["url"]).alias("h")).orderBy("i").collect()
    assert [r.h for r in found] == list(urls.values())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_sql(spark, small_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small_dir}/{table}.parquet'")
    df = entry_points.queries()[name](spark, small_dir)
    found = con.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r) for r in found.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr) == want


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    importlib.reload(corpus_pipeline)


def test_pipeline_stages(spark, small_dir, tmp_path):
    """Each stage against what it must do to its own input."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    n = {"read": docs.count()}
    words = lambda df: sum(len((r.text or "").encode().split()) for r in df.select("text").collect())
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, small_dir)
        assert out.columns == docs.columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        n[name] = docs.count()
        if name == "mix":
            assert abs(words(docs) - 1.5 * words(before)) <= 40
    assert n["read"] >= n["language"] > n["near_dedup"] == n["passage_dedup"] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, small_dir)
    assert last.count() == n["mix"]
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
