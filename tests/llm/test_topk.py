import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk


def brute(ids, vecs, query_ids, k):
    out = []
    for q in sorted(query_ids):
        v = vecs[ids.index(q)]
        got = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in zip(ids, vecs, strict=True) if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(got[:k])]
    return out


@pytest.mark.parametrize("leaf", [2, 8, 256])
def test_dual_tree_against_brute_force(leaf, monkeypatch):
    monkeypatch.setattr(topk, "LEAF", leaf)
    rng = np.random.default_rng(leaf)
    centres = rng.normal(scale=60, size=(12, 8))
    x = np.floor(centres[rng.integers(12, size=500)] + rng.normal(scale=4, size=(500, 8))).astype(np.int64)
    x[100:160] = x[100]  # equal vectors
    ids = rng.permutation(5000)[:500]
    s = topk.Search(ids[:90], x[:90], ids, x, 5)
    got = sorted(map(tuple, zip(*(c.to_pylist() for c in s.result().columns), strict=True)))
    want = brute(ids.tolist(), x.tolist(), ids[:90].tolist(), 5)
    assert got == sorted((q, i, v) for q, _, i, v in want)
    if leaf < 20:
        assert s.pairs < 90 * 500 * 0.8  # node pairs are pruned


def test_tree_invariants():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 6))
    order, root = topk.cover_tree(x)
    assert sorted(order) == list(range(3000))

    def walk(n):
        away = np.sqrt(((x[order[n.lo : n.hi]] - n.centre) ** 2).sum(axis=1))
        assert away.max() <= n.radius + 1e-9
        assert not n.children or (n.children[0].lo, n.children[-1].hi) == (n.lo, n.hi)
        for c in n.children:
            walk(c)

    walk(root)


def test_odd_rows_and_grid(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 7)
    monkeypatch.setattr(topk, "MOST", 11)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rows = [(i, [math.sin(i * j + 1) for j in range(6)]) for i in range(60)] + [(i, [0.5] * 6) for i in range(60, 90)]
    rows += [(100, None), (150, [1.0, None]), (200, [float("nan"), 1.0]), (250, [float("inf")]), (None, [1.0]), (300, []), (350, [0.25, -0.003])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, score int, VEC_ID int")
    ids = [i for i, v in rows if i is not None and i not in (100, 150, 200, 250)]
    vecs = [[math.floor(256 * float(np.float32(x))) for x in v] + [0] * (6 - len(v)) for i, v in rows if i in ids]
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 10 == 0).collect())
    assert got == brute(ids, vecs, [i for i in ids if i % 10 == 0], 5)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert topk.top_k(spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>"), F.col("vec_id") == 0).count() == 2


def test_large_components():
    x = np.array([[2**31, 1], [2**31 - 1, 5], [3, 4]], dtype=np.int64)
    s = topk.Search(np.array([7]), x[:1], np.array([1, 2, 3]), x, 2)
    assert not s.exact
    assert s.result().column("score").to_pylist() == [2**62 + 1, 2**31 * (2**31 - 1) + 5]


def test_pruning_across_cells(spark, monkeypatch):
    """Clustered vectors: most cells are never sent to a query, and the answers are those of brute force."""
    monkeypatch.setattr(topk, "ROWS", 50)
    monkeypatch.setattr(topk, "LEAF", 8)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(16, 8))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    x = (centres[rng.integers(16, size=1200)] + rng.normal(scale=0.02, size=(1200, 8))).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect())
    vecs = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    assert got == brute(list(range(1200)), vecs.tolist(), list(range(0, 1200, 50)), 5)
    data = topk.quantised(df)
    cells = topk.celled(data, topk.centres_of(data, 1200, 8)).toPandas()
    assert cells["cell"].nunique() > 8
    own = topk.centres_of(data, 1200, 8)
    radius = cells.groupby("cell")["away"].max().reindex(range(len(own)), fill_value=0).to_numpy()
    parts = np.bincount(cells["cell"], minlength=len(own)).clip(max=1)
    asked = data.where("vec_id % 50 = 0").withColumn("least", F.lit(0.9 * 256**2))
    assert topk.reached(asked, own, radius, parts, first=False).count() < 24 * len(own) / 3


def test_equal_rows_spread(spark, monkeypatch):
    monkeypatch.setattr(topk, "MOST", 500)
    df = spark.range(20_000).select("id", F.array(*[F.lit(0.25)] * 8).alias("embedding")).withColumnRenamed("id", "vec_id")
    seen = []
    real = topk.searched
    monkeypatch.setattr(topk, "searched", lambda q, d, *a: seen.append(d) or real(q, d, *a))
    got = topk.top_k(df, F.col("vec_id") % 5000 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got)[:5] == [(0, i, i) for i in range(1, 6)]
    sizes = [r["count"] for r in seen[-1].groupBy("cell", "part").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 750
