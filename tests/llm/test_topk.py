"""Top-k search against all inner products in whole numbers."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lisan.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int, x string, key int, rid int, dim string, shard int, score int"


def table(seed: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(8):
        centre = rng.normal(size=6)
        out += [(centre + rng.normal(size=6) * rng.choice([0.01, 0.3])).tolist() for _ in range(40)]
    base = rng.normal(size=6).tolist()
    out += [base] * 30 + [[x + 1e-9 for x in base], [0.0] * 6, [-0.0] * 6, [], None, [float("nan")] * 6, [None, 1.0]]
    out += [[float("inf"), 1.0], [1.0, 2.0], [1.0, 2.0], [2.0, 2.0], [-1.0, 0.5], [3.0], [1e300, 1e300], [-1e300, 1.0]]
    rows = [(5 * k, v) for k, v in enumerate(out)]
    rows += [(50, out[10]), (50, out[10]), (100, out[3]), (None, out[7]), (None, base), (None, None), (150, None)]
    rows += [(50 * k + 10_000, base) for k in range(10)] + [(50 * k + 20_000, [float(k), 1.0]) for k in range(5)]
    return [(*r, 0, "x", 1, 2, "y", 3, 4) for r in rows]


def plain(rows: list[tuple], k: int) -> Counter:
    most = 2**52

    def whole(v):
        if not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [max(-most, min(most, math.floor(256 * x) if abs(x) < 1e200 else int(math.copysign(most, x)))) for x in v]

    vectors = [(r[0], whole(r[1])) for r in rows]
    out = Counter()
    for i, (q, x) in enumerate(vectors):
        if x is None or q is None or q % 50:
            continue
        found = [
            (-max(-(2**63 - 1), min(2**63 - 1, sum(a * b for a, b in zip(x, y)))), v is None, v)
            for j, (v, y) in enumerate(vectors)
            if j != i and y is not None and len(y) == len(x)
        ]
        for rank, (low, _, v) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k], 1):
            out[q, rank, v, -low] += 1
    return out


@pytest.mark.parametrize(("shard", "leaf", "block", "k"), [(8_192, 64, 1_024, 5), (40, 4, 3, 5), (25, 2, 1, 2)])
def test_top_k(spark, monkeypatch, shard, leaf, block, k):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "WAVES", (1, 2, None))
    monkeypatch.setattr(topk, "PACK", 2)
    rows = table(shard)
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA).repartition(4), F.col("vec_id") % 50 == 0, k=k).collect()
    assert Counter((r.query_id, r.rank, r.vec_id, r.score) for r in got) == plain(rows, k)


def test_search_opens_few_nodes_and_finds_all(monkeypatch):
    """Bounds and the shared k-th score leave out most leaves where vectors lie in groups."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 8)) * 300
    x = np.floor(np.concatenate([c + rng.normal(size=(50, 8)) * 5 for c in centres]))
    ids = rng.permutation(len(x))
    tree = topk.BallTree(x, ids, leaf=16)
    assert sorted(tree.order.tolist()) == list(range(len(x)))
    for node in range(len(tree.start)):
        own = tree.x[tree.start[node] : tree.stop[node]]
        assert np.sqrt(((own - tree.centre[node]) ** 2).sum(axis=1)).max() <= tree.radius[node] + 1e-9
        assert tree.least[node] == tree.ids[tree.start[node] : tree.stop[node]].min()
    read = []
    products = topk.products
    monkeypatch.setattr(topk, "products", lambda q, y: read.append(len(y) * len(q)) or products(q, y))
    q = x[::97]
    low = np.full(len(q), -topk.LONGEST - 1)
    scores, found, _ = topk.search(tree, tree.ids * 10, q, low, np.full(len(q), topk.LAST), 5)
    exact = (q @ x.T).astype(np.int64)
    for row in range(len(q)):
        order = np.lexsort((ids, -exact[row]))[:5]
        assert found[row].tolist() == ids[order].tolist() and scores[row].tolist() == exact[row, order].tolist()
    assert sum(read) < len(q) * len(x) / 2
    read.clear()
    topk.search(tree, tree.ids, q, scores[:, -1], found[:, -1], 5)  # the k-th is known: fewer still, not none
    assert 0 < sum(read) < len(q) * len(x) / 4


def test_products_are_exact():
    q, x = np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 1.0], [2.0**52, 0.0], [-(2.0**52), 3.0]])
    assert topk.products(q, x).tolist() == [[2**60 + 1, 2**63 - 1, -(2**63 - 1)]]


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0
    alone = spark.createDataFrame([(50, [1.0, 2.0], 0, "", 1, 2, "", 3, 4)], SCHEMA)
    assert topk.top_k(alone, F.col("vec_id") % 50 == 0).count() == 0
    unasked = spark.createDataFrame([(51, [1.0, 2.0], 0, "", 1, 2, "", 3, 4)], SCHEMA)
    assert topk.top_k(unasked, F.col("vec_id") % 50 == 0).count() == 0
