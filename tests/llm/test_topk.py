"""Exact search against brute force."""

import math
import random

import numpy as np

from sievegate.llm import topk


def brute(rows, k, step=20):
    usable = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in {i: v for i, v in reversed(usable) if i % step == 0}.items():
        scores = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q and len(b) == len(a)]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE_VECTORS", 60)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 5)
    monkeypatch.setattr(topk, "HEAD_VECTORS", 40)
    monkeypatch.setattr(topk, "STEP", 16)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6) * rng.choice([0.1, 1, 5])]) for i in range(400)]
    rows += [(400, [0.0] * 6), (401, [0.0] * 6), (403, [1e5] * 6), (402, [1.0] * 6), (402, [1.0] * 6), (420, None),
             (440, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (460, [math.nan] * 6), (480, [math.inf] * 6), (500, [2.0, -3.5]),
             (501, [0.5, 0.5]), (None, [1.0] * 6), (520, [])]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS dim", "2 AS tile")
    for k in (20, 3):
        assert sorted(map(tuple, topk.exact_top_k(frame, k=k).collect())) == brute(rows, k)
    assert topk.exact_top_k(frame.limit(0)).count() == 0


def test_whole_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    assert sorted(map(tuple, topk.exact_top_k(frame).collect())) == brute(rows, 20)


def test_large_components_are_exact(spark):
    rows = [(0, [1e7, 3.0]), (1, [1e8, 1.0]), (2, [1e8, 1.015625]), (3, [1e8, -1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.exact_top_k(frame).collect())) == brute(rows, 20)
