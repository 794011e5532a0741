from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import topk
from tallyframe.llm.topk import ImpactIndex, exact_top_k


def test_index_equals_brute_force(monkeypatch):
    rng = np.random.default_rng(0)
    for _ in range(200):
        n, d, k = (int(rng.integers(1, high)) for high in (150, 9, 12))
        monkeypatch.setattr(topk, "LEFT", int(rng.integers(1, 40)))
        monkeypatch.setattr(topk, "STEP", int(rng.integers(1, 30)))
        vectors = rng.integers(-int(rng.integers(1, 400)), 400, (n, d))
        ids = rng.permutation(n) // 2
        query = rng.integers(-300, 300, d) * (rng.random(d) < 0.8)
        own = int(rng.integers(-1, n))
        rows, scores = ImpactIndex(vectors, ids).top(query, k, own)
        best = sorted((-int(vectors[i] @ query), int(ids[i])) for i in range(n) if i != own)[:k]
        assert [(-int(s), int(ids[r])) for r, s in zip(rows, scores, strict=True)] == best


@pytest.mark.parametrize("shard_rows", [4096, 10])
def test_table_with_odd_rows(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(topk, "MOST_ROWS", shard_rows)
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    rows += [(7, rows[7][1]), (61, rows[3][1]), (62, rows[3][1])]
    odd = [(63, None), (64, [1.0, None, 1.0, 1.0]), (65, [math.nan] * 4), (66, [math.inf] * 4), (None, [1.0] * 4)]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS row", "2 AS shard", "3 AS id")
    whole = [(i, [math.floor(1024 * x) for x in map(float, np.array(v, np.float32))]) for i, v in rows]
    expected = []
    for at, (query, q) in enumerate(whole):
        if query % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i) for n, (i, v) in enumerate(whole) if n != at)
            expected += [(query, rank, i, -s) for rank, (s, i) in enumerate(scored[:10], 1)]
    found = exact_top_k(frame, F.col("vec_id") % 20 == 0).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_few_and_no_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0, 5.0])], "vec_id bigint, embedding array<double>")
    rows = exact_top_k(frame, F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in rows] == [(0, 1, 1, 1024 * 2048)]
    assert exact_top_k(frame.where("vec_id > 5"), F.lit(True)).collect() == []
    with pytest.raises(Exception, match="64 bits"):
        exact_top_k(frame.selectExpr("vec_id", "array(1e15D) AS embedding"), F.lit(True)).collect()


@pytest.mark.parametrize("large", [1e30, -1e30, 1e308, -(2.0**53), 2.0**52])
def test_components_beyond_64_bits_raise(spark, large):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [large, 0.0]), (2, [3.0, 1.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        exact_top_k(frame, F.col("vec_id") == 0).collect()


def test_components_next_to_the_limit(spark):
    large = 2.0**40
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [large, 0.0]), (2, [-large, 9.0])], "vec_id bigint, embedding array<double>")
    rows = exact_top_k(frame, F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in rows] == [(0, 1, 1, 2**60), (0, 2, 2, -(2**60))]
