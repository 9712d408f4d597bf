from __future__ import annotations

import math

import numpy as np
import pytest
from llm_helpers import clashing, rows
from pyspark.sql import functions as F

from floorline.llm.bit_sliced import Block, top_k

SCHEMA = "vec_id long, embedding array<float>"


def valid(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) and abs(64 * x) < 2 ** 24 for x in v)


def brute(data, k):
    good = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in data if i is not None and valid(v)]
    out = []
    for i, q in dict.fromkeys((i, tuple(q)) for i, q in good if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out, key=repr)


def check(spark, data, k=5, **sizes):
    found = top_k(clashing(spark.createDataFrame(data, SCHEMA)), F.col("vec_id") % 20 == 0, k, **sizes)
    assert rows(found, "query_id", "rank", "vec_id", "score") == brute(data, k)


def test_matches_brute_force_in_several_blocks(spark):
    rng = np.random.default_rng(2)
    data = [(i, rng.normal(0, 1, 7).tolist()) for i in range(150)]
    check(spark, data, 5, block_rows=40, group_queries=3)
    check(spark, data, 200, block_rows=64, group_queries=100)


def test_ties_repeats_nulls_and_odd_values(spark):
    data = [(i, [1.0, -1.0, 0.5]) for i in range(70)]
    data += [(40, None), (60, [None, 1.0, 2.0]), (80, [math.nan, 0.0, 0.0]), (100, [math.inf, 0.0, 0.0]), (120, []), (140, [1e30, 0.0, 0.0]),
             (None, [1.0, 1.0, 1.0]), (160, [1.0, 2.0]), (161, [1.0, 2.0]), (20, [1.0, -1.0, 0.5]), (180, [0.0, 0.0, 0.0]), (200, [-3.0, 7.0, 100.0])]
    check(spark, data, 5, block_rows=30)


def test_large_components_take_part(spark):
    data = [(0, [300_000.0, 1.0, -2.0]), (1, [1.0, 2.0, 3.0]), (2, [-1e6, 5.0, 0.5]), (3, [2.0 ** 40, -1.0, 0.0]), (20, [0.25, -4.0, 2.0]),
            (4, [2.0 ** 20, -(2.0 ** 20), 7.0]), (40, [-(2.0 ** 34), 0.0, 0.0])]
    found = top_k(spark.createDataFrame(data[:3] + data[4:6], SCHEMA), F.col("vec_id") % 20 == 0, 5, block_rows=2)
    exact = {i: [math.floor(64 * x) for x in v] for i, v in data}
    best = lambda q, ids: sorted((-sum(a * b for a, b in zip(exact[q], exact[j])), j) for j in ids if j != q)
    assert rows(found, "query_id", "rank", "vec_id", "score") == sorted(
        ((q, r + 1, j, -s) for q in (0, 20) for r, (s, j) in enumerate(best(q, (0, 1, 2, 20, 4)))), key=repr)
    # Far beyond the square root of 64 bits, as long as the scores fit.
    block = Block.of(np.array([1, 3, 40]), np.array([exact[i] for i in (1, 3, 40)]))
    ids, scores = block.top(np.array(exact[20]), 20, 3)
    assert sorted(zip((-scores).tolist(), ids.tolist())) == best(20, (1, 3, 40))
    ends = np.array([[-(2 ** 63), 1], [2 ** 63 - 1, 0], [5, -3]])
    ids, scores = Block.of(np.arange(3), ends).top(np.array([1, 0]), -1, 3)
    assert dict(zip(ids.tolist(), scores.tolist())) == {0: -(2 ** 63), 1: 2 ** 63 - 1, 2: 5}
    with pytest.raises(OverflowError):
        block.top(np.array(exact[3]), 99, 3)


def test_empty_and_single(spark):
    assert top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
    assert top_k(spark.createDataFrame([(0, [1.0])], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


def test_slices_add_up_to_the_products():
    rng = np.random.default_rng(5)
    values = rng.integers(-200, 200, (130, 9))
    block = Block.of(np.arange(130), values)
    for query in (rng.integers(-100, 100, 9), np.zeros(9, np.int64), np.full(9, -1)):
        ids, scores = block.top(query, -1, 130)
        assert dict(zip(ids.tolist(), scores.tolist())) == dict(enumerate((values @ query).tolist()))
