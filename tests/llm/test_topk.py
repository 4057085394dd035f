"""Top-k search against plain products of whole integers."""

import math
import random

import numpy as np
import pytest

from varlake.llm import topk

SCHEMA = "vec_id long, embedding array<double>"


def whole(v, scale=256):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(scale * x) for x in v]


def brute(rows, asked, k):
    vectors = [(i, whole(v)) for i, v in rows]
    out, seen = [], set()
    for i, v in rows:
        q = whole(v)
        if not asked(i) or q is None or (i, tuple(q)) in seen:
            continue
        seen.add((i, tuple(q)))
        scores = sorted((-sum(a * b for a, b in zip(q, c)), j is None, j) for j, c in vectors if c is not None and j != i)
        out += [(i, n + 1, s[2], -s[0]) for n, s in enumerate(scores[:k])]
    return sorted(out, key=repr)


def found(spark, rows, k, schema=SCHEMA, parts=5):
    df = spark.createDataFrame(rows, schema).repartition(parts)
    return sorted((tuple(r) for r in topk.top_k(df.where("vec_id % 5 = 0"), df, k=k).collect()), key=repr)


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(12)
    rows = [(i, [rng.gauss(0, 0.15) for _ in range(40)]) for i in range(300)]
    rows += [(300 + i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(40)]) for i in range(60)]  # ties
    rows += [(400, None), (405, [None] * 40), (410, [math.nan] + [0.0] * 39), (415, [math.inf] + [1.0] * 39), (420, []), (425, [1.0, 2.0]), (430, [0.5] * 70), (None, [1.0] * 40), (435, [0.0] * 40), (440, [3e4] * 40)]
    return rows + rows[295:365] + [(5, [0.25] * 40)]  # repeated rows, and another vector of an id


@pytest.mark.parametrize("k", [1, 5, 1000])
def test_top_k(spark, vectors, k):
    assert found(spark, vectors, k) == brute(vectors, lambda i: i is not None and i % 5 == 0, k)


def test_top_k_in_blocks(spark, vectors, monkeypatch):
    """Queries in several blocks, columns in many pieces, few seeds."""
    for name, value in (("QUERY_NUMBERS", 500), ("COLUMNS", 16), ("TOGETHER", 7), ("SEEDS", 3), ("BLOCK", 8)):
        monkeypatch.setattr(topk, name, value)
    assert found(spark, vectors, 5) == brute(vectors, lambda i: i is not None and i % 5 == 0, 5)


def test_top_k_large_numbers(spark):
    """Products beyond what doubles hold exactly; vectors whose scores may not fit in a long take no part."""
    rows = [(i, [float((i * 7919 + d * 104729) % 1_000_003) + i / 7 for d in range(20)]) for i in range(40)] + [(100, [1e300] * 20), (105, [3e7] * 20)]
    assert found(spark, rows, 4) == brute(rows[:-2], lambda i: i % 5 == 0, 4)


def test_top_k_edges(spark):
    assert found(spark, [], 5) == []
    assert found(spark, [(0, [1.0])], 5) == []
    assert found(spark, [(0, []), (3, []), (7, [])], 5) == [(0, 1, 3, 0), (0, 2, 7, 0)]
    assert found(spark, [(0, [1.0], "a", 1), (3, [2.0], "b", 2)], 5, "vec_id long, embedding array<float>, query_id string, score int") == [(0, 1, 3, 256 * 512)]


def test_candidates_are_left_out():
    """Most products of later dimensions are never made, where bounds are known and mass is in few dimensions."""
    rng = np.random.default_rng(1)
    vectors = np.floor(256 * rng.normal(size=(5000, 64)) * 0.9 ** np.arange(64)).astype(np.int64)
    seeds = topk.Queries(np.arange(20), vectors[:20], 5)
    seeds.meet(np.arange(4000, 4400), np.ascontiguousarray(vectors[4000:4400].T))
    own = topk.Queries(np.arange(20), vectors[:20], 5, seeds.bound)
    own.meet(np.arange(5000), np.ascontiguousarray(vectors.T))
    assert own.multiplied < 0.5 * 20 * vectors.size
    scores = vectors[:20] @ vectors.T
    for i in range(20):
        scores[i, i] = np.iinfo(np.int64).min
        assert own.scores[i].tolist() == sorted(scores[i].tolist(), reverse=True)[:5]
