"""Centroid clustering against rounds over whole vectors in plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from varlake.llm import vafile
from varlake.llm.queries import op13_centroid_clustering


def brute(rows, count=16, rounds=3, size=64, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        own = [[] for _ in centroids]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(own, centroids)]
    found = [(i, nearest(v)) for i, v in kept]
    inertia = [sum(d for _, (d, j) in found if j == k) for k in range(len(centroids))]
    return sorted(((i, k, d, inertia[k], sum(inertia), hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()) for i, (d, k) in found), key=repr)


def run(spark, rows, parts=5, schema="vec_id long, embedding array<double>", **options):
    assigned, centroids, fetched = vafile.cluster(spark.createDataFrame(rows, schema).repartition(parts), **options)
    return sorted((tuple(r) for r in vafile.with_inertia(assigned, centroids).collect()), key=repr), fetched


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(13)
    middle = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [rng.gauss(x, 0.2) for x in rng.choice(middle)]) for i in range(600)]
    rows += [(700, None), (701, [None] * 8), (702, [math.nan] * 8), (703, [math.inf] * 8), (704, []), (705, [1.0] * 7), (706, [1.0] * 9), (None, [0.1] * 8), (707, [-40.0] * 8)]
    return rows + rows[:50] + [(3, [0.0] * 8)] * 3  # repeated rows


@pytest.mark.parametrize("bits", [1, 3, 6, 9])
def test_clusters(spark, vectors, bits):
    got, fetched = run(spark, vectors, count=7, size=8, bits=bits)
    assert got == brute(vectors, count=7, size=8)
    assert fetched[0] == len(got) and (bits < 6 or fetched[-1] < len(got) / 3)


def test_ties_and_empty_clusters(spark):
    """Equal vectors as several centroids: the smaller number takes all, the others keep their places."""
    rows = [(i, [float(i % 3), 1.0]) for i in range(60)]
    assert run(spark, rows, count=16, size=2, scale=4)[0] == brute(rows, count=16, size=2, scale=4)
    assert run(spark, rows[:2], count=16, size=2)[0] == brute(rows[:2], count=16, size=2)


def test_nothing_kept(spark, tmp_path):
    assert run(spark, [], size=3)[0] == [] and run(spark, [(1, None), (2, [1.0])], size=3)[0] == []
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op13_centroid_clustering(spark, str(tmp_path)).collect() == []


def test_clashing_columns_and_large_components(spark):
    rows = [(i, [i * 0.5, -i * 1000.0], "x", i) for i in range(30)] + [(31, [1e30, 0.0], "y", 0)]
    got = run(spark, rows, count=4, size=2, schema="vec_id long, embedding array<float>, cluster string, v int")[0]
    assert got == brute([r[:2] for r in rows[:-1]], count=4, size=2)


def test_cells():
    """A cell for each value where there are few; else rare values are joined, and cells cover all buckets in order."""
    few = np.array([0, 5, 0, 9, 1], np.int64)
    assert vafile.cells(few, -2, 1, 4).tolist() == [-1, 1, 2]
    many = np.array([1, 1, 1, 100, 100, 100, 1, 1], np.int64)
    assert {3, 4, 5} <= set(vafile.cells(many, 0, 1, 5).tolist())
    rng = np.random.default_rng(2)
    v = rng.integers(-300, 300, (500, 3))
    low, high = v.min(0), v.max(0)
    own = vafile.Grid([vafile.cells(np.bincount(v[:, d] - low[d], minlength=1024), int(low[d]), 1, 8) for d in range(3)], low, high, 3)
    cells = own.unpack(own.pack(v))
    assert all((own.low[d, cells[:, d]] <= v[:, d]).all() and (v[:, d] <= own.high[d, cells[:, d]]).all() for d in range(3))
    centroids = v[:9]
    least, most = (sum(t[d][cells[:, d]] for d in range(3)) for t in own.tables(centroids))
    exact = vafile.distances(v, centroids)
    assert (least <= exact).all() and (exact <= most).all()
    near, unknown = own.nearest(cells, own.tables(centroids))
    assert (near == exact.argmin(1))[~unknown].all()
