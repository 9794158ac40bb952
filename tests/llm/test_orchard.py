"""Orchard's search and the rounds of k-means against measuring everything."""

import hashlib
import math

import numpy as np
import pytest

from caseworks.llm import orchard
from caseworks.llm.orchard import Neighbours, clusters, moved


def brute_nearest(x, centroids):
    apart = ((x[:, None, :] - centroids[None, :, :]) ** 2).sum(2)
    return apart.argmin(1), apart.min(1)


@pytest.mark.parametrize("k", [1, 2, 8, 60])
def test_search_equals_measuring_all(k):
    rng = np.random.Generator(np.random.PCG64(k))
    for spread in (3, 400):
        x = rng.integers(-spread, spread, (3000, 5))
        centroids = rng.integers(-spread, spread, (k, 5))
        at, best, measured = Neighbours(centroids).nearest(x)
        expected, least = brute_nearest(x, centroids)
        assert (at == expected).all() and (best == least).all()
        assert measured <= len(x) * k
    centres = rng.integers(-10_000, 10_000, (k, 5)) if k > 1 else centroids
    near = centres[rng.integers(0, k, 3000)] + rng.integers(-20, 20, (3000, 5))
    _, _, measured = Neighbours(centres).nearest(near)
    assert k < 8 or measured < 0.8 * len(near) * k


def test_ties_go_to_the_smaller_number():
    centroids = np.array([[4, 0], [0, 0], [2, 2], [0, 0]])
    at, best, _ = Neighbours(centroids).nearest(np.array([[2, 0], [0, 0], [2, 1]]))
    assert at.tolist() == [0, 1, 2] and best.tolist() == [4, 0, 1]


def brute_clusters(rows, k, rounds, dims):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) for c in v] for _, v in kept], "int64").reshape(len(kept), dims)
    mark = [hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest() for i, _ in kept]
    order = sorted(range(len(kept)), key=lambda n: (mark[n], x[n].tolist()))[:k]
    centroids = x[order]
    for _ in range(rounds):
        at, _ = brute_nearest(x, centroids)
        centroids = np.array([x[at == c].sum(0) // (at == c).sum() if (at == c).any() else centroids[c] for c in range(len(centroids))])
    at, best = brute_nearest(x, centroids)
    own = [int(best[at == c].sum()) for c in range(len(centroids))]
    marks = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return sorted(((i, int(c), int(d), own[c], int(best.sum()), marks[c]) for (i, _), c, d in zip(kept, at, best, strict=True)), key=repr)


@pytest.mark.parametrize(("k", "rounds"), [(8, 10), (3, 0), (30, 2)])
def test_whole_runs(spark, k, rounds):
    rng = np.random.Generator(np.random.PCG64(9))
    rows = [(int(i), [float(c) for c in rng.normal(0, 1, 4).astype("float32")]) for i in range(300)]
    rows += [(300, rows[0][1]), (300, rows[0][1]), (None, rows[1][1]), (301, None), (302, [1.0, 2.0]), (303, [1.0, None, 2.0, 3.0])]
    rows += [(304, [1.0, float("nan"), 0.0, 0.0]), (305, [float("-inf"), 0.0, 0.0, 0.0]), (306, [-0.0] * 4), (307, [1.0] * 5)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster string").repartition(3)
    found = clusters(df, k=k, rounds=rounds, dims=4)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute_clusters(rows, k, rounds, 4)
    assert clusters(df.limit(0), dims=4).count() == 0
    few = brute_clusters(rows[:2], k, rounds, 4)
    assert sorted(map(tuple, clusters(df.filter("vec_id < 2"), k=k, rounds=rounds, dims=4).collect()), key=repr) == few


def test_empty_centroids_stay_and_large_components_are_refused(spark):
    centroids = np.array([[5, 5], [-9, 4]])
    assert moved(centroids, {0: (3, np.array([-4, 7]))}).tolist() == [[-2, 2], [-9, 4]]
    df = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="beyond"):
        orchard.clusters(df, dims=2).collect()
