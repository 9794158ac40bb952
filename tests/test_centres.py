"""Nearest centre among any number, and the grouped second level, against plain versions."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from caseworks.operators import themes
from caseworks.operators.themes import _Centres, assign_nearest, grouped_kmeans, hierarchical_themes


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_nearest_of_many_centres(spark, metric, monkeypatch):
    rng = np.random.Generator(np.random.PCG64(4))
    x = rng.normal(0, 1, (60, 3))
    centres = np.round(rng.normal(0, 1, (50_000, 3)) * rng.uniform(0.1, 3, (50_000, 1)), 3)
    centres[7], centres[40_000] = x[0], x[0]  # a tie over blocks of other lengths
    monkeypatch.setattr(themes, "BLOCK_BYTES", 8 * 3 * 5_000)
    monkeypatch.setattr(themes, "CHAIN", 4)
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())] + [(99, None)], "id long, v array<double>").repartition(3)
    table = spark.createDataFrame([(i, v) for i, v in enumerate(centres.tolist())], "theme int, centre array<double>")
    found = {r["id"]: r for r in assign_nearest(rows, "id", "v", table, metric).collect()}
    if metric == "cosine":
        exact = 1 - (x @ centres.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(centres, axis=1))
    else:
        exact = np.sqrt(((x[:, None] - centres[None]) ** 2).sum(2))
    assert sorted(found) == list(range(60))
    for i in range(60):
        assert found[i]["distance"] == pytest.approx(exact[i].min(), abs=1e-7)
        assert exact[i, found[i]["theme"]] == pytest.approx(exact[i].min(), abs=1e-7)
    if metric == "euclidean":
        assert found[0]["theme"] == 7


def test_ties_go_to_the_smaller_name(spark, monkeypatch):
    rows = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 0.0])], "id long, v array<double>")
    table = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [0.0, 1.0]), ("c", [3.0, 0.0])], "theme string, centre array<double>")
    for size in (16, 1 << 20):
        monkeypatch.setattr(themes, "BLOCK_BYTES", size)
        got = {r["id"]: (r["theme"], r["distance"]) for r in assign_nearest(rows, "id", "v", table).collect()}
        assert got == {1: ("a", 1.0), 2: ("c", 0.0)}
    assert assign_nearest(rows, "id", "v", table.limit(0)).filter("theme is null").count() == 2


def plain_lloyd(x, starts, rounds=20):
    centres = starts.copy()
    for _ in range(rounds):
        at = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.array([x[at == c].mean(0) if (at == c).any() else centres[c] for c in range(len(centres))])
    return centres


def test_grouped_lloyd_equals_separate_fits(spark, monkeypatch):
    rng = np.random.Generator(np.random.PCG64(6))
    top = rng.integers(0, 6, 900)
    x = np.round(rng.normal(0, 1, (900, 4)) + rng.integers(0, 3, (900, 1)) * 4, 2) * (rng.random((900, 4)) < 0.8)
    rows = [(int(t), Vectors.dense(v) if i % 2 else Vectors.sparse(4, {j: e for j, e in enumerate(v) if e})) for i, (t, v) in enumerate(zip(top, x.tolist(), strict=True))]
    points = spark.createDataFrame(rows, ["theme_top", "_v"]).repartition(5)
    count = np.array([3, 2, 3, 1, 3, 2])
    starts = np.concatenate([x[top == t][: count[t]] for t in range(6)])
    for held in (1, 1 << 28):
        monkeypatch.setattr(themes, "HELD_SUMS", held)
        found = grouped_kmeans(points, _Centres(np.arange(6), count, starts), tolerance=0.0)
        for t in range(6):
            own = slice(found.first[t], found.first[t] + count[t])
            assert np.abs(found.values[own] - plain_lloyd(x[top == t], starts[own])).max() < 1e-9


def test_passes_do_not_grow_with_themes(spark):
    from test_training_passes import jobs_of

    counts = []
    for groups in (2, 40):
        rows = spark.range(800).select(
            F.col("id"), (F.col("id") % groups).cast("int").alias("top"),
            F.array((F.col("id") % 7).cast("double"), F.lit(1.0) * (F.col("id") % 3)).alias("v"),
        )
        found, jobs = jobs_of(spark, lambda: hierarchical_themes(rows, "id", "v", sub_k=2, min_sub=5, top="top").collect())
        assert len(found) == 800 and {r["theme_sub_local"] for r in found} == {0, 1}
        assert all(r["theme_sub_id"] == f"{r['theme_top']}.{r['theme_sub_local']}" for r in found)
        counts.append(jobs)
    assert counts[1] <= counts[0] + 60  # at most some more iterations, of three jobs each
