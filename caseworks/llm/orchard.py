"""k-means over whole numbers, each vector finding its nearest centroid by Orchard's search.

Every centroid has a list of the others by rising distance. A vector starts at one centroid and walks its list. When it
meets a closer centroid (or an equally close one of smaller number) it goes on with that one's list from the start;
centroids it has measured are marked and passed over. It stops once the next centroid of the list lies strictly more than
twice the vector's distance away: by the triangle inequality nothing beyond can be as close. All comparisons are of squared
distances in 64-bit integers, so ties are exact. The walk advances all vectors of an Arrow batch together.

A round is one job: every task adds up its vectors by centroid, the sums are merged by (centroid, component), and k x
components numbers reach the driver. The vectors are scaled once and stored in the shared folder; no row is shuffled and a lost executor
repeats its tasks only. A centroid that holds a third of all rows is a sum like any other.

Kept are vectors with exactly ``dims`` components, none null or non-finite; null vectors are left out. A null id hashes as the empty
text behind the seed; equal hashes are ordered by components. Repeated rows count as often as they stand. With fewer vectors than
``k`` there are as many centroids as vectors; an empty table gives no rows. Other columns are ignored.
Components beyond 2**27 in size would not give exact sums of squares and are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.llm.common import map_batches, named, stored

SCALE = 1024
LARGEST = 1 << 27


def whole_numbers(vectors: DataFrame, dims: int = 64, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): kept vectors with their components as floor(``SCALE`` * component)."""
    value = named(vector)
    sound = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    scaled = F.transform(value, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))))
    checked = F.when(F.forall(scaled, lambda c: F.abs(c) <= LARGEST), scaled.cast("array<int>")).otherwise(
        F.raise_error(F.lit(f"a component is beyond {LARGEST // SCALE}")).cast("array<int>")
    )
    return vectors.filter(F.coalesce((F.size(value) == dims) & sound, F.lit(False))).select(named(id_col).alias("vec_id"), checked.alias("x"))


def first_centroids(points: DataFrame, k: int, seed: int = 3) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:id``, in that order."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = points.select(mark.alias("mark"), "x").orderBy("mark", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], "int64")


class Neighbours:
    """Centroids with their sorted neighbour lists and squared distances between them."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k = len(centroids)
        apart = np.array([((centroids - c) ** 2).sum(1) for c in centroids]).reshape(k, k)
        order = np.argsort(apart, axis=1, kind="stable")
        self.lists = np.array([[j for j in row if j != i] for i, row in enumerate(order.tolist())], "int64").reshape(k, k - 1)
        self.apart = np.take_along_axis(apart, self.lists, 1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid of each row, its squared distance, and the number of distances measured."""
        rows, k = len(x), len(self.centroids)
        at = np.zeros(rows, "int64")
        best = ((x - self.centroids[0]) ** 2).sum(1)
        measured = rows
        seen = np.zeros((rows, k), bool)
        seen[:, 0] = True
        place = np.zeros(rows, "int64")
        active = np.arange(rows if k > 1 else 0)
        while len(active):
            near = self.apart[at[active], place[active]] <= 4 * best[active]
            active = active[near]
            other = self.lists[at[active], place[active]]
            place[active] += 1
            fresh = ~seen[active, other]
            who, where = active[fresh], other[fresh]
            seen[who, where] = True
            distance = ((x[who] - self.centroids[where]) ** 2).sum(1)
            measured += len(who)
            closer = (distance < best[who]) | ((distance == best[who]) & (where < at[who]))
            jump, to = who[closer], where[closer]
            at[jump], best[jump], place[jump] = to, distance[closer], 0
            active = active[place[active] < k - 1]
        return at, best, measured


#: Rows of a batch that walk together.
TOGETHER = 8192


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims).astype("int64")


def _sums(points: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, np.ndarray]]:
    """Number and componentwise sum of the vectors of each centroid that has any."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Neighbours(centroids)
        totals, counts = np.zeros((k, dims), "int64"), np.zeros(k, "int64")
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            for start in range(0, len(x), TOGETHER):
                part = x[start : start + TOGETHER]
                at, _, _ = search.nearest(part)
                counts += np.bincount(at, minlength=k)
                for c in np.unique(at).tolist():
                    totals[c] += part[at == c].sum(0)
        held = np.flatnonzero(counts)
        columns = [pa.array(held), pa.array(counts[held]), pa.array(totals[held].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "total"])

    partial = points.select("x").mapInArrow(run, "cluster long, n long, total array<long>")
    cells = partial.select("cluster", "n", F.posexplode("total").alias("component", "total"))
    merged = cells.groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    found: dict[int, tuple[int, np.ndarray]] = {}
    for r in merged:
        found.setdefault(r["cluster"], (r["n"], np.zeros(dims, "int64")))[1][r["component"]] = r["total"]
    return found


def moved(centroids: np.ndarray, sums: dict[int, tuple[int, np.ndarray]]) -> np.ndarray:
    """Each centroid with vectors at the floor of their mean; the others where they were."""
    after = centroids.copy()
    for cluster, (n, total) in sums.items():
        after[cluster] = total // n
    return after


def assign(points: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of each vector of ``points``."""
    dims = centroids.shape[1]
    schema = T.StructType([points.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Neighbours(centroids)
        for batch in batches:
            for start in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(start, TOGETHER)
                at, best, _ = search.nearest(_matrix(part.column(1), dims))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(at.astype("int32")), pa.array(best)], names=schema.names)

    return map_batches(points.select("vec_id", "x"), run, schema)


def digest(centroid: np.ndarray) -> str:
    """sha256 of a centroid's components, joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def fit(points: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """Centroids after ``rounds`` rounds over ``points`` (vec_id, x); none without vectors."""
    centroids = first_centroids(points, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(centroids, _sums(points, centroids))
    return centroids


def clusters(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    points = stored(whole_numbers(vectors, dims, id_col, vector), "points")
    centroids = fit(points, k, rounds, seed)
    if not len(centroids):
        nothing = F.lit(None)
        return points.select(
            "vec_id", nothing.cast("int").alias("cluster"), nothing.cast("long").alias("distance"), nothing.cast("long").alias("cluster_inertia"),
            nothing.cast("long").alias("inertia"), nothing.cast("string").alias("centroid_sha256"),
        )
    found = stored(assign(points, centroids), "assigned")
    sums = {r["cluster"]: r["total"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    own = F.array(*[F.lit(sums.get(c, 0)).cast("long") for c in range(len(centroids))])
    marks = F.array(*[F.lit(digest(c)) for c in centroids])
    return found.select(
        "vec_id", "cluster", "distance", F.get(own, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"), F.get(marks, F.col("cluster")).alias("centroid_sha256"),
    )
