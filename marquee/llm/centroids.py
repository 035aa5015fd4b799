"""Centroid clustering: exact Lloyd rounds in whole numbers, with Shallot search for the nearest centroid.

Method: a vector's components become floor(256 * x), so distances and means are exact. Between rounds every
vector remembers its centroid, the second-nearest one, an upper bound for its distance to the first and a
lower bound for its distance to all others. Centroids move; the bounds are widened by how far.

* A vector whose upper bound stays below the lower bound, or below half the way from its centroid to the
  nearest other one, keeps its centroid without any distance.
* Otherwise the distances to the remembered two are computed, and the search starts from the closer one.
* The other centroids are scanned in the order of their distance from it. By the triangle inequality only
  those in a ball can matter whose radius is the distance to the start plus the second-least distance so
  far; each survivor can lower the latter, so the ball shrinks while the scan goes on, and the scan ends at
  its edge.
* Bounds are floating-point numbers rounded outwards; survivors are compared by exact squared distances in
  whole numbers, ties by the smaller centroid number.

Centroids (k x 64 numbers) travel with the tasks; sums and counts are added up in Spark. Each round is a
written table, so a lost executor costs one round's partition at most. No vector is shuffled.

Defined cases: rows without a vector, with another number of components, or with a null or non-finite one
are left out; repeated rows and ids are vectors of their own; a null id hashes as an empty number; fewer
than k kept vectors give as many centroids as there are; ties between starting vectors of one hash follow
their components; an empty table gives an empty table; columns other than vec_id and embedding are not
read. Components above 2^27 after scaling would overflow a distance and raise an ArithmeticError.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from marquee.sources.scratch import keep

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED_TEXT = "2:"
WIDEST = 1 << 27
SLACK = 1e-9  # relative, far above the rounding of 64 squares and a root
STATE = "vec_id {0}, v array<int>, own int, second int, upper double, lower double"


def whole_vectors(vectors: DataFrame, width: int = WIDTH) -> DataFrame:
    """vec_id and v, the whole-number components of the rows that have a full finite vector."""
    x = F.col("embedding").cast("array<double>")
    sound = F.coalesce((F.size(x) == width) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))), F.lit(False))
    return vectors.filter(sound).select("vec_id", F.transform(x, lambda c: F.floor(c * SCALE)).alias("v"))


def starting_centroids(whole: DataFrame, k: int = CENTROIDS) -> np.ndarray:
    """The k vectors of least sha256 of the seed text and their id, in that order."""
    mark = F.sha2(F.concat(F.lit(SEED_TEXT), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = whole.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()  # k rows
    return np.array([r["v"] for r in rows], dtype=np.int64) if rows else np.zeros((0, WIDTH), dtype=np.int64)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of v and c (or of v and one row)."""
    d = v - c
    return np.einsum("ij,ij->i", d, d)


class Geometry:
    """What a round needs of its centroids: distances between them, the order of neighbours, the moves since before."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None):
        self.centroids = centroids
        k = len(centroids)
        between = np.sqrt(np.stack([squared(centroids, c) for c in centroids]).astype(np.float64))
        self.order = np.argsort(between, axis=1, kind="stable")
        # the centroid itself comes first, also before an equal one of a smaller number
        self.order = np.array([[i, *[j for j in row if j != i]] for i, row in enumerate(self.order.tolist())])
        self.near = np.take_along_axis(between, self.order, axis=1) * (1 - SLACK)
        self.half = self.near[:, 1] / 2 if k > 1 else np.full(k, np.inf)
        moves = np.zeros(k) if before is None else np.sqrt(squared(centroids, before).astype(np.float64)) * (1 + SLACK)
        self.moves = moves
        # the largest move of any other centroid
        first = int(np.argmax(moves))
        rest = np.delete(moves, first).max(initial=0.0)
        self.others = np.full(k, moves[first])
        self.others[first] = rest


def assign(v: np.ndarray, own: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray, geo: Geometry):
    """New (own, second, upper, lower) of the vectors, and the number of exact distances computed."""
    own, second = own.copy(), second.copy()
    upper = upper + geo.moves[own]
    lower = lower - geo.others[own]
    if len(geo.centroids) == 1:
        return own, second, upper, lower, 0
    todo = np.flatnonzero(~(upper < np.maximum(lower, geo.half[own])))
    work = len(todo)
    d1 = squared(v[todo], geo.centroids[own[todo]])
    upper[todo] = np.sqrt(d1.astype(np.float64)) * (1 + SLACK)
    still = ~(upper[todo] < np.maximum(lower[todo], geo.half[own[todo]]))
    todo, d1 = todo[still], d1[still]
    if not len(todo):
        return own, second, upper, lower, work
    x, a, b = v[todo], own[todo], second[todo]
    d2 = squared(x, geo.centroids[b])
    work += len(todo)
    closer = (d2 < d1) | ((d2 == d1) & (b < a))
    a, b = np.where(closer, b, a), np.where(closer, a, b)
    d1, d2 = np.where(closer, d2, d1), np.where(closer, d1, d2)
    start, other = a.copy(), b.copy()
    reach = np.sqrt(d1.astype(np.float64)) * (1 + SLACK)
    ball = reach + np.sqrt(d2.astype(np.float64)) * (1 + SLACK)
    alive = np.arange(len(todo))
    for rank in range(1, len(geo.centroids)):
        alive = alive[geo.near[start[alive], rank] <= ball[alive]]
        if not len(alive):
            break
        j = geo.order[start[alive], rank]
        new = j != other[alive]  # the remembered one is known already
        at, j = alive[new], j[new]
        if not len(at):
            continue
        d = squared(x[at], geo.centroids[j])
        work += len(at)
        best = (d < d1[at]) | ((d == d1[at]) & (j < a[at]))
        next_best = ~best & ((d < d2[at]) | ((d == d2[at]) & (j < b[at])))
        w = at[best]
        b[w], d2[w] = a[w], d1[w]
        a[w], d1[w] = j[best], d[best]
        w = at[next_best]
        b[w], d2[w] = j[next_best], d[next_best]
        ball[at] = reach[at] + np.sqrt(d2[at].astype(np.float64)) * (1 + SLACK)
    own[todo], second[todo] = a, b
    upper[todo] = np.sqrt(d1.astype(np.float64)) * (1 + SLACK)
    lower[todo] = np.sqrt(d2.astype(np.float64)) * (1 - SLACK)
    return own, second, upper, lower, work


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)


def _round(state: DataFrame, geo: Geometry, width: int, schema: str) -> DataFrame:
    """The state after every vector has looked for its nearest centroid."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(1), width)
            old = [batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4, 5)]
            own, second, upper, lower, _ = assign(v, *old, geo)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(own, pa.int32()), pa.array(second, pa.int32()), pa.array(upper), pa.array(lower)],
                names=["vec_id", "v", "own", "second", "upper", "lower"])

    return state.mapInArrow(run, schema)


def means(state: DataFrame, centroids: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Componentwise floor(sum / count) of each centroid's vectors; the old one where there are none."""
    sums = state.groupBy("own").agg(F.count("*").alias("n"), *[F.sum(F.col("v")[i].cast("bigint")).alias(f"s{i}") for i in range(width)])
    out = centroids.copy()
    for r in sums.collect():  # a row a centroid
        out[r["own"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return out


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH) -> tuple[DataFrame, np.ndarray]:
    """The final state (vec_id, v, own, ...) of every kept vector, and the centroids it refers to."""
    whole = whole_vectors(vectors, width)
    id_type = dict(vectors.dtypes)["vec_id"]
    schema = STATE.format(id_type)
    extreme = whole.agg(F.max(F.array_max(F.transform("v", lambda c: F.abs(c))))).first()[0]
    if extreme is not None and extreme > WIDEST:
        raise ArithmeticError("components are too large for whole-number distances")
    centroids, before = starting_centroids(whole, k), None
    second = 1 if len(centroids) > 1 else 0
    # without a round behind them vectors have no bounds: the first search starts from centroids 0 and 1
    state = whole.select("vec_id", F.col("v").cast("array<int>").alias("v"), F.lit(0).alias("own"), F.lit(second).alias("second"),
                         F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower"))
    if not len(centroids):
        return state, centroids
    for _ in range(rounds):
        state = keep(_round(state, Geometry(centroids, before), width, schema), "state")
        before, centroids = centroids, means(state, centroids, width)
    return keep(_round(state, Geometry(centroids, before), width, schema), "state"), centroids


def cluster_vectors(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid (its components)."""
    spark = vectors.sparkSession
    state, centroids = cluster(vectors, k, rounds, width)
    table = spark.createDataFrame([(i, c) for i, c in enumerate(centroids.tolist())], "own int, centroid array<bigint>")  # k rows
    away = F.zip_with(F.col("v").cast("array<bigint>"), "centroid", lambda a, b: (a - b) * (a - b))
    found = keep(state.join(F.broadcast(table), "own").select(
        "vec_id", F.col("own").alias("cluster"), F.aggregate(away, F.lit(0).cast("bigint"), lambda s, x: s + x).alias("distance")), "distances")
    by_cluster = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # at most k rows
    total = sum(r["cluster_inertia"] for r in by_cluster)
    sums = {r["cluster"]: r["cluster_inertia"] for r in by_cluster}
    known = spark.createDataFrame([(i, sums[i], total, c) for i, c in enumerate(centroids.tolist()) if i in sums],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return found.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
