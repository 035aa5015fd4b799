"""Centroid clustering against plain Lloyd rounds in Python integers."""

import math
import os
import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from marquee.llm import centroids

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, own int, v string, cluster int, centroid string, distance string"


def plain(rows, k=40, rounds=5):
    kept = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    at = [r[1] for r in first]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(at)) for _, v in kept]

    for _ in range(rounds):
        own = nearest()
        for j in range(len(at)):
            mine = [v for (_, v), (_, o) in zip(kept, own) if o == j]
            if mine:
                at[j] = tuple(sum(c) // len(mine) for c in zip(*mine))
    own = nearest()
    inertia = Counter()
    for d, j in own:
        inertia[j] += d
    return Counter((i, j, d, inertia[j], sum(inertia.values()), at[j]) for (i, _), (d, j) in zip(kept, own))


def found(spark, rows):
    df = spark.createDataFrame([(i, v, 1, "v", 2, "c", "d") for i, v in rows], SCHEMA).repartition(3)
    return Counter((*r[:5], tuple(r[5])) for r in centroids.cluster_vectors(df).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid").collect())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    got = found(spark, rows)
    assert got == plain(rows) and len(got) == len(rows)


def test_awkward_rows(spark):
    rng = random.Random(2)
    vector = lambda: [rng.choice([-1.5, -0.25, 0.0, 0.5, 1.0]) for _ in range(64)]
    same = vector()
    rows = [(i, vector()) for i in range(60)] + [(100 + i, same) for i in range(30)] + [(7, vector()), (7, same), (None, same), (None, vector())]
    rows += [(200, None), (201, []), (202, vector()[:63]), (203, [*vector(), 1.0]), (204, [None, *vector()[1:]]), (205, [float("nan"), *vector()[1:]]),
             (206, [float("inf"), *vector()[1:]])]
    assert found(spark, rows) == plain(rows)
    for some in ([], rows[:1], rows[:12], rows[60:90], rows[-7:]):
        assert found(spark, some) == plain(some)


def test_too_large_components_raise(spark):
    with pytest.raises(ArithmeticError):
        found(spark, [(1, [1e30] * 64)])


def test_ties_and_skipped_distances():
    """Vectors on a small grid tie often; the search must still choose the smaller number, with less work than a full scan."""
    rng = np.random.default_rng(3)
    for spread, k in ((2, 9), (3, 40), (50, 40), (50, 2), (4, 1)):
        blobs = rng.integers(-spread, spread, (k, 6))
        v = (blobs[rng.integers(0, k, 600)] * 4 + rng.integers(-2, 3, (600, 6))).astype(np.int64)
        at = v[:k].copy()
        state = (np.zeros(600, np.int32), np.full(600, min(1, k - 1), np.int32), np.full(600, np.inf), np.zeros(600))
        before, work = None, 0
        for _ in range(6):
            *state, done = centroids.assign(v, *state, centroids.Geometry(at, before))
            work += done
            full = ((v[:, None, :] - at[None]) ** 2).sum(axis=2)
            assert (state[0] == full.argmin(axis=1)).all()
            assert (np.sqrt(full[np.arange(600), state[0]]) <= state[2]).all() or k == 1
            before, at = at, np.array([v[state[0] == j].sum(axis=0) // max(1, (state[0] == j).sum()) if (state[0] == j).any() else at[j] for j in range(k)])
        assert work < 600 * k * 6 or k <= 2
        if spread == 50 and k == 40:
            assert work < 600 * k * 6 / 3
