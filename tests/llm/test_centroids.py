"""Delta Lloyd against the plain algorithm, and what it compares and sums."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import centroids

from ..conftest import DATA, agrees


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def plain(vectors, k, rounds):
    """{id: (cluster, distance)} and the centroids, with Python's whole numbers."""
    vectors = [(i, [int(np.floor(64 * np.float64(np.float32(e)))) for e in x]) for i, x in vectors]
    order = sorted(vectors, key=lambda v: (hashlib.sha256(f"1:{v[0]}".encode()).hexdigest(), v[1]))
    at = [x for _, x in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(at))

    for _ in range(rounds):
        own = [[] for _ in at]
        for _, x in vectors:
            own[nearest(x)[1]].append(x)
        at = [[sum(col) // len(some) for col in zip(*some, strict=True)] if some else c for some, c in zip(own, at, strict=True)]
    return sorted((i, nearest(x)[1], nearest(x)[0]) for i, x in vectors), at


@pytest.mark.parametrize("seed", range(3))
def test_plain_algorithm(spark, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 0.3, (3, 5))
    vectors = [(i, (middle[i % 3] + rng.normal(0, 0.05 + seed / 10, 5)).tolist()) for i in range(60)]
    vectors += [(7, vectors[7][1])] * 30 + [(100 + i, [0.5] * 5) for i in range(4)]  # repeated rows, ties
    made, at = centroids.cluster(centroids.whole(frame(spark, [(*v, 0) for v in vectors]).repartition(3), dims=5), k=6, rounds=4)
    want, last = plain(vectors, 6, 4)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in made.collect()) == want
    assert at.tolist() == last


def test_only_moved_centroids_are_compared():
    x = np.array([[0, 0], [10, 0], [4, 0]])
    at = np.array([[0, 0], [10, 0], [5, 0]])
    owner, distance = centroids.compared(x, np.array([0, 1, 0]), np.array([0, 0, 16]), at, np.array([2]))
    assert owner.tolist() == [0, 1, 2] and distance.tolist() == [0, 0, 1]
    # a stale distance of an unmoved owner is trusted, so nothing but the moved centroid was looked at
    owner, distance = centroids.compared(x, np.array([0, 1, 0]), np.array([0, 0, 0]), at, np.array([2]))
    assert owner.tolist() == [0, 1, 0] and distance.tolist() == [0, 0, 0]
    # vectors of a moved owner are compared with all
    owner, _ = centroids.compared(x, np.array([2, 2, 2]), np.zeros(3, int), at, np.array([2]))
    assert owner.tolist() == [0, 1, 2]


def test_transfers_are_signed(spark):
    rows = [(1, [1, 2], 1, 0, 0, True), (2, [3, 4], 1, 0, -1, True), (3, [9, 9], 0, 0, 0, False)]
    sums, counts = centroids._transfers(spark.createDataFrame(rows, centroids.STATE), 2, 2)
    assert sums.tolist() == [[-1, -2], [4, 6]] and counts.tolist() == [-1, 2]


def test_what_is_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, 0.2], 0), (2, None, 0), (3, [0.1], 0), (4, [0.1, None], 0), (5, [nan, 0.1], 0), (6, [inf, 0.0], 0), (None, [0.3, 0.4], None)]
    vectors = frame(spark, rows).withColumn("cluster", F.lit("x")).withColumn("distance", F.lit("y"))
    made, at = centroids.cluster(centroids.whole(vectors, dims=2))
    assert sorted((r.vec_id or 0, r.cluster) for r in made.collect()) == sorted([(0, 1 - made.where("vec_id = 1").first().cluster), (1, made.where("vec_id = 1").first().cluster)])
    assert len(at) == 2
    got = centroids.digest(made, at).collect()
    assert len(got) == 2 and all(r.inertia == r.distance == 0 for r in got)
    none, at = centroids.cluster(centroids.whole(frame(spark, []), dims=2))
    assert centroids.digest(none, at).count() == 0 and len(at) == 0
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(centroids.whole(frame(spark, [(1, [1e30, 0.0], 0)]), dims=2))


def test_sql(spark, duck):
    from gridloom.llm import queries

    agrees(spark, duck, queries.op13_centroids, queries.ORACLE_SQL["op13_centroids"], DATA)
