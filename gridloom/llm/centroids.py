"""Centroid clustering by delta Lloyd, in whole numbers.

Vectors become whole numbers, floor(scale * x), and the first centroids are the
vectors whose ids have the least hashes.  Each round

1. compares vectors whose own centroid moved with all centroids, and all other
   vectors with the moved centroids only, as their distance to their own is known;
2. writes owner and distance of every vector to the shared folder, vectors that
   changed their owner in a partition of their own;
3. reads that partition alone and sums signed transfers, minus the vector for the
   old owner and plus for the new one, to the global sums kept so far.

The first round's transfers are all vectors, each from no owner.  Transfers are
added up in each task before they are shuffled: a task sends k * dims rows at most,
so a cluster that holds most vectors is no hot key.  The driver sees the k centroids
and their sums, k * dims numbers each; nothing else is collected.  Two rounds of the
table are kept at a time.

Sums are exact whole numbers, so results don't depend on the order of rows, and equal
those of the plain algorithm.

Edge cases.  Vectors that are null, have another number of components, or a null,
infinite or NaN component are left out.  A component beyond 2^27 after scaling raises:
squared distances wouldn't fit 64 bits.  Vectors without id count as having an empty
one.  Repeated rows are vectors of their own; of equal ids, the vector whose components
come first in order starts first.  With fewer vectors than k there are that many
centroids; an empty table gives an empty result.  Empty clusters keep their centroid.
Ties go to the smaller number.  Columns other than id and vector are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, stage, staged

K, ROUNDS, DIMS, SCALE = 16, 3, 64, 64
LIMIT = 1 << 27
#: was: the owner before the round (-1: none); moved: whether the owner changed.
STATE = "vec_id long, vector array<int>, cluster int, distance long, was int, moved boolean"
NAMES = [f.split()[0] for f in STATE.split(", ")]


def whole(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id and vector (whole numbers) of the vectors that count."""
    v = F.col(vector_col)
    number = lambda x: x.cast("double")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < F.lit(float("inf"))))
    scaled = lambda x: F.floor(number(x) * F.lit(float(scale)))
    fits = lambda x: F.abs(number(x) * F.lit(float(scale))) <= F.lit(float(LIMIT))
    checked = F.transform(v, lambda x: F.when(fits(x), scaled(x)).otherwise(F.raise_error(F.lit("a component is too large to be clustered in whole numbers"))).cast("int"))
    return vectors.where((F.size(v) == dims) & finite).select(F.col(id_col).cast("long").alias("vec_id"), checked.alias("vector"))


def first_centroids(whole_vectors: DataFrame, k: int = K) -> np.ndarray:
    """The k vectors whose ids have the least SHA-256 of ``1:<id>``, in that order: a bounded heap in each task."""
    named = F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = whole_vectors.select("vector", F.sha2(named, 256).alias("hash")).orderBy("hash", "vector").limit(k).collect()
    return np.array([r.vector for r in rows], np.int64).reshape(len(rows), len(rows[0].vector) if rows else 0)


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    off = x - centroid
    return np.einsum("ij,ij->i", off, off)


def compared(x: np.ndarray, owner: np.ndarray, distance: np.ndarray, centroids: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New owners and distances. moved: the numbers of the centroids that aren't what the distances were taken to."""
    again = np.isin(owner, moved) | (owner < 0)
    owner, distance = owner.copy(), distance.copy()
    owner[again], distance[again] = len(centroids), np.iinfo(np.int64).max
    for k, centroid in enumerate(centroids):
        some = np.arange(len(x)) if k in moved else np.flatnonzero(again)
        if len(some):
            d = _squared(x[some], centroid)
            better = (d < distance[some]) | (d == distance[some]) & (k < owner[some])
            owner[some[better]], distance[some[better]] = k, d[better]
    return owner, distance


def _assign(state: DataFrame, centroids: np.ndarray, moved: np.ndarray) -> DataFrame:
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(2).to_numpy().astype(np.int64)
            owner, distance = compared(_matrix(batch.column(1), dims), old, batch.column(3).to_numpy(), centroids, moved)
            made = [pa.array(owner, pa.int32()), pa.array(distance), pa.array(old, pa.int32()), pa.array(owner != old)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=NAMES)

    return state.select(NAMES[:4]).mapInArrow(run, STATE)


def _transfers(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """What vectors that changed their owner add to the sums (k x dims) and counts of the clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)  # the last column counts
        for batch in batches:
            x = np.pad(_matrix(batch.column(0), dims), ((0, 0), (0, 1)), constant_values=1)
            to, since = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for j in range(k):
                total[j] += x[to == j].sum(0) - x[since == j].sum(0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.ravel()[at])], names=["place", "added"])

    sums = np.zeros(k * (dims + 1), np.int64)
    rows = state.where("moved").select("vector", "cluster", "was").mapInArrow(run, "place long, added long")
    for r in rows.groupBy("place").agg(F.sum("added").alias("added")).collect():  # k * (dims + 1) rows at most
        sums[r.place] = r.added
    sums = sums.reshape(k, dims + 1)
    return sums[:, :-1], sums[:, -1]


def cluster(whole_vectors: DataFrame, k: int = K, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """vec_id, vector, cluster and distance of every vector after so many rounds and a last assignment, and the centroids.

    The frame reads a table of the shared folder.
    """
    centroids = first_centroids(whole_vectors, k)
    none = whole_vectors.select("*", F.lit(-1).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    if not len(centroids):
        return none, centroids
    k, dims = centroids.shape
    sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
    state, moved = none, np.arange(k)
    for turn in range(rounds + 1):
        state = stage(_assign(state, centroids, moved), "owners", "moved")
        if turn:
            release(staged() - 2, staged() - 1)  # the round before
        if turn == rounds:
            break
        more, some = _transfers(state, k, dims)
        sums, counts = sums + more, counts + some
        new = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], centroids)
        moved = np.flatnonzero((new != centroids).any(1))
        centroids = new
    return state.select("vec_id", "vector", "cluster", "distance"), centroids


def digest(clustered: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance, and of its cluster the inertia and the centroid's SHA-256; inertia: of all vectors."""
    spark = clustered.sparkSession
    by = dict(clustered.groupBy("cluster").agg(F.sum("distance")).collect())  # k rows
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(j, by.get(j, 0), sum(by.values()), s) for j, s in enumerate(shas)]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return clustered.drop("vector").join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE) -> str:
    """The plain algorithm in DuckDB: every round compares all vectors with all centroids."""
    parts = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS INTEGER) AS k, x FROM v QUALIFY k < {k})""",
    ]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT row_id, any_value(vec_id) AS vec_id, any_value(v.x) AS x, arg_min(k, (d, k)) AS k, min(d) AS d
  FROM (SELECT v.row_id, v.vec_id, v.x, c.k, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{r} c) v
  GROUP BY row_id)""")
        if r < rounds:
            parts.append(f"""s{r} AS (
  SELECT k, i, sum(e) AS s, count(*) AS n FROM (SELECT k, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY k, i)""")
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT k, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{r} GROUP BY k) m ON m.k = c.k)""")
    return f"""WITH {", ".join(parts)}
SELECT a.vec_id, a.k AS "cluster", CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.k = a.k"""
