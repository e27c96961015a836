"""Centroid clustering of integer vectors, the nearest centroid found by the
threshold algorithm.

Per dimension the centroids' values are a sorted list.  A vector walks each
list outward from its own value; a centroid met for the first time, in any
list, gets its exact distance.  No centroid that is still unmet is nearer than
the sum of the squared steps to the next value of every list, so the walk ends
when that sum strictly exceeds the best exact distance (an equal one might
hide a tie).

Spark holds the vectors, cleaned once and written to the shared folder.  A
round is one pass over them: every task assigns its vectors and gives per
centroid the number, the sums and the summed distances, ``k`` rows a task, that
Spark adds up.  The driver sees centroids only, ``k`` times the dimensions,
whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelic.llm.common import stored

DIMENSIONS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, "3"
#: Larger components would let a squared distance pass 63 bits.
LARGEST = 2 ** 27
#: Vectors that walk together.
ROWS = 2048
_FAR = np.iinfo(np.int64).max
#: Farther than any step between components.
_END = 8 * LARGEST


class CentroidLists:
    """Per dimension the centroids in order of their value, between two ends
    that are farther than any value."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k, dims = centroids.shape
        self.order = np.argsort(centroids, axis=0, kind="stable")
        values = np.take_along_axis(centroids, self.order, axis=0)
        end = np.full((1, dims), _END)
        self.values = np.concatenate([-end, values, end])
        self.dim = np.arange(dims)

    def _steps(self, x: np.ndarray, below: np.ndarray, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Steps to the next value on either side; ``below`` and ``above`` are
        its places, counted from the lower end."""
        flat, dims = self.values.ravel(), len(self.dim)
        return x - flat.take(below * dims + self.dim), flat.take(above * dims + self.dim) - x

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of each vector, the smaller number among equals,
        and its squared distance."""
        k, dims = self.centroids.shape
        best, who = np.empty(len(vectors), np.int64), np.empty(len(vectors), np.int64)
        walking, x = np.arange(len(vectors)), vectors
        above = np.empty(vectors.shape, np.int64)
        for d in range(dims):
            above[:, d] = np.searchsorted(np.ascontiguousarray(self.values[:, d]), vectors[:, d])
        below = above - 1
        met = np.zeros((len(vectors), k), bool)
        exact = np.full((len(vectors), k), _FAR, np.int64)
        while len(walking):
            down, up = self._steps(x, below, above)
            lower = down <= up
            place = np.where(lower, below, above) - 1
            hit = np.zeros(len(walking) * k, bool)
            hit[np.arange(0, len(hit), k)[:, None] + self.order.ravel().take(place * dims + self.dim)] = True
            hit = hit.reshape(-1, k) & ~met
            for c in np.flatnonzero(hit.any(axis=0)):
                rows = np.flatnonzero(hit[:, c])
                away = x[rows] - self.centroids[c]
                exact[rows, c] = np.einsum("ij,ij->i", away, away)
            met |= hit
            nearest = exact.min(axis=1)
            ended = met.all(axis=1)
            go = np.flatnonzero(~ended)  # the others have met every centroid
            if len(go):
                below, above = below[go] - lower[go], above[go] + ~lower[go]
                next_ = np.minimum(*self._steps(x[go], below, above))
                far = (next_ ** 2).sum(axis=1) > nearest[go]
                ended[go[far]] = True
                go, below, above = go[~far], below[~far], above[~far]
            done = walking[ended]
            best[done], who[done] = nearest[ended], exact[ended].argmin(axis=1)
            walking, x, met, exact = walking[go], x[go], met[go], exact[go]
        return who, best


def clean_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                  dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, v (integers): vectors of ``dimensions`` components, none null or
    not finite, each component ``floor(scale * x)``.  A finite component of
    ``LARGEST`` or more (after scaling) is an error: its squares pass a long."""
    x = F.col(vector_col)
    whole = (F.size(x) == dimensions) & F.forall(
        x, lambda e: F.coalesce(F.abs(e.cast("double")) < F.lit(float("inf")), F.lit(False)))
    scaled = F.transform(x, lambda e: F.floor(e.cast("double") * F.lit(float(scale))))
    checked = F.when(F.exists(scaled, lambda e: F.abs(e) >= LARGEST), F.raise_error(F.concat(
        F.lit("a component is too large to cluster, vector "), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))).otherwise(scaled)
    return embeddings.filter(F.coalesce(whole, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), checked.alias("v"))


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, seed: str = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of their ids (equal ids: the
    smaller vector), in that order; fewer, if there are fewer."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _parts(batch: pa.RecordBatch, lists: CentroidLists) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, vectors, centroid, distance) of some rows at a time."""
    dims = lists.centroids.shape[1]
    for begin in range(0, batch.num_rows, ROWS):
        part = batch.slice(begin, ROWS)
        flat = pc.list_flatten(part.column(1)).to_numpy(zero_copy_only=False)
        vectors = np.ascontiguousarray(flat, np.int64).reshape(-1, dims)
        yield part.column(0), vectors, *lists.nearest(vectors)


def _round(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    lists, (k, dims) = CentroidLists(centroids), centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, v, who, _ in _parts(batch, lists):
                order = np.argsort(who, kind="stable")
                met, first = np.unique(who[order], return_index=True)
                total[met] += np.add.reduceat(v[order], first, axis=0)
                number += np.bincount(who, minlength=k)
        used = np.flatnonzero(number)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(number[used], pa.int64()), pa.array(total[used].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "total"])

    parts = vectors.mapInArrow(sums, "cluster int, n long, total array<long>")
    one = parts.select("cluster", "n", F.posexplode("total").alias("dim", "x"))
    rows = one.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()  # k times dimensions at most
    after = centroids.copy()
    for r in rows:
        after[r["cluster"], r["dim"]] = r["x"] // r["n"]
    return after


def cluster(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = CENTROIDS,
            rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector after ``rounds``
    rounds, as a written table, and the centroids it was assigned to.

    Rows that repeat an id are clustered each for itself; a null id draws as an
    empty one.  Without any kept vector there are no centroids and no rows.
    Rounds that would change nothing are left out.
    """
    vectors = stored(clean_vectors(embeddings, id_col, vector_col, dimensions, scale), "vectors")
    centroids = first_centroids(vectors, k, seed).reshape(-1, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        after = _round(vectors, centroids)
        if np.array_equal(after, centroids):
            break
        centroids = after
    lists = CentroidLists(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, who, best in _parts(batch, lists):
                yield pa.RecordBatch.from_arrays([ids, pa.array(who, pa.int32()), pa.array(best, pa.int64())],
                                                 names=["vec_id", "cluster", "distance"])

    return stored(vectors.mapInArrow(assign, "vec_id long, cluster int, distance long"), "clusters"), centroids


def cluster_digest(embeddings: DataFrame) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, the summed distances
    of its cluster and of all, and the digest of its centroid."""
    found, centroids = cluster(embeddings)
    spark = found.sparkSession
    digests = spark.createDataFrame(
        [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())],
        "_c int, centroid_sha256 string")
    # k rows
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    inertia = inertia.join(F.broadcast(digests), F.col("cluster") == F.col("_c")).select("_c", "cluster_inertia", "centroid_sha256")
    total = found.select(F.sum("distance")).scalar()
    return (found.join(F.broadcast(inertia), F.col("cluster") == F.col("_c"))
            .select("vec_id", "cluster", "distance", "cluster_inertia", total.alias("inertia"), "centroid_sha256"))


def _oracle() -> str:
    steps = ["""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = 64
  AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = 64)""",
             """v AS MATERIALIZED (SELECT r, generate_subscripts(embedding, 1) AS d,
  CAST(floor(1024 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM kept)""",
             """picked AS (SELECT r, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR))) - 1 AS c FROM kept
  QUALIFY c < 8)""",
             "c0 AS MATERIALIZED (SELECT c, d, x FROM picked JOIN v USING (r))"]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, c, dist FROM (SELECT r, c, sum((v.x - k.x) * (v.x - k.x)) AS dist
  FROM v JOIN c{i} k USING (d) GROUP BY r, c) QUALIFY row_number() OVER (PARTITION BY r ORDER BY dist, c) = 1)""")
        if i < ROUNDS:
            steps.append(f"""s{i} AS (SELECT c, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM v JOIN a{i} USING (r) GROUP BY c, d)""")
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT k.c, k.d, CASE WHEN n IS NULL THEN k.x
  ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{i} k LEFT JOIN s{i} USING (c, d))""")
    return f"""WITH {', '.join(steps)},
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS digest FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
       CAST(sum(dist) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(dist) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM a{ROUNDS} JOIN kept USING (r) JOIN h USING (c)"""


ORACLE = _oracle()
