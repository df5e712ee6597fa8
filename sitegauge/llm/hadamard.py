"""Centroid clustering of integer vectors with a Walsh-Hadamard progressive search.

Vectors and centroids are turned by the Walsh-Hadamard transform, which is exact in integers and multiplies
squared distances by its size.  A vector's coefficient differences are summed up from coarse to fine; the centroid
that leads after the coarse ones is finished first, and every centroid whose sum is already larger is dropped.  All 64
coefficients of those that remain are finished, so distances are exact.

A round sends the centroids to the tasks and brings back counts and sums per centroid, merged on the executors.
Integers are 64 bits wide where nothing can overflow, of any size elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import staged

SIZE, CENTROIDS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
#: Coefficients that are summed up in one step, coarse to fine.
STEPS = (4, 8, 16, 32, 64)
#: Components below this size keep the transformed squared distance under 2**63.
NARROW = 2**24
VECTORS = 4_096  # searched at once
SHARES = 32  # partial sums of a centroid are merged in so many groups
LARGEST = 2**63 - 1


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) exactly: 64-bit integers, or Python's where some are large."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * scale)
    if np.abs(scaled).max(initial=0) < NARROW:
        return scaled.astype(np.int64)
    out = np.empty(x.shape, object)
    for place, v in np.ndenumerate(x):
        n, d = float(v).as_integer_ratio()
        out[place] = scale * n // d
    return out


def sequency(size: int = SIZE) -> np.ndarray:
    """Rows of the transform by number of sign changes: coarse to fine."""
    return np.argsort([int((np.diff(row) != 0).sum()) for row in transform(np.eye(size, dtype=np.int64))], kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row by butterflies: additions and subtractions only."""
    n, size = x.shape
    half = 1
    while half < size:
        pairs = x.reshape(n, size // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return x


_ORDER = sequency()


def coefficients(x: np.ndarray) -> np.ndarray:
    return transform(x)[:, _ORDER]


@dataclass
class Centroids:
    """values: centroids x SIZE, exact integers."""

    values: np.ndarray

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row, and how many centroids each row finished."""
        if x.dtype != self.values.dtype:
            x, c = x.astype(object), self.values.astype(object)
        else:
            c = self.values
        mine, theirs = coefficients(x), coefficients(c)
        n, k = len(x), len(c)
        row, centroid = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
        total = np.zeros(n * k, mine.dtype)
        at, bound = 0, None
        for end in STEPS:
            total = total + self._more(mine, theirs, row, centroid, at, end)
            at = end
            if bound is None:
                leader = total.reshape(n, k).argmin(1)
                bound = self._more(mine, theirs, np.arange(n), leader, 0, SIZE)
            if end < SIZE:
                alive = total <= bound[row]
                row, centroid, total = row[alive], centroid[alive], total[alive]
        least = np.minimum.reduceat(total, np.searchsorted(row, np.arange(n))) if n else total
        best = np.full(n, k)
        hit = total == least[row]
        np.minimum.at(best, row[hit], centroid[hit])
        return best, least // SIZE, np.bincount(row, minlength=n)

    @staticmethod
    def _more(mine, theirs, row, centroid, start, end) -> np.ndarray:
        d = mine[row, start:end] - theirs[centroid, start:end]
        return (d * d).sum(1)

    def hashes(self) -> list[str]:
        return [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in self.values]


def tidy(values: list[list[int]]) -> Centroids:
    """Centroids in 64-bit integers where that is safe."""
    narrow = all(abs(v) < NARROW for c in values for v in c)
    made = np.empty((len(values), SIZE), np.int64 if narrow else object)
    for k, c in enumerate(values):
        made[k] = c
    return Centroids(made)


def usable(embedding):
    """SIZE components, all finite numbers."""
    limit = F.lit(float("inf"))
    finite = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < limit))
    return F.coalesce((F.size(embedding) == SIZE) & finite, F.lit(False))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Small parts of the batches with their vectors as integers; column 1 holds the vectors."""
    for batch in batches:
        for at in range(0, batch.num_rows, VECTORS):
            part = batch.slice(at, VECTORS)
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            yield part, integers(flat.reshape(part.num_rows, SIZE))


def _sums(rows: DataFrame, centroids: Centroids) -> dict[int, tuple[int, list[int]]]:
    """Count and component sums of each centroid's vectors."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids.values)
        count, total = np.zeros(k, np.int64), np.zeros((k, SIZE), object)
        for _, x in _matrices(batches):
            cluster, _, _ = centroids.nearest(x)
            count += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                total[c] = total[c] + x[cluster == c].sum(0)  # exact: a part has few rows
        some = np.flatnonzero(count)
        share = TaskContext.get().partitionId() % SHARES
        yield pa.RecordBatch.from_arrays([
            pa.array(some, pa.int32()), pa.array([share] * len(some), pa.int32()), pa.array(count[some], pa.int64()),
            pa.array([[str(v) for v in total[c]] for c in some], pa.list_(pa.string()))], names=["cluster", "share", "count", "total"])

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        total = [0] * SIZE
        for one in group["total"]:
            total = [a + int(b) for a, b in zip(total, one, strict=True)]
        return pd.DataFrame({"cluster": [group["cluster"].iloc[0]], "count": [group["count"].sum()], "total": [[str(v) for v in total]]})

    parts = rows.mapInArrow(partial, "cluster int, share int, count bigint, total array<string>")
    found: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("cluster", "share").applyInPandas(merged, "cluster int, count bigint, total array<string>").collect():
        n, total = found.get(r["cluster"], (0, [0] * SIZE))
        found[r["cluster"]] = (n + r["count"], [a + int(b) for a, b in zip(total, r["total"], strict=True)])
    return found


def start(rows: DataFrame, centroids: int, seed: int) -> Centroids:
    """The vectors with the smallest hashes of seed and id, in the order of their hashes."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.select(digest.alias("h"), "embedding").orderBy("h", "embedding").limit(centroids).collect()
    return tidy([[int(v) for v in integers(np.array([r["embedding"]], np.float64))[0]] for r in first])


def cluster(embeddings: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, finished of every vector that is kept.

    Kept are vectors with exactly 64 components, none of them null or not finite; all others have no row.  Fewer
    vectors than centroids give as many centroids.  Repeated rows are vectors of their own; a null vec_id is hashed as an empty
    one; equal hashes at the start stand in the order of their vectors.  Distances and their sums beyond 64 bits are
    given as the largest 64-bit integer.  An empty table gives no rows; other columns are ignored.  `finished` tells with
    how many centroids the search went to the end.
    """
    spark = embeddings.sparkSession
    rows = embeddings.where(usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = staged(rows, "vectors")
    current = start(rows, centroids, seed)
    for _ in range(rounds if len(current.values) else 0):
        found = _sums(rows, current)
        current = tidy([[s // found[k][0] for s in found[k][1]] if k in found else [int(v) for v in c] for k, c in enumerate(current.values)])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches):
            number, distance, finished = current.nearest(x)
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(number, pa.int32()), pa.array([min(int(d), LARGEST) for d in distance], pa.int64()), pa.array(finished, pa.int32())],
                names=["vec_id", "cluster", "distance", "finished"])

    assigned = staged(rows.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint, finished int"), "clusters")
    inertia = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole = min(sum(inertia.values()), LARGEST)
    facts = spark.createDataFrame(
        [(k, min(inertia.get(k, 0), LARGEST), whole, digest) for k, digest in enumerate(current.hashes())],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(facts, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "finished")


def _oracle() -> str:
    """The same by comparing every vector with every centroid, component by component."""
    def assign(k: int) -> str:
        return f"""a{k} AS (SELECT vec_id, any_value(e) AS e, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
    SELECT v.vec_id, v.e, c.k, list_sum(list_transform(range(1, {SIZE + 1}), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i])))::BIGINT AS d FROM v, c{k} AS c) GROUP BY vec_id)"""

    def move(k: int) -> str:
        return f"""c{k + 1} AS (SELECT c.k, coalesce(m.e, c.e) AS e FROM c{k} AS c LEFT JOIN (SELECT k, list(m ORDER BY i) AS e FROM (
    SELECT k, i, floor(sum(x) / count(*))::BIGINT AS m FROM (SELECT k, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{k}) GROUP BY k, i) GROUP BY k) AS m USING (k))"""

    rounds = ",\n".join(f"{assign(k)},\n{move(k)}" for k in range(ROUNDS))
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
    WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {SIZE}),
c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS k, e FROM (SELECT e, sha256('{SEED}:' || vec_id::VARCHAR) AS h FROM v ORDER BY h LIMIT {CENTROIDS})),
{rounds},
{assign(ROUNDS)}
SELECT vec_id, a.k::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.k)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
    sha256(array_to_string(c.e, ',')) AS centroid_sha256 FROM a{ROUNDS} AS a JOIN c{ROUNDS} AS c USING (k)
"""


ORACLE = _oracle()
