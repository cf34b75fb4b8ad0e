"""Exact k-means over whole-number vectors with heaps of expiring bounds.

Every vector stands in a heap of its cluster. Its key is the gap between a lower
bound of the distance to all other centroids and an upper bound of the distance to
its own, plus the cluster's drift so far. When the centroids move, a gap shrinks at
most by its own centroid's move and the largest move of another one; that sum is
added to the cluster's drift, once for the whole heap. The vectors whose key is not
above the drift are popped and measured against all centroids; all others keep
their cluster without being looked at.

Heaps are rows of a written table: one row per run of at most BLOCK vectors of a
cluster, with keys in ascending order (a sorted array is a heap), the vectors, and
their sum. A pass reads one table and writes the next, so a lost executor costs its
tasks only; new centroids come from the sums and counts, not from the vectors.

Distances are sums of squares of whole numbers and exact, centroids are exact floors
of means. Bounds are doubles, widened by their rounding error, so an expiry may come
early but never late. Equal distances go to the smaller number: they make a gap of
0, which is always popped.

Defined results:

- vectors of another length, null ones, and those with a null or non-finite
  component are left out; null ids are kept and hash as an empty id;
- scaled components are clipped (at +-2^27 for 64 components), so that distances and
  sums stay in 64 bits;
- repeated rows count one by one; with fewer vectors than ``k`` there are as many
  clusters as vectors, and an empty table gives no rows;
- a cluster that loses all its vectors keeps its centroid.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

#: Vectors of a heap row at most.
BLOCK = 4_096
#: Relative widening of bounds, far above the rounding of a square root and a few sums.
SLACK = 1e-12
#: Widths that vectors are stored in, by their largest component.
_WIDTHS = (np.int8, np.int16, np.int32)

_HEAP = ("cluster int, n long, popped long, sums array<long>, ids binary, keys binary, "
         "width int, vectors binary")


# --- exact distances -----------------------------------------------------------

def clip_at(dim: int) -> int:
    """The largest power of two whose squared distances fit 63 bits."""
    return 1 << ((62 - (dim - 1).bit_length()) // 2 - 1)


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number rows (n x k)."""
    top = int(max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)))
    if 4 * top * top * centroids.shape[1] < 1 << 53:  # doubles are exact
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        d = (v * v).sum(1)[:, None] - 2.0 * (v @ c.T) + (c * c).sum(1)[None, :]
        return d.astype(np.int64)
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for k, c in enumerate(centroids.astype(np.int64)):
        diff = vectors.astype(np.int64) - c
        out[:, k] = (diff * diff).sum(1)
    return out


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (the smaller number of equals) and the gap to the second one."""
    d = squared(vectors, centroids)
    own = d.argmin(1)
    if d.shape[1] == 1:
        return own, np.full(len(d), np.inf)
    two = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(np.float64))
    return own, two[:, 1] * (1 - SLACK) - two[:, 0] * (1 + SLACK)


def drifts(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """What every cluster's gaps shrink by: its own move and the largest other one."""
    diff = (new - old).astype(np.float64)
    move = np.sqrt((diff * diff).sum(1)) * (1 + SLACK)
    if len(move) == 1:
        return move
    first, second = np.argsort(move)[::-1][:2]
    other = np.where(np.arange(len(move)) == first, move[second], move[first])
    return (move + other) * (1 + SLACK)


# --- heaps -----------------------------------------------------------------------

class Heaps:
    """Gathers vectors by cluster and gives them out as heap rows of BLOCK vectors."""

    def __init__(self, k: int):
        self.parts: list[list] = [[] for _ in range(k)]
        self.sizes = [0] * k

    def add(self, cluster: int, ids: np.ndarray, keys: np.ndarray, vectors: np.ndarray,
            popped: int = 0) -> None:
        self.parts[cluster].append((ids, keys, vectors, popped))
        self.sizes[cluster] += len(ids)

    def spread(self, clusters, ids, keys, vectors) -> None:
        for c in np.unique(clusters):
            mine = clusters == c
            self.add(int(c), ids[mine], keys[mine], vectors[mine])

    def rows(self, all_of_them: bool = False) -> Iterator[dict]:
        """Full heaps; at the end the rest of every cluster too."""
        for c, parts in enumerate(self.parts):
            if not parts or not all_of_them and self.sizes[c] < BLOCK:
                continue
            ids, keys, vectors = (np.concatenate([p[k] for p in parts]) for k in range(3))
            popped = sum(p[3] for p in parts)
            order = np.argsort(keys, kind="stable")
            end = len(order) if all_of_them else len(order) // BLOCK * BLOCK
            for start in range(0, max(1, end), BLOCK):
                at = order[start:min(start + BLOCK, end)]
                yield heap_row(c, ids[at], keys[at], vectors[at], 0 if start else popped)
            rest = order[end:]
            self.parts[c] = [(ids[rest], keys[rest], vectors[rest], 0)] if len(rest) else []
            self.sizes[c] = len(rest)


def heap_row(cluster: int, ids, keys, vectors, popped: int) -> dict:
    top = np.abs(vectors).max(initial=0)
    width = next(k for k, t in enumerate(_WIDTHS) if top <= np.iinfo(t).max)
    return {"cluster": cluster, "n": len(ids), "popped": popped,
            "sums": vectors.sum(0, dtype=np.int64).tolist(), "ids": packed_ids(ids),
            "keys": np.asarray(keys, "<f8").tobytes(), "width": width,
            "vectors": vectors.astype(_WIDTHS[width]).tobytes()}


def packed_ids(ids) -> bytes:
    return json.dumps(list(ids)).encode()


def opened(row: dict, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.array(json.loads(row["ids"]), dtype=object)
    vectors = np.frombuffer(row["vectors"], _WIDTHS[row["width"]]).reshape(-1, dim)
    return ids, np.frombuffer(row["keys"], "<f8"), vectors


_SCHEMA = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("popped", pa.int64()),
                     ("sums", pa.list_(pa.int64())), ("ids", pa.binary()), ("keys", pa.binary()),
                     ("width", pa.int32()), ("vectors", pa.binary())])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def whole_numbers(column: pa.Array, dim: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``column`` that are vectors (their positions), scaled and floored."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == dim)
    flat = column.take(pa.array(at)).flatten().cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)  # nulls become NaN
    good = np.isfinite(x).all(1)
    return at[good], np.clip(np.floor(scale * x[good]), -clip_at(dim), clip_at(dim)).astype(np.int64)


def _first(batches: Iterator[pa.RecordBatch], dim: int, scale: float,
           centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    heaps = Heaps(len(centroids))
    for batch in batches:
        at, vectors = whole_numbers(batch.column(1), dim, scale)
        ids = np.array(batch.column(0).to_pylist(), dtype=object)[at]
        own, gaps = nearest(vectors, centroids)
        heaps.spread(own, ids, gaps, vectors)
        for row in heaps.rows():
            yield _batch([row])
    yield from (_batch([row]) for row in heaps.rows(True))


def _pass(batches: Iterator[pa.RecordBatch], centroids: np.ndarray,
          drift: np.ndarray) -> Iterator[pa.RecordBatch]:
    heaps, dim = Heaps(len(centroids)), centroids.shape[1]
    for batch in batches:
        for row in batch.to_pylist():
            c = row["cluster"]
            ids, keys, vectors = opened(row, dim)
            # the heap's top: every key up to the drift has expired
            n = int(np.searchsorted(keys, drift[c], side="right"))
            heaps.add(c, ids[n:], keys[n:], vectors[n:], popped=n)
            if n:
                own, gaps = nearest(vectors[:n], centroids)
                heaps.spread(own, ids[:n], gaps + drift[own], vectors[:n])
            for made in heaps.rows():
                yield _batch([made])
    yield from (_batch([row]) for row in heaps.rows(True))


# --- rounds --------------------------------------------------------------------------

class Clusters:
    """Result of ``fit``: the heaps, final centroids and popped vectors of every pass."""

    def __init__(self, heaps: DataFrame, centroids: np.ndarray, popped: list[int]):
        self.heaps, self.centroids, self.popped = heaps, centroids, popped


def seeds(vectors: DataFrame, k: int, dim: int, scale: float, salt: int, key: str,
          column: str) -> np.ndarray:
    """The ``k`` vectors with the smallest digest of ``salt:id``, in that order."""
    x = F.col(column)
    kept = vectors.where((F.size(x) == dim) & ~F.exists(
        x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
                    .cast("binary"), 256)
    rows = kept.select(digest.alias("digest"), x.cast("array<double>").alias("x")).orderBy(
        "digest", "x").limit(k).collect()
    flat = pa.array([r["x"] for r in rows], pa.list_(pa.float64()))
    return whole_numbers(flat, dim, scale)[1]


def moved(heaps: DataFrame, old: np.ndarray) -> np.ndarray:
    """Exact floors of the clusters' means from the sums of their heaps."""
    dim = old.shape[1]
    sums = heaps.where("n > 0").groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[j].cast("decimal(38,0)")).alias(f"s{j}")
                                 for j in range(dim)]).collect()
    new = old.copy()
    for r in sums:  # one row per cluster
        new[r["cluster"]] = [int(r[f"s{j}"]) // r["n"] for j in range(dim)]
    return new


def fit(vectors: DataFrame, k: int = 16, dim: int = 64, scale: float = 64.0, rounds: int = 3,
        salt: int = 1, key: str = "vec_id", column: str = "embedding") -> Clusters:
    """``rounds`` of assigning and moving, then a last assignment.

    The driver holds the centroids only (k x dim numbers).
    """
    centroids = seeds(vectors, k, dim, scale, salt, key, column)
    if not len(centroids):
        spark = vectors.sparkSession
        return Clusters(spark.createDataFrame([], _HEAP), centroids, [])
    start = centroids
    heaps = written(vectors.select(F.col(key).cast("string").alias("key"), F.col(column).alias("x")).mapInArrow(
        lambda it: _first(it, dim, scale, start), _HEAP), "heaps-0")
    drift, popped = np.zeros(len(centroids)), []
    for r in range(1, rounds + 1):
        new = moved(heaps, centroids)
        drift = drift + drifts(centroids, new)
        centroids = new
        at, by = centroids, drift
        heaps = written(heaps.mapInArrow(lambda it, at=at, by=by: _pass(it, at, by), _HEAP),
                        f"heaps-{r}")
        popped.append(heaps.agg(F.sum("popped")).first()[0] or 0)
    return Clusters(heaps, centroids, popped)


def assignments(found: Clusters, id_type: str = "bigint") -> DataFrame:
    """``vec_id``, ``cluster`` and the squared ``distance`` of every kept vector."""
    centroids = found.centroids

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim = centroids.shape[1]
        for batch in batches:
            for row in batch.to_pylist():
                ids, _, vectors = opened(row, dim)
                c = row["cluster"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(ids), pa.string()),
                     pa.array(np.full(len(ids), c), pa.int32()),
                     pa.array(squared(vectors, centroids[c:c + 1])[:, 0], pa.int64())],
                    names=["vec_id", "cluster", "distance"])

    rows = found.heaps.where("n > 0").mapInArrow(
        measure, "vec_id string, cluster int, distance long")
    return rows.withColumn("vec_id", F.col("vec_id").cast(id_type))


def digests(spark: SparkSession, centroids: np.ndarray) -> DataFrame:
    """``cluster`` and ``centroid_sha256``: one row per centroid."""
    rows = [(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
            for c, v in enumerate(centroids.tolist())]
    return spark.createDataFrame(rows, "cluster int, centroid_sha256 string")


def clustered(vectors: DataFrame, **how) -> DataFrame:
    """Every kept vector with its cluster, distance, inertias and its centroid's digest."""
    found = fit(vectors, **how)
    kind = vectors.schema[how.get("key", "vec_id")].dataType.simpleString()
    placed = written(assignments(found, kind), "clusters")
    inertia = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = placed.agg(F.coalesce(F.sum("distance"), F.lit(0)).alias("t")).first()["t"]
    # one row per cluster on the broadcast side
    facts = digests(placed.sparkSession, found.centroids).join(inertia, "cluster", "left")
    return placed.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias(
            "inertia"), "centroid_sha256")


_STEP = """
a{r} AS MATERIALIZED (
  SELECT vec_id, x, arg_min(c.num, (d, c.num)) AS cluster, min(d) AS distance FROM (
    SELECT v.vec_id, v.x, v.i, c.num, list_sum(list_transform(list_zip(v.x, c.x),
      lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
    FROM kept v, c{r} c) c GROUP BY vec_id, x, i),
s{r} AS (
  SELECT cluster, j, CAST(floor_div AS BIGINT) AS y FROM (
    SELECT cluster, j, CASE WHEN s >= 0 OR s % n = 0 THEN s // n ELSE s // n - 1 END AS floor_div
    FROM (SELECT cluster, j, sum(x[j])::HUGEINT AS s, count(*) AS n
          FROM a{r}, range(1, 65) t(j) GROUP BY ALL))),
c{next} AS MATERIALIZED (
  SELECT num, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT cluster, list(y ORDER BY j) AS x FROM s{r} GROUP BY cluster) m ON cluster = num),
"""

#: The query op12_centroids in DuckDB, by measuring every vector in every round.
ORACLE_SQL = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding,
    lambda v: CAST(greatest(-134217728, least(134217728, floor(64 * CAST(v AS DOUBLE))))
                   AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding,
    lambda v: v IS NOT NULL AND isfinite(v))) = 64),
c0 AS MATERIALIZED (
  SELECT num - 1 AS num, x FROM (
    SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), x)
      AS num, x FROM kept) WHERE num <= 16),
""" + "".join(_STEP.format(r=r, next=r + 1) for r in range(3)) + """
a3 AS (
  SELECT vec_id, arg_min(num, (d, num)) AS cluster, min(d) AS distance FROM (
    SELECT v.vec_id, v.i, c.num, list_sum(list_transform(list_zip(v.x, c.x),
      lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
    FROM kept v, c3 c) GROUP BY vec_id, i)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c3.x, ',')) AS centroid_sha256
FROM a3 JOIN c3 ON c3.num = cluster
"""
