"""Matrix operators on tall tables of vectors (M1-M5).

They rest on the R factor of X = QR, found by a tall-skinny QR reduction: every
task reduces its rows to one d x d triangle, and triangles are stacked and reduced
again, FAN at a time, in Spark tasks until one is left. The driver receives that
triangle. Its singular values and right vectors are those of X, and as X'X is never
formed, the condition of X is not squared. Per-row outputs (U, scores,
reconstructions, distances) are column expressions with the d x k matrix inlined as
literals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import sq_distance
from ..session import written

#: Triangles that one task stacks.
FAN = 16


def as_array(df: DataFrame, cols: Sequence[str], out: str = "vec") -> DataFrame:
    """Numeric columns -> one array<double> column."""
    return df.withColumn(out, F.array(*[F.col(c).cast("double") for c in cols]))


def triangle(rows: np.ndarray) -> np.ndarray:
    """R of a QR decomposition, with rows of zeros where there are too few."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))])


def _reduced(batches, d: int, blocks):
    """One triangle from all blocks of rows of a task; ``blocks`` reads them from a batch."""
    r, part = None, None
    for batch in batches:
        for x in blocks(batch):
            r = triangle(x if r is None else np.vstack([r, x]))
        if batch.num_rows:
            part = batch.column("part")[0].as_py()
    if r is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([r.astype("<f8").tobytes()], pa.binary())],
            names=["part", "r"])


def r_factor(df: DataFrame, vec: str, center: bool = False
             ) -> tuple[np.ndarray, np.ndarray, int]:
    """-> (R, means, n) of the non-null vectors in ``vec``, an array column of fixed length.

    With ``center``, R belongs to the rows minus their means: a first aggregate gives
    the means, and a column of ones beside the shifted rows takes up what their
    rounding leaves. An empty table gives matrices without columns.
    """
    rows = df.where(F.col(vec).isNotNull()).select(F.col(vec).cast("array<double>").alias("x"))
    first = rows.first()
    if first is None:
        return np.zeros((0, 0)), np.zeros(0), 0
    d = len(first["x"])
    facts = rows.agg(F.count("x").alias("n"),
                     *[F.avg(F.get("x", F.lit(j))).alias(f"m{j}") for j in range(d)]).first()
    mean = np.array([facts[f"m{j}"] for j in range(d)]) if center else np.zeros(d)
    ones = int(center)

    def shifted(batch):
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d) - mean
        return [np.hstack([np.ones((len(x), ones)), x])] if len(x) else []

    def stacked(batch):
        return [np.frombuffer(b, "<f8").reshape(d + ones, d + ones)
                for b in batch.column("r").to_pylist()]

    schema = "part long, r binary"
    parts = written(rows.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(
        lambda it: _reduced(it, d, shifted), schema), "triangles")
    top = parts.agg(F.max("part")).first()[0]
    while top:
        # one partition per FAN triangles
        top = top // FAN
        parts = written(parts.select((F.col("part") / FAN).cast("long").alias("part"), "r")
                        .groupBy("part").applyInArrow(
            lambda table: next(pa.Table.from_batches([b]) for b in _reduced(
                table.combine_chunks().to_batches(), d, stacked)), schema), "triangles")
    r = np.frombuffer(parts.first()["r"], "<f8").reshape(d + ones, d + ones)
    return r[ones:, ones:], mean + r[0, ones:] / r[0, 0] if center else mean, int(facts["n"])


def right_vectors(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right vectors (rows); the largest component of each is positive."""
    if not r.size:
        return np.zeros(0), r
    _, s, vt = np.linalg.svd(r)
    signs = np.sign(vt[np.arange(len(vt)), np.abs(vt).argmax(axis=1)])
    return s, vt * np.where(signs == 0, 1, signs)[:, None]


def _lit_matrix(M: np.ndarray) -> Column:
    """A k x d matrix as an array of array literals."""
    return F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in M])


def _project(vec: Column | str, rows: np.ndarray, shift: np.ndarray | None = None,
             scale: np.ndarray | None = None) -> Column:
    """[(x - shift)/scale] . r for each row r of ``rows`` -> array<double>."""
    x = F.col(vec) if isinstance(vec, str) else vec
    if shift is not None:
        sh = F.array(*[F.lit(float(v)) for v in shift])
        sc = F.array(*[F.lit(float(v)) for v in (scale if scale is not None else np.ones(len(shift)))])
        x = F.zip_with(F.zip_with(x, sh, lambda a, b: a - b), sc, lambda a, b: a / b)
    return F.transform(_lit_matrix(rows), lambda r: F.aggregate(
        F.zip_with(r, x, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v))


# M1
def svd(df: DataFrame, vec: str, k: int | None = None, id_col: str | None = None):
    """Thin SVD X = U S V' -> (U frame, S, Vt) with Vt k x d.

    S and V come from the R factor; U = X V S^-1 per row, with zeros where a singular
    value is 0 next to the largest one. A null vector has a null row in U; an empty
    table gives no singular values.
    """
    r, _, n = r_factor(df, vec)
    S, Vt = right_vectors(r)
    S, Vt = S[:k], Vt[:k]
    if not len(S):
        return df.select(*([id_col] if id_col else []),
                         F.col(vec).cast("array<double>").alias("u")), S, Vt
    some = S > S[0] * np.finfo(float).eps * max(n, len(Vt[0]))
    inv = np.where(some, 1 / np.where(some, S, 1), 0.0)
    U = df.select(*([id_col] if id_col else []), F.when(
        F.col(vec).isNotNull(), _project(vec, Vt * inv[:, None])).alias("u"))
    return U, S, Vt


# M2
def reconstruct(U: DataFrame, S: np.ndarray, Vt: np.ndarray, u_col: str = "u",
                out: str = "approx") -> DataFrame:
    """x_hat = sum_j u_j s_j v_j, per row."""
    M = (Vt * S[:, None]).T  # d x k: row i holds s_j v_ji
    return U.withColumn(out, _project(u_col, M))


# M3
def low_rank(df: DataFrame, vec: str, k: int, id_col: str | None = None):
    """Rank-k approximation: reconstructed rows, SSE and storage ratio
    k (n + 1 + d) / (n d). SSE equals the sum of the dropped sigma^2."""
    r, _, n = r_factor(df, vec)
    S, Vt = right_vectors(r)
    if not len(S):  # an empty table
        none = df.select(*([id_col] if id_col else []), vec,
                         F.col(vec).cast("array<double>").alias("approx"))
        return none, none.agg(F.sum(F.lit(None).cast("double")).alias("sse")), math.nan, 0.0
    d = len(S)
    P = Vt[:k].T @ Vt[:k]  # projection onto the top-k right singular space
    rec = df.select(*([id_col] if id_col else []), vec, F.when(
        F.col(vec).isNotNull(), _project(vec, P)).alias("approx"))
    sse = rec.agg(F.sum(sq_distance(vec, "approx")).alias("sse"))
    ratio = k * (n + 1 + d) / (n * d)
    return rec, sse, float(ratio), float((S[k:] ** 2).sum())


# M4
def pca(df: DataFrame, cols: Sequence[str], k: int, center: bool = True,
        scale: bool = False, id_col: str | None = None):
    """Principal components: rotation (d x k), scores per row and the
    cumulated share of variance. ``center=False`` is the reference's
    uncentred variant (right singular vectors of the raw rows). Rows with a
    null are left out; without spread the shares are NaN."""
    v = as_array(df.select(*([id_col] if id_col else []), *cols).na.drop(), cols)
    r, mu, n = r_factor(v, "vec", center)
    if not n:
        r, mu = np.zeros((len(cols), len(cols))), np.zeros(len(cols))
    sd = np.ones(len(cols))
    if scale and n > 1:
        # a column without spread stays as it is
        spread = np.sqrt((r * r).sum(0) / (n - 1))
        sd = np.where(spread > 0, spread, 1.0)
    S, Vt = right_vectors(r / sd)
    w, V = S ** 2, Vt.T
    share = np.cumsum(w) / w.sum() if w.sum() > 0 else np.full(len(w), math.nan)
    R = V[:, :k]
    scores = v.select(*([id_col] if id_col else []),
                      _project("vec", R.T, mu, sd).alias("scores"))
    variance = df.sparkSession.createDataFrame(
        [(i + 1, float(w[i] / max(1, n - 1 if center else n)),
          float(share[i] - (share[i - 1] if i else 0)), float(share[i])) for i in range(len(w))], "component int, variance double, share double, cumulative double")
    return {"rotation": R, "mean": mu, "scale": sd, "scores": scores, "variance": variance}


# M5
def similar_rows(model: dict, query: Sequence[float], k: int, id_col: str,
                 n_components: int | None = None) -> DataFrame:
    """Project the query with the rotation and take the k rows nearest in
    the first components (squared distance, ties by id)."""
    R = model["rotation"][:, : (n_components or model["rotation"].shape[1])]
    q = (np.asarray(query, dtype=float) - model["mean"]) / model["scale"]
    qs = F.array(*[F.lit(float(x)) for x in (q @ R)])
    sc = model["scores"].withColumn("scores", F.slice("scores", 1, R.shape[1]))
    d = sc.withColumn("sq_dist", sq_distance("scores", qs))
    return d.orderBy("sq_dist", id_col).limit(k)
