"""Explained variance, component choice, PCA and truncated SVD.

* Variance statistics are JVM ``Summarizer`` aggregates over vector
  columns (one partial per task) or ``groupBy(term)`` sums for sparse rows.
* The component sweep (D3) fits once at the largest k: each sweep point is
  a prefix sum of the explained-variance ratios (W6), not a refit.
* Choice of k (W7): smallest k whose cumulative ratio reaches the
  threshold; if never reached, ``max + 1`` capped at ``max``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import let_go
from .linalg import list_column, sum_partials

VARIANCE_THRESHOLD = 0.95
MAX_SPARSE_COMPONENTS = 300
MAX_DENSE_COMPONENTS = 100
SWEEP_POINTS = 20


def sweep_grid(max_components: int, points: int = SWEEP_POINTS, start: int = 10) -> list[int]:
    """D3: ``points`` evenly spaced component counts from ``start`` to ``max`` (truncated to int)."""
    return [int(x) for x in np.linspace(start, max_components, points)]


def choose_k(cumulative: list[float], max_components: int, threshold: float = VARIANCE_THRESHOLD) -> int:
    """W7 on the driver for a fitted curve (at most ``max_components`` values)."""
    for i, c in enumerate(cumulative):
        if c >= threshold:
            return min(i + 1, max_components)
    return min(len(cumulative) + 1, max_components)


def axis_variance_ratios(df: DataFrame, vec_col: str = "embedding", threshold: float = VARIANCE_THRESHOLD,
                         max_components: int | None = None) -> DataFrame:
    """A18/W6/W7 with the coordinate axes as components (PCA convention: centred variance).

    ``(component, axis, ratio, cumulative, k95)``; components ordered by ratio
    desc (ties: axis asc).  The ranking, the prefix sum and k95 run over one
    row per axis.
    """
    var = df.select(Summarizer.variance(array_to_vector(vec_col)).alias("v")).select(
        F.posexplode(vector_to_array("v")).alias("axis", "var"))
    total = F.sum("var").over(Window.partitionBy())
    ratios = var.select("axis", (F.col("var") / total).alias("ratio"))
    order = Window.orderBy(F.round("ratio", 9).desc(), F.col("axis").asc())
    ranked = ratios.withColumn("component", F.row_number().over(order))
    cum = ranked.withColumn("cumulative", F.sum("ratio").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    n_axes = F.max("component").over(Window.partitionBy())
    cap = n_axes if max_components is None else F.least(n_axes, F.lit(max_components))
    first_hit = F.min(F.when(F.col("cumulative") >= threshold, F.col("component"))).over(Window.partitionBy())
    k95 = F.least(F.coalesce(first_hit, n_axes + 1), cap)
    return cum.select(F.col("component").cast("int"), F.col("axis").cast("int"), F.round("ratio", 6).alias("ratio"),
                      F.round("cumulative", 6).alias("cumulative"), k95.cast("int").alias("k95"))


# ---------------------------------------------------------------------------
# PCA with a centred projection, by a tall-skinny QR tree
#
# A task folds its centred rows into a triangular factor of at most d rows, block by
# block; factors are stacked and factored again, QR_FAN at a time, until one is left.
# No d x d product of the rows is formed, so small components keep their digits.

QR_FAN = 16
QR_BLOCK_ROWS = 1024


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r") if len(rows) else rows


def _factors(d: int):
    """Stacks and factors packed triangles that arrive in one task."""
    def run(batches):
        held = np.zeros((0, d))
        for b in batches:
            for cell in b.column(0):
                held = _triangle(np.vstack([held, np.frombuffer(cell.as_buffer()).reshape(-1, d)]))
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary()), pa.array([0])], ["r", "n"])

    return run


def tall_skinny_qr(rows: DataFrame, mean: np.ndarray, vec_col: str = "features") -> np.ndarray:
    """The triangular factor (at most d x d) of the rows less ``mean``; the driver gets it alone."""
    d = len(mean)

    def leaf(batches):
        held = np.zeros((0, d))
        for b in batches:
            _, flat = list_column(b, vec_col, np.float64)
            X = flat.reshape(-1, d)
            for a in range(0, len(X), QR_BLOCK_ROWS):
                held = _triangle(np.vstack([held, X[a:a + QR_BLOCK_ROWS] - mean]))
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary()), pa.array([0])], ["r", "n"])

    schema, n = "r binary, n long", rows.rdd.getNumPartitions()
    tree = rows.select(vec_col).mapInArrow(leaf, schema)
    while n > QR_FAN:  # each task of the next level takes QR_FAN factors
        n = math.ceil(n / QR_FAN)
        tree = tree.repartition(n).mapInArrow(_factors(d), schema)
    held = tree.repartition(1).mapInArrow(_factors(d), schema).first()
    return np.frombuffer(held["r"]).reshape(-1, d) if held else np.zeros((0, d))


def pca_fit(train: DataFrame, vec_col: str = "features") -> dict:
    """``{"mean", "components" d x m, "variances" m, "n"}`` of all components, largest first, signs fixed."""
    n, mean = train.agg(F.count(F.lit(1)), Summarizer.mean(array_to_vector(vec_col))).first()
    mean = np.asarray(mean.toArray())
    _, sing, Vt = np.linalg.svd(tall_skinny_qr(train, mean, vec_col), full_matrices=False)
    return {"mean": mean, "components": _fix_signs(Vt.T), "variances": sing ** 2 / max(n - 1, 1), "n": n}


def pca_project(df: DataFrame, model: dict, k: int, vec_col: str = "features") -> DataFrame:
    """``df`` with the centred projection on the first k components in place of its vectors."""
    sent = df.sparkSession.sparkContext.broadcast((model["mean"], np.ascontiguousarray(model["components"][:, :k])))
    schema = df.withColumn(vec_col, F.array().cast("array<double>")).schema
    names = df.columns

    def run(batches):
        mean, V = sent.value
        for b in batches:
            _, flat = list_column(b, vec_col, np.float64)
            Y = (flat.reshape(b.num_rows, -1) - mean) @ V if b.num_rows else np.zeros((0, V.shape[1]))
            cells = pa.ListArray.from_arrays(pa.array(np.arange(len(Y) + 1, dtype=np.int32) * V.shape[1]), pa.array(Y.ravel()))
            yield pa.RecordBatch.from_arrays([cells if c == vec_col else b.column(i) for i, c in enumerate(names)], names)

    return df.mapInArrow(run, schema)


def pca_fit_project(train: DataFrame, others: list[DataFrame], k: int, vec_col: str = "features",
                    id_col: str = "doc_id"):
    """Fit centred PCA on ``train`` only; project train and each frame in ``others``.

    Returns ``(projected_train, [projected...], ratios list)``; projections
    have ``features array<double>`` of width k (fewer where the train rows are
    fewer).  Components get a fixed sign: the largest-magnitude loading of each is positive.
    """
    model = pca_fit(train, vec_col)
    total = float(model["variances"].sum())
    ratios = [float(v) / total if total > 0 else 0.0 for v in model["variances"][:k]]
    return pca_project(train, model, k, vec_col), [pca_project(o, model, k, vec_col) for o in others], ratios


# ---------------------------------------------------------------------------
# Truncated SVD of a sparse matrix (uncentred), block Krylov iteration
#
# A is n x d in packed rows (doc_id, indices, values); d <= the vocabulary cap.
# A pass computes Z = A^T (A W) for a broadcast d x b block W: every task folds
# its rows into a d x b partial and emits the column ranges that its rows
# touched; the partials are added range by range on the executors, so d x b
# numbers reach the driver, never rows of A.  Each pass adds a block to the
# Krylov basis; G = A^T A restricted to the basis comes from the Z already
# computed, and so does the exact residual |G v - lambda v| of each component:
# no pass is spent on checking, and the iteration ends when all have converged.

SVD_OVERSAMPLES = 10
SVD_PASSES = 6
SVD_BLOCKS_PER_RANK = 3  # a block has about a third of the wanted components
SVD_TOLERANCE = 1e-7     # of a component's residual, relative to the largest eigenvalue
SVD_RESIDUAL = 2e-3      # what every component keeps to when the passes end before all have converged
SVD_SEED = 42
# Row blocks of the fold: at most this many rows and (unless one row has more) entries.
_BLOCK_ROWS = 16
_BLOCK_NNZ = 4096


def _row_blocks(lens: np.ndarray, max_rows: int = _BLOCK_ROWS, max_nnz: int = _BLOCK_NNZ):
    """Consecutive row ranges ``(r0, r1, o0, o1)`` of at most ``max_rows`` rows and ``max_nnz`` entries."""
    ends = np.cumsum(lens)
    starts = ends - lens
    r, n = 0, len(lens)
    while r < n:
        s = int(np.searchsorted(ends, starts[r] + max_nnz, side="right"))
        s = min(max(r + 1, s), r + max_rows, n)
        yield r, s, int(starts[r]), int(ends[s - 1])
        r = s


def _dense_block(lens: np.ndarray, idx: np.ndarray, val: np.ndarray, r0: int, r1: int, o0: int, o1: int, dt):
    """Rows r0..r1 as a dense block over only the columns they touch: ``(columns, block)``.

    Column indices are unique within a packed row, so a plain scatter fills it.
    """
    cols, inv = np.unique(idx[o0:o1], return_inverse=True)
    block = np.zeros((r1 - r0, len(cols)), dtype=dt)
    block[np.repeat(np.arange(r1 - r0), lens[r0:r1]), inv] = val[o0:o1]
    return cols, block


def _gram_pass(packed: DataFrame, W: np.ndarray) -> np.ndarray:
    """Z = A^T A W for the packed sparse rows; W is d x l (broadcast), computed in W's precision.

    Each task cuts its rows into small blocks; a block is dense over the
    columns it touches (a few thousand), so both products are BLAS GEMMs:
    ``Y = B W[cols]`` and ``Z[cols] += B^T Y``.
    """
    spark = packed.sparkSession
    d, l = W.shape
    dt = W.dtype
    bw = spark.sparkContext.broadcast(W)

    def fold(batches):
        Wl = bw.value
        Z = np.zeros((d, l), dtype=dt)
        touched = False
        for b in batches:
            lens, idx = list_column(b, "indices", np.int64)
            _, val = list_column(b, "values", dt)
            for r0, r1, o0, o1 in _row_blocks(lens):
                if o1 == o0:
                    continue
                cols, B = _dense_block(lens, idx, val, r0, r1, o0, o1, dt)
                Z[cols] += B.T @ (B @ Wl[cols])
                touched = True
        return Z.ravel() if touched else None

    Z = sum_partials(packed, fold, d * l, ["indices", "values"], dtype=dt, arrow=True)
    bw.destroy()  # its file on the driver goes too
    let_go(spark)  # and so do the shuffled partials
    return Z.reshape(d, l).astype(np.float64)


# Few tasks, so that each reads at least this multiple of its partial's bytes: below the number
# of cores a small fraction is enough (small inputs still fill the cores), above it the partials
# must stay small next to the input, whose partitions are then merged without a shuffle.
PARTIAL_RATIO_FEW, PARTIAL_RATIO_MANY = 0.08, 8
_ENTRY_BYTES = 12  # int index + double value


def _size_for_partials(packed: DataFrame, partial_bytes: int) -> DataFrame:
    """Coalesce (no shuffle) so that the d x b partials are small next to the entries, see above."""
    nnz = packed.select(F.sum(F.size("indices"))).first()[0] or 0
    have, cores = packed.rdd.getNumPartitions(), packed.sparkSession.sparkContext.defaultParallelism
    few, many = (math.ceil(nnz * _ENTRY_BYTES / (r * partial_bytes)) for r in (PARTIAL_RATIO_FEW, PARTIAL_RATIO_MANY))
    want = max(1, min(few, cores), many)
    if have < min(want, cores):  # small shuffle partitions were merged below the number of cores
        return packed.repartition(min(want, cores))
    return packed.coalesce(want) if want < have else packed


def _fix_signs(V: np.ndarray) -> np.ndarray:
    signs = np.sign(V[np.abs(V).argmax(axis=0), np.arange(V.shape[1])])
    signs[signs == 0] = 1.0
    return V * signs


def _new_directions(W: np.ndarray, Q: np.ndarray | None) -> np.ndarray:
    """An orthonormal basis of what ``W`` adds to ``Q``; columns that add nothing are left out."""
    size = np.linalg.norm(W)
    for _ in range(2 if Q is not None else 0):  # twice is enough
        W = W - Q @ (Q.T @ W)
    U, s, _ = np.linalg.svd(W, full_matrices=False)
    return U[:, s > 1e-10 * max(size, 1e-300)]


def truncated_svd(packed: DataFrame, d: int, k: int, n_rows: int, col_stats: tuple | None = None,
                  oversamples: int = SVD_OVERSAMPLES, passes: int = SVD_PASSES, seed: int = SVD_SEED,
                  tolerance: float = SVD_TOLERANCE) -> dict:
    """Top-k right singular vectors of the sparse n x d matrix (uncentred, like TruncatedSVD).

    Returns ``{"components": d x k, "singular_values": k, "residuals": k, "passes", "ratios": k}``; a
    residual is ``|G v - lambda v| / lambda_1`` with G = A^T A.  The explained-variance ratios use
    column means/squares ``col_stats = (sum, sum_sq)`` (length-d arrays) and ``n_rows`` (documents,
    empty ones included). .
    """
    k = max(1, min(k, d, n_rows))
    b = min(d, max(16, math.ceil((k + oversamples) / SVD_BLOCKS_PER_RANK)))
    packed = _size_for_partials(packed, d * b * 8).persist()
    W = _new_directions(np.random.default_rng(seed).standard_normal((d, b)), None)
    Q, Z, done = W[:, :0], W[:, :0], 0
    while W.shape[1] and done < max(passes, math.ceil((k + oversamples) / b)):
        Q, Z, done = np.hstack([Q, W]), np.hstack([Z, _gram_pass(packed, W)]), done + 1
        T = Q.T @ Z
        lam, S = np.linalg.eigh((T + T.T) / 2)
        order = np.argsort(lam)[::-1][:k]
        lam, S = np.clip(lam[order], 0.0, None), S[:, order]
        residuals = np.linalg.norm(Z @ S - (Q @ S) * lam, axis=0) / max(lam[0], 1e-300)
        if len(lam) == k and residuals.max() <= tolerance:
            break
        W = _new_directions(Z[:, -W.shape[1]:], Q)
    packed.unpersist()
    V = Q @ S
    if V.shape[1] < k:  # the rows span fewer dimensions: any completion has the value 0
        rest = _new_directions(np.random.default_rng(seed + 1).standard_normal((d, k - V.shape[1])), V)
        V, zeros = np.hstack([V, rest]), np.zeros(rest.shape[1])
        lam, residuals = np.concatenate([lam, zeros]), np.concatenate([residuals, zeros])
    V = _fix_signs(V)
    out = {"components": V, "singular_values": np.sqrt(lam), "residuals": residuals, "passes": done}
    if col_stats is not None:
        s1, s2 = (np.asarray(x, dtype=np.float64) for x in col_stats)
        mu = s1 / n_rows
        total = float((s2 / n_rows - mu * mu).sum())
        proj_var = lam / n_rows - (mu @ V) ** 2
        out["ratios"] = proj_var / total if total > 0 else np.zeros_like(proj_var)
    return out


def column_stats(long_df: DataFrame, d: int, value_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Per-column sum and sum of squares of a long sparse matrix (d rows reach the driver)."""
    rows = long_df.groupBy("term_id").agg(F.sum(value_col).alias("s1"),
                                          F.sum(F.col(value_col) * F.col(value_col)).alias("s2")).collect()
    s1, s2 = np.zeros(d), np.zeros(d)
    for r in rows:
        s1[r["term_id"]], s2[r["term_id"]] = r["s1"], r["s2"]
    return s1, s2


def split_norms(packed: DataFrame, components: np.ndarray, id_cols: list[str]) -> DataFrame:
    """``(*id_cols, explained, rest)``: squared norms of each sparse row's projection and of what it leaves of the row.

    The rest is taken of the row itself, ``|x|^2 - 2 x.(V y) + |V y|^2`` with y = V^T x, so explained + rest is the
    row's squared norm only if the components are orthonormal.
    """
    bv = packed.sparkSession.sparkContext.broadcast(np.ascontiguousarray(components, dtype=np.float64))

    def run(batches):
        V = bv.value
        inner = V.T @ V
        for b in batches:
            lens, idx = list_column(b, "indices", np.int64)
            _, val = list_column(b, "values", np.float64)
            explained, rest = np.zeros(b.num_rows), np.zeros(b.num_rows)
            for r0, r1, o0, o1 in _row_blocks(lens):
                if o1 > o0:
                    cols, B = _dense_block(lens, idx, val, r0, r1, o0, o1, np.float64)
                    Y = B @ V[cols]
                    explained[r0:r1] = (Y * Y).sum(axis=1)
                    rest[r0:r1] = (B * B).sum(axis=1) - 2 * explained[r0:r1] + ((Y @ inner) * Y).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in id_cols), pa.array(explained), pa.array(rest)],
                                             [*id_cols, "explained", "rest"])

    schema = ", ".join(f"{c} {packed.schema[c].dataType.simpleString()}" for c in id_cols) + ", explained double, rest double"
    return packed.select(*id_cols, "indices", "values").mapInArrow(run, schema)


def project_sparse(packed: DataFrame, components: np.ndarray, id_cols: list[str]) -> DataFrame:
    """X V for packed sparse rows -> ``(*id_cols, features array<double>)``; rows without entries -> zeros."""
    spark = packed.sparkSession
    bv = spark.sparkContext.broadcast(np.ascontiguousarray(components, dtype=np.float64))
    k = components.shape[1]

    def proj(batches):
        V = bv.value
        for b in batches:
            lens, idx = list_column(b, "indices", np.int64)
            _, val = list_column(b, "values", np.float64)
            out = np.zeros((b.num_rows, k))
            for r0, r1, o0, o1 in _row_blocks(lens):
                if o1 > o0:
                    cols, B = _dense_block(lens, idx, val, r0, r1, o0, o1, np.float64)
                    out[r0:r1] = B @ V[cols]
            feats = pa.ListArray.from_arrays(pa.array(np.arange(0, b.num_rows * k + 1, k, dtype=np.int32)),
                                             pa.array(out.ravel()))
            cols = [b.column(b.schema.get_field_index(c)) for c in id_cols]
            yield pa.RecordBatch.from_arrays(cols + [feats], id_cols + ["features"])

    schema = ", ".join(f"{c} {packed.schema[c].dataType.simpleString()}" for c in id_cols) + \
        ", features array<double>"
    return packed.select(*id_cols, "indices", "values").mapInArrow(proj, schema)
