"""M1: multinomial logistic regression by matrix-free Newton-CG.

The objective is the reference's: ``1/2 |W|^2 + C sum_i -log p(y_i | x_i)``
with an intercept for each class that is not penalised.  A Newton step solves
``H D = -g`` by conjugate gradients, where H is never formed: one pass over the
train rows gives ``H V`` for a broadcast V, from the rows' scores alone.

Rows are dense (``features array<double>``) or packed sparse (``indices``,
``values``).  A task folds its rows block by block, a sparse block dense over
the columns it touches, into one K x (d+1) partial.  For up to ``DENSE_WIDTH``
columns CG is preconditioned by the Hessian's blocks of one class each, which
take one more pass a step; wider rows use its diagonal.
"""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linalg import list_column, sum_partials
from .reduce import _dense_block, _row_blocks

C_PENALTY = 1.0
TOLERANCE = 1e-6     # of the gradient's norm, relative to that at zero weights
MAX_NEWTON, MAX_CG = 100, 200
DENSE_WIDTH = 1024


def _blocks(batch: pa.RecordBatch, sparse: bool):
    """``(first row, last row, columns, dense block)`` of a batch."""
    if not sparse:
        _, flat = list_column(batch, "features", np.float64)
        if batch.num_rows:
            yield 0, batch.num_rows, slice(None), flat.reshape(batch.num_rows, -1)
        return
    lens, idx = list_column(batch, "indices", np.int64)
    _, val = list_column(batch, "values", np.float64)
    for r0, r1, o0, o1 in _row_blocks(lens):
        cols, block = _dense_block(lens, idx, val, r0, r1, o0, o1, np.float64)
        yield r0, r1, cols, block


def _scores(X: np.ndarray, cols, W: np.ndarray) -> np.ndarray:
    return X @ W[:, :-1][:, cols].T + W[:, -1]


class _Problem:
    def __init__(self, data: DataFrame, classes: np.ndarray, width: int, c: float, sparse: bool):
        self.data, self.classes, self.width, self.c, self.sparse = data, classes, width, c, sparse
        self.sc = data.sparkSession.sparkContext
        self.cols = ["indices", "values", "label"] if sparse else ["features", "label"]
        self.penalty = np.append(np.ones(width), 0.0)
        self.passes = 0

    def _sum(self, size: int, fold, *arrays) -> np.ndarray:
        """``fold(totals, label codes, columns, block, *arrays)`` over all blocks, ``totals`` of ``size`` numbers."""
        sent, sparse, classes = [self.sc.broadcast(a) for a in arrays], self.sparse, self.classes

        def run(batches):
            own, total, seen = [s.value for s in sent], np.zeros(size), False
            for b in batches:
                labels = np.searchsorted(classes, b.column(b.schema.get_field_index("label")).to_numpy(zero_copy_only=False))
                for r0, r1, cols, X in _blocks(b, sparse):
                    fold(total, labels[r0:r1], cols, X, *own)
                    seen = True
            return total if seen else None

        out = sum_partials(self.data, run, size, self.cols, arrow=True)
        self.passes += 1
        for s in sent:
            s.unpersist()
        return out

    def value(self, W: np.ndarray) -> tuple[float, np.ndarray]:
        """Objective and gradient."""
        shape = W.shape

        def fold(total, y, cols, X, W):
            P = _scores(X, cols, W)
            P -= P.max(axis=1, keepdims=True)
            at = np.arange(len(y))
            own = P[at, y].sum()
            np.exp(P, out=P)
            norm = P.sum(axis=1, keepdims=True)
            total[-1] += np.log(norm).sum() - own
            P /= norm
            P[at, y] -= 1.0
            G = total[:-1].reshape(shape)
            G[:, :-1][:, cols] += P.T @ X
            G[:, -1] += P.sum(axis=0)

        out = self._sum(W.size + 1, fold, W)
        reg = W * self.penalty
        return 0.5 * float((reg * W).sum()) + self.c * float(out[-1]), reg + self.c * out[:-1].reshape(shape)

    def curvature(self, W: np.ndarray, V: np.ndarray) -> np.ndarray:
        """Hessian at W times V."""
        shape = W.shape

        def fold(total, y, cols, X, W, V):
            P = _scores(X, cols, W)
            P -= P.max(axis=1, keepdims=True)
            np.exp(P, out=P)
            P /= P.sum(axis=1, keepdims=True)
            S = _scores(X, cols, V)
            R = P * (S - (P * S).sum(axis=1, keepdims=True))
            G = total.reshape(shape)
            G[:, :-1][:, cols] += R.T @ X
            G[:, -1] += R.sum(axis=0)

        return V * self.penalty + self.c * self._sum(W.size, fold, W, V).reshape(shape)

    def preconditioner(self, W: np.ndarray):
        """Approximate inverse of the Hessian at W, as a function of a K x (d+1) array: its blocks of one class each."""
        d, k = self.width + 1, len(self.classes)
        full = d <= DENSE_WIDTH

        def fold(total, y, cols, X, W):
            P = _scores(X, cols, W)
            P -= P.max(axis=1, keepdims=True)
            np.exp(P, out=P)
            P /= P.sum(axis=1, keepdims=True)
            P *= 1 - P
            if full:
                G, E = total.reshape(k, d, d), np.hstack([X, np.ones((len(X), 1))])
                at = np.append(np.arange(d - 1)[cols], d - 1)
                for i in range(k):
                    G[i][np.ix_(at, at)] += E.T @ (E * P[:, i:i + 1])
            else:
                G = total.reshape(k, d)
                G[:, :-1][:, cols] += P.T @ (X * X)
                G[:, -1] += P.sum(axis=0)

        out = self.c * self._sum(k * d * d if full else k * d, fold, W)
        if not full:
            diagonal = out.reshape(k, d) + self.penalty + 1e-9
            return lambda G: G / diagonal
        inverse = np.linalg.inv(out.reshape(k, d, d) + np.diag(self.penalty + 1e-9))
        return lambda G: np.einsum("kij,kj->ki", inverse, G)


def fit(train: DataFrame, c: float = C_PENALTY, tolerance: float = TOLERANCE, width: int | None = None) -> dict:
    """``{"classes", "weights" K x (d+1) with the intercept last, "gradient_norm", "passes"}``.

    ``train`` holds ``label`` and either ``features`` or ``indices`` and ``values`` (then ``width`` is the
    number of columns).  Null labels are not allowed; one class alone gets zero weights.
    """
    sparse = "indices" in train.columns
    cols = ["indices", "values"] if sparse else ["features"]
    data = train.select(*cols, F.col("label").cast("int").alias("label")).persist()
    classes = np.array(sorted(r[0] for r in data.select("label").distinct().collect()))
    width = width if sparse else len(data.first()["features"])
    problem = _Problem(data, classes, width, c, sparse)
    W = np.zeros((len(classes), width + 1))
    f, g = problem.value(W)
    first = max(np.linalg.norm(g), 1e-300)
    for _ in range(MAX_NEWTON):
        if np.linalg.norm(g) <= tolerance * first:
            break
        D, r, solve = np.zeros_like(W), -g, problem.preconditioner(W)
        z = solve(r)
        p, rz = z, float((r * z).sum())
        target = min(0.1, np.sqrt(np.linalg.norm(g) / first)) * np.linalg.norm(g)  # superlinear, no more exact than the step needs
        for _ in range(MAX_CG):
            Hp = problem.curvature(W, p)
            bend = float((p * Hp).sum())
            if bend <= 0:
                break
            step = rz / bend
            D, r = D + step * p, r - step * Hp
            if np.linalg.norm(r) <= target:
                break
            z = solve(r)
            rz, before = float((r * z).sum()), rz
            p = z + (rz / before) * p
        slope, t = float((g * D).sum()), 1.0
        while True:
            f_new, g_new = problem.value(W + t * D)
            if f_new <= f + 1e-4 * t * slope + 1e-12 * abs(f) or t < 1e-6:
                break
            t /= 2
        if t < 1e-6:  # as far as doubles go
            break
        W, f, g = W + t * D, f_new, g_new
    data.unpersist()
    W[:, -1] -= W[:, -1].mean()
    return {"classes": classes, "weights": W, "gradient_norm": float(np.linalg.norm(g)), "passes": problem.passes}


def scores(features: Column, model: dict) -> Column:
    """``w_k . x + b_k`` of every class."""
    x = F.concat(features, F.array(F.lit(1.0)))
    return F.array(*[F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in w]), lambda a, b: a * b),
                                 F.lit(0.0), lambda acc, y: acc + y) for w in model["weights"]])


def predicted(features: Column, model: dict) -> Column:
    """The class of the largest score, ties to the smaller class."""
    s = scores(features, model)
    return F.element_at(F.array(*[F.lit(int(k)) for k in model["classes"]]), F.array_position(s, F.array_max(s)).cast("int"))


def gradient(train: DataFrame, model: dict, c: float = C_PENALTY) -> DataFrame:
    """``(label, dim, gradient)`` of the objective at the model's weights, by columns' sums and not by the solver's fold.

    ``dim`` d is the intercept.
    """
    s = train.select(F.col("label").cast("int").alias("y"), F.concat("features", F.array(F.lit(1.0))).alias("x"), scores(F.col("features"), model).alias("s"))
    e = s.select("y", "x", F.transform("s", lambda v: F.exp(v - F.array_max("s"))).alias("e"))
    classes = F.array(*[F.lit(int(k)) for k in model["classes"]])
    total = F.aggregate("e", F.lit(0.0), lambda a, v: a + v)
    rest = e.select("x", F.explode(F.zip_with(classes, "e", lambda k, v: F.struct(k.alias("label"), (v / total - (k == F.col("y")).cast("double")).alias("r")))).alias("c"))
    sums = rest.select("c.label", array_to_vector(F.transform("x", lambda v: v * F.col("c.r"))).alias("v")).groupBy("label").agg(Summarizer.sum(F.col("v")).alias("v"))
    flat = sums.select("label", F.posexplode(vector_to_array("v")).alias("dim", "sum"))
    weights = [(int(k), i, float(v)) for k, w in zip(model["classes"], model["weights"]) for i, v in enumerate(w[:-1])]
    own = train.sparkSession.createDataFrame(weights, "label int, dim int, w double")  # the model
    return flat.join(F.broadcast(own), ["label", "dim"], "left").select("label", "dim", (c * F.col("sum") + F.coalesce("w", F.lit(0.0))).alias("gradient"))


def train_and_predict(train: DataFrame, test: DataFrame, c: float = C_PENALTY, id_col: str = "doc_id") -> tuple[DataFrame, float]:
    """``(id, true_label, pred_label)`` of the test rows, and the seconds of the fit alone."""
    from .models import compact_for_fit

    n = train.count()
    rows = compact_for_fit(train.select("features", "label"), n, 8 * (len(train.select("features").first()[0]) + 2), 4 << 20).persist()
    rows.count()
    began = time.time()
    model = fit(rows, c)
    seconds = time.time() - began
    rows.unpersist()
    return test.select(id_col, F.col("label").cast("int").alias("true_label"), predicted(F.col("features"), model).alias("pred_label")), seconds
