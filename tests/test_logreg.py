import numpy as np
import pytest
from pyspark.sql import functions as F

from textlab.operators import logreg, models


def data(spark, n=400, d=12, k=4, seed=1, sparse=False):
    rng = np.random.default_rng(seed)
    X = rng.standard_normal((n, d)) * (rng.random((n, d)) < 0.5) * np.linspace(3, 0.2, d)
    y = np.argmax(X[:, :k] + 0.8 * rng.standard_normal((n, k)), axis=1) * 2 + 1  # classes 1, 3, 5, 7
    if sparse:
        rows = [(i, int(c), np.flatnonzero(x).tolist(), x[x != 0].tolist()) for i, (x, c) in enumerate(zip(X, y))]
        return X, y, spark.createDataFrame(rows, "doc_id long, label int, indices array<int>, values array<double>").repartition(3)
    return X, y, spark.createDataFrame([(i, int(c), x.tolist()) for i, (x, c) in enumerate(zip(X, y))], "doc_id long, label int, features array<double>").repartition(3)


def plain_gradient(X, y, classes, W):
    S = X @ W[:, :-1].T + W[:, -1]
    P = np.exp(S - S.max(1, keepdims=True))
    P /= P.sum(1, keepdims=True)
    R = P - (y[:, None] == classes)
    return np.hstack([R.T @ X + W[:, :-1], R.sum(0)[:, None]])


def test_gradient_vanishes_and_predictions_equal_the_library(spark):
    X, y, df = data(spark)
    model = logreg.fit(df)
    assert np.abs(plain_gradient(X, y, model["classes"], model["weights"])).max() < 1e-3
    lib = models.logistic_regression(len(y)).setTol(1e-10).fit(models._vectors(df).withColumn("_y", F.col("label").cast("double")))
    W = lib.coefficientMatrix.toArray()[[1, 3, 5, 7]]
    assert np.allclose(model["weights"][:, :-1], W, atol=2e-3)
    got = df.select("doc_id", logreg.predicted(F.col("features"), model).alias("p")).orderBy("doc_id").collect()
    assert [r["p"] for r in got] == model["classes"][np.argmax(X @ model["weights"][:, :-1].T + model["weights"][:, -1], axis=1)].tolist()


def test_reported_gradient_is_that_of_the_weights(spark):
    X, y, df = data(spark, seed=2)
    model = logreg.fit(df, tolerance=0.05)  # stopped early
    for m in (model, {**model, "weights": np.zeros_like(model["weights"])}):
        got = {(r["label"], r["dim"]): r["gradient"] for r in logreg.gradient(df, m).collect()}
        want = plain_gradient(X, y, m["classes"], m["weights"])
        assert np.allclose([[got[(c, i)] for i in range(X.shape[1] + 1)] for c in m["classes"].tolist()], want, atol=1e-8)
        assert np.abs(want).max() > 0.1


@pytest.mark.parametrize("dense_width", [1024, 0])
def test_sparse_rows_give_the_same_model(spark, monkeypatch, dense_width):
    monkeypatch.setattr(logreg, "DENSE_WIDTH", dense_width)  # 0: the diagonal preconditioner
    X, y, df = data(spark, seed=3, sparse=True)
    model = logreg.fit(df, width=X.shape[1])
    assert np.abs(plain_gradient(X, y, model["classes"], model["weights"])).max() < 1e-3


def test_one_class_and_separable_classes(spark):
    one = spark.createDataFrame([(1, 0, [1.0, 2.0]), (2, 0, [0.0, 1.0])], "doc_id long, label int, features array<double>")
    assert not logreg.fit(one)["weights"].any()
    apart = spark.createDataFrame([(i, i % 2, [100.0 * (i % 2) - 50, float(i)]) for i in range(40)], "doc_id long, label int, features array<double>")
    pred, _ = logreg.train_and_predict(apart, apart)
    assert pred.where("true_label <> pred_label").isEmpty()
