from pyspark.sql import functions as F

from textlab.operators import models, report


def test_cluster_majority_ties_and_empty(spark):
    a = spark.createDataFrame([(0, 3), (0, 3), (0, 1), (0, 1), (1, 2)], "cluster int, label int")
    got = {r["cluster"]: r["label"] for r in models.cluster_majority(a, 3).collect()}
    assert got == {0: 1, 1: 2, 2: 0}


def test_nearest_centroid_tie_smaller_index(spark):
    df = spark.createDataFrame([([0.0, 0.0],)], "v array<double>")
    c = models.centroid_literal([[1.0, 0.0], [-1.0, 0.0]])
    assert df.select(models.nearest_centroid(F.col("v"), c).alias("c")).first()["c"] == 0


def test_median_and_equal_lengths_histogram(spark):
    lengths = spark.createDataFrame([(i, float(i), 5.0) for i in (1, 2, 3, 4)], "doc_id long, raw_len double, clean_len double")
    med = {r["kind"]: r["median"] for r in report.length_median(lengths).collect()}
    assert med["raw_len"] == 2.5
    h = report.length_histogram(lengths).where("kind = 'clean_len' and n > 0").collect()
    assert len(h) == 1 and h[0]["n"] == 4


def test_best_combination_tie_first_in_run_order(spark):
    res = spark.createDataFrame([("A", "m1", "accuracy", 0.5, 2), ("B", "m2", "accuracy", 0.5, 1)],
                                "feature_set string, model string, metric string, value double, run_order int")
    best = report.best_combination(res).first()
    assert (best["feature_set"], best["model"]) == ("B", "m2")


def test_metric_matrix_missing_is_zero(spark):
    res = spark.createDataFrame([("A", "m1", "accuracy", 0.5)], "feature_set string, model string, metric string, value double")
    row = report.metric_matrix(res, "accuracy", ["m1", "m2"]).first()
    assert row["m1"] == 0.5 and row["m2"] == 0.0


def test_squared_hinge_svm_reaches_optimum(spark):
    import numpy as np

    from textlab.operators import svm

    rng = np.random.default_rng(5)
    X = rng.standard_normal((90, 4))
    y = (X[:, 0] + 0.5 * X[:, 1] > 0).astype(int) + (X[:, 2] > 1).astype(int)
    df = spark.createDataFrame([(i, [float(v) for v in x], int(t)) for i, (x, t) in enumerate(zip(X, y))],
                               "id long, features array<double>, label int").repartition(3)
    m = svm.fit_squared_hinge(df, c=1.0, tol=1e-8, max_iter=50)
    Xa = np.hstack([X, np.ones((90, 1))])
    for k, cls in enumerate(m["classes"]):
        Y = np.where(y == cls, 1.0, -1.0)
        w = m["weights"][k]
        z = Xa @ w
        act = 1 - Y * z > 0
        grad = w + 2 * ((z - Y) * act) @ Xa
        assert np.linalg.norm(grad) < 1e-6
    pred = df.select("id", svm.decision_label(F.col("features"), m).alias("p")).orderBy("id").collect()
    scores = Xa @ m["weights"].T
    assert [r["p"] for r in pred] == list(m["classes"][scores.argmax(axis=1)])
