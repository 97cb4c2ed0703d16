"""Classifiers on dense feature arrays, with fit timing.

Features are ``array<double>`` columns turned into ML vectors at the
boundary (``array_to_vector``, JVM side).  Fits run on a persisted,
materialised train set so the timer measures the fit only (M7).
Cluster assignment broadcasts the k centroids as a literal and picks the
nearest one with array expressions (no join, no per-row Python).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import kmeans
from .clock import WorkClock

# The reference's model settings.
LOGREG_MAX_ITER = 1000
SVM_MAX_ITER = 2000
C_PENALTY = 1.0
KMEANS_RESTARTS = 10
KMEANS_MAX_ITER = 300
KMEANS_TOL = 1e-4
SEED = 42


# Iterative fits run one job per iteration; partitions are sized by bytes so a
# reduced train set (n x <=300 doubles) is not spread over more tasks than its
# size warrants, while large train sets keep their parallelism.
FIT_PARTITION_BYTES = 32 << 20
KMEANS_PARTITION_BYTES = 4 << 20  # a pass multiplies with the centres of all restarts


def _vectors(df: DataFrame, features: str = "features") -> DataFrame:
    return df.withColumn("_fv", array_to_vector(features))


def compact_for_fit(df: DataFrame, n_rows: int, row_bytes: int, target: int = FIT_PARTITION_BYTES) -> DataFrame:
    """Coalesce (no shuffle) to ``ceil(n_rows*row_bytes / target)`` partitions, never more than it has."""
    want = max(1, -(-n_rows * row_bytes // target))
    have = df.rdd.getNumPartitions()
    return df.coalesce(want) if want < have else df


def kept_on_disk(train: DataFrame) -> DataFrame:
    """M7: the train rows made before the clock starts; a fit holds its own form of them in memory, and not both."""
    train = train.persist(StorageLevel.DISK_ONLY)
    train.count()
    return train


def fit_timed(estimator, train: DataFrame):
    """M7: fit on a persisted train set; the clock covers the fit only."""
    train = kept_on_disk(train)
    with WorkClock(train.sparkSession) as clock:
        model = estimator.fit(train)
    train.unpersist()
    return model, clock.seconds


def logistic_regression(n_train: int, max_iter: int = LOGREG_MAX_ITER, c: float = C_PENALTY) -> LogisticRegression:
    """M1: multinomial, L2 with ``C`` -> ``regParam = 1/(C*n)``, unpenalised intercept, no standardisation."""
    return LogisticRegression(featuresCol="_fv", labelCol="_y", family="multinomial", maxIter=max_iter,
                              regParam=1.0 / (c * n_train), elasticNetParam=0.0, standardization=False, tol=1e-4)


def linear_svm(n_train: int, max_iter: int = SVM_MAX_ITER, c: float = C_PENALTY) -> OneVsRest:
    """M2 (v1, kept for comparison): Spark's one-vs-rest ``LinearSVC`` (plain hinge loss, unpenalised intercept).

    The registered queries use :mod:`textlab.operators.svm` (squared hinge, the reference's loss).
    """
    svc = LinearSVC(featuresCol="_fv", labelCol="_y", maxIter=max_iter, regParam=1.0 / (c * n_train),
                    standardization=False, tol=1e-4)
    return OneVsRest(classifier=svc, featuresCol="_fv", labelCol="_y", parallelism=4)


def train_and_predict(kind: str, train: DataFrame, test: DataFrame, features: str = "features",
                      label: str = "label", id_col: str = "doc_id") -> tuple[DataFrame, float]:
    """Fit ``kind`` in {'logreg', 'svm'} on train, predict test -> ``(id, true_label, pred_label)``, seconds."""
    tr = _vectors(train, features).withColumn("_y", F.col(label).cast("double")).select(id_col, "_fv", "_y")
    n = tr.count()
    width = len(train.select(features).first()[0])
    tr = compact_for_fit(tr, n, 8 * (width + 2))
    est = logistic_regression(n) if kind == "logreg" else linear_svm(n)
    model, secs = fit_timed(est, tr)
    pred = model.transform(_vectors(test, features).select(id_col, "_fv", F.col(label).alias("true_label")))
    return pred.select(id_col, F.col("true_label").cast("int"),
                       F.col("prediction").cast("int").alias("pred_label")), secs


def kmeans_best(train: DataFrame, k: int, features: str = "features", restarts: int = KMEANS_RESTARTS,
                seed: int = SEED) -> tuple[dict, float]:
    """M4: the lowest cost of ``restarts`` fits that advance together; returns (model, seconds of the fit)."""
    n = train.count()
    width = len(train.select(features).first()[0])
    tr = kept_on_disk(compact_for_fit(train.select(features), n, 8 * (width + 1), KMEANS_PARTITION_BYTES))
    with WorkClock(train.sparkSession) as clock:
        model = kmeans.fit(tr, k, restarts, seed, KMEANS_MAX_ITER, KMEANS_TOL, features)
    tr.unpersist()
    return model, clock.seconds


def centroid_literal(centers: list) -> Column:
    return F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])


def nearest_centroid(vec: Column, centers: Column) -> Column:
    """M5: index of the nearest centroid by squared distance (rounded to 9 places; ties -> smaller index)."""
    dists = F.transform(centers, lambda c: F.round(F.aggregate(
        F.zip_with(vec, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x), 9))
    return (F.array_position(dists, F.array_min(dists)) - 1).cast("int")


def label_means(train: DataFrame, features: str = "embedding", label: str = "label") -> DataFrame:
    """Mean vector per label (``Summarizer``; one partial aggregate per task)."""
    return (train.select(F.col(label).alias("label"), array_to_vector(features).alias("v"))
            .groupBy("label").agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("center")))


def cluster_majority(assigned: DataFrame, k: int, cluster_col: str = "cluster", label_col: str = "label") -> DataFrame:
    """Majority train label per cluster id ``0..k-1``; ties -> smallest label; empty cluster -> 0."""
    counts = assigned.groupBy(cluster_col, label_col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(cluster_col).orderBy(F.col("n").desc(), F.col(label_col).asc())
    top = counts.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    ids = assigned.sparkSession.range(k).select(F.col("id").cast("int").alias(cluster_col))
    return ids.join(top, cluster_col, "left").select(
        cluster_col, F.coalesce(F.col(label_col), F.lit(0)).cast("int").alias("label"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"))
