"""Feature sets for the classifiers (D4): sparse counts/TF-IDF -> SVD, dense vectors -> centred PCA.

Every feature set is a table ``(doc_id, split, label int, features array<double>)``
staged once per input folder (S8) so the model queries and the experiment
grid reuse it instead of refitting.
"""

from __future__ import annotations

import hashlib
from functools import partial
from pathlib import Path

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import embed, reduce, vectorize
from ..operators.common import bounded_broadcast, join_on_groups, let_go, stage, unstage
from ..session import checkpoint_root
from ..sources import files
from ..sources.tables import table_path
from .corpus import reused_split_corpus, reused_word_vectors, train_part
from .overlap import LANES, overlap

FEATURE_SETS = ("BOW_SVD", "TFIDF_SVD", "FIRST_PCA", "MEAN_PCA", "WORDVEC_PCA")


_CODE_KEY: list = []


def _code_key() -> str:
    """Fingerprint of the library source, so a stage written by other code is never reused."""
    if not _CODE_KEY:
        root = Path(__file__).resolve().parents[1]
        h = hashlib.md5()
        for f in sorted(root.rglob("*.py")):
            h.update(f.read_bytes())
        _CODE_KEY.append(h.hexdigest()[:12])
    return _CODE_KEY[0]


def stage_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Stage folder keyed by the input files and the library code, under the shared checkpoint root."""
    key = files.input_fingerprint(spark, sf_dir)
    return f"{checkpoint_root(spark).rstrip('/')}/textlab/stages/{_code_key()}/{key}/{name}"


def labelled_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split corpus with the class as an int (classes in sorted order, null last; a class-sized lookup)."""
    split = reused_split_corpus(spark, sf_dir)
    classes = split.select("label").distinct().withColumn(
        "y", (F.dense_rank().over(Window.orderBy(F.col("label").asc_nulls_last())) - 1).cast("int"))
    # one row per class, counted before it is broadcast
    return join_on_groups(split, bounded_broadcast(classes), ["label"]).select("doc_id", "split", "tokens", F.col("y").alias("label"))


def _sparse_svd(spark: SparkSession, sf_dir: str, n: int, weighted: bool) -> tuple[DataFrame, dict]:
    split = labelled_split(spark, sf_dir)
    train = train_part(split)
    vocab = stage(vectorize.fit_vocabulary(train, n=n), "vocabulary")
    d = vocab.count()
    long = (vectorize.tfidf(split, vocab, n=n) if weighted else
            vectorize.bag_of_words(split, vocab, n=n).withColumnRenamed("count", "weight"))
    long = long.select("doc_id", "term_id", F.col("weight").cast("double").alias("weight"))
    packed = split.select("doc_id", "split", "label").join(vectorize.pack(long, "weight"), "doc_id", "left")
    packed = packed.select("doc_id", "split", "label",
                           F.coalesce("indices", F.array().cast("array<int>")).alias("indices"),
                           F.coalesce("values", F.array().cast("array<double>")).alias("values"))
    packed = stage(packed, "packed")  # not held in memory beside the train rows that the SVD persists
    n_train = packed.where("split = 'train'").count()
    # column sums from the staged packed train rows (no second pass over the tokens)
    entries = packed.where("split = 'train'").select(F.explode(F.arrays_zip("indices", "values")).alias("_e"))
    stats = reduce.column_stats(entries.select(F.col("_e.indices").alias("term_id"), F.col("_e.values").alias("weight")),
                                d, "weight")
    max_k = min(reduce.MAX_SPARSE_COMPONENTS, d, n_train)
    svd = reduce.truncated_svd(packed.where("split = 'train'"), d, max_k, n_train, stats)
    cum = np.cumsum(svd["ratios"]).tolist()
    k = reduce.choose_k(cum, max_k)
    feats = reduce.project_sparse(packed, svd["components"][:, :k], ["doc_id", "split", "label"])
    info = {"max_k": max_k, "k": k, "cumulative": cum, "residuals": svd["residuals"].tolist(), "spent": [vocab, packed]}
    return feats, info


def dense_pca(vectors: DataFrame) -> tuple[DataFrame, dict]:
    """Centred PCA fitted on the train rows; k = smallest reaching 95% variance, capped at min(100, d, n)."""
    vectors = stage(vectors, "vectors")
    train = vectors.where("split = 'train'")
    n_train = train.count()
    d = vectors.select(F.max(F.size("features"))).first()[0]
    max_k = min(reduce.MAX_DENSE_COMPONENTS, d, n_train)
    var = train.select(Summarizer.variance(array_to_vector("features")).alias("v")).first()["v"]
    if var is None or float(np.sum(var.toArray())) <= 0.0:
        raise ValueError("the train vectors are constant: there is no variance to explain")
    _, (proj,), ratios = reduce.pca_fit_project(train, [vectors], max_k, "features")
    cum = np.cumsum(ratios).tolist()
    k = reduce.choose_k(cum, max_k)
    out = proj.select("doc_id", "split", "label", F.slice("features", 1, k).alias("features"))
    return out, {"max_k": max_k, "k": k, "cumulative": cum, "spent": [vectors]}


def _dense_inputs(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    split = labelled_split(spark, sf_dir)
    docs = split.select("doc_id", "tokens")
    wv = reused_word_vectors(spark, sf_dir)
    if which == "WORDVEC":
        vec = embed.mean_word_vectors(docs, wv)
    else:
        pooled = embed.pool_window(docs, wv, embed.vector_width(wv))
        vec = pooled.select("doc_id", F.col("first" if which == "FIRST" else "mean").alias("vec"))
    return split.select("doc_id", "split", "label").join(vec, "doc_id").select(
        "doc_id", "split", "label", F.col("vec").alias("features"))


def build_feature_set(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, dict]:
    """The feature table, still to be computed, and its curve; ``spent`` are stages that go when it has been written."""
    if name == "BOW_SVD":
        return _sparse_svd(spark, sf_dir, 1, False)
    if name == "TFIDF_SVD":
        return _sparse_svd(spark, sf_dir, 2, True)
    return dense_pca(_dense_inputs(spark, sf_dir, name.split("_")[0]))


def feature_set(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The staged feature table for ``name`` (computed and written on first use, its variance curve beside it)."""
    files.require_inputs(spark, [table_path(sf_dir, t) for t in ("documents", "embeddings")])

    spent = []

    def compute():
        df, info = build_feature_set(spark, sf_dir, name)
        spent.extend(info["spent"])
        curve = spark.createDataFrame([(int(info["max_k"]), int(info["k"]), [float(c) for c in info["cumulative"]],
                                        [float(r) for r in info.get("residuals", [])])],
                                      "max_k int, k int, cumulative array<double>, residuals array<double>")
        files.reuse_or_compute(spark, stage_path(spark, sf_dir, f"curve_{name}"), lambda: curve)
        return df

    out = files.reuse_or_compute(spark, stage_path(spark, sf_dir, f"features_{name}"), compute)
    if spent:
        unstage(*spent)
        let_go(spark)
    return out


def feature_sets(spark: SparkSession, sf_dir: str, names=FEATURE_SETS, lanes: int = LANES) -> dict[str, DataFrame]:
    """The staged feature tables by name, ``lanes`` of them built at a time after what they share."""
    files.require_inputs(spark, [table_path(sf_dir, t) for t in ("documents", "embeddings")])
    reused_split_corpus(spark, sf_dir)  # all feature sets read it
    if any(name.endswith("_PCA") for name in names):
        reused_word_vectors(spark, sf_dir)
    built = overlap(spark, {f"features {name}": partial(feature_set, spark, sf_dir, name) for name in names}, lanes)
    return {name: built[f"features {name}"] for name in names}


def feature_info(spark: SparkSession, sf_dir: str, name: str) -> dict:
    """The variance curve staged with the features: ``max_k``, ``k``, the cumulative ratios and the residuals (one row)."""
    feature_set(spark, sf_dir, name)
    return spark.read.parquet(stage_path(spark, sf_dir, f"curve_{name}")).first().asDict()
