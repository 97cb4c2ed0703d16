"""Registered queries: ``name -> callable(spark, sf_dir) -> DataFrame``.

Each query reads the given tables (or data Spark derives from them) in
full.  Output columns are flat scalars with the same names and types as
the matching SQL in :mod:`textlab.plans.oracle`.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..operators import embed, kmeans, logreg, metrics, models, neighbors, quantiles, reduce, report, sampling, svm, vectorize
from ..operators.common import r6, stage
from ..session import scratch_dir
from ..sources import files
from ..sources.tables import SCHEMAS, read_table, table_path
from .corpus import (CLASS_COLUMN, cleaned_corpus, fixture_word_vectors, reused_split_corpus, tokens_once, train_part,
                     vector_split)

# The corpus' expected class set for the input checks.
EXPECTED_CLASSES = ("de", "en", "es", "fr")
# The reference's ten topic names, index = label.
LABEL_NAMES = (
    "Society & Culture",
    "Science & Mathematics",
    "Health",
    "Education & Reference",
    "Computers & Internet",
    "Sports",
    "Business & Finance",
    "Entertainment & Music",
    "Family & Relationships",
    "Politics & Government",
)
SAMPLE_PER_CLASS = 50
SUMMARY_CAPACITY = 200_000
UNIFORM_SAMPLE = 2000


def scan_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus with its (partial) quality labels."""
    docs = read_table(spark, sf_dir, "documents", spread=False)
    labels = read_table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")


def input_checks(spark: SparkSession, sf_dir: str, label_col: str = CLASS_COLUMN,
                 expected=EXPECTED_CLASSES) -> DataFrame:
    """Required column present, class count, expected classes that have no rows."""
    docs = read_table(spark, sf_dir, "documents", spread=False)
    has_col = label_col in docs.columns
    present = docs.where(F.col(label_col).isNotNull()).select(F.col(label_col).alias("c")).distinct()
    exp = spark.createDataFrame([(c,) for c in expected], "c string")
    missing = exp.join(present, "c", "left_anti")
    n_rows = docs.select(F.count(F.lit(1))).scalar()
    n_classes = docs.select(F.countDistinct(label_col)).scalar()
    n_missing = missing.select(F.count(F.lit(1))).scalar()
    return spark.range(1).select(
        F.lit(has_col).alias("has_label_column"), n_rows.alias("n_rows"), n_classes.alias("n_classes"),
        F.lit(len(expected)).cast("long").alias("n_expected"), n_missing.alias("n_missing"),
        (F.lit(has_col) & (n_classes == len(expected)) & (n_missing == 0)).alias("ok"))


def combine_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turn t joined with turn t+1 of the same conversation, texts combined null-safely."""
    conv = read_table(spark, sf_dir, "conversations", spread=False)
    a = conv.select("conv_id", "turn", F.col("text").alias("a"))
    b = conv.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("b"))
    return a.join(b, ["conv_id", "turn"], "left").select("conv_id", "turn", tx.combine_text("a", "b").alias("text"))


def label_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label -> class name through a 10-row dimension (broadcast); unmapped -> null."""
    dim = spark.createDataFrame(list(enumerate(LABEL_NAMES)), "label int, label_name string")
    vecs = read_table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return vecs.join(F.broadcast(dim), "label", "left").select("vec_id", "label", "label_name")


def clean_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned text and its token count."""
    c = cleaned_corpus(spark, sf_dir)
    return c.select("doc_id", F.array_join("tokens", " ").alias("clean_text"),
                    F.size("tokens").cast("long").alias("n_tokens"))


def strip_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4-P6 on text that holds URLs: the page URL in a sentence, and the page HTML."""
    pages = read_table(spark, sf_dir, "pages")
    return pages.select("page_id",
                        tx.normalize_text(F.concat(F.lit("see "), F.col("url"), F.lit(" end"))).alias("url_text"),
                        tx.normalize_text("html").alias("html_text"))


def bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: contiguous bigrams of the cleaned token stream."""
    c = cleaned_corpus(spark, sf_dir)
    g = tx.ngrams("tokens", 2)
    return c.select("doc_id", F.size(g).cast("long").alias("n_bigrams"), F.array_join(g, "|").alias("bigrams"))


def text_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitespace token counts of the raw and the cleaned text."""
    docs = read_table(spark, sf_dir, "documents")
    return report.length_table(docs.select("doc_id", "text", tx.clean_tokens("text").alias("tokens"))).select(
        "doc_id", F.col("raw_len").cast("long"), F.col("clean_len").cast("long"))


def token_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """128-slot window with special tokens and padding, and its mask."""
    c = cleaned_corpus(spark, sf_dir).select("doc_id", tx.token_window("tokens").alias("w"))
    return c.select("doc_id", F.aggregate("w.mask", F.lit(0).cast("long"), lambda acc, x: acc + x).alias("mask_sum"),
                    F.array_join("w.window", " ").alias("window_text"),
                    F.array_join("w.mask", "").alias("mask_text"))


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/O2: documents per class."""
    docs = read_table(spark, sf_dir, "documents", spread=False)
    return report.class_counts(docs.select(F.col(CLASS_COLUMN).alias("lang")), "lang")


def sample_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the first three rows in id order."""
    docs = read_table(spark, sf_dir, "documents", spread=False)
    return docs.orderBy("doc_id").limit(3).select("doc_id", "lang", "text")


def stratified_sample(spark: SparkSession, sf_dir: str, n: int = SAMPLE_PER_CLASS) -> DataFrame:
    """Exactly min(n, class size) documents per class, seeded."""
    docs = read_table(spark, sf_dir, "documents", spread=False).select("doc_id", "lang")
    return sampling.stratified_sample(docs, "lang", "doc_id", n)


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact stratified 80/20 split."""
    docs = read_table(spark, sf_dir, "documents", spread=False).select("doc_id", "lang")
    return sampling.stratified_split(docs, "lang", "doc_id")


def term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram tf and df on the train split, pruned by document frequency."""
    train = train_part(reused_split_corpus(spark, sf_dir))
    n_docs = train.select(F.count(F.lit(1))).scalar()
    return vectorize.prune_terms(vectorize.term_statistics(train, n=1), n_docs)


def vocabulary_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capped unigram vocabulary with alphabetical column ids."""
    train = train_part(reused_split_corpus(spark, sf_dir))
    return vectorize.fit_vocabulary(train, n=1).select("term", "term_id", "tf", "df")


def incremental_counts(spark: SparkSession, sf_dir: str, path: str, scanned: list | None = None) -> DataFrame:
    """``(term, tf, df)`` over all documents from counts staged for each input file, which add up.

    ``scanned`` gets the files that were read because they were new or had changed.
    """
    def counts(rows: DataFrame) -> DataFrame:
        if scanned is not None:
            scanned.extend(rows.inputFiles())
        docs = rows.select("input", "doc_id", tx.clean_tokens("text").alias("tokens"))
        return vectorize.doc_term_counts(docs, "tokens", 1, "doc_id", ("input",)).groupBy("input", "term").agg(
            F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))

    parts = files.incremental_stage(spark, table_path(sf_dir, "documents"), path, counts, SCHEMAS["documents"])
    return parts.groupBy("term").agg(F.sum("tf").cast("long").alias("tf"), F.sum("df").cast("long").alias("df"))


def incremental_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term statistics of all documents by way of the stage that is kept for each input file."""
    return incremental_counts(spark, sf_dir, scratch_dir(spark, "term_counts"))


def _summarised(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    train = train_part(reused_split_corpus(spark, sf_dir))
    return vectorize.fit_vocabulary(train, n=n, capacity=SUMMARY_CAPACITY).select("term", "term_id", "tf", "df")


def vocabulary_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unigram vocabulary by heavy-hitter summaries, the way large corpora are counted."""
    return _summarised(spark, sf_dir, 1)


def bigram_vocabulary_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bigram vocabulary by heavy-hitter summaries; refused and counted in full where they prove too little."""
    return _summarised(spark, sf_dir, 2)


def bow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram counts of train and test documents over the train vocabulary."""
    split = reused_split_corpus(spark, sf_dir)
    vocab = vectorize.fit_vocabulary(train_part(split), n=1)
    return vectorize.bag_of_words(split, vocab, n=1, keep=("split",)).select(
        "doc_id", "split", "term_id", "count")


def tfidf_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5/P10: L2-normalised sublinear bigram TF-IDF of train and test over the train vocabulary."""
    split = reused_split_corpus(spark, sf_dir)
    vocab = vectorize.fit_vocabulary(train_part(split), n=2)
    return vectorize.tfidf(split, vocab, n=2, keep=("split",)).select(
        "doc_id", "split", "term_id", r6("weight").alias("weight"))


UNIFORM_SAMPLE_SMALL = 150


def uniform_sample_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W8 with fewer rows asked for than there are."""
    return uniform_sample(spark, sf_dir, UNIFORM_SAMPLE_SMALL)


def uniform_sample(spark: SparkSession, sf_dir: str, n: int = UNIFORM_SAMPLE) -> DataFrame:
    """min(n, rows) documents without replacement, seeded."""
    docs = read_table(spark, sf_dir, "documents", spread=False).select("doc_id", "lang")
    return sampling.uniform_sample(docs, "doc_id", n)


def _lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return report.length_table(docs.select("doc_id", "text", tx.clean_tokens("text").alias("tokens")))


def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50-bin histograms of raw and cleaned lengths over all documents."""
    return report.length_histogram(_lengths(spark, sf_dir))


def length_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians of raw and cleaned lengths."""
    return report.length_median(_lengths(spark, sf_dir))


def top_words_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 80 most frequent cleaned words per class."""
    c = cleaned_corpus(spark, sf_dir)
    return report.top_words_by_class(c, "label").select(
        F.col("label").alias("lang"), "rank", "word", F.col("n").cast("long"))


def top_terms_by_class(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """Flagship: clean -> exact split -> train-only bigram vocabulary -> TF-IDF -> per-class top k."""
    split = reused_split_corpus(spark, sf_dir)
    train = train_part(split)
    vocab = stage(vectorize.fit_vocabulary(train, n=2), "vocabulary")  # at most 20,000 rows, joined twice
    weights = vectorize.tfidf(train, vocab, n=2, keep=("label",))
    return report.top_terms_by_weight(weights, vocab, "label", k).withColumnRenamed("label", "lang")


def word_vector_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean word vector of each document's cleaned tokens; zeros without a known word."""
    docs = tokens_once(spark, sf_dir)
    wv = fixture_word_vectors(spark, sf_dir, docs)
    return embed.long_vectors(embed.mean_word_vectors(docs, wv), "doc_id", "vec")


def word_vector_mean_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same means by the blocked product, which word tables that cannot be broadcast take."""
    docs = tokens_once(spark, sf_dir)
    wv = fixture_word_vectors(spark, sf_dir, docs)
    return embed.long_vectors(embed.mean_word_vectors(docs, wv, limit=0), "doc_id", "vec")


def _pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tokens_once(spark, sf_dir)
    wv = fixture_word_vectors(spark, sf_dir, docs)
    return embed.pool_window(docs, wv, embed.vector_width(wv))


def masked_mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked mean over the 128-slot token states."""
    return embed.long_vectors(_pooled(spark, sf_dir), "doc_id", "mean")


def first_token_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of the first slot (the [CLS] token)."""
    return embed.long_vectors(_pooled(spark, sf_dir), "doc_id", "first")


def encode_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch encoder over the cleaned corpus (64 texts per batch), both poolings.

    The default encoder holds the word table, broadcast like model weights; a table too
    large for that is pooled by a join, with the same result.
    """
    docs = tokens_once(spark, sf_dir)
    wv = stage(fixture_word_vectors(spark, sf_dir, docs).select("word", "vec"), "word_vectors")
    table = embed.broadcast_words(wv)
    out = (embed.encode_documents(docs, lambda: embed.WordVectorEncoder(table)) if table is not None else
           embed.pool_window(docs, wv, embed.vector_width(wv)))
    z = out.select("doc_id", F.posexplode(F.arrays_zip("first", "mean")).alias("dim", "_z"))
    return z.select("doc_id", "dim", F.round("_z.first", 6).alias("first_value"),
                    F.round("_z.mean", 6).alias("mean_value"))


def _knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vector_split(spark, sf_dir)
    return neighbors.knn(v.where("split = 'train'"), v.where("split = 'test'"))


def knn_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 most cosine-similar train vectors of each test vector."""
    return _knn(spark, sf_dir).select("query_id", "rank", "train_id", "train_label", r6("sim").alias("sim"))


def knn_index_neighbors(spark: SparkSession, sf_dir: str, block_rows: int = 256) -> DataFrame:
    """The same neighbours through the ball index, which ``knn`` takes for train sides that are not broadcast."""
    v = vector_split(spark, sf_dir)
    found = neighbors.knn(v.where("split = 'train'"), v.where("split = 'test'"), block_rows=block_rows)
    return found.select("query_id", "rank", "train_id", "train_label", r6("sim").alias("sim"))


def _knn_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vector_split(spark, sf_dir)
    pred = neighbors.vote(_knn(spark, sf_dir))
    truth = v.where("split = 'test'").select(F.col("vec_id").alias("query_id"), F.col("label").alias("true_label"))
    # one row a query, staged: metrics that read it several times do not search again
    return stage(pred.join(truth, "query_id").select("query_id", "true_label", "pred_label"), "knn_predictions")


def knn_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-NN majority vote (ties -> smallest label)."""
    return _knn_predictions(spark, sf_dir)


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: confusion cells of the k-NN predictions (zero cells kept)."""
    return metrics.confusion(_knn_predictions(spark, sf_dir), [])


def metric_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy, weighted precision/recall/F1, macro F1 of the k-NN predictions."""
    return metrics.metric_bundle(_knn_predictions(spark, sf_dir), [])


def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-class report with accuracy, macro and weighted rows."""
    return metrics.class_report(_knn_predictions(spark, sf_dir), [])


def _assigned(spark: SparkSession, sf_dir: str):
    v = vector_split(spark, sf_dir)
    # one centre per label: a k x d table collected to build a literal (bounded by k)
    centers = [r["center"] for r in models.label_means(v.where("split = 'train'")).orderBy("label").collect()]
    a = v.select("vec_id", "label", "split",
                 models.nearest_centroid(F.transform("embedding", lambda x: x.cast("double")),
                                         models.centroid_literal(centers)).alias("cluster"))
    return a, len(centers)


def cluster_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest centroid (centroids = train mean per label) for every vector."""
    return _assigned(spark, sf_dir)[0].select("vec_id", "split", "cluster")


def cluster_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Majority train label per cluster; ties -> smallest label; empty cluster -> 0."""
    a, k = _assigned(spark, sf_dir)
    return models.cluster_majority(a.where("split = 'train'"), k)


def variance_ratio_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explained-variance ratios with the coordinate axes as components, cumulative, k95."""
    return reduce.axis_variance_ratios(read_table(spark, sf_dir, "embeddings"))


def component_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A16 on numeric columns: the exact quartiles of every vector component, by selection over refined histograms."""
    cells = read_table(spark, sf_dir, "embeddings").select(F.posexplode("embedding").alias("dim", "x"))
    found = quantiles.exact_quantiles(cells, "dim", "x")  # a row a component
    rows = [(int(g), *(round(float(v), 6) for v in q)) for g, q in found.items()]
    return spark.createDataFrame(rows, "dim int, q25 double, q50 double, q75 double")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: documents through CSV (quotes, newlines, header) and back with a declared schema."""
    docs = read_table(spark, sf_dir, "documents", spread=False).select("doc_id", "text", "lang")
    path = scratch_dir(spark, "csv")
    files.write_csv(docs, path)
    schema = SCHEMAS["documents"]
    return files.read_csv(spark, path, type(schema)([schema["doc_id"], schema["text"], schema["lang"]]))


def word_vector_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word vectors written as a text file and parsed back (whitespace split, float32, last line wins)."""
    wv = fixture_word_vectors(spark, sf_dir, tokens_once(spark, sf_dir))
    path = scratch_dir(spark, "word_vectors_txt")
    files.write_word_vectors(wv, path)
    back = files.read_word_vectors(spark, path)
    return back.select("word", F.posexplode("vec").alias("dim", "_v")).select(
        "word", "dim", F.col("_v").cast("double").alias("value"))


FEATURE_STORE = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("split", T.StringType()),
                              T.StructField("features", T.ArrayType(T.DoubleType()))])
LABEL_STORE = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", T.IntegerType())])


def feature_store(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Features and labels in stores of their own, bucketed by id, and joined where they lie."""
    v = vector_split(spark, sf_dir)
    buckets = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    feats = lambda: v.select("vec_id", "split", F.col("embedding").alias("features"))
    files.reuse_bucketed(spark, f"{root}/features", feats, FEATURE_STORE, "vec_id", buckets)
    labels = files.reuse_bucketed(spark, f"{root}/labels", lambda: v.select("vec_id", "label"), LABEL_STORE, "vec_id", buckets)
    # the second call finds the completed store and reads it instead of recomputing
    feats = files.reuse_bucketed(spark, f"{root}/features", lambda: None, FEATURE_STORE, "vec_id", buckets)
    return feats.join(labels.hint("merge"), "vec_id")


def feature_store_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features and labels stored apart, reused, re-joined on the id."""
    joined = feature_store(spark, sf_dir, scratch_dir(spark, "feature_store"))
    return joined.select("vec_id", "split", "label", F.posexplode("features").alias("dim", "value"))


def _reloaded_vectorizer(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """The vocabulary of n-grams fitted on train, written as a table and as an ML model, and both read again."""
    train = train_part(reused_split_corpus(spark, sf_dir))
    vocab = vectorize.fit_vocabulary(train, n=n)
    root = scratch_dir(spark, f"vectorizer_{n}")
    files.write_table(vocab, f"{root}/vocabulary")
    back = files.read_table_at(spark, f"{root}/vocabulary")
    files.save_count_vectorizer(back, f"{root}/count_vectorizer")
    # the reloaded model's terms (at most 20,000) must be the table's, id by id: others would lose their row here
    terms = spark.createDataFrame(list(enumerate(files.load_count_vectorizer(f"{root}/count_vectorizer"))), "term_id int, term string")
    return back.join(terms, ["term", "term_id"])


def vectorizer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted unigram vocabulary (with idf) persisted as a table and as an ML model, reloaded."""
    return _reloaded_vectorizer(spark, sf_dir, 1).select("term", "term_id", "tf", "df", r6("idf").alias("idf"))


def tfidf_vectorizer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bigram TF-IDF vectorizer persisted and reloaded, then used: the weights of all documents."""
    back = stage(_reloaded_vectorizer(spark, sf_dir, 2), "reloaded_vocabulary")
    weights = vectorize.tfidf(reused_split_corpus(spark, sf_dir), back, n=2, keep=("split",))
    return weights.select("doc_id", "split", "term_id", r6("weight").alias("weight"))


def _centroid_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 on exact centroids: nearest label-mean centroid, then the cluster's majority train label."""
    a, k = _assigned(spark, sf_dir)
    majority = models.cluster_majority(a.where("split = 'train'"), k).select(
        "cluster", F.col("label").alias("pred_label"))
    test = a.where("split = 'test'").select(F.col("vec_id").alias("query_id"),
                                            F.col("label").alias("true_label"), "cluster")
    return test.join(F.broadcast(majority), "cluster").select("query_id", "true_label", "pred_label")


def _exact_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    knn = _knn_predictions(spark, sf_dir).withColumn("model", F.lit("KNN"))
    cen = _centroid_predictions(spark, sf_dir).withColumn("model", F.lit("NearestCentroid"))
    return knn.unionByName(cen).withColumn("feature_set", F.lit("VECTORS"))


def tidy_metrics(pred: DataFrame, group_cols: list[str]) -> DataFrame:
    m = metrics.metric_bundle(pred, group_cols)
    return m.select(*group_cols, F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"))
                                                      for c in metrics.METRIC_NAMES])).alias("_m")).select(
        *group_cols, "_m.metric", "_m.value")


def _exported(spark: SparkSession, sf_dir: str) -> str:
    pred = _exact_predictions(spark, sf_dir)
    g = ["feature_set", "model"]
    path = scratch_dir(spark, "results_json")
    files.export_results(tidy_metrics(pred, g), metrics.confusion(pred, g), path)
    return path


def results_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and confusion matrices exported as nested JSON, the metrics reloaded as a tidy table."""
    return files.read_results(spark, _exported(spark, sf_dir))


def results_export_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same export, its confusion matrices reloaded cell by cell."""
    return files.read_result_cells(spark, _exported(spark, sf_dir))


def _vector_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vector_split(spark, sf_dir)
    return v.select(F.col("vec_id").alias("doc_id"), "split", "label",
                    F.transform("embedding", lambda x: x.cast("double")).alias("features"))


def svd_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram counts reduced by truncated SVD fitted on train (k by the 95% rule, cap 300)."""
    from .features import feature_set

    f = feature_set(spark, sf_dir, "BOW_SVD")
    return f.select("doc_id", "split", "label", F.size("features").alias("n_components"), "features")


def pca_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense vectors, centred PCA fitted on train (k by the 95% rule, cap 100)."""
    from .features import dense_pca

    out, _ = dense_pca(_vector_features(spark, sf_dir))
    return out.select(F.col("doc_id").alias("vec_id"), "split", "label",
                      F.size("features").alias("n_components"), "features")


def pca_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 checked exactly: at full width a row's squared norm is its squared distance to the train mean."""
    f = _vector_features(spark, sf_dir)
    width = f.select(F.max(F.size("features"))).first()[0] or 1
    _, (proj,), _ = reduce.pca_fit_project(f.where("split = 'train'"), [f], width, "features")
    squares = F.aggregate("features", F.lit(0.0), lambda a, x: a + x * x)
    return proj.select(F.col("doc_id").alias("vec_id"), "split", F.round(squares, 4).alias("squared_norm"))


def pca_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 checked exactly: sums of the eigenvalues, their squares and cubes; at the chosen k, the projection's
    covariance has nothing off its diagonal and the eigenvalues on it."""
    f = _vector_features(spark, sf_dir).where("split = 'train'")
    model = reduce.pca_fit(f)
    lam = model["variances"]
    total = float(lam.sum())
    k = reduce.choose_k((np.cumsum(lam) / total).tolist(), min(reduce.MAX_DENSE_COMPONENTS, len(lam)))
    sums = reduce.pca_project(f, model, k).select(F.posexplode("features").alias("i", "x"), "features").select("i", "x", F.posexplode("features").alias("j", "y"))
    cells = sums.groupBy("i", "j").agg((F.sum(F.col("x") * F.col("y")) / (model["n"] - 1)).alias("c")).collect()  # k x k
    off = max((abs(r["c"]) for r in cells if r["i"] != r["j"]), default=0.0) / total
    on = max(abs(r["c"] - lam[r["i"]]) for r in cells if r["i"] == r["j"]) / total
    rows = [("first", round(total, 6)), ("second", round(float((lam ** 2).sum()) / total ** 2, 9)), ("third", round(float((lam ** 3).sum()) / total ** 3, 9)),
            ("off_diagonal", round(off, 9)), ("on_diagonal", round(on, 9))]
    return spark.createDataFrame([(m, float(v)) for m, v in rows], "moment string, value double")


def _packed_counts(split: DataFrame, vocab: DataFrame, keys: tuple) -> DataFrame:
    """``(*keys, indices, values)``: counts of the vocabulary's terms, one sparse row for each combination of ``keys``."""
    counts = vectorize.bag_of_words(split, vocab, n=1, keep=tuple(k for k in keys if k != "doc_id"))
    sums = counts.groupBy(*keys, "term_id").agg(F.sum("count").cast("double").alias("v"))
    entries = F.array_sort(F.collect_list(F.struct("term_id", "v")))  # at most a vocabulary's number of terms
    return sums.groupBy(*keys).agg(entries.alias("e")).select(*keys, F.col("e.term_id").alias("indices"), F.col("e.v").alias("values"))


SVD_CHECK_COMPONENTS = 100


def svd_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 for every document: what the components explain of its squared norm, plus what they leave, is that norm.

    The rest is the norm of the row less its rebuilt projection, so components that are not orthonormal fail.
    """
    split = reused_split_corpus(spark, sf_dir)
    vocab = stage(vectorize.fit_vocabulary(train_part(split), n=1), "vocabulary")
    d = vocab.count()
    packed = split.select("doc_id", "split").join(_packed_counts(split, vocab, ("doc_id",)), "doc_id", "left")
    packed = stage(packed.select("doc_id", "split", F.coalesce("indices", F.array().cast("array<int>")).alias("indices"),
                                 F.coalesce("values", F.array().cast("array<double>")).alias("values")), "packed")
    train = train_part(packed)
    svd = reduce.truncated_svd(train, d, SVD_CHECK_COMPONENTS, train.count())
    parts = reduce.split_norms(packed, svd["components"], ["doc_id", "split"])
    return parts.select("doc_id", "split", F.round(F.col("explained") + F.col("rest"), 3).alias("squared_norm"))


def svd_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 checked exactly: sums of the eigenvalues and of their squares and cubes, and how many components converged.

    The rows are the word counts of all train documents by (source, lang) over the real vocabulary, so the
    spectrum is whole and SQL can take the same sums as traces of the Gram matrix and its powers.
    """
    split = reused_split_corpus(spark, sf_dir)
    vocab = stage(vectorize.fit_vocabulary(train_part(split), n=1), "vocabulary")
    d = vocab.count()
    groups = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"))
    packed = stage(_packed_counts(train_part(split).join(groups, "doc_id"), vocab, ("source", "label")), "packed")
    k = packed.count()
    svd = reduce.truncated_svd(packed, d, k, k)
    lam = svd["singular_values"] ** 2
    first = float(lam.sum())
    converged = int((svd["residuals"] <= reduce.SVD_TOLERANCE).sum())
    rows = [("components", float(k)), ("converged", float(converged)), ("first", round(first, 2)),
            ("second", round(float((lam ** 2).sum()) / first ** 2, 9)), ("third", round(float((lam ** 3).sum()) / first ** 3, 9))]
    return spark.createDataFrame([(m, float(v)) for m, v in rows], "moment string, value double")


def svd_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every component of the unigram counts' SVD is an eigenvector of the Gram matrix to ``SVD_RESIDUAL``."""
    from .features import feature_info

    info = feature_info(spark, sf_dir, "BOW_SVD")
    return spark.createDataFrame([(i, bool(r <= reduce.SVD_RESIDUAL)) for i, r in enumerate(info["residuals"], 1)], "component int, converged boolean")


def logreg_expected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 checked by optimality: with an unpenalised intercept the train probabilities of a class sum to its rows."""
    train = _vector_features(spark, sf_dir).where("split = 'train'").select(
        array_to_vector("features").alias("_fv"), F.col("label").cast("double").alias("_y")).persist()
    model = models.logistic_regression(train.count()).fit(train)
    p = model.transform(train).select(F.posexplode(vector_to_array("probability")).alias("label", "p"))
    out = stage(p.groupBy("label").agg(F.round(F.sum("p")).cast("long").alias("expected_rows")), "expected_rows")
    train.unpersist()
    return out.where(F.col("expected_rows") > 0)


def logreg_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 checked by optimality: the objective's gradient at the fitted weights, for every weight and intercept.

    It is taken by column sums over the train rows, not by the solver; weights that are not the optimum fail.
    """
    train = _vector_features(spark, sf_dir).where("split = 'train'")
    model = logreg.fit(train)
    return logreg.gradient(train, model).select("label", "dim", (F.round("gradient", 4) + 0.0).alias("gradient"))


def svm_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 checked by optimality: the squared-hinge objective's gradient at every weight and intercept of a fit run to its end."""
    train = _vector_features(spark, sf_dir).where("split = 'train'")
    model = svm.fit_squared_hinge(train, models.C_PENALTY, models.SVM_MAX_ITER, tol=1e-12)
    return svm.gradient(train, model, models.C_PENALTY).select("label", "dim", (F.round("gradient", 4) + 0.0).alias("gradient"))


def kmeans_fixed_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 checked by optimality: each centre is the mean of the rows nearest to it; in cluster -1's row, the kept
    cost is the sum of squared distances to the nearest centres and the least of all restarts."""
    train = _vector_features(spark, sf_dir).where("split = 'train'")
    k = train.select("label").distinct().count()
    model = kmeans.fit(train, k, tolerance=0.0)
    centres = models.centroid_literal(model["centres"])
    squares = lambda x, c: F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, v: a + v)
    near = train.select("features", models.nearest_centroid(F.col("features"), centres).alias("cluster"))
    near = stage(near.withColumn("d2", squares("features", F.get(centres, F.col("cluster")))), "nearest")
    means = near.groupBy("cluster").agg(vector_to_array(Summarizer.mean(array_to_vector("features"))).alias("mean"))
    moved = squares("mean", F.get(centres, F.col("cluster")))
    cells = means.select("cluster", (moved < 1e-12).alias("holds"))
    cost = near.agg(F.sum("d2").alias("cost")).select(F.lit(-1).alias("cluster"), (
        (F.abs(F.col("cost") - model["cost"]) < 1e-9 * F.col("cost")) & F.lit(model["cost"] == min(model["costs"]))).alias("holds"))
    return cells.unionByName(cost)


def variance_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative explained variance on the 20-point grid, from one fit per feature set."""
    from .features import FEATURE_SETS, feature_info, feature_sets

    feature_sets(spark, sf_dir)
    rows = []
    for name in FEATURE_SETS:
        info = feature_info(spark, sf_dir, name)
        cum = info["cumulative"]
        for n in reduce.sweep_grid(info["max_k"]):
            rows.append((name, int(n), float(round(cum[min(n, len(cum)) - 1], 6)), int(info["k"])))
    return spark.createDataFrame(rows, "feature_set string, n_components int, cumulative double, k int")


def projection_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per feature set, a seeded sample of min(2000, n) train rows in 2-D (centred PCA, k = 2)."""
    from .features import feature_sets

    out = None
    for name, features in feature_sets(spark, sf_dir).items():
        f = features.where("split = 'train'")
        sample = stage(sampling.uniform_sample(f, "doc_id", UNIFORM_SAMPLE), "projection_sample")
        proj, _, _ = reduce.pca_fit_project(sample, [], min(2, len(sample.first()["features"])), "features")
        xy = proj.select(F.lit(name).alias("feature_set"), "doc_id", "label", F.get("features", F.lit(0)).alias("x"),
                         F.coalesce(F.get("features", F.lit(1)), F.lit(0.0)).alias("y"))
        out = xy if out is None else out.unionByName(xy)
    return out


def _model_query(model_name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from .experiments import classify
        from .features import feature_set

        pred, _ = classify(model_name, feature_set(spark, sf_dir, "BOW_SVD"))
        return pred
    run.__doc__ = f"M7: {model_name} on unigram counts + SVD; test predictions (doc_id, true_label, pred_label)."
    return run


def experiment_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: 5 feature sets x 4 models, metrics and train times as a tidy table."""
    from .experiments import grid_results

    return grid_results(spark, sf_dir)


def grid_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 for all 20 experiments, from the staged predictions."""
    from .experiments import GROUP, grid_predictions

    return metrics.confusion(grid_predictions(spark, sf_dir), GROUP)


def grid_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 for all 20 experiments."""
    from .experiments import GROUP, grid_predictions

    return metrics.class_report(grid_predictions(spark, sf_dir), GROUP)


def grid_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 for all 20 experiments: nested JSON of metrics, train time and confusion matrix; the cells read back with the time."""
    from .experiments import GROUP, grid_predictions, grid_results

    path = scratch_dir(spark, "grid_json")
    files.export_results(grid_results(spark, sf_dir), metrics.confusion(grid_predictions(spark, sf_dir), GROUP), path)
    times = files.read_results(spark, path).where("metric = 'train_time'").select(*GROUP, F.col("value").alias("train_time"))
    return files.read_result_cells(spark, path).join(times, GROUP)


def metric_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature set x model grid of accuracy and macro F1 (missing experiment -> 0)."""
    from .experiments import MODELS, grid_results

    res = grid_results(spark, sf_dir).where(F.col("metric").isin("accuracy", "f1_macro"))
    return (res.groupBy("feature_set", "metric").pivot("model", list(MODELS)).agg(F.first("value"))
            .fillna(0.0))


def best_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best experiment by accuracy; ties -> first in run order."""
    from .experiments import grid_results

    return report.best_combination(grid_results(spark, sf_dir))


def train_time_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: all experiments by training time, longest first."""
    from .experiments import grid_results

    return report.train_time_ranking(grid_results(spark, sf_dir))


def stream_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 on Structured Streaming: the documents file read as a stream, cleaned, sunk to parquet, read back."""
    from ..streaming import documents as st

    root = scratch_dir(spark, "stream_clean")
    src = f"{sf_dir.rstrip('/')}/documents*.parquet"
    st.run_to_table(st.clean_stream(st.document_stream(spark, src)), f"{root}/out", f"{root}/checkpoint")
    out = spark.read.parquet(f"{root}/out")
    return out.select("doc_id", "clean_text", F.size("tokens").cast("long").alias("n_tokens"))


def _nearest_centroid_predictions(df: DataFrame) -> DataFrame:
    """M5 -> A9 -> M6 with label-mean centroids over ``(id, label, split, e)``: exact, no iteration."""
    centers = [r["center"] for r in models.label_means(df.where("split = 'train'"), "e").orderBy("label").collect()]
    a = df.select("id", "label", "split",
                  models.nearest_centroid(F.col("e"), models.centroid_literal(centers)).alias("cluster"))
    majority = models.cluster_majority(a.where("split = 'train'"), len(centers)).select(
        "cluster", F.col("label").alias("pred_label"))
    return (a.where("split = 'test'").join(F.broadcast(majority), "cluster")
            .select(F.col("id").alias("query_id"), F.col("label").alias("true_label"), "pred_label"))


def _knn_model_predictions(df: DataFrame) -> DataFrame:
    nn = neighbors.knn(df.where("split = 'train'"), df.where("split = 'test'"), train_id="id", query_id="id",
                       vec_col="e", label_col="label")
    truth = df.where("split = 'test'").select(F.col("id").alias("query_id"), F.col("label").alias("true_label"))
    return neighbors.vote(nn).join(truth, "query_id").select("query_id", "true_label", "pred_label")


def _exact_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the exactly reproducible experiments: {VECTORS, WORDVEC} x {KNN, NearestCentroid}."""
    from .features import labelled_split

    v = vector_split(spark, sf_dir).select(F.col("vec_id").alias("id"), "label", "split",
                                           F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    split = labelled_split(spark, sf_dir)
    wv = fixture_word_vectors(spark, sf_dir, split)
    docs = embed.mean_word_vectors(split.select("doc_id", "tokens"), wv)
    d = split.select(F.col("doc_id").alias("id"), "label", "split").join(
        docs.select(F.col("doc_id").alias("id"), F.col("vec").alias("e")), "id")
    parts, order = [], 0
    for fs, df in (("VECTORS", v), ("WORDVEC", d)):
        df = df.persist()
        for model, fn in (("KNN", _knn_model_predictions), ("NearestCentroid", _nearest_centroid_predictions)):
            parts.append(fn(df).select(F.lit(fs).alias("feature_set"), F.lit(model).alias("model"),
                                       F.lit(order).alias("run_order"), "true_label", "pred_label"))
            order += 1
    allpred = parts[0]
    for p in parts[1:]:
        allpred = allpred.unionByName(p)
    g = ["feature_set", "model", "run_order"]
    return tidy_metrics(allpred, g)


def metric_matrix_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A19 over exactly reproducible experiments: feature set x model grid of accuracy and macro F1."""
    res = _exact_experiments(spark, sf_dir).where(F.col("metric").isin("accuracy", "f1_macro"))
    return (res.groupBy("feature_set", "metric").pivot("model", ["KNN", "NearestCentroid"])
            .agg(F.first("value")).fillna(0.0))


def best_combination_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A20 over exactly reproducible experiments: best accuracy, ties -> first in run order."""
    return report.best_combination(_exact_experiments(spark, sf_dir))


def knn_full_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 and D2 as a cell of the grid, exactly: a PCA of full width turns the centred vectors without changing their angles."""
    from .experiments import classify

    f = _vector_features(spark, sf_dir)
    width = f.select(F.max(F.size("features"))).first()[0] or 1
    _, (proj,), _ = reduce.pca_fit_project(f.where("split = 'train'"), [f], width, "features")
    pred, _ = classify("KNN", stage(proj.select("doc_id", "split", "label", "features"), "full_width"))
    return pred.withColumnRenamed("doc_id", "vec_id")


def time_ranking_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 on a results table with many ties: mean lengths (in steps of 10) of the documents of each source and language."""
    docs = read_table(spark, sf_dir, "documents")
    cells = docs.groupBy(F.coalesce("source", F.lit("-")).alias("feature_set"), F.coalesce("lang", F.lit("-")).alias("model")).agg(
        F.expr("cast(coalesce(sum(n_chars), 0) div (10 * count(*)) as double)").alias("value"))
    return report.train_time_ranking(cells.withColumn("metric", F.lit("train_time")))


QUERIES = {
    "top_terms_by_class": top_terms_by_class,
    "scan_corpus": scan_corpus,
    "input_checks": input_checks,
    "combine_text": combine_text,
    "label_names": label_names,
    "clean_text": clean_text_query,
    "strip_urls": strip_urls,
    "bigrams": bigrams,
    "text_lengths": text_lengths,
    "token_window": token_window,
    "class_counts": class_counts,
    "sample_peek": sample_peek,
    "stratified_sample": stratified_sample,
    "stratified_split": stratified_split,
    "term_stats": term_stats,
    "vocabulary_topk": vocabulary_topk,
    "vocabulary_summaries": vocabulary_summaries,
    "incremental_term_counts": incremental_term_counts,
    "bigram_vocabulary_summaries": bigram_vocabulary_summaries,
    "bow": bow,
    "tfidf_bigrams": tfidf_bigrams,
    "uniform_sample": uniform_sample,
    "uniform_sample_cut": uniform_sample_cut,
    "length_histogram": length_histogram,
    "length_median": length_median,
    "component_quantiles": component_quantiles,
    "top_words_by_class": top_words_by_class,
    "word_vector_mean": word_vector_mean,
    "word_vector_mean_blocks": word_vector_mean_blocks,
    "masked_mean_pool": masked_mean_pool,
    "first_token_pool": first_token_pool,
    "encode_batches": encode_batches,
    "knn_neighbors": knn_neighbors,
    "knn_index_neighbors": knn_index_neighbors,
    "knn_predict": knn_predict,
    "confusion_matrix": confusion_matrix,
    "metric_bundle": metric_bundle,
    "class_report": class_report,
    "cluster_assign": cluster_assign,
    "cluster_majority": cluster_majority,
    "variance_ratio_axes": variance_ratio_axes,
    "csv_roundtrip": csv_roundtrip,
    "word_vector_file": word_vector_file,
    "feature_store_roundtrip": feature_store_roundtrip,
    "vectorizer_roundtrip": vectorizer_roundtrip,
    "tfidf_vectorizer_roundtrip": tfidf_vectorizer_roundtrip,
    "results_export": results_export,
    "results_export_cells": results_export_cells,
    "svd_project": svd_project,
    "pca_project": pca_project,
    "pca_norms": pca_norms,
    "pca_moments": pca_moments,
    "svd_norms": svd_norms,
    "svd_moments": svd_moments,
    "svd_residuals": svd_residuals,
    "logreg_expected_rows": logreg_expected_rows,
    "logreg_gradient": logreg_gradient,
    "svm_gradient": svm_gradient,
    "kmeans_fixed_point": kmeans_fixed_point,
    "variance_sweep": variance_sweep,
    "projection_2d": projection_2d,
    "logreg_predict": _model_query("LogisticRegression"),
    "linear_svm_predict": _model_query("LinearSVC"),
    "kmeans_classify": _model_query("KMeans"),
    "experiment_grid": experiment_grid,
    "grid_confusion": grid_confusion,
    "grid_class_report": grid_class_report,
    "grid_export": grid_export,
    "metric_matrix": metric_matrix,
    "best_combination": best_combination,
    "train_time_ranking": train_time_ranking,
    "stream_clean_text": stream_clean_text,
    "metric_matrix_exact": metric_matrix_exact,
    "best_combination_exact": best_combination_exact,
    "knn_full_width": knn_full_width,
    "time_ranking_exact": time_ranking_exact,
}
