"""Train-only vocabulary, bag-of-words and bigram TF-IDF.

Long form ``(doc_id, term_id, value)`` is the queryable sparse matrix;
:func:`pack` turns it into one row per document (``indices``, ``values``)
for linear algebra.

Plan shape (checked with ``explain``): a document is one row, so its
term frequencies are counted where it lies (Arrow batches: the grams are encoded
by a hash table and cells of document and code counted) and only distinct
``(doc, term, tf)`` rows leave it.  They are filtered against the vocabulary by a broadcast hash
join (the vocabulary is capped at ``max_features`` rows, a proven bound).
Bag-of-words therefore needs no shuffle at all; TF-IDF shuffles once, by
document, for the L2 norm.  Term statistics aggregate by term only, with
map-side partial aggregation, so a term found in every document is
combined per task and ``count(distinct doc)`` never materialises a
per-term set.  ``doc_id`` is a key of the document table (one row per
document).
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ngrams
from . import heavy

MAX_FEATURES = 20000
MIN_DF = 2
MAX_DF = "0.95"
# Corpora that the optimizer takes to be larger are summarised before they are counted.
SUMMARY_BYTES = 64 << 30


def _grams(tokens_col: str, n: int):
    return F.col(tokens_col) if n == 1 else ngrams(tokens_col, n)


def doc_terms(docs: DataFrame, tokens_col: str = "tokens", n: int = 1, id_col: str = "doc_id",
              keep: tuple = ()) -> DataFrame:
    """Explode n-grams of the token array: one row per occurrence ``(doc_id, *keep, term)``."""
    return docs.select(id_col, *keep, F.explode(_grams(tokens_col, n)).alias("term"))


def doc_term_counts(docs: DataFrame, tokens_col: str = "tokens", n: int = 1, id_col: str = "doc_id",
                    keep: tuple = ()) -> DataFrame:
    """A4 (before the vocabulary): ``(doc_id, *keep, term, tf)``, counted row by row (no shuffle).

    ``id_col=None`` leaves the document id out.

    ``keep`` are per-document columns (e.g. the label) carried along so no
    join back to the documents is needed later.
    """
    cols = [c for c in (id_col, *keep) if c]

    def run(batches):
        for b in batches:
            for a, z in _token_slices(b.column(len(cols))):
                row, grams = _flat_grams(b.column(len(cols)).slice(a, z - a), n)
                codes = grams.dictionary_encode()
                cells = row * max(1, len(codes.dictionary)) + codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                cells, counts = np.unique(cells, return_counts=True)
                at, code = np.divmod(cells, max(1, len(codes.dictionary)))
                yield pa.RecordBatch.from_arrays([*(b.column(i).take(pa.array(at + a)) for i in range(len(cols))), codes.dictionary.take(pa.array(code)), pa.array(counts, pa.int64())],
                                                 [*cols, "term", "tf"])

    schema = T.StructType([*(docs.schema[c] for c in cols), T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])
    return docs.select(*cols, tokens_col).mapInArrow(run, schema)


SLICE_TOKENS = 1 << 18


def _token_slices(lists: pa.Array):
    """Row ranges of a list column of about ``SLICE_TOKENS`` items (one row may have more)."""
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(ends):
        z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE_TOKENS, side="right")))
        yield a, z
        a = z


def _flat_grams(lists: pa.Array, n: int) -> tuple[np.ndarray, pa.Array]:
    """``(row, n-gram)`` of every n-gram of a list column's rows, as :func:`~textlab.functions.text.ngrams` has them."""
    lens, flat = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()
    row = np.repeat(np.arange(len(lens)), lens)
    if n == 1 or len(flat) < n:
        return (row, flat) if n == 1 else (row[:0], flat.slice(0, 0))
    own = np.flatnonzero(row[:len(row) - n + 1] == row[n - 1:])  # not over the end of a row
    grams = pc.binary_join_element_wise(*(flat.slice(i, len(flat) - n + 1) for i in range(n)), " ")
    return row[own], grams.take(pa.array(own))


def term_statistics(train_docs: DataFrame, tokens_col: str = "tokens", n: int = 1,
                    id_col: str = "doc_id") -> DataFrame:
    """A3: per term, total count ``tf`` and document frequency ``df`` over the given (train) docs.

    Each document emits each distinct gram once with its in-row count, so
    ``tf = sum(tf)`` and ``df = count(*)`` in one aggregation by term.
    Partial aggregation combines hot terms map-side; only per-task term
    totals are shuffled, with no (doc, term) shuffle.
    """
    return (doc_term_counts(train_docs, tokens_col, n, id_col)
            .groupBy("term").agg(F.sum("tf").cast("long").alias("tf"), F.count(F.lit(1)).cast("long").alias("df")))


def prune_terms(stats: DataFrame, n_docs, min_df: int = MIN_DF, max_df: str = MAX_DF) -> DataFrame:
    """keep ``min_df <= df <= max_df * n_docs`` (max_df a fraction, exact decimal)."""
    return stats.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(Decimal(max_df)) * n_docs))


def cap_vocabulary(stats: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """Top ``max_features`` by tf (ties: term ascending), then ids in alphabetical order from 0.

    ``orderBy().limit()`` plans as a bounded top-k; the id window then runs
    over at most ``max_features`` rows.
    """
    top = stats.orderBy(F.col("tf").desc(), F.col("term").asc()).limit(max_features)
    return top.withColumn("term_id", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))


def fit_vocabulary(train_docs: DataFrame, tokens_col: str = "tokens", n: int = 1, id_col: str = "doc_id",
                   min_df: int = MIN_DF, max_df: str = MAX_DF, max_features: int = MAX_FEATURES,
                   capacity: int | None = None) -> DataFrame:
    """Vocabulary ``(term, term_id, tf, df, n_docs, idf)`` fitted on the given (train) documents only.

    ``idf = ln((1+n)/(1+df)) + 1`` (smooth idf) with ``n`` the number of train documents,
    empty ones included.  A corpus of over ``SUMMARY_BYTES`` (or any, with a ``capacity``) is
    summarised first, see :mod:`textlab.operators.heavy`; the result is the same.
    """
    n_docs = train_docs.select(F.count(F.lit(1))).scalar()
    stats = None
    if capacity or _plan_bytes(train_docs) > SUMMARY_BYTES:
        stats = heavy.top_terms(doc_term_counts(train_docs, tokens_col, n, id_col), lambda t: prune_terms(t, n_docs, min_df, max_df),
                                max_features, min_df, capacity or heavy.CAPACITY)
    if stats is None:
        stats = prune_terms(term_statistics(train_docs, tokens_col, n, id_col), n_docs, min_df, max_df)
    vocab = cap_vocabulary(stats, max_features)
    return (vocab.withColumn("n_docs", n_docs)
            .withColumn("idf", F.log((F.lit(1.0) + F.col("n_docs")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)))


def _plan_bytes(df: DataFrame) -> int:
    """The optimizer's size of the tables that ``df`` reads (its size of a join is a product, however small one side)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _vocab_hits(docs: DataFrame, vocab: DataFrame, tokens_col: str, n: int, id_col: str,
                keep: tuple = ()) -> DataFrame:
    """``(doc_id, *keep, term_id, idf, tf)`` for the in-vocabulary terms of each document."""
    terms = doc_term_counts(docs, tokens_col, n, id_col, keep)
    # The vocabulary is capped (<= max_features rows): a proven broadcast bound.
    return (terms.join(F.broadcast(vocab.select("term", "term_id", "idf")), "term")
            .select(id_col, *keep, "term_id", "idf", "tf"))


def bag_of_words(docs: DataFrame, vocab: DataFrame, tokens_col: str = "tokens", n: int = 1,
                 id_col: str = "doc_id", keep: tuple = ()) -> DataFrame:
    """A4: ``(doc_id, *keep, term_id, count)`` for in-vocabulary terms; no shuffle."""
    return (_vocab_hits(docs, vocab, tokens_col, n, id_col, keep)
            .select(id_col, *keep, "term_id", F.col("tf").alias("count")))


def tfidf(docs: DataFrame, vocab: DataFrame, tokens_col: str = "tokens", n: int = 2,
          id_col: str = "doc_id", keep: tuple = ()) -> DataFrame:
    """A5: ``weight = (1 + ln tf) * idf``, L2-normalised per document -> ``(doc_id, *keep, term_id, weight)``.

    One shuffle, by document, for the norm.
    """
    counts = _vocab_hits(docs, vocab, tokens_col, n, id_col, keep)
    w = (F.lit(1.0) + F.log(F.col("tf").cast("double"))) * F.col("idf")
    norm = F.sqrt(F.sum(w * w).over(Window.partitionBy(id_col)))
    return counts.select(id_col, *keep, "term_id", (w / norm).alias("weight"))


def pack(long_df: DataFrame, value_col: str, id_col: str = "doc_id") -> DataFrame:
    """Sparse rows: ``(doc_id, indices array<int>, values array<double>)``, indices ascending.

    One group per document: bounded by the document's own length.
    """
    entries = F.array_sort(F.collect_list(F.struct(F.col("term_id"), F.col(value_col).cast("double").alias("v"))))
    return (long_df.groupBy(id_col).agg(entries.alias("_e"))
            .select(id_col, F.col("_e.term_id").alias("indices"), F.col("_e.v").alias("values")))
