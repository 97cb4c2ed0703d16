"""Prepared inputs shared by the registered queries (all lazy DataFrames)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_tokens
from ..operators.common import stage
from ..operators.sampling import stratified_split
from ..sources.tables import read_table, table_path

CLASS_COLUMN = "lang"


def cleaned_corpus(spark: SparkSession, sf_dir: str, label_col: str = CLASS_COLUMN) -> DataFrame:
    """``doc_id, label, tokens``: the documents with the class column and cleaned tokens."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.col(label_col).alias("label"), clean_tokens("text").alias("tokens"))


def split_corpus(spark: SparkSession, sf_dir: str, label_col: str = CLASS_COLUMN) -> DataFrame:
    """``doc_id, label, split, tokens``: W2 split, cleaned once and checkpointed.

    The split's histogram jobs read only ``doc_id`` and the class column
    (pruned scan); the text is cleaned in a single pass afterwards and the
    result is staged, so vocabulary fitting and vectorising reuse it.
    """
    return stage(_split_tokens(spark, sf_dir, label_col), "split_corpus")


def _split_tokens(spark: SparkSession, sf_dir: str, label_col: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.col(label_col).alias("label"), "text")
    marked = stratified_split(docs, "label", "doc_id")
    return marked.select("doc_id", "label", "split", clean_tokens("text").alias("tokens"))


def reused_split_corpus(spark: SparkSession, sf_dir: str, label_col: str = CLASS_COLUMN) -> DataFrame:
    """:func:`split_corpus` written once per input folder and class column, then read back."""
    from ..sources.files import require_inputs, reuse_or_compute
    from .features import stage_path

    require_inputs(spark, [table_path(sf_dir, "documents")])
    path = stage_path(spark, sf_dir, f"split_corpus_{label_col}")
    return reuse_or_compute(spark, path, lambda: _split_tokens(spark, sf_dir, label_col))  # written there, and nowhere else


def train_part(split_df: DataFrame) -> DataFrame:
    return split_df.where(F.col("split") == "train")


TEST_EVERY = 5


def vector_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id, label, embedding, split``: the dense vector table with a fixed split (test = vec_id % 5 = 0)."""
    v = read_table(spark, sf_dir, "embeddings")
    return v.withColumn("split", F.when(F.col("vec_id") % TEST_EVERY == 0, "test").otherwise("train"))


def fixture_word_vectors(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """``(word, vec array<float>)``: the i-th most frequent cleaned term gets ``embeddings.vec_id = i``.

    ``docs`` (with ``tokens``) can be an already cleaned corpus to avoid cleaning twice.
    """
    from ..operators.embed import rank_terms_to_vectors

    docs = cleaned_corpus(spark, sf_dir) if docs is None else docs
    return rank_terms_to_vectors(docs, read_table(spark, sf_dir, "embeddings"))


def reused_word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`fixture_word_vectors` over the split corpus, ranked once per input folder, then read back."""
    from ..sources.files import reuse_or_compute
    from .features import stage_path

    return reuse_or_compute(spark, stage_path(spark, sf_dir, "word_vectors"), lambda: fixture_word_vectors(spark, sf_dir, tokens_once(spark, sf_dir)))


def tokens_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, label, tokens`` read from the staged split corpus (cleaned once per input folder)."""
    return reused_split_corpus(spark, sf_dir).select("doc_id", "label", "tokens")
