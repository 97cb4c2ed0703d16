"""Corpus pipeline: quality, line dedup, near-duplicates, decontamination, mixing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``;
``run`` writes what a stage returns as Parquet in shared storage and reads it
again as the next stage's ``docs``.  All but the last return the columns of
``documents``.  No SQL twin: the classifier, the fingerprints and the mix
cannot be written in SQL, so tests hold each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlab.llm.common import free_name, read, stage, text_key
from textlab.llm.decontam import decontaminate, hit_words
from textlab.llm.linededup import LAST, dedup_lines
from textlab.llm.mixing import mix_sources, write_order
from textlab.llm.quality import THRESHOLD, score, train
from textlab.llm.simhash import simhash_components
from textlab.session import workers_can_import

ORACLE_SQL = None


def quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, does not reject.

    Null and empty texts are scored like others; repeated rows share their fate; an empty table stays empty.
    """
    workers_can_import(spark)
    scored, name = score(docs, train(docs, read(spark, sf_dir, "labels")))
    return scored.where(F.col(name) >= THRESHOLD).drop(name)


def line_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a smaller id has; ``n_chars`` follows the text, null texts become empty."""
    workers_can_import(spark)
    out, names = dedup_lines(docs)
    out = out.drop(*names.values())
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the smallest id, null last, and one row of it."""
    workers_can_import(spark)
    groups = simhash_components(docs)
    first = groups.groupBy("root").agg(F.min(F.struct(F.coalesce("id", F.lit(LAST)).alias("id"), "text_key")).alias("first"))
    i, k, n, keep_i, keep_k = (free_name(docs, c) for c in ("stay_id", "stay_key", "nth", "keep_id", "keep_key"))
    first = first.select(F.col("first.id").alias(keep_i), F.col("first.text_key").alias(keep_k))
    keyed = docs.withColumns({i: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), k: text_key("text")})
    kept = keyed.join(first.hint("merge"), (F.col(i) == F.col(keep_i)) & (F.col(k) == F.col(keep_k)))
    kept = kept.withColumn(n, F.row_number().over(Window.partitionBy(i, k).orderBy(i))).where(F.col(n) == 1)
    return kept.select(*docs.columns)


def decontamination(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window; null and empty texts have none."""
    workers_can_import(spark)
    out, names = decontaminate(docs, read(spark, sf_dir, "benchmark"))
    return out.where(hit_words(names["spans"]) == 0).drop(*names.values())


def mixing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each time the mix takes a document, in its shard's order, with the mix's columns."""
    workers_can_import(spark)
    return write_order(mix_sources(docs))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
