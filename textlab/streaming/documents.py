"""Structured Streaming form of the stateless text operators.

The reference is batch only; its per-document steps (cleaning X1, and
counting in-vocabulary terms against a frozen train vocabulary J3/A4) are
stateless, so they run unchanged on a stream: new document files are
picked up incrementally, cleaned by the same column expressions, and
joined with the static vocabulary (a stream-static broadcast join; the
vocabulary is capped).  Nothing here keeps state across micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_tokens
from ..sources.tables import SCHEMAS


def document_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 64) -> DataFrame:
    """A streaming DataFrame of documents from parquet files under ``path`` (a folder or glob)."""
    return (spark.readStream.schema(SCHEMAS["documents"]).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def clean_stream(docs: DataFrame) -> DataFrame:
    """X1 on a stream: ``doc_id, lang, tokens, clean_text``."""
    t = clean_tokens("text")
    return docs.select("doc_id", "lang", t.alias("tokens"), F.array_join(t, " ").alias("clean_text"))


def run_term_counts(cleaned: DataFrame, vocab: DataFrame, out_path: str, checkpoint_path: str) -> None:
    """J3/A4 on a stream: per document, counts of unigrams known to a frozen vocabulary.

    A document arrives whole in one micro-batch, so each batch is counted with
    the batch operator and written to its own ``batch_id=`` folder
    (overwritten on replay: idempotent, no cross-batch state).
    """
    from ..operators.vectorize import bag_of_words

    def per_batch(df: DataFrame, batch_id: int) -> None:
        bag_of_words(df, vocab).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    q = (cleaned.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def run_to_table(stream: DataFrame, out_path: str, checkpoint_path: str, mode: str = "append") -> None:
    """Process everything available now into a parquet table (exactly-once file sink with a checkpoint)."""
    q = (stream.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint_path).outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
