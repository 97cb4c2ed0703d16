"""Scans of the input tables with explicit schemas (no inference).

Only the columns a caller selects are read: parquet column pruning and
filter pushdown happen in the scan because every consumer stays a
DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMAS = {
    "documents": T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]),
    "embeddings": T.StructType([
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]),
    "labels": T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType()),
    ]),
    "conversations": T.StructType([
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]),
    "benchmark": T.StructType([
        T.StructField("item_id", T.LongType()),
        T.StructField("text", T.StringType()),
    ]),
    "pages": T.StructType([
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


# Text tables whose per-row work (regex cleaning, tokenising) is CPU heavy, with their key.
TEXT_TABLE_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id", "benchmark": "item_id"}


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    df = reader.parquet(table_path(sf_dir, name))
    if spread and name in TEXT_TABLE_KEYS:
        df = spread_scan(df, TEXT_TABLE_KEYS[name])
    return df


def spread_scan(df: DataFrame, key: str) -> DataFrame:
    """Hash-distribute a scan by its key when it has fewer partitions than the cluster has cores.

    A file written as one row group is read by one task; the text work after
    it would then use one core.  On large inputs the scan already has more
    partitions than cores and this is a no-op (no shuffle is added).  When
    it does apply, the rows end up hash-partitioned by the key, so later
    per-document aggregations and windows reuse that partitioning.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(max(cores, 1), key)
    return df


def check_input(df: DataFrame, label_col: str, expected_classes) -> dict:
    """Raise unless the class column exists, has exactly the expected number of distinct
    classes, and every expected class has at least one row.

    One aggregation (distinct non-null classes, at most the class count reaches the driver).
    """
    if label_col not in df.columns:
        raise KeyError(f"'{label_col}' column not found")
    from pyspark.sql import functions as F

    present = {r[0] for r in df.where(F.col(label_col).isNotNull()).select(label_col).distinct().collect()}
    expected = set(expected_classes)
    if len(present) != len(expected):
        raise ValueError(f"dataset does not contain {len(expected)} classes (found {len(present)})")
    missing = sorted(expected - present)
    if missing:
        raise ValueError(f"no data for classes {missing}")
    return {"classes": sorted(present)}
