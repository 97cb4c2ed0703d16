"""File formats and stage reuse.

Every writer targets a folder in shared storage (normally under
``spark.checkpoint.dir``); every reader declares its schema.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import whitespace_tokens

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# A multi-line CSV file cannot be split, so a file (one read task) is bounded when written.
CSV_RECORDS_PER_FILE = 100_000


# S3 -------------------------------------------------------------------------
def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, RFC-4180 quoting (quotes doubled), text may hold newlines."""
    df.write.mode("overwrite").options(**CSV_OPTIONS, maxRecordsPerFile=CSV_RECORDS_PER_FILE).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back with a declared schema.  An empty text reads back as null (as with the
    reference's CSV stages); text consumers coalesce nulls to ''."""
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


# S4 -------------------------------------------------------------------------
def write_word_vectors(df: DataFrame, path: str, word_col: str = "word", vec_col: str = "vec") -> None:
    """Text lines ``word f1 f2 ...`` (the usual word-vector file layout)."""
    line = F.concat_ws(" ", F.col(word_col), F.array_join(F.transform(vec_col, lambda x: x.cast("string")), " "))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``(word, vec array<float>)`` from a word-vector text file; for a repeated word the later line wins.

    Lines split on any whitespace; the first field is the word, the rest are
    float32 values.  "Later" is (file, byte offset of the split, position in
    the split), taken with ``max_by`` so duplicates are resolved in one
    aggregation without collecting a group.  Blank lines are skipped.
    """
    raw = spark.read.text(path).select(
        whitespace_tokens("value").alias("f"),
        F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                 F.monotonically_increasing_id()).alias("_pos"))
    raw = raw.where(F.size("f") > 0).select(
        F.col("f")[0].alias("word"),
        F.transform(F.slice("f", 2, F.size("f") - 1), lambda x: x.cast("float")).alias("vec"), "_pos")
    return raw.groupBy("word").agg(F.max_by("vec", "_pos").alias("vec"))


# S5 / S6 ----------------------------------------------------------------------
def write_table(df: DataFrame, path: str, partition_by: tuple = ()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table_at(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_count_vectorizer(vocab: DataFrame, path: str) -> None:
    """An ML ``CountVectorizerModel`` with the fitted vocabulary in id order (<= max_features terms)."""
    from pyspark.ml.feature import CountVectorizerModel

    terms = [r["term"] for r in vocab.orderBy("term_id").select("term").collect()]
    CountVectorizerModel.from_vocabulary(terms, inputCol="tokens", outputCol="counts").write().overwrite().save(path)


def load_count_vectorizer(path: str) -> list[str]:
    """The terms of a saved ``CountVectorizerModel`` in id order."""
    from pyspark.ml.feature import CountVectorizerModel

    return CountVectorizerModel.load(path).vocabulary


# S7 -------------------------------------------------------------------------
def export_results(results: DataFrame, confusion: DataFrame, path: str) -> None:
    """Nested results: one JSON object per feature set, ``{feature_set, models: {model: {metric: value,
    confusion_matrix: [[n]]}}}``.

    ``results(feature_set, model, metric, value)``; ``confusion(feature_set, model, true_label, pred_label, n)``.
    """
    metrics = results.groupBy("feature_set", "model").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("metrics"))
    rows = (confusion.groupBy("feature_set", "model", "true_label")
            .agg(F.array_sort(F.collect_list(F.struct("pred_label", "n"))).alias("_r"))
            .select("feature_set", "model", "true_label", F.col("_r.n").alias("row")))
    matrix = rows.groupBy("feature_set", "model").agg(
        F.array_sort(F.collect_list(F.struct("true_label", "row"))).alias("_m")).select(
        "feature_set", "model", F.col("_m.row").alias("confusion_matrix"))
    per_model = metrics.join(matrix, ["feature_set", "model"], "left").select(
        "feature_set", "model", F.struct("metrics", "confusion_matrix").alias("result"))
    nested = per_model.groupBy("feature_set").agg(
        F.map_from_entries(F.collect_list(F.struct("model", "result"))).alias("models"))
    nested.write.mode("overwrite").json(path)


RESULTS_JSON_SCHEMA = T.StructType([
    T.StructField("feature_set", T.StringType()),
    T.StructField("models", T.MapType(T.StringType(), T.StructType([
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("confusion_matrix", T.ArrayType(T.ArrayType(T.LongType()))),
    ]))),
])


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Reload nested results as the tidy ``(feature_set, model, metric, value)`` table."""
    j = spark.read.schema(RESULTS_JSON_SCHEMA).json(path)
    per_model = j.select("feature_set", F.explode("models").alias("model", "result"))
    return per_model.select("feature_set", "model", F.explode("result.metrics").alias("metric", "value"))


def read_result_cells(spark: SparkSession, path: str) -> DataFrame:
    """Reload the confusion matrices of nested results as ``(feature_set, model, row, col, n)``; row and col are
    positions in the sorted labels of the experiment."""
    j = spark.read.schema(RESULTS_JSON_SCHEMA).json(path)
    per_model = j.select("feature_set", F.explode("models").alias("model", "result"))
    rows = per_model.select("feature_set", "model", F.posexplode("result.confusion_matrix").alias("row", "cells"))
    return rows.select("feature_set", "model", "row", F.posexplode("cells").alias("col", "n"))


# S8 -------------------------------------------------------------------------
def stage_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a completely written output (``_SUCCESS``), on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return bool(marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker))


def require_inputs(spark: SparkSession, paths: list[str]) -> None:
    """Raise at once, before any job, with the names of the inputs that do not exist (on any Hadoop file system)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        if not at.getFileSystem(conf).exists(at):
            missing.append(path)
    if missing:
        raise FileNotFoundError("missing input: " + ", ".join(missing))


def reuse_or_compute(spark: SparkSession, path: str, compute, partition_by: tuple = ()) -> DataFrame:
    """Read the stage at ``path`` when it was written completely before, else compute, write, read.

    The table is written to a folder of its own and published with one rename, so of
    two drivers that compute the same stage each reads a whole one.
    """
    if not stage_exists(spark, path):
        own = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
        write_table(compute(), own, partition_by)
        jvm = spark.sparkContext._jvm
        source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (own, path))
        fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(source, target) or not stage_exists(spark, path):
            path = own  # another driver was faster: its stage is as good, ours is already whole
    return spark.read.parquet(path)


def open_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """A table written by :func:`reuse_bucketed`, with its buckets known to the optimizer.

    The catalog entry is only needed to resolve the table, and goes again; the files stay.
    """
    name = f"store_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    try:
        return spark.table(name).select("*")
    finally:
        spark.sql(f"DROP TABLE {name}")


def reuse_bucketed(spark: SparkSession, path: str, compute, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """The store at ``path``, written once, bucketed and sorted by ``key``.

    Stores with the same key type and number of buckets join on the key without an exchange:
    the shuffle by key is paid once, when the store is written.
    """
    if not stage_exists(spark, path):
        name = f"store_{uuid.uuid4().hex}"
        rows = compute().select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))
        rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")
    return open_bucketed(spark, path, schema, key, buckets)


INPUT_KEY = "input"


def _input_keys(spark: SparkSession, folder: str) -> dict[str, str]:
    """``{key: path}`` of the Parquet files under ``folder``; the key changes with path, length or modification time."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    found, files = {}, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True)
    while files.hasNext():
        f = files.next()
        if f.getPath().getName().endswith(".parquet"):
            place = "/" + f.getPath().toUri().getRawPath().lstrip("/")
            found[hashlib.md5(f"{place}:{f.getLen()}:{f.getModificationTime()}".encode()).hexdigest()] = f.getPath().toString()
    return found


def _key_column() -> Column:
    """The same key, of the file that a row comes from."""
    place = F.concat(F.lit("/"), F.ltrim(F.parse_url(F.col("_metadata.file_path"), F.lit("PATH")), F.lit("/")))
    return F.md5(F.concat_ws(":", place, F.col("_metadata.file_size").cast("string"),
                             F.unix_millis("_metadata.file_modification_time").cast("string")))


def incremental_stage(spark: SparkSession, folder: str, path: str, compute, schema: T.StructType | None = None) -> DataFrame:
    """The rows of ``compute`` over the files under ``folder``, of which only new or changed ones are read.

    ``compute`` gets the rows of those files with a column ``input`` and returns rows with it.  They are written
    in one job, in a folder for each input, and published by a row of the manifest (input, file, part); parts of
    files that changed or went are not read any more.
    """
    keys, manifest = _input_keys(spark, folder), f"{path.rstrip('/')}/manifest"
    read = spark.read if schema is None else spark.read.schema(schema)
    known = spark.read.schema("input string, file string, part string").json(manifest) if _exists(spark, manifest) else None
    done = {r["input"]: r["part"] for r in known.collect()} if known is not None else {}  # a row an input file
    new = {k: f for k, f in keys.items() if k not in done}
    if new:
        part = f"{path.rstrip('/')}/parts/{uuid.uuid4().hex}"
        rows = read.parquet(*new.values()).select("*", _key_column().alias(INPUT_KEY))
        compute(rows).write.partitionBy(INPUT_KEY).parquet(part)
        spark.createDataFrame([(k, f, part) for k, f in new.items()], "input string, file string, part string").coalesce(1).write.mode("append").json(manifest)
        done |= dict.fromkeys(new, part)
    live = spark.createDataFrame([(k,) for k in keys], "input string")  # one row an input file
    out = None
    for part in sorted({done[k] for k in keys}):
        rows = spark.read.parquet(part)
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise FileNotFoundError(f"missing input: no Parquet files in {folder}")
    return out.join(F.broadcast(live), INPUT_KEY, "left_semi")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at))


def input_fingerprint(spark: SparkSession, folder: str) -> str:
    """Digest of (path, length, modification time) of all Parquet files under a folder, on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True)
    found = []
    while files.hasNext():
        f = files.next()
        if ".parquet" in (name := f.getPath().toString()):
            found.append((name, f.getLen(), f.getModificationTime()))
    return hashlib.md5(repr(sorted(found)).encode()).hexdigest()[:12]
