from pyspark.sql import Window
from pyspark.sql import functions as F

from textlab.functions.keys import order_key
from textlab.operators import sampling

from conftest import SF_SMALL


def test_split_quotas_balanced(spark):
    # 10 classes x 800 rows -> 160 test and 640 train per class
    df = spark.range(8000).select(F.col("id").alias("doc_id"), (F.col("id") % 10).cast("int").alias("label"))
    s = sampling.stratified_split(df, "label", "doc_id")
    counts = {(r["label"], r["split"]): r["count"] for r in s.groupBy("label", "split").count().collect()}
    assert all(counts[(c, "test")] == 160 and counts[(c, "train")] == 640 for c in range(10))


def test_sample_small_class_keeps_all(spark):
    df = spark.createDataFrame([(i, "a" if i < 3 else "b") for i in range(40)], "doc_id long, label string")
    s = sampling.stratified_sample(df, "label", "doc_id", 10)
    got = {r["label"]: r["count"] for r in s.groupBy("label").count().collect()}
    assert got == {"a": 3, "b": 10}


def test_split_equals_window_definition(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    s = sampling.stratified_split(docs, "lang", "doc_id")
    quotas = {r["lang"]: r["quota"] for r in
              sampling.split_quotas(docs.groupBy("lang").agg(F.count("*").alias("n")), "lang").collect()}
    w = Window.partitionBy("lang").orderBy(order_key("doc_id"), "doc_id")
    ranked = docs.withColumn("rn", F.row_number().over(w)).collect()
    expected = {r["doc_id"]: ("test" if r["rn"] <= quotas[r["lang"]] else "train") for r in ranked}
    got = {r["doc_id"]: r["split"] for r in s.collect()}
    assert got == expected
    assert sum(quotas.values()) == -(-docs.count() // 5)


def test_split_is_partition_count_independent(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    a = {r["doc_id"]: r["split"] for r in sampling.stratified_split(docs, "lang", "doc_id").collect()}
    b = {r["doc_id"]: r["split"] for r in
         sampling.stratified_split(docs.repartition(7), "lang", "doc_id").collect()}
    assert a == b


def test_uniform_sample_size(spark):
    df = spark.range(50).withColumnRenamed("id", "doc_id")
    assert sampling.uniform_sample(df, "doc_id", 2000).count() == 50
    assert sampling.uniform_sample(df, "doc_id", 20).count() == 20


def test_global_row_number_equals_window(spark):
    """Distributed rank over several (some empty) partitions equals a single-window row_number."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from textlab.operators.common import global_row_number

    rows = [(i, (i * 7919) % 13) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g long").repartition(7).where("id % 3 <> 0 OR id < 50")
    order = [F.col("g").desc(), F.col("id").asc()]
    got = {r["id"]: r["rank"] for r in global_row_number(df, order).collect()}
    want = {r["id"]: r["rank"] - 1 for r in df.withColumn("rank", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == want and sorted(got.values()) == list(range(len(want)))
