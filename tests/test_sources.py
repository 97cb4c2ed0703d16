import tempfile

import pytest
from pyspark.sql import functions as F

from textlab.operators import metrics
from textlab.sources import files, tables
from textlab.sources.tables import SCHEMAS

from conftest import SF_SMALL


def test_csv_roundtrip_quotes_newlines_empty(spark):
    rows = [(1, 'say "hi"\nnext line, with comma', "en"), (2, "", "de"), (3, None, "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    path = tempfile.mkdtemp() + "/csv"
    files.write_csv(df, path)
    s = SCHEMAS["documents"]
    back = files.read_csv(spark, path, type(s)([s["doc_id"], s["text"], s["lang"]]))
    got = {r["doc_id"]: r["text"] for r in back.collect()}
    # quotes, commas and newlines survive; an empty text comes back null, as in the reference's
    # CSV stages, which is why every text consumer coalesces nulls to ''
    assert got[1] == rows[0][1] and got[2] is None and got[3] is None


def test_csv_keeps_blanks_line_breaks_and_backslashes(spark):
    rows = [(1, " lead trail ", " "), (2, "a\\nb\\\\", "\t"), (3, "x\n\n y", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    path = tempfile.mkdtemp() + "/csv"
    files.write_csv(df, path)
    s = SCHEMAS["documents"]
    back = files.read_csv(spark, path, type(s)([s["doc_id"], s["text"], s["lang"]]))
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_changed_input_is_never_answered_from_an_old_stage(spark):
    import __spark_entry__ as entry

    root = tempfile.mkdtemp()
    for t in ("documents", "embeddings", "labels"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").coalesce(1).write.parquet(f"{root}/{t}.parquet")
    q = entry.queries()
    docs = {n: q[n](spark, root).select("doc_id").distinct().count() for n in ("bow", "clean_text")}
    more = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 1_000_000)
    more.coalesce(1).write.mode("append").parquet(f"{root}/documents.parquet")
    again = {n: q[n](spark, root).select("doc_id").distinct().count() for n in docs}
    assert all(again[n] >= 1.9 * docs[n] for n in docs), (docs, again)


def test_published_stage_has_one_folder(spark):
    import os

    root = tempfile.mkdtemp()
    files.reuse_or_compute(spark, f"{root}/a/stage", lambda: spark.range(3))
    assert os.listdir(f"{root}/a") == ["stage"]


def test_rows_of_a_null_class_stay(spark):
    from textlab.plans.features import labelled_split

    root = tempfile.mkdtemp()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang"))).withColumn("lang", F.col("lang"))
    docs.coalesce(1).write.parquet(f"{root}/documents.parquet")
    got = labelled_split(spark, root)
    assert got.count() == docs.count()
    assert got.where(F.col("label") == got.agg(F.max("label")).first()[0]).count() == docs.where("lang IS NULL").count()


def test_results_json_roundtrip(spark):
    pred = spark.createDataFrame([("F", "M", 0, 0), ("F", "M", 1, 0), ("F", "M", 1, 1)],
                                 "feature_set string, model string, true_label int, pred_label int")
    g = ["feature_set", "model"]
    res = metrics.metric_bundle(pred, g)
    tidy = res.selectExpr("feature_set", "model", "stack(2, 'accuracy', accuracy, 'f1_macro', f1_macro) as (metric, value)")
    path = tempfile.mkdtemp() + "/json"
    files.export_results(tidy, metrics.confusion(pred, g), path)
    back = {(r["metric"]): r["value"] for r in files.read_results(spark, path).collect()}
    assert back["accuracy"] == round(2 / 3, 6)
    raw = spark.read.schema(files.RESULTS_JSON_SCHEMA).json(path).first()
    assert raw["models"]["M"]["confusion_matrix"] == [[1, 0], [1, 1]]


def test_stage_reuse_reads_existing(spark):
    path = tempfile.mkdtemp() + "/stage"
    first = files.reuse_or_compute(spark, path, lambda: spark.range(3))
    again = files.reuse_or_compute(spark, path, lambda: (_ for _ in ()).throw(AssertionError("recomputed")))
    assert first.count() == again.count() == 3


def test_input_checks_raise(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert tables.check_input(docs, "lang", ["de", "en", "es", "fr"])["classes"] == ["de", "en", "es", "fr"]
    with pytest.raises(KeyError):
        tables.check_input(docs, "topic", range(10))
    with pytest.raises(ValueError):
        tables.check_input(docs, "lang", ["de", "en", "es", "xx"])
    with pytest.raises(ValueError):
        tables.check_input(docs, "lang", range(10))


def test_missing_inputs_fail_at_once_with_their_names(spark, tmp_path):
    import pytest

    from textlab.plans import catalog, features
    from textlab.sources.files import require_inputs

    spark.range(3).write.parquet(f"{tmp_path}/documents.parquet")
    require_inputs(spark, [f"{tmp_path}/documents.parquet"])
    with pytest.raises(FileNotFoundError, match="embeddings.parquet"):
        features.feature_set(spark, str(tmp_path), "BOW_SVD")
    with pytest.raises(FileNotFoundError, match="documents.parquet"):
        catalog.bow(spark, f"{tmp_path}/elsewhere")


def test_bucketed_stores_join_without_an_exchange(spark, tmp_path):
    from conftest import SF_SMALL
    from textlab.plans import catalog

    joined = catalog.feature_store(spark, SF_SMALL, f"{tmp_path}/store")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2, plan
    again = catalog.feature_store(spark, SF_SMALL, f"{tmp_path}/store")  # reopened from its files
    assert again.count() == joined.count() == spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").count()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("store_")]


def test_an_added_file_alone_is_scanned(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from textlab.plans import catalog

    folder = tmp_path / "documents.parquet"
    folder.mkdir()

    def write(name, texts, first):
        pq.write_table(pa.table({"doc_id": range(first, first + len(texts)), "text": texts, "lang": ["en"] * len(texts), "source": ["s"] * len(texts),
                                 "n_chars": [len(t) for t in texts]}), folder / name)

    def run():
        scanned = []
        rows = catalog.incremental_counts(spark, str(tmp_path), str(tmp_path / "stage"), scanned)
        return {r["term"]: (r["tf"], r["df"]) for r in rows.collect()}, sorted(f.rsplit("/", 1)[1] for f in scanned)

    write("a.parquet", ["apple apple pear", "pear"], 0)
    write("b c.parquet", ["apple plum"], 10)
    assert run() == ({"apple": (3, 2), "pear": (2, 2), "plum": (1, 1)}, ["a.parquet", "b%20c.parquet"])
    assert run()[1] == []
    write("d.parquet", ["plum plum"], 20)
    assert run() == ({"apple": (3, 2), "pear": (2, 2), "plum": (3, 2)}, ["d.parquet"])
    write("a.parquet", ["cherry cherry cherry cherry"], 0)  # changed
    assert run() == ({"apple": (1, 1), "cherry": (4, 1), "plum": (3, 2)}, ["a.parquet"])
    (folder / "d.parquet").unlink()
    assert run() == ({"apple": (1, 1), "cherry": (4, 1), "plum": (1, 1)}, [])
