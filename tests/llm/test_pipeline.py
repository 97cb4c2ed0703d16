"""The pipeline's stages one by one against brute force, and the registry."""

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from conftest import SF_SMALL
from edge_fixtures import edge_docs, empty_docs  # noqa: F401
from oracle_compare import compare
from textlab.llm import mixing


@pytest.fixture(scope="module")
def steps(spark):
    from textlab.llm.common import read, stage

    docs = read(spark, SF_SMALL, "documents")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], SF_SMALL), f"test_{name}"))
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns(steps):
    assert all(s.columns == steps[0].columns for s in steps[1:5])
    assert set(steps[0].columns) < set(steps[5].columns)


def test_quality_keeps_the_good(spark, steps):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    kept = steps[1].select("doc_id").withColumn("kept", F.lit(1))
    counts = {(r["quality"], r["kept"]): r["count"] for r in labels.join(kept, "doc_id", "left").groupBy("quality", "kept").count().collect()}
    assert counts[1, 1] >= 0.95 * (counts[1, 1] + counts.get((1, None), 0))
    assert counts.get((0, None), 0) >= 0.7 * sum(n for (q, _), n in counts.items() if q == 0)


def test_line_dedup(steps):
    want = {d: s for d, _, _, s in brute.line_dedup(pairs(steps[1]))}
    assert {d: brute.sha(t) for d, t in pairs(steps[2])} == want
    assert steps[2].where(F.length("text") != F.col("n_chars")).count() == 0


def test_one_of_each_group_stays(steps):
    want = {c for _, _, c in brute.simhash_components(pairs(steps[2]))}
    got = [d for d, _ in pairs(steps[3])]
    assert len(got) == len(set(got)) and set(got) == want


def test_contaminated_documents_go(spark, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert {d for d, _ in pairs(steps[4])} == {r[0] for r in brute.decontaminate(pairs(steps[3]), items) if not r[5]}


def test_mix(steps):
    rows = steps[5].groupBy("source").agg(F.sum("size").alias("taken"), F.first("target").alias("target")).join(
        steps[4].groupBy("source").agg(F.max(mixing.word_count("text")).alias("most")), "source").collect()
    assert all(abs(r["taken"] - r["target"]) <= r["most"] for r in rows)
    assert steps[5].groupBy("doc_id").count().where("count > 3").count() == 0


def test_stages_of_edge_tables(spark, edge_docs, empty_docs, tmp_path):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    for docs in (edge_docs.withColumn("n_chars", F.length("text").cast("long")), empty_docs):
        rows = docs
        for name, step in corpus_pipeline.STAGES:
            rows = step(spark, rows, str(tmp_path))
            if name != "mixing":
                assert rows.columns == docs.columns, name
            if name == "near_duplicates":
                from textlab.llm.common import stage
                rows = stage(rows, "edge")
        assert rows.count() >= 0


QUERIES = ["op3_warc", "op5_decontaminate", "op6_line_dedup", "op7_topk", "op8_secrets", "op10_chat", "chat_turn_order", "op11_lexical_search", "op13_merkle"]


@pytest.fixture(scope="module")
def compared(spark):
    return compare(spark, SF_SMALL, QUERIES, verbose=False)


@pytest.mark.parametrize("name", QUERIES)
def test_queries_match_their_sql(compared, name):
    assert compared[name]["ok"], compared[name]


def test_registry():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert len(corpus_pipeline.STAGES) == 5
