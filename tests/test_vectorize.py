import math

from pyspark.sql import functions as F

from textlab.operators import vectorize


def _docs(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, tokens array<string>")


def test_document_frequency_pruning(spark):
    # "all" is in 4 of 4 docs (4 > 0.95*4) and "one" in 1 (< 2): both dropped
    d = _docs(spark, [["all", "two"], ["all", "two"], ["all", "one"], ["all"]])
    v = vectorize.fit_vocabulary(d, n=1)
    assert [r["term"] for r in v.collect()] == ["two"]


def test_vocabulary_cap_ties_keep_smaller_term(spark):
    d = _docs(spark, [["bbb", "aaa", "ccc"], ["bbb", "aaa", "ccc"], ["ccc"]])
    v = vectorize.fit_vocabulary(d, n=1, max_df="1.0", max_features=2).orderBy("term_id").collect()
    assert [(r["term"], r["term_id"]) for r in v] == [("aaa", 0), ("ccc", 1)]


def test_tfidf_rows_are_unit_norm_and_idf_formula(spark):
    d = _docs(spark, [["a", "b", "c", "a", "b"], ["a", "b", "x", "y"], ["c", "a", "b", "a", "b"]])
    v = vectorize.fit_vocabulary(d, n=2, max_df="1.0")
    w = vectorize.tfidf(d, v, n=2)
    norms = w.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert all(abs(r["s"] - 1.0) < 1e-12 for r in norms)
    ab = v.where("term = 'a b'").first()
    assert abs(ab["idf"] - (math.log((1 + 3) / (1 + ab["df"])) + 1)) < 1e-12


def test_bag_of_words_counts(spark):
    d = _docs(spark, [["a", "a", "b"], ["a", "b"]])
    v = vectorize.fit_vocabulary(d, n=1, max_df="1.0")
    got = {(r["doc_id"], r["term_id"]): r["count"] for r in vectorize.bag_of_words(d, v).collect()}
    assert got == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 1}


def test_plan_shapes_bow_no_shuffle_tfidf_one(spark):
    """BoW counts inside rows (no hash exchange); TF-IDF shuffles once, by document, for the norm."""
    from textlab.functions.text import clean_tokens

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", clean_tokens("text").alias("tokens"))
    fitted = vectorize.fit_vocabulary(docs, n=1)
    vocab = spark.createDataFrame(fitted.collect(), fitted.schema)  # a literal table: its own plan adds nothing

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    bow_plan = plan(vectorize.bag_of_words(docs, vocab))
    assert "Exchange hashpartitioning" not in bow_plan
    tfidf_plan = plan(vectorize.tfidf(docs, vocab, n=1))
    assert tfidf_plan.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(doc_id" in tfidf_plan


def test_counts_are_taken_by_a_table_of_codes_not_by_lambdas(spark):
    d = spark.createDataFrame([(1, "x", ["b", "a", "b", "a b"]), (1, "x", ["b"]), (2, "y", []), (3, None, None), (4, "z", ["c", "b", "a"])],
                              "doc_id long, label string, tokens array<string>")
    one = vectorize.doc_term_counts(d, keep=("label",))
    assert "transform(" not in one._jdf.queryExecution().executedPlan().toString().lower() and "MapInArrow" in one._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, one.collect())) == [(1, "x", "a", 1), (1, "x", "a b", 1), (1, "x", "b", 1), (1, "x", "b", 2), (4, "z", "a", 1), (4, "z", "b", 1), (4, "z", "c", 1)]
    two = vectorize.doc_term_counts(d, n=2, id_col=None)
    assert sorted(map(tuple, two.collect())) == [("a b", 1), ("b a", 1), ("b a", 1), ("b a b", 1), ("c b", 1)]
    assert sorted(map(tuple, vectorize.doc_term_counts(d, n=3).collect())) == [(1, "a b a b", 1), (1, "b a b", 1), (4, "c b a", 1)]
