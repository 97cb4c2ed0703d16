from pyspark.sql import functions as F

from textlab.functions import text as tx

EDGE = "I CANNOT go, gonna: gotta http://a.b/c?d=1 don't wanna e.g. word1,word2 HTTPS://X café"


def _one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_clean_tokens_edge_sentence(spark):
    assert _one(spark, tx.clean_tokens("x"), EDGE) == ["gon", "got", "dont", "wan", "wordword", "caf"]


def test_clean_tokens_empty_inputs(spark):
    for v in ["", "   ", "the of a", None]:
        assert _one(spark, tx.clean_tokens("x"), v) == []


def test_clean_text_joins_with_space(spark):
    assert _one(spark, tx.clean_text("x"), "Hello   brave\tnew\nworld") == "hello brave new world"


def test_unicode_whitespace_separates_tokens(spark):
    # NBSP and U+3000 are whitespace for the reference's Python regexes
    assert _one(spark, tx.clean_tokens("x"), "alpha beta　gamma") == ["alpha", "beta", "gamma"]


def test_combine_text_null_safe(spark):
    df = spark.createDataFrame([(None, "b"), ("a", None), (None, None)], "a string, b string")
    got = [r["t"] for r in df.select(tx.combine_text("a", "b").alias("t")).collect()]
    assert got == [" b", "a ", " "]


def test_ngrams(spark):
    df = spark.createDataFrame([([],), (["x"],), (["x", "y", "z"],)], "t array<string>")
    got = [r["g"] for r in df.select(tx.ngrams("t", 2).alias("g")).collect()]
    assert got == [[], [], ["x y", "y z"]]


def test_token_window_lengths_and_masks(spark):
    rows = [([f"w{i}" for i in range(n)],) for n in (0, 3, 126, 127, 200)]
    df = spark.createDataFrame(rows, "t array<string>").select(tx.token_window("t").alias("w"))
    out = df.collect()
    assert all(len(r["w"]["window"]) == 128 and len(r["w"]["mask"]) == 128 for r in out)
    assert [sum(r["w"]["mask"]) for r in out] == [2, 5, 128, 128, 128]
    assert out[1]["w"]["window"][:5] == ["[CLS]", "w0", "w1", "w2", "[SEP]"]
    assert out[4]["w"]["window"][-1] == "[SEP]"


def test_token_count(spark):
    assert _one(spark, tx.token_count("x"), None) == 0
    assert _one(spark, tx.token_count("x"), "  a b\n c ") == 3


def test_stop_words_list_shape():
    letters_only = [w for w in tx.STOP_WORDS_EN if w.isalpha()]
    assert len(tx.STOP_WORDS_EN) == 179 and len(letters_only) == 153


def test_term_counts_run_length(spark):
    from collections import Counter

    cases = [[], ["x"], ["b", "a", "b"], ["z", "z", "z"], ["c", "a", "b", "a", "c", "c"]]
    for toks in cases:
        df = spark.createDataFrame([(toks,)], "x array<string>")
        got = tx.term_counts(df, "x", [], "r").first()["r"]
        assert [(r["term"], r["tf"]) for r in got] == sorted(Counter(toks).items())
    assert tx.term_counts(spark.createDataFrame([(None,)], "x array<string>"), "x", [], "r").first()["r"] == []


def test_every_character_is_kept_or_deleted_as_by_the_published_pattern(spark):
    points = [*range(1, 0x2100), *range(0x2FF0, 0x3010), 0xFEFF, 0x1F600]
    rows = [(p, f"a{chr(p)}b {chr(p)}") for p in points]
    got = {r["p"]: r["t"] for r in spark.createDataFrame(rows, "p int, x string").select("p", tx.normalize_text("x").alias("t")).collect()}
    low = spark.createDataFrame(rows, "p int, x string").select("p", F.lower("x").alias("t")).collect()
    assert got == {r["p"]: "".join(c for c in r["t"] if "a" <= c <= "z" or c.isspace()) for r in low}


def test_letters_are_passed_over_before_the_long_class(spark):
    # the class of all whitespace ranges, tried on every letter, took five sixths of the cleaning
    plan = spark.createDataFrame([("x",)], "x string").select(tx.normalize_text("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "(?![a-z ])" in plan
