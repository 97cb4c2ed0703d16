"""Secret scans of long texts: time in proportion, and the same spans as brute force."""

import random
import time

from pyspark.sql import functions as F

from textlab.llm import secrets


def seconds(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.perf_counter()
    row = secrets.scan_secrets(df).select(F.size("base").alias("b"), F.size("added").alias("a")).first()
    return time.perf_counter() - began, row["b"], row["a"]


def hex_runs(n, rng):
    return " ".join("".join(rng.choice("0123456789abcdef") for _ in range(32)) for _ in range(n))


def test_texts_of_many_spans_take_time_in_proportion(spark):
    rng = random.Random(1)
    seconds(spark, hex_runs(3000, rng))
    (small, n, _), (large, m, _) = seconds(spark, hex_runs(4000, rng)), seconds(spark, hex_runs(32_000, rng))
    assert (n, m) == (4000, 32_000) and large < 24 * max(small, 0.5)  # eight times the text, 1 MB


def test_a_long_candidate_takes_time_in_proportion(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(800_000))
    (small, *_), (large, _, added) = seconds(spark, text[:100_000]), seconds(spark, text)
    assert added > 0 and large < 24 * max(small, 0.5)


def test_stretches_of_a_candidate_change_nothing(spark, monkeypatch):
    rng = random.Random(3)
    parts = ["aaaaaaaaaaaaaaaaaaaaaaaaa", "".join(rng.choice("abcdefXYZ0123456789+/") for _ in range(70))]
    word = "".join(rng.choice(parts) for _ in range(30)) + "Zk3vR9xQ7mB2tY8wL5nC1pF6"
    df = spark.createDataFrame([(1, "pre " + word + " post " + word[5:900])], "doc_id long, text string")
    seen = set()
    for stretch in (1, 7, 20, 21, 1024, 1 << 20):
        monkeypatch.setattr(secrets, "STRETCH", stretch)
        seen.add(str(secrets.scan_secrets(df).first()))
    assert len(seen) == 1 and "entropy" in seen.pop()


def test_added_spans_inside_base_spans_go(spark):
    key = "Zk3vR9xQ7mB2tY8wL5nC1pF6"
    rows = [(1, f"token={key}"), (2, f"{key} token={key} {key}"), (3, f"token={key[:8]} {key}")]
    got = {r["id"]: (len(r["base"]), len(r["added"])) for r in secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 0), 2: (1, 2), 3: (1, 1)}


def test_no_rows_of_an_empty_table(spark):
    assert secrets.scan_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0
