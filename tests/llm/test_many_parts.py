"""A benchmark of many parts: the same hits, and few Python workers in a task."""

import random

from pyspark.sql import functions as F

import brute
from textlab.llm import decontam


def test_fifty_parts_chain_few_scans_and_hit_the_same(spark):
    rng = random.Random(4)
    items = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(25))) for i in range(120)]
    docs = [(i, " ".join([f"x{i}", *items[rng.randrange(120)][1].split()[rng.randrange(10):], f"y{i}"])) for i in range(40)] + [(100, None), (101, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert len(decontam.benchmark_parts(bench, "item_id", "text", 60)) >= 50
    out, c = decontam.decontaminate(df, bench, part_words=60)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count("MapInArrow") <= decontam.SCANS
    got = out.select("doc_id", c["n_words"], decontam.hit_words(c["spans"]), F.size(c["items"]),
                     F.sha2(F.array_join(F.array_sort(c["items"]), ","), 256), decontam.hit_words(c["spans"]) > 0)
    key = lambda r: str(r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute.decontaminate(docs, items), key=key)
