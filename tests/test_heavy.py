"""Heavy-hitter summaries: error bounds, proofs and refusals."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textlab.operators import heavy, vectorize


def batches(rows, size=50):
    for a in range(0, len(rows), size):
        t, n = zip(*rows[a:a + size])
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(n, pa.int64())], ["term", "tf"])


def adversarial(order):
    """A few heavy terms among many light ones, in an order made to push the heavy ones out."""
    light = [(f"light{i}", 1) for i in range(3000)]
    strong = [(f"heavy{i}", 1) for i in range(10) for _ in range(200 + 10 * i)]
    if order == "last":
        return light + strong
    if order == "first":
        return strong + light
    mixed = light + strong
    np.random.default_rng(1).shuffle(mixed)
    return [(str(t), int(n)) for t, n in mixed]


@pytest.mark.parametrize("order", ["first", "last", "mixed"])
def test_counts_are_low_by_at_most_the_error(order):
    rows = adversarial(order)
    exact = Counter()
    for t, n in rows:
        exact[t] += n
    own = heavy.Summary(40)
    for b in batches(rows):
        own.add(b)
    table = own.cut()
    low = dict(zip(table["term"].to_pylist(), table["tf"].to_pylist()))
    assert len(low) <= 40 and own.error <= len(rows) // 41 + 1
    assert all(low.get(t, 0) <= n <= low.get(t, 0) + own.error for t, n in exact.items())
    assert {f"heavy{i}" for i in range(10)} <= set(low)


def expected(rows, k, min_df=1):
    tf, df = Counter(), Counter()
    for t, n in rows:
        tf[t] += n
        df[t] += 1
    return sorted(((t, tf[t], df[t]) for t in tf if df[t] >= min_df), key=lambda r: (-r[1], r[0]))[:k]


@pytest.mark.parametrize("order", ["first", "last", "mixed"])
@pytest.mark.parametrize("parts", [1, 5])
def test_top_terms_are_exact_or_refused(spark, order, parts):
    rows = adversarial(order)
    counts = spark.createDataFrame(rows, "term string, tf long").coalesce(1).repartition(parts) if parts > 1 else spark.createDataFrame(rows, "term string, tf long").coalesce(1)
    seen = set()
    for capacity in (12, 200, 100_000):
        for k in (5, 40):
            info = {}
            top = heavy.top_terms(counts, lambda t: t.where("df >= 1"), k, 1, capacity, info)
            seen.add(info["proven"])
            assert (top is not None) == info["proven"]
            if top is not None:
                assert [tuple(r) for r in top.orderBy(F.desc("tf"), "term").collect()] == expected(rows, k)
            if capacity == 100_000:
                assert info["error"] == 0 and info["proven"]
    assert seen == {True, False}


def test_pruned_candidates_and_few_terms(spark):
    rows = [("everywhere", 3)] * 30 + [("some", 1)] * 4 + [("once", 9)]
    counts = spark.createDataFrame(rows, "term string, tf long")
    info = {}
    top = heavy.top_terms(counts, lambda t: t.where("df BETWEEN 2 AND 20"), 2, 2, 100, info)
    assert [tuple(r) for r in top.collect()] == [("some", 4, 4)] and info["proven"]
    assert heavy.top_terms(counts.limit(0), lambda t: t, 2, 2, 100).count() == 0


def test_vocabulary_is_the_same_with_and_without_summaries(spark):
    rng = np.random.default_rng(2)
    docs = [[f"w{int(x)}" for x in rng.zipf(1.4, 60) % 500] for _ in range(80)]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, tokens array<string>").repartition(4)
    for n in (1, 2):
        want = sorted(map(tuple, vectorize.fit_vocabulary(d, n=n, max_features=30).collect()))
        for capacity in (5, 60, 5000):  # the smallest is refused
            assert sorted(map(tuple, vectorize.fit_vocabulary(d, n=n, max_features=30, capacity=capacity).collect())) == want
