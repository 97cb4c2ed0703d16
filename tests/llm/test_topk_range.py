"""Scores beyond 64 bits raise; a query's own row does not count."""

import pytest
from pyspark.sql import functions as F

from textlab.llm import topk


def search(spark, rows):
    return topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 100 == 0).collect()


@pytest.mark.parametrize("rows", [[(0, [1e9, 0.0]), (1, [1e9, 0.0])], [(0, [1.0, 1.0]), (1, [1e300, -1e300])]])
def test_scores_beyond_the_range_raise(spark, rows):
    with pytest.raises(Exception, match="within 2"):
        search(spark, rows)


def test_a_large_own_row_and_large_unused_components_do_not(spark):
    got = search(spark, [(0, [1e9, 0.0]), (1, [1.0, 1e300]), (2, [-2.0, 5.0])])
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, 1024 * 10**9 * 1024), (2, -2048 * 10**9 * 1024)]
