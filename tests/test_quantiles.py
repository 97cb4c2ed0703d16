import numpy as np
import pytest

from textlab.operators import quantiles


def check(spark, groups, probs=(0.25, 0.5, 0.75), **kw):
    rows = [(g, None if v is None else float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, x double").repartition(3)
    info = {}
    got = quantiles.exact_quantiles(df, "g", "x", probs, info=info, **kw)
    want = {g: [float(np.quantile([v for v in vs if v is not None and v == v], p)) for p in probs] for g, vs in groups.items() if any(v is not None and v == v for v in vs)}
    assert set(got) == set(want)
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12, abs=1e-300), g
    return info["passes"]


def test_quantiles_of_many_distributions(spark):
    rng = np.random.default_rng(1)
    groups = {"normal": rng.standard_normal(701), "hot": np.r_[np.full(400, 2.5), rng.standard_normal(300)], "one": [7.0], "two": [1.0, 2.0],
              "same": [3.0] * 50, "powers": 2.0 ** np.arange(-200, 200), "signs": [-1e308, 1e308, 0.0, -0.0, 1e-308],
              "gaps": [None, float("nan"), 5.0, 6.0], "none": [None]}
    check(spark, groups)
    check(spark, {k: v for k, v in groups.items() if k != "powers"}, probs=(0.0, 0.1, 0.5, 1.0), bins=4)


def test_a_shared_value_and_smooth_values_take_few_passes(spark):
    rng = np.random.default_rng(2)
    assert check(spark, {"hot": np.r_[np.full(2000, 1.0), rng.random(500)]}) <= 4
    assert check(spark, {"smooth": rng.random(4000)}) <= 4


def test_no_rows(spark):
    assert quantiles.exact_quantiles(spark.createDataFrame([], "g string, x double"), "g", "x") == {}
