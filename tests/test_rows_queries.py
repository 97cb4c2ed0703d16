"""Queries without an SQL twin run end to end on sf0.001 and return the expected shape."""

import numpy as np
import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

ROWS_ONLY = sorted(set(entry.queries()) - set(entry.oracle_sql()))


@pytest.fixture(scope="module")
def outputs(spark):
    qs = entry.queries()
    return {name: qs[name](spark, SF_SMALL).collect() for name in ROWS_ONLY}


def test_rows_only_queries_return_rows(outputs):
    for name in ROWS_ONLY:
        assert len(outputs[name]) > 0, name


def test_predictions_cover_the_test_split(outputs):
    n_test = len(outputs["logreg_predict"])
    assert n_test == len(outputs["linear_svm_predict"]) == len(outputs["kmeans_classify"]) == 40  # ceil(0.2*200)


def test_grid_has_all_experiments(outputs):
    grid = outputs["experiment_grid"]
    assert len({(r["feature_set"], r["model"]) for r in grid}) == 20
    assert {r["metric"] for r in grid} == {"accuracy", "precision", "recall", "f1", "f1_macro", "train_time"}
    assert all(r["value"] == round(r["value"], 4) for r in grid if r["metric"] != "train_time")
    assert sorted(r["position"] for r in outputs["train_time_ranking"]) == list(range(1, 21))


def test_grid_keeps_confusions_and_exports(outputs):
    runs = {(r["feature_set"], r["model"]) for r in outputs["experiment_grid"]}
    totals = {}
    for r in outputs["grid_confusion"]:
        totals[r["feature_set"], r["model"]] = totals.get((r["feature_set"], r["model"]), 0) + r["n"]
    assert set(totals) == runs and set(totals.values()) == {40}
    assert {(r["feature_set"], r["model"]) for r in outputs["grid_class_report"]} == runs
    cells = outputs["grid_export"]
    assert sorted(r["n"] for r in cells) == sorted(r["n"] for r in outputs["grid_confusion"])
    assert all(r["train_time"] >= 0 for r in cells)


def test_sweep_and_projection_of_all_feature_sets(outputs):
    assert len(outputs["variance_sweep"]) == 100 and len({r["feature_set"] for r in outputs["projection_2d"]}) == 5


def test_projections_have_chosen_width(outputs):
    widths = {r["n_components"] for r in outputs["pca_project"]}
    assert len(widths) == 1 and 1 <= widths.pop() <= 64
    assert all(len(r["features"]) == r["n_components"] for r in outputs["svd_project"])
    xy = np.array([[r["x"], r["y"]] for r in outputs["projection_2d"]])
    assert np.allclose(xy.mean(axis=0), 0, atol=1e-9)
