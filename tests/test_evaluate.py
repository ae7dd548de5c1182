import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import evaluate as E


def frame(spark, pairs):
    return spark.createDataFrame([(float(s), int(y)) for s, y in pairs], "score double, y int")


def test_areas(spark):
    perfect = frame(spark, [(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1)])
    assert tuple(E.areas(perfect, "y", "score").first()) == (1.0, 1.0)
    flat = frame(spark, [(0.5, 0), (0.5, 1), (0.5, 1)])
    assert E.areas(flat, "y", "score").first()["roc_auc"] == 0.5
    single = frame(spark, [(0.5, 0)])
    assert E.areas(single, "y", "score").first()["roc_auc"] is None


def test_no_positives(spark):
    m = E.binary_metrics(frame(spark, [(0.1, 0), (0.9, 0)]), "y", F.col("score") > 0.5).first()
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0)


def test_calibration_edges(spark):
    rows = frame(spark, [(0.0, 0), (0.1, 1), (0.3, 1), (0.7, 0), (0.70001, 1), (1.0, 1)])
    got = {r["bin"]: r["n"] for r in E.calibration(rows, "y", "score").collect()}
    edges = np.linspace(0, 1, 11)
    want = {}
    for p in (0.0, 0.1, 0.3, 0.7, 0.70001, 1.0):
        b = int(np.searchsorted(edges[1:-1], p))
        want[b] = want.get(b, 0) + 1
    assert got == want


def test_segment_sweep_takes_largest_tied_threshold(spark):
    rows = frame(spark, [(0.5, 1), (0.95, 1), (0.2, 0)])
    best = E.best_segment_threshold(E.segment_sweep(rows, "y", "score")).first()
    assert best["recall"] == 1.0 and best["threshold"] == pytest.approx(0.5)
    none = frame(spark, [(0.5, 0)])
    assert E.best_segment_threshold(E.segment_sweep(none, "y", "score")).first()["threshold"] == pytest.approx(0.9)


def test_missing_scores_are_never_predicted(spark):
    rows = spark.createDataFrame([(float("nan"), 1), (None, 1), (0.9, 1), (0.2, 0)], "score double, y int")
    got = {r["threshold"]: (r["tp"], r["fp"], r["fn"]) for r in E.counts_at(rows, "y", "score", [0.1, 0.5]).collect()}
    assert got == {0.1: (1, 1, 2), 0.5: (1, 0, 2)}


def test_percentile_sweep_takes_smallest_tied_percentile(spark):
    rows = [(float(i), int(i >= 90)) for i in range(100)]
    swept = E.percentile_sweep(frame(spark, rows), "y", "score")
    assert swept.count() == 39
    scores, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    best = (-1, None)
    for p in np.arange(80, 99.5, 0.5):
        predicted = scores >= np.percentile(scores, p)
        tp = (predicted & (y == 1)).sum()
        f1 = 2 * tp / (2 * tp + (predicted & (y == 0)).sum() + (~predicted & (y == 1)).sum())
        if f1 > best[0]:
            best = (f1, p)
    got = E.best_percentile(swept).first()
    assert (got["f1"], got["percentile"]) == (pytest.approx(best[0]), best[1])


def test_best_model_ties_by_order(spark):
    board = spark.createDataFrame([("b", 1, 0.5), ("a", 0, 0.5), ("c", 2, 0.1)], "model string, place int, f1 double")
    assert E.best_model(board).first()[0] == "a"


def test_class_report(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b"), ("c", "c"), ("c", "c")]
    rows = {r["class"]: r for r in E.class_report(spark.createDataFrame(pairs, "t string, p string"), "t", "p").collect()}
    assert rows["accuracy"]["f1"] == pytest.approx(4 / 6)
    assert rows["b"]["precision"] == pytest.approx(1 / 3) and rows["b"]["recall"] == 1.0
    assert rows["macro avg"]["recall"] == pytest.approx((0.5 + 1 + 2 / 3) / 3)
    assert rows["weighted avg"]["support"] == 6
