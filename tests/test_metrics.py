import random

import pytest

from riskloom.config import DEFAULT
from riskloom.operators import metrics


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "y int, s double")


def test_auc_counts_ties_as_half(spark):
    rng = random.Random(2)
    pairs = [(int(rng.random() < 0.3), rng.randrange(20) / 20) for _ in range(300)]
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert metrics.roc_auc(scored(spark, pairs), "y", "s").first()[0] == pytest.approx(want, rel=1e-12)
    assert metrics.roc_auc(scored(spark, [(1, 0.5), (1, 0.2)]), "y", "s").first()[0] is None


def test_undefined_scores_are_zero(spark):
    row = metrics.prf_scores(scored(spark, [(0, 0.1), (0, 0.2)]), "y", "s", 0.5).first()
    assert tuple(row) == (0.0, 0.0, 0.0)


def test_threshold_grid_and_first_best(spark):
    assert metrics.threshold_grid() == [0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7]
    grid = metrics.threshold_grid(DEFAULT.with_(threshold_step=0.10))
    assert grid == [0.3, 0.4, 0.5, 0.6, 0.7]
    sweep = metrics.threshold_sweep(scored(spark, [(1, 0.65), (0, 0.45), (0, 0.1)]), "y", "s", grid)
    best = metrics.best_threshold(sweep).first()
    assert (best["threshold"], best["f1_score"]) == (0.5, 1.0)


def test_boundaries_count_as_hits(spark):
    row = metrics.confusion_matrix(scored(spark, [(1, 0.5), (0, 0.5), (1, 0.4999), (0, 0.1)]), "y", "s", 0.5).first()
    assert tuple(row) == (1, 1, 1, 1)


def test_class_weight(spark):
    assert metrics.class_weight(scored(spark, [(0, 0.0)] * 6 + [(1, 0.0)] * 2), "y").first()["weight"] == 3.0
    assert metrics.class_weight(scored(spark, [(0, 0.0)]), "y").first()["weight"] == 1.0


def test_best_trial_takes_the_first(spark):
    trials = spark.createDataFrame([(0, 0.5), (1, 0.7), (2, 0.7)], "t int, f double")
    assert metrics.best_trial(trials, "f", "t").first()["t"] == 1


def test_importance_counts_missing_as_zero(spark):
    df = spark.createDataFrame([({"a": -2.0, "b": 1.0},), ({"a": 4.0},)], "m map<string,double>")
    assert [tuple(r) for r in metrics.global_importance(df, "m").collect()] == [("a", 3.0), ("b", 0.5)]
    assert metrics.global_importance(df, "m", 1).count() == 1
