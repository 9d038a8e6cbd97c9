"""Approximate neighbours: recall against the exact join on 10 and 30 columns, bounded cells, copies, few rows."""

import numpy as np
import pytest

from riskloom.operators import projections
from riskloom.operators.neighbours import nearest


def points(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>").repartition(4)


@pytest.mark.parametrize("dims", [10, 30])
def test_recall_against_the_exact_join(spark, dims):
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(40, dims)) * 2
    df = points(spark, centres[rng.integers(0, 40, 1500)] + rng.normal(size=(1500, dims)) * 0.6)
    found, exact = projections.approximate_nearest(df, 5, tables=12, leaf=128), nearest(df, 5)
    assert found.count() == exact.count() == 7500
    assert projections.recall(found, exact) >= 0.9


def test_no_cell_passes_the_bound_whatever_the_data(spark, monkeypatch):
    seen = []
    rows = np.zeros((600, 3))
    rows[:, 0] = np.arange(600) // 2  # one busy spot, then a line: half the rows are copies
    rows[:300] *= 1e-9
    kept = projections._first_k
    monkeypatch.setattr(projections, "_first_k", lambda df, *a: (seen.append(df), kept(df, *a))[1])
    found = projections.approximate_nearest(points(spark, rows), 3, tables=2, leaf=16)
    per_id = {r["id"]: r["n"] for r in found.groupBy("id").agg({"neighbour": "count"}).toDF("id", "n").collect()}
    assert set(per_id) == set(range(600)) and set(per_id.values()) == {3}
    assert seen[-1].groupBy("vid").count().agg({"count": "max"}).first()[0] <= 2 * 4


def test_few_rows_and_none(spark):
    df = points(spark, [[0.0], [3.0]])
    assert sorted((r["id"], r["neighbour"], r["distance"]) for r in projections.approximate_nearest(df, 5).collect()) == [(0, 1, 3.0), (1, 0, 3.0)]
    assert projections.approximate_nearest(df.limit(0), 5).count() == 0
