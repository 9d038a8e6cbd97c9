import random

import numpy as np
import pytest

from riskloom.operators.neighbours import nearest


def brute(points, k):
    out = {}
    for i, a in points:
        order = sorted((float(np.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))), j) for j, b in points if j != i)
        out[i] = [d for d, _ in order[:k]]
    return out


@pytest.mark.parametrize("dims, copies, block_rows, pivots", [(1, 0, 4096, None), (3, 40, 16, 9), (6, 10, 32, 5)])
def test_exact_with_clusters_copies_and_small_blocks(spark, dims, copies, block_rows, pivots):
    rng = random.Random(dims)
    points = [(i, [rng.gauss(5 * (i % 3), 1) for _ in range(dims)]) for i in range(150)]
    points += [(1000 + i, [5.0] * dims) for i in range(copies)]
    df = spark.createDataFrame(points, "id long, vec array<double>")
    got = {}
    rows = nearest(df, 5, block_rows, pivots).collect()
    for r in rows:
        assert r["neighbour"] != r["id"]
        got.setdefault(r["id"], {})[r["rank"]] = r["distance"]
    want = brute(points, 5)
    assert set(got) == set(want)
    for i, distances in want.items():
        assert [got[i][k] for k in range(1, 6)] == pytest.approx(distances, abs=1e-12)


def test_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [3.0])], "id long, vec array<double>")
    assert sorted((r["id"], r["neighbour"], r["distance"]) for r in nearest(df, 5).collect()) == [(1, 2, 3.0), (2, 1, 3.0)]
    assert nearest(df.limit(0), 5).count() == 0
