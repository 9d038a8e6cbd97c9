"""Histogram boosting against a plain numpy form, the same trees whatever the partitions, saved tables, awkward rows."""

import numpy as np
import pytest

from riskloom.config import DEFAULT
from riskloom.operators import boosting

CFG = DEFAULT.with_(n_trees=12, max_depth=3, learning_rate=0.3, subsample=1.0, column_sample=1.0)
CUTS = [tuple(np.linspace(-1.5, 1.5, 9)), (0.0, 1.0), (0.5,)]
NAMES = ["a", "b.c", "d"]


def made(n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 3, n), rng.integers(0, 2, n)]).astype(float)
    x[rng.random(n) < 0.05, 0] = np.nan
    y = (np.nan_to_num(x[:, 0], nan=-9) + x[:, 1] * x[:, 2] + rng.normal(size=n) * 0.5 > 1.2).astype(int)
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(i, None if np.isnan(r[0]) else float(r[0]), float(r[1]), float(r[2]), None if v is None else int(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "TransactionID long, a double, `b.c` double, d double, isFraud int").repartition(parts)


def plain(x, y, cfg):
    """Margins by growing each node from its own rows."""
    bins, margin = boosting.to_bins(x, CUTS), np.zeros(len(x))
    w = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0)
    unit = boosting.UNIT

    def grow(rows, g, h, depth):
        G, H = g[rows].sum() / unit, h[rows].sum() / unit
        best = (1e-9, None)
        if depth < cfg.max_depth:
            for f in range(x.shape[1]):
                for b in range(256):
                    left = bins[rows, f] <= b
                    gl, hl = g[rows][left].sum() / unit, h[rows][left].sum() / unit
                    if hl < 1 or H - hl < 1:
                        continue
                    gain = 0.5 * (gl**2 / (hl + 1) + (G - gl) ** 2 / (H - hl + 1) - G**2 / (H + 1))
                    if gain > best[0] + 1e-12:
                        best = (gain, (f, b))
        if best[1] is None:
            margin[rows] += -cfg.learning_rate * G / (H + 1)
            return
        f, b = best[1]
        left = bins[rows, f] <= b
        grow(rows[left], g, h, depth + 1)
        grow(rows[~left], g, h, depth + 1)

    for _ in range(cfg.n_trees):
        p = 1 / (1 + np.exp(-margin))
        grow(np.arange(len(x)), np.rint(w * (p - y) * unit), np.rint(w * p * (1 - p) * unit), 0)
    return margin


def test_equals_the_plain_form_and_survives_saving(spark, tmp_path):
    x, y = made()
    fitted = boosting.train(frame(spark, x, y), NAMES, CFG, CUTS)
    assert len(fitted.trees) == 12  # the margins were written once on the way
    want = plain(x, y, CFG)
    assert np.allclose(fitted.margins(x), want, atol=1e-6)
    fitted.save(spark, f"{tmp_path}/m")
    again = boosting.Booster.load(spark, f"{tmp_path}/m")
    assert again == fitted
    scored = {r["TransactionID"]: r for r in boosting.score(again, frame(spark, x, y), ["TransactionID"]).collect()}
    assert np.allclose([scored[i]["margin"] for i in range(len(x))], want, atol=1e-6)
    assert np.allclose([scored[i]["score"] for i in range(len(x))], 1 / (1 + np.exp(-want)), atol=1e-6)


def test_same_trees_from_any_partitions(spark):
    x, y = made(400, 2)
    cfg = CFG.with_(n_trees=4, subsample=0.7, column_sample=0.67)
    first, second = (boosting.train(frame(spark, x, y, parts), NAMES, cfg, CUTS) for parts in (1, 7))
    assert first == second
    used = [{f for f in t.feature if f >= 0} for t in first.trees]
    assert all(len(u) <= 2 for u in used) and len({frozenset(u) for u in used}) > 1
    assert first != boosting.train(frame(spark, x, y), NAMES, cfg.with_(seed=7), CUTS)


def test_sketched_cuts_separate_values(spark):
    x, y = made(800, 3)
    cuts = boosting.quantile_cuts(frame(spark, x, y), NAMES)
    assert cuts[1] == (0.0, 1.0) and cuts[2] == (0.0,)
    assert 200 < len(cuts[0]) <= 255 and list(cuts[0]) == sorted(set(cuts[0]))
    fitted = boosting.train(frame(spark, x, y), NAMES, CFG.with_(n_trees=5))
    better = (fitted.margins(x)[y == 1][:, None] > fitted.margins(x)[y == 0][None, :]).mean()
    assert better > 0.9


@pytest.mark.parametrize("labels", [[], [1], [0, 0], [None, 1, 0]])
def test_few_rows_and_missing_labels(spark, labels):
    x = np.zeros((len(labels), 3))
    fitted = boosting.train(frame(spark, x, labels, 1), NAMES, CFG.with_(n_trees=2), CUTS)
    assert len(fitted.trees) == 2 and np.isfinite(fitted.margins(np.zeros((2, 3)))).all()


def test_draws_have_the_wanted_share():
    draw = np.arange(100_000, dtype=np.int64) * 7919
    assert abs(boosting._drawn(draw, 12345, 0.8).mean() - 0.8) < 0.01
    assert (boosting._drawn(draw, 1, 0.5) != boosting._drawn(draw, 2, 0.5)).mean() > 0.4
