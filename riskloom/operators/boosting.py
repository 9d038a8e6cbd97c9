"""Boosted trees by second-order histograms.

Features are cut into at most 256 bins at quantiles. A tree grows level by level: every task sums gradients and hessians of its rows
by (node, feature, bin), Spark adds the tasks' sums up by (node, feature), and the best split of each open node comes back: one short
row per node. Sums are whole numbers (2^20 to the unit), so they do not depend on the order of rows, tasks or retries, and a tree is
the same on any cluster. Rows keep their margin of all but the newest trees; it is written again every ten trees.

Objective: log loss, positives weighing negatives / positives. Gain 1/2 (GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)), leaf -G/(H+l), each
leaf times the learning rate; a child needs a hessian of one. Columns are drawn per tree, rows per tree by a hash of their id. Of equal
gains the first feature and the lowest cut win. Nulls count as below all cuts.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.config import DEFAULT, Config
from riskloom.operators.sampling import class_sizes
from riskloom.session import discard, shared_path

BINS = 256
#: Whole units of a gradient or hessian of one: enough for 2^40 rows of weight 4 in a 64-bit sum.
UNIT = float(1 << 20)
L2, LEAST_HESSIAN = 1.0, 1.0
#: Trees that are applied anew in each pass before the margins are written.
FRESH_TREES = 10


@dataclass
class Tree:
    """Nodes in the order they were made; a leaf has feature -1. A row goes left where its value is at most the threshold."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, gradient: int, hessian: int, rate: float) -> int:
        g, h = gradient / UNIT, hessian / UNIT
        for column, x in ((self.feature, -1), (self.bin, -1), (self.left, -1), (self.right, -1), (self.value, -rate * g / (h + L2)), (self.cover, h), (self.gain, 0.0)):
            column.append(x)
        return len(self.feature) - 1

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The last node that each row of binned values gets to."""
        feature, cut, left, right = (np.array(c) for c in (self.feature, self.bin, self.left, self.right))
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            rows = rows[feature[at[rows]] >= 0]
            if not len(rows):
                return at
            own = at[rows]
            at[rows] = np.where(bins[rows, feature[own]] <= cut[own], left[own], right[own])


@dataclass(frozen=True)
class Booster:
    """An ensemble: the cuts of each feature, and the trees over bins."""

    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    trees: tuple[Tree, ...]

    def margins(self, x: np.ndarray) -> np.ndarray:
        bins = to_bins(x, self.cuts)
        out = np.zeros(len(x))
        for tree in self.trees:
            out += np.array(tree.value)[tree.nodes_of(bins)]
        return out

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The ensemble as a table, one row for each node."""
        rows = [(t, n, f, self.cuts[f][b] if f >= 0 else None, left, right, v, c, g) for t, tree in enumerate(self.trees) for n, (f, b, left, right, v, c, g)
                in enumerate(zip(tree.feature, tree.bin, tree.left, tree.right, tree.value, tree.cover, tree.gain))]
        return spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, left int, right int, value double, cover double, gain double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        cuts = [(i, f, list(map(float, c))) for i, (f, c) in enumerate(zip(self.features, self.cuts))]
        spark.createDataFrame(cuts, "position int, feature string, cuts array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Booster:
        columns = spark.read.parquet(f"{path}/features").orderBy("position").collect()
        cuts = tuple(tuple(r["cuts"]) for r in columns)
        trees: dict[int, Tree] = {}
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():  # the model's own nodes
            tree = trees.setdefault(r["tree"], Tree())
            cut = cuts[r["feature"]].index(r["threshold"]) if r["feature"] >= 0 else -1
            for column, x in zip((tree.feature, tree.bin, tree.left, tree.right, tree.value, tree.cover, tree.gain),
                                 (r["feature"], cut, r["left"], r["right"], r["value"], r["cover"], r["gain"])):
                column.append(x)
        return Booster(tuple(r["feature"] for r in columns), cuts, tuple(trees[t] for t in sorted(trees)))


def to_bins(x: np.ndarray, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin b holds values above cut b - 1 and at most cut b; nulls are in bin 0."""
    out = np.zeros(x.shape, np.uint8)
    for f, own in enumerate(cuts):
        known = ~np.isnan(x[:, f])
        out[known, f] = np.searchsorted(np.asarray(own, float), x[known, f], "left")
    return out


def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int = BINS, error: float = 0.0005) -> tuple[tuple[float, ...], ...]:
    """Cut points of each feature from one pass of quantile sketches: no more than bins - 1, none at the largest value."""
    probabilities = [k / bins for k in range(1, bins)] + [1.0]
    plain = df.select(*[F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    found = plain.approxQuantile(plain.columns, probabilities, error)
    # The largest value closes the last bin; a feature of few values has a cut at each of the others.
    return tuple(tuple(sorted(v for v in set(q) if v < q[-1])) if q else () for q in found)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column as a matrix of doubles, nulls as NaN."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(-1, width)


def _binned(df: DataFrame, features: Sequence[str], cuts, target: str, row_id: str, weight: float) -> DataFrame:
    """What training reads: draw key, label, weight, bins, margin."""
    width = len(features)
    source = df.select(
        F.xxhash64(F.col(f"`{row_id}`").cast("string"), *[F.col(f"`{f}`") for f in features]).alias("draw"), F.col(target).cast("double").alias("label"),
        F.array(*[F.col(f"`{f}`").cast("double") for f in features]).alias("x")).where(F.col("label").isNotNull())

    def bins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = to_bins(_matrix(batch.column(2), width), cuts) if batch.num_rows else np.zeros((0, width), np.uint8)
            label = batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.where(label == 1, weight, 1.0)),
                                              pa.array([r.tobytes() for r in own], pa.binary()), pa.array(np.zeros(len(own)))], ["draw", "label", "weight", "bins", "margin"])

    return source.mapInArrow(bins, "draw long, label double, weight double, bins binary, margin double")


def _held(batch: pa.RecordBatch, width: int, trees: Sequence[Tree]) -> tuple[np.ndarray, np.ndarray]:
    """Bins and margins of a batch, trees since the last writing applied."""
    bins = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, width)
    margin = batch.column(4).to_numpy().copy()
    for tree in trees:
        margin += np.array(tree.value)[tree.nodes_of(bins)]
    return bins, margin


def _drawn(draw: np.ndarray, key: int, share: float) -> np.ndarray:
    """Rows drawn for a tree: the row's hash mixed with the tree's key (the finaliser of SplitMix64)."""
    z = draw.view(np.uint64) ^ np.uint64(key)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) < share * float(1 << 53)


def _key(*parts) -> int:
    return int.from_bytes(hashlib.sha256("|".join(map(str, parts)).encode()).digest()[:8], "big")


def _sums(rows: DataFrame, width: int, trees: Sequence[Tree], tree: Tree, open_: Sequence[int], columns: Sequence[int], key: int, share: float) -> DataFrame:
    """Gradient and hessian sums of each task by open node and feature; the bins of a feature in one row."""
    place = np.full(len(tree.feature), -1, np.int64)
    place[list(open_)] = np.arange(len(open_))

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(open_), len(columns), BINS, 2), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, margin = _held(batch, width, trees)
            at = place[tree.nodes_of(bins)]
            own = np.flatnonzero((at >= 0) & (_drawn(batch.column(0).to_numpy(), key, share) if share < 1 else True))
            p = 1.0 / (1.0 + np.exp(-margin[own]))
            weight = batch.column(2).to_numpy()[own]
            # Whole numbers below 2^53, so the floating sums of a batch are exact.
            g = np.rint(weight * (p - batch.column(1).to_numpy()[own]) * UNIT)
            h = np.rint(weight * p * (1.0 - p) * UNIT)
            at = at[own]
            for k, f in enumerate(columns):
                cell = at * BINS + bins[own, f]
                for c, values in enumerate((g, h)):
                    total[:, k, :, c] += np.bincount(cell, values, len(open_) * BINS).astype(np.int64).reshape(-1, BINS)
        node, k = np.nonzero(total.any(axis=(2, 3)))
        yield pa.RecordBatch.from_arrays([pa.array(np.asarray(open_)[node]), pa.array(np.asarray(columns)[k]),
                                          pa.array([total[n, j].tobytes() for n, j in zip(node, k)], pa.binary())], ["node", "feature", "sums"])

    return rows.mapInArrow(sums, "node long, feature long, sums binary")


_SPLIT = "node long, feature long, bin long, gain double, g long, h long, left_g long, left_h long"


def _best(sums: DataFrame) -> DataFrame:
    """The best cut of each (node, feature): the tasks' sums added up, then gains of all cuts."""
    kind = pa.schema([("node", pa.int64()), ("feature", pa.int64()), ("bin", pa.int64()), ("gain", pa.float64())]
                     + [(c, pa.int64()) for c in ("g", "h", "left_g", "left_h")])

    def best(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s.as_buffer(), np.int64).reshape(BINS, 2) for s in table.column("sums"))
        left, whole = np.cumsum(total, axis=0), total.sum(axis=0)
        right = whole - left
        gl, hl, gr, hr = (v / UNIT for v in (left[:, 0], left[:, 1], right[:, 0], right[:, 1]))
        part = lambda g, h: g * g / (h + L2)
        gain = 0.5 * (part(gl, hl) + part(gr, hr) - part(*(whole / UNIT)))
        gain[(hl < LEAST_HESSIAN) | (hr < LEAST_HESSIAN)] = -np.inf
        b = int(gain.argmax())
        row = [table.column("node")[0].as_py(), table.column("feature")[0].as_py(), b, float(gain[b]), *map(int, whole), *map(int, left[b])]
        return pa.Table.from_pylist([dict(zip(kind.names, row))], schema=kind)

    return sums.groupBy("node", "feature").applyInArrow(best, _SPLIT)


def _grown(rows: DataFrame, width: int, trees: Sequence[Tree], columns: Sequence[int], key: int, cfg: Config) -> Tree:
    tree, open_ = Tree(), [0]
    tree.add(0, 0, cfg.learning_rate)
    for depth in range(cfg.max_depth):
        found = _best(_sums(rows, width, trees, tree, open_, columns, key, cfg.subsample))
        first = F.struct(F.col("gain"), -F.col("feature"), -F.col("bin"))
        splits = found.groupBy("node").agg(F.max_by(F.struct("*"), first).alias("s")).collect()  # one row for each open node
        open_ = []
        for s in sorted((r["s"] for r in splits), key=lambda s: s["node"]):
            n = s["node"]
            if not depth:
                tree = Tree()
                n = tree.add(s["g"], s["h"], cfg.learning_rate)
            if not s["gain"] > 1e-9:
                continue
            tree.feature[n], tree.bin[n], tree.gain[n] = s["feature"], s["bin"], s["gain"]
            tree.left[n] = tree.add(s["left_g"], s["left_h"], cfg.learning_rate)
            tree.right[n] = tree.add(s["g"] - s["left_g"], s["h"] - s["left_h"], cfg.learning_rate)
            open_ += [tree.left[n], tree.right[n]]
        if not open_:
            break
    return tree


def _rewritten(rows: DataFrame, width: int, trees: Sequence[Tree]) -> DataFrame:
    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = _held(batch, width, trees)[1] if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(margin)], batch.schema.names)

    return rows.mapInArrow(apply, rows.schema)


def train(df: DataFrame, features: Sequence[str], cfg: Config = DEFAULT, cuts: Sequence[Sequence[float]] | None = None) -> Booster:
    """Fit on all rows of ``df`` with a label. Given ``cuts`` replace the quantile bins. An empty table gives trees of one leaf of 0."""
    spark, width = df.sparkSession, len(features)
    cuts = quantile_cuts(df, features) if cuts is None else tuple(tuple(map(float, c)) for c in cuts)
    neg, pos = class_sizes(df, cfg.target_column)
    path = shared_path(spark, "boost-rows")
    _binned(df, features, cuts, cfg.target_column, cfg.join_key, neg / pos if pos else 1.0).write.parquet(path)
    rows, trees, fresh = spark.read.parquet(path), [], []
    drawn = max(1, int(cfg.column_sample * width))
    for t in range(cfg.n_trees):
        columns = sorted(sorted(range(width), key=lambda f: _key(cfg.seed, t, "column", features[f]))[:drawn])
        fresh.append(_grown(rows, width, tuple(fresh), columns, _key(cfg.seed, t, "row"), cfg))
        trees.append(fresh[-1])
        if len(fresh) == FRESH_TREES and t + 1 < cfg.n_trees:
            newer = shared_path(spark, "boost-rows")
            _rewritten(rows, width, tuple(fresh)).write.parquet(newer)
            discard(spark, path)
            path, rows, fresh = newer, spark.read.parquet(newer), []
    discard(spark, path)
    return Booster(tuple(features), tuple(cuts), tuple(trees))


def score(model: Booster, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``margin`` and probability of class 1 as ``score`` next to the kept columns."""
    width = len(model.features)

    @F.arrow_udf("double")
    def margins(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(model.margins(_matrix(batch, width)) if len(batch) else np.zeros(0))

    x = F.array(*[F.col(f"`{f}`").cast("double") for f in model.features])
    rows = df.select(*keep, margins(x).alias("margin"))
    return rows.withColumn("score", 1.0 / (1.0 + F.exp(-F.col("margin"))))


# Workers get this module with each job, so sessions built anywhere can run it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
