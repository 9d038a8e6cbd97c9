"""Boosted trees on Spark ML: training, scoring, trials, random search and additive attributions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import comb

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.config import DEFAULT, Config
from riskloom.operators.encode import PreprocessParams, apply_preprocess
from riskloom.operators.metrics import confusion_matrix, with_scores
from riskloom.operators.sampling import class_sizes, kfold_assign
from riskloom.session import ensure_checkpoint_dir, settle

# fixed values: the three trials of the tuning run and the choices of the random search
TRIALS = (
    {"max_depth": 4, "learning_rate": 0.05, "n_trees": 100, "subsample": 0.8},
    {"max_depth": 6, "learning_rate": 0.05, "n_trees": 300, "subsample": 0.8},
    {"max_depth": 6, "learning_rate": 0.1, "n_trees": 200, "subsample": 1.0},
)
SEARCH = {
    "max_depth": (3, 4, 5, 6),
    "learning_rate": (0.01, 0.05, 0.1, 0.15),
    "n_trees": (50, 100, 150),
    "subsample": (0.8, 0.9, 1.0),
}


def assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add the feature vector; names with dots are looked up under plain aliases."""
    plain = {f: f"_x{i}" for i, f in enumerate(features)}
    wide = df.select("*", *[F.col(f"`{f}`").cast("double").alias(a) for f, a in plain.items()])
    vectors = VectorAssembler(inputCols=list(plain.values()), outputCol="features", handleInvalid="error").transform(wide)
    return vectors.drop(*plain.values())


def train(df: DataFrame, features: Sequence[str], cfg: Config = DEFAULT) -> GBTClassificationModel:
    """Boosted trees on log loss; positives weigh negatives / positives."""
    target = cfg.target_column
    ensure_checkpoint_dir(df.sparkSession)
    neg, pos = class_sizes(df, target)
    weight = neg / pos if pos else 1.0
    rows = assembled(df, features).select(
        F.col(target).cast("double").alias("label"), "features",
        F.when(F.col(target) == 1, F.lit(float(weight))).otherwise(1.0).alias("weight"),
    )
    return GBTClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", maxDepth=cfg.max_depth, stepSize=cfg.learning_rate,
        maxIter=cfg.n_trees, subsamplingRate=cfg.subsample, featureSubsetStrategy=str(cfg.column_sample), seed=cfg.seed,
        checkpointInterval=10,
    ).fit(rows)


def score(model: GBTClassificationModel, df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Probability of class 1 as ``score`` next to the kept columns."""
    scored = model.transform(assembled(df, features))
    return scored.select(*keep, vector_to_array("probability")[1].alias("score"))


def score_features(
    model: GBTClassificationModel, engineered: DataFrame, params: PreprocessParams, keep: Sequence[str]
) -> DataFrame:
    """Engineered rows to scores through the fitted preprocessing."""
    return score(model, apply_preprocess(engineered, params, keep), params.features, keep)


def validation_scores(model: GBTClassificationModel, df: DataFrame, features: Sequence[str], cfg: Config, threshold: float = 0.5) -> dict:
    rows = score(model, df, features, [cfg.target_column])
    return with_scores(confusion_matrix(rows, cfg.target_column, "score", threshold)).first().asDict()


def tune(train_rows: DataFrame, val_rows: DataFrame, features: Sequence[str], cfg: Config = DEFAULT,
         trials: Sequence[dict] = TRIALS) -> tuple[GBTClassificationModel, list[dict]]:
    """Fit each trial, score it at 0.5 on validation, keep the first best F1. Returns the model and all trials."""
    results, best = [], None
    for i, changes in enumerate(trials):
        candidate = train(train_rows, features, cfg.with_(**changes))
        found = validation_scores(candidate, val_rows, features, cfg)
        results.append({"trial": i, **changes, **{k: float(found[k]) for k in ("f1_score", "precision_score", "recall_score")}})
        if best is None or results[-1]["f1_score"] > best[0]:
            best = (results[-1]["f1_score"], candidate)
    return best[1], results


def search_draws(n: int = 5, seed: int = 42, space: dict = SEARCH) -> list[dict]:
    """Seeded random parameter draws."""
    rng = np.random.default_rng(seed)
    return [{k: v[int(rng.integers(len(v)))] for k, v in space.items()} for _ in range(n)]


def random_search(df: DataFrame, row_id: str, features: Sequence[str], cfg: Config = DEFAULT, draws: Sequence[dict] | None = None,
                  folds: int = 3) -> tuple[GBTClassificationModel, list[dict]]:
    """Mean F1 over shuffled folds for each draw; the best draw is refitted on all rows."""
    draws = search_draws(seed=cfg.seed) if draws is None else draws
    # Read 2 x folds x draws times from here on.
    rows = settle(kfold_assign(df, row_id, folds, cfg.seed), "folds")
    results = []
    for i, changes in enumerate(draws):
        scores = []
        for fold in range(folds):
            fitted = train(rows.where(F.col("fold") != fold), features, cfg.with_(**changes))
            scores.append(float(validation_scores(fitted, rows.where(F.col("fold") == fold), features, cfg)["f1_score"]))
        results.append({"draw": i, **changes, "mean_f1": float(np.mean(scores))})
    best = max(results, key=lambda r: (r["mean_f1"], -r["draw"]))
    return train(rows, features, cfg.with_(**draws[best["draw"]])), results


def save_model(model: GBTClassificationModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> GBTClassificationModel:
    return GBTClassificationModel.load(path)


# --- attributions ----------------------------------------------------------------------------------------------


def linear_attributions(df: DataFrame, coefficients: dict[str, float], means: dict[str, float]) -> Column:
    """Contribution of each feature of a linear model: coefficient x (value - mean)."""
    pairs = []
    for f, c in coefficients.items():
        pairs += [F.lit(f), F.lit(c) * (F.col(f"`{f}`") - F.lit(means[f]))]
    return F.create_map(*pairs)


class _Paths:
    """Root-to-leaf paths of all trees: bounded by the size of the model, not by the data.

    On a path a row either meets the conditions on a feature or it does not, so the Shapley values of a leaf
    depend only on which of its few features are met. They are tabulated per leaf for every such pattern.
    """

    def __init__(self) -> None:
        self.leaves: list[tuple[list[tuple[int, float, float]], np.ndarray]] = []
        self.base = 0.0

    def add(self, conditions: dict[int, tuple[float, float, float]], value: float) -> None:
        """Conditions: feature -> (above, up to, share of training weight that follows)."""
        features = list(conditions)
        shares = np.array([conditions[f][2] for f in features])
        d = len(features)
        self.base += value * float(np.prod(shares)) if d else value
        if d == 0:
            return
        # met[p, j]: whether pattern p meets the conditions on feature j
        met = ((np.arange(2**d)[:, None] >> np.arange(d)) & 1).astype(float)
        # weight of a coalition of s of the other features
        weights = np.array([1.0 / (d * comb(d - 1, s)) for s in range(d)])
        table = np.zeros((2**d, d))
        for i in range(d):
            # coefficient s: sum over coalitions of size s of products of met and share
            poly = np.zeros((2**d, d))
            poly[:, 0] = 1.0
            for j in range(d):
                if j != i:
                    grown = poly * shares[j]
                    grown[:, 1:] += poly[:, :-1] * met[:, j, None]
                    poly = grown
            table[:, i] = value * (met[:, i] - shares[i]) * (poly @ weights)
        self.leaves.append(([(f, *conditions[f][:2]) for f in features], table))

    def contributions(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros_like(x)
        for conditions, table in self.leaves:
            pattern = np.zeros(len(x), dtype=int)
            for j, (f, above, upto) in enumerate(conditions):
                pattern |= ((x[:, f] > above) & (x[:, f] <= upto)).astype(int) << j
            values = table[pattern]
            for j, (f, _, _) in enumerate(conditions):
                out[:, f] += values[:, j]
        return out


def tree_paths(spark: SparkSession, model_path: str) -> _Paths:
    """Read a saved ensemble back as node tables and lay out its paths."""
    trees = spark.read.parquet(f"{model_path}/treesMetadata").toDF("tree", "metadata", "weight")
    weights = {r["tree"]: r["weight"] for r in trees.select("tree", "weight").collect()}
    nodes: dict[int, dict[int, object]] = {}
    for r in spark.read.parquet(f"{model_path}/data").collect():  # the model's own nodes
        nodes.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    paths = _Paths()
    for tree, table in nodes.items():
        def cover(node) -> float:
            return float(node["impurityStats"][0]) if node["impurityStats"] else float(node["rawCount"])

        def walk(node, conditions) -> None:
            if node["leftChild"] < 0:
                paths.add(conditions, weights[tree] * node["prediction"])
                return
            feature, cut = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
            for child_id, low, high in ((node["leftChild"], -np.inf, cut), (node["rightChild"], cut, np.inf)):
                child = table[child_id]
                above, upto, share = conditions.get(feature, (-np.inf, np.inf, 1.0))
                follows = cover(child) / cover(node) if cover(node) > 0 else 0.5
                walk(child, {**conditions, feature: (max(above, low), min(upto, high), share * follows)})

        walk(table[0], {})
    return paths


def tree_attributions(df: DataFrame, model_path: str, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Path-dependent tree Shapley values (Lundberg et al., 2018): ``contributions`` map, ``base`` and ``margin``.

    base + sum of contributions = margin, and the score is 1 / (1 + exp(-2 margin)).
    """
    spark = df.sparkSession
    paths = spark.sparkContext.broadcast(tree_paths(spark, model_path))
    rows = df.select(*keep, F.array(*[F.col(f"`{f}`").cast("double") for f in features]).alias("_x"))
    kept = rows.select(*keep).schema

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                values = paths.value.contributions(np.stack(batch["_x"].to_numpy()).astype(float))
                out = batch[list(keep)].copy()
                out["phi"] = list(values)
                yield out

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    phi = rows.mapInPandas(explain, f"{columns}, phi array<double>")
    base = float(paths.value.base)
    names = F.array(*[F.lit(f) for f in features])
    total = F.aggregate("phi", F.lit(0.0), lambda a, x: a + x)
    return phi.select(
        *keep, F.map_from_arrays(names, F.col("phi")).alias("contributions"), F.lit(base).alias("base"),
        (F.lit(base) + total).alias("margin"),
    )


def local_explanations(explained: DataFrame, row_id: str, target: str, threshold: float, n: int = 5) -> DataFrame:
    """The first n rows with label, probability, two-way verdict and contributions."""
    return explained.orderBy(row_id).limit(n).select(
        row_id, F.col(target).alias("actual_label"), "score",
        F.when(F.col("score") >= threshold, "FRAUD").otherwise("CLEAN").alias("prediction"), "contributions",
    )
