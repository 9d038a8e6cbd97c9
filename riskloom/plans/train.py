"""Training data, evaluation and the report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, functions as F

from riskloom.config import DEFAULT, Config
from riskloom.functions.scalars import columns_of
from riskloom.operators import metrics, model
from riskloom.operators.cleaning import drop_null
from riskloom.operators.encode import PreprocessParams, apply_preprocess, fit_preprocess
from riskloom.operators.neighbours import smote
from riskloom.operators.sampling import random_oversample, stratified_split
from riskloom.session import settle, shared_path


def prepare(engineered: DataFrame, cfg: Config = DEFAULT) -> tuple[DataFrame, PreprocessParams]:
    """Labelled features to model rows: split, fit on train, apply to all, oversample train only.

    The result is written once; training reads it many times. Synthetic rows have no id.
    """
    rows = stratified_split(drop_null(engineered, cfg.target_column), cfg.join_key, cfg)
    params = fit_preprocess(rows.where(F.col("split") == "train"), cfg)
    ready = apply_preprocess(rows, params, (cfg.join_key, cfg.target_column, "split"))
    if not cfg.use_smote:
        return settle(ready, "processed"), params
    ready = settle(ready, "encoded")
    train = ready.where(F.col("split") == "train").drop("split")
    if cfg.oversample_method == "random":
        grown = random_oversample(train, cfg.join_key, cfg)
    else:
        grown = smote(train, cfg.join_key, params.features, cfg)
    grown = grown.select(*columns_of(train), F.lit("train").alias("split"))
    held = ready.where(F.col("split") != "train").select(*columns_of(grown))
    return settle(grown.unionByName(held), "processed"), params


def fit(processed: DataFrame, params: PreprocessParams, cfg: Config = DEFAULT) -> GBTClassificationModel:
    """One model, or the best of the tuning trials when tuning is on."""
    train_rows = processed.where(F.col("split") == "train")
    if cfg.tune:
        return model.tune(train_rows, processed.where(F.col("split") == "val"), params.features, cfg)[0]
    return model.train(train_rows, params.features, cfg)


@dataclass(frozen=True)
class Evaluation:
    """Scalars of the evaluation and the frames behind the report."""

    threshold: float
    val_f1: float
    test: dict[str, float]
    importance: DataFrame
    explanations: DataFrame
    report: DataFrame


def evaluate(fitted: GBTClassificationModel, processed: DataFrame, params: PreprocessParams, cfg: Config = DEFAULT,
             model_path: str | None = None) -> Evaluation:
    """Threshold on validation, metrics on test, attributions of the test rows, one report row."""
    spark, target, row_id = processed.sparkSession, cfg.target_column, cfg.join_key
    scored = settle(
        model.score(fitted, processed.where(F.col("split") != "train"), params.features,
                    [row_id, target, "split", *[f"`{f}`" for f in params.features]]), "scored")
    val, test = scored.where(F.col("split") == "val"), scored.where(F.col("split") == "test")
    best = metrics.best_threshold(metrics.threshold_sweep(val, target, "score", metrics.threshold_grid(cfg))).first()
    threshold = float(best["threshold"])
    counts = metrics.with_scores(metrics.confusion_matrix(test, target, "score", threshold)).first().asDict()
    auc = metrics.roc_auc(test, target, "score").first()[0]

    path = model_path or shared_path(spark, "model")
    if model_path is None:
        model.save_model(fitted, path)
    explained = settle(model.tree_attributions(test, path, params.features, [row_id, target, "score"]), "explained")
    importance = metrics.global_importance(explained, "contributions")
    explanations = model.local_explanations(explained, row_id, target, threshold)
    scalars = {**{k: float(v) for k, v in counts.items()}, "roc_auc_score": float(auc or 0.0), "threshold": threshold}

    top = importance.agg(F.map_from_entries(F.collect_list(F.struct("feature", "importance")))).scalar()  # ten entries
    samples = explanations.agg(F.collect_list(F.struct("*"))).scalar()  # five rows
    report = spark.range(1).select(
        F.struct(*[F.lit(v).alias(k) for k, v in scalars.items()]).alias("metrics"),
        top.alias("global_importance"), samples.alias("local_explanations_sample"),
    )
    return Evaluation(threshold, float(best["f1_score"]), scalars, importance, explanations, report)
