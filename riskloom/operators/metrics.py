"""Classification metrics as single aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.config import DEFAULT, Config
from riskloom.operators.ranks import cumulative, value_splits
from riskloom.session import settle


def class_weight(df: DataFrame, target: str) -> DataFrame:
    """Negatives per positive; 1 without positives."""
    y = F.col(target)
    return df.agg(F.count_if(y == 0).alias("negatives"), F.count_if(y == 1).alias("positives")).withColumn(
        "weight", F.when(F.col("positives") > 0, F.col("negatives") / F.col("positives")).otherwise(1.0)
    )


def confusion_aggregates(target: str, score: str, threshold: float, suffix: str = "") -> list[Column]:
    y, hit = F.col(target), F.col(score) >= F.lit(threshold)
    return [
        F.count_if((y == 0) & ~hit).alias(f"true_negatives{suffix}"),
        F.count_if((y == 0) & hit).alias(f"false_positives{suffix}"),
        F.count_if((y == 1) & ~hit).alias(f"false_negatives{suffix}"),
        F.count_if((y == 1) & hit).alias(f"true_positives{suffix}"),
    ]


def confusion_matrix(df: DataFrame, target: str, score: str, threshold: float) -> DataFrame:
    return df.agg(*confusion_aggregates(target, score, threshold))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0))


def with_scores(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 from confusion counts; 0 where undefined."""
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return counts.withColumns(
        {
            "precision_score": _ratio(tp, tp + fp),
            "recall_score": _ratio(tp, tp + fn),
            "f1_score": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def prf_scores(df: DataFrame, target: str, score: str, threshold: float) -> DataFrame:
    return with_scores(confusion_matrix(df, target, score, threshold)).select("precision_score", "recall_score", "f1_score")


def threshold_grid(cfg: Config = DEFAULT) -> list[float]:
    """Thresholds from min to max inclusive, in whole hundredths."""
    lo, hi, step = (round(100 * x) for x in (cfg.threshold_min, cfg.threshold_max, cfg.threshold_step))
    return [i / 100 for i in range(lo, hi + 1, step)]


def threshold_sweep(df: DataFrame, target: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """Scores at every threshold from one pass over the rows: no row is repeated per threshold."""
    names = ("true_negatives", "false_positives", "false_negatives", "true_positives")
    wide = df.agg(*[a for i, t in enumerate(thresholds) for a in confusion_aggregates(target, score, t, f"_{i}")])
    rows = F.array(*[
        F.struct(F.lit(t).alias("threshold"), *[F.col(f"{n}_{i}").alias(n) for n in names]) for i, t in enumerate(thresholds)
    ])
    return with_scores(wide.select(F.inline(rows)))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The first threshold with the best F1."""
    return sweep.orderBy(F.desc("f1_score"), "threshold").limit(1)


def best_trial(trials: DataFrame, score: str, trial: str) -> DataFrame:
    return trials.orderBy(F.desc(score), trial).limit(1)


def roc_auc(df: DataFrame, target: str, score: str) -> DataFrame:
    """Tie-aware area under the ROC curve: the share of (positive, negative) pairs in the right order.

    Scores are counted first; pairs are never formed. Integer arithmetic until the last division.
    """
    y = F.col(target)
    counts = df.where(F.col(score).isNotNull()).groupBy(score).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    counts = settle(counts, "counts")
    ranked = cumulative(counts, score, ["neg"], value_splits(counts, score))
    pairs = F.col("pos").cast("decimal(18,0)") * (2 * F.col("neg_below") + F.col("neg")).cast("decimal(19,0)")
    sums = ranked.agg(
        F.sum(pairs).cast("double").alias("won"),
        F.sum("pos").cast("double").alias("p"),
        F.sum("neg").cast("double").alias("n"),
    )
    return sums.select((F.col("won") / F.nullif(2.0 * F.col("p") * F.col("n"), F.lit(0.0))).alias("roc_auc_score"))


def global_importance(df: DataFrame, contributions: str, top: int = 10) -> DataFrame:
    """Mean absolute contribution per feature, largest first; a missing entry counts as zero."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    sums = df.select(F.explode(contributions).alias("feature", "v")).groupBy("feature").agg(F.sum(F.abs("v")).alias("s"))
    return sums.select("feature", (F.col("s") / rows).alias("importance")).orderBy(F.desc("importance"), "feature").limit(top)
