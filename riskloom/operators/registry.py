"""Model registry, retraining log and the promotion decision. Tables are append-only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


METRICS = ("f1_score", "auc_score", "precision_score", "recall_score")


def production_metrics(*sources: DataFrame) -> DataFrame:
    """Metrics of the newest production row; the first source that has one wins, zeros if none has."""
    found = [
        s.where("is_production").agg(F.max_by(F.struct(*[F.col(m).cast("double").alias(m) for m in METRICS]), "id")).scalar()
        for s in sources
    ]
    spark = sources[0].sparkSession
    row = spark.range(1).select(F.coalesce(*found).alias("m"))
    return row.select(*[F.coalesce(F.col(f"m.{m}"), F.lit(0.0)).alias(m) for m in METRICS])


def promotion_decision(candidate_f1: Column, production_f1: Column, min_delta: float = 0.01) -> Column:
    """Promote on a gain of at least ``min_delta`` or when production has no score yet."""
    return (candidate_f1 - production_f1 >= min_delta) | (production_f1 == 0.0)


def compare_with_production(registry: DataFrame, min_delta: float = 0.01) -> DataFrame:
    """Newest candidate (not in production) against the newest production row."""
    def newest_f1(rows: DataFrame) -> Column:
        return F.coalesce(rows.agg(F.max_by("f1_score", "id")).scalar(), F.lit(0.0))

    row = registry.sparkSession.range(1).select(
        newest_f1(registry.where(~F.col("is_production"))).alias("candidate_f1"),
        newest_f1(registry.where("is_production")).alias("production_f1"),
    )
    return row.withColumns(
        {
            "delta": F.round(F.col("candidate_f1") - F.col("production_f1"), 6),
            "promote": promotion_decision(F.col("candidate_f1"), F.col("production_f1"), min_delta),
        }
    )


def promote(registry: DataFrame, model_name: str, run_id: Column | str) -> DataFrame:
    """The registry after promotion: within the model name only the given run is in production."""
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    state = F.when(F.col("model_name") == model_name, F.col("run_id") == run).otherwise(F.col("is_production"))
    return registry.withColumn("is_production", state)


def with_promotions(registry: DataFrame, promotions: DataFrame) -> DataFrame:
    """Current registry: for each model name the newest promotion event decides. One event row per promotion."""
    last = promotions.groupBy("model_name").agg(F.max_by("run_id", "promoted_at").alias("_run"))
    joined = registry.join(last, "model_name", "left")
    state = F.when(F.col("_run").isNotNull(), F.col("run_id") == F.col("_run")).otherwise(F.col("is_production"))
    return joined.withColumn("is_production", state).select(*registry.columns)


#: How the note of a run begins that the gate denied.
DENIED = "Denied by the gate: "


def retrain_gate(
    log: DataFrame, now: Column, min_hours: float = 6.0, max_per_day: int = 3, count_failures: bool = True,
) -> DataFrame:
    """Whether retraining may run at ``now``: the last run and all runs of the day before; an empty log allows it."""
    rows = log if count_failures else log.where(~F.startswith("notes", F.lit(DENIED)))
    gap = F.expr(f"interval {int(min_hours * 3600)} seconds")
    state = rows.agg(
        F.max("timestamp").alias("last_run"),
        F.count_if(F.col("timestamp") >= now - F.expr("interval 1 day")).alias("runs_last_day"),
    )
    reason = (
        F.when(F.col("last_run").isNull(), "")
        .when(F.col("last_run") > now - gap, "too_recent")
        .when(F.col("runs_last_day") >= max_per_day, "daily_limit")
        .otherwise("")
    )
    return state.withColumn("reason", reason).withColumn("allowed", F.col("reason") == "")
