"""Whole jobs: batch generation, drift check, conditional retraining. Each stage hands over a table."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.config import DEFAULT, Config
from riskloom.functions.scalars import confidence, decision, explanation_kept, scoring_card_label
from riskloom.operators import model, registry
from riskloom.operators.cleaning import dedupe_first
from riskloom.operators.drift import drift_summary
from riskloom.operators.encode import PreprocessParams, apply_preprocess
from riskloom.plans.drift import TESTED, baseline_exclude, detect_drift, make_shifted_batch, source_columns
from riskloom.plans.features import engineer_features
from riskloom.plans.ingest import ingest_split
from riskloom.plans.train import evaluate, fit, prepare
from riskloom.session import settle
from riskloom.sources import readers, sinks
from riskloom.streaming.events import split_payload, to_transactions, with_serving_defaults

RETRAIN_LOG = ("triggered_at timestamp_ntz, trigger_reason string, old_f1 double, new_f1 double, promoted boolean, "
               "notes string, timestamp timestamp_ntz")
REGISTRY_ROW = ("model_name string, model_version string, run_id string, f1_score double, auc_score double, precision_score double, "
                "recall_score double, val_f1_score double, threshold double, is_production boolean, created_at timestamp_ntz")


def preprocess_job(spark: SparkSession, raw_dir: str, work_dir: str, cfg: Config = DEFAULT) -> DataFrame:
    """Ingest, engineer, split, encode and oversample; writes ``processed`` and ``preprocess``. The ingestion summary."""
    joined, summary = ingest_split(spark, raw_dir, "train", cfg)
    processed, params = prepare(settle(engineer_features(joined, cfg), "engineered"), cfg)
    sinks.write_splits(processed, f"{work_dir}/processed")
    params.save(spark, f"{work_dir}/preprocess")
    return summary


def load_processed(spark: SparkSession, work_dir: str) -> tuple[DataFrame, PreprocessParams]:
    return spark.read.parquet(f"{work_dir}/processed"), PreprocessParams.load(spark, f"{work_dir}/preprocess")


def register(spark: SparkSession, work_dir: str, cfg: Config, run_id: str, scores: dict, val_f1: float, now: datetime, promote: bool) -> None:
    """Append the run to the registry and, if it goes to production, a promotion event."""
    entry = (cfg.model_name, run_id, run_id, scores["f1_score"], scores.get("roc_auc_score", 0.0), scores["precision_score"],
             scores["recall_score"], val_f1, scores.get("threshold", 0.5), False, now)
    sinks.append_log(spark.createDataFrame([entry], REGISTRY_ROW), f"{work_dir}/registry")
    if promote:
        event = spark.createDataFrame([(cfg.model_name, run_id, now)], "model_name string, run_id string, promoted_at timestamp_ntz")
        event.write.mode("append").parquet(f"{work_dir}/promotions")


def new_run_id(now: datetime) -> str:
    """The time, and a few random digits so that runs of one moment differ."""
    return f"run-{now:%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def train_job(spark: SparkSession, work_dir: str, cfg: Config = DEFAULT, promote: bool = True, now: datetime | None = None) -> str:
    """Train on the processed table, save and register the model with its validation and test scores. The run id."""
    now = now or datetime.now()
    processed, params = load_processed(spark, work_dir)
    fitted = fit(processed, params, cfg)
    run_id = new_run_id(now)
    path = f"{work_dir}/models/{run_id}"
    model.save_model(fitted, path)
    params.save(spark, f"{path}-preprocess")
    result = evaluate(fitted, processed, params, cfg, path)
    sinks.write_report(result.report, f"{work_dir}/reports/{run_id}")
    register(spark, work_dir, cfg, run_id, result.test, result.val_f1, now, promote)
    return run_id


def evaluate_job(spark: SparkSession, work_dir: str, run_id: str, cfg: Config = DEFAULT) -> DataFrame:
    """Evaluate a saved model on the processed table again and write its report."""
    processed, params = load_processed(spark, work_dir)
    path = f"{work_dir}/models/{run_id}"
    report = evaluate(model.load_model(path), processed, params, cfg, path).report
    sinks.write_report(report, f"{work_dir}/reports/{run_id}")
    return report


def score_batch(spark: SparkSession, engineered: DataFrame, work_dir: str, run_id: str, cfg: Config = DEFAULT) -> DataFrame:
    """Probability, band and confidence of engineered rows under a saved model."""
    path = f"{work_dir}/models/{run_id}"
    params = PreprocessParams.load(spark, f"{path}-preprocess")
    scored = model.score_features(model.load_model(path), engineered, params, [cfg.join_key])
    p = F.col("score")
    return scored.withColumns(
        {
            "prediction": decision(p, cfg.fraud_threshold, cfg.suspicious_threshold),
            "confidence": confidence(p, cfg.fraud_threshold, cfg.suspicious_threshold),
        }
    )


def predict_requests(spark: SparkSession, payloads: DataFrame, history: DataFrame, work_dir: str, run_id: str,
                     cfg: Config = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Request payloads to rows of the prediction log, and the rejected payloads.

    Features look at strictly earlier transactions of ``history`` and of the requests themselves. A request that comes
    twice is scored once, as of its earliest time. The log holds score, band, confidence, the contributions that matter, the card's label and the model.
    """
    accepted, rejected = split_payload(payloads)
    key, time = cfg.join_key, cfg.time_column
    requests = dedupe_first(to_transactions(accepted), key, time)
    kinds = {f.name: f.dataType for f in requests.schema if f.name in history.columns}
    past = history.select(*[F.col(c).cast(t).alias(c) for c, t in kinds.items()])
    marked = past.withColumn("is_inference_batch", F.lit(False)).unionByName(
        requests.withColumn("is_inference_batch", F.lit(True)), allowMissingColumns=True)
    features = engineer_features(marked, cfg, ties="strict").where("is_inference_batch")
    # The label is of the card as sent, before missing names are filled.
    features = with_serving_defaults(features.withColumn("card_label", scoring_card_label(F.col("card6"), F.col("card4"))))

    path = f"{work_dir}/models/{run_id}"
    params = PreprocessParams.load(spark, f"{path}-preprocess")
    kept = [key, "card_label"]
    ready = apply_preprocess(features, params, kept)
    scored = model.score(model.load_model(path), ready, params.features, [*kept, *[f"`{f}`" for f in params.features]])
    explained = model.tree_attributions(scored, path, params.features, [*kept, "score"])
    p = F.col("score")
    log = explained.select(
        F.col(key).alias("transaction_id"), "score", decision(p, cfg.fraud_threshold, cfg.suspicious_threshold).alias("prediction"),
        confidence(p, cfg.fraud_threshold, cfg.suspicious_threshold).alias("confidence"),
        explanation_kept(F.col("contributions")).alias("explanation"), "card_label", F.lit(run_id).alias("model_version"),
    )
    return log, rejected


def score_job(spark: SparkSession, requests: str, history: DataFrame, work_dir: str, run_id: str, run_date: str,
              cfg: Config = DEFAULT) -> DataFrame:
    """Score a file of JSON requests, one a line; writes the date's part of ``predictions`` and ``rejected``. Rows of each."""
    log, rejected = predict_requests(spark, spark.read.text(requests).withColumnRenamed("value", "payload"), history, work_dir, run_id, cfg)
    sinks.write_batch(log, f"{work_dir}/predictions", run_date)
    sinks.write_batch(rejected, f"{work_dir}/rejected", run_date)
    counts = [spark.read.parquet(f"{work_dir}/{name}").where(F.col("batch_date") == F.lit(run_date).cast("date"))
              .select(F.lit(name).alias("part")) for name in ("predictions", "rejected")]
    return counts[0].unionByName(counts[1]).groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"))


def generate_batch(cleaned: DataFrame, batch_dir: str, batch_date: str, intensity: float | None = None, cfg: Config = DEFAULT) -> None:
    """Write the shifted batch of the newest rows under its date."""
    sinks.write_batch(make_shifted_batch(cleaned, intensity, cfg), batch_dir, batch_date)


def check_drift(cleaned: DataFrame, batch_dir: str, log_path: str, run_date: str, cfg: Config = DEFAULT) -> tuple[bool, DataFrame]:
    """Newest batch against the baseline; appends the test rows to the drift log. Verdict and tests."""
    spark = cleaned.sparkSession
    batch = readers.read_latest_batch(spark, batch_dir)
    reference = engineer_features(baseline_exclude(cleaned, cfg), cfg, wanted=source_columns(TESTED))
    tests = settle(detect_drift(reference, batch, cfg), "tests")
    rows = tests.select(
        F.lit(run_date).cast("date").alias("run_date"), "feature_name", "drift_score", "p_value", "drift_detected",
        "drift_intensity", F.localtimestamp().alias("timestamp"),
    )
    sinks.append_log(rows, log_path, "feature_name")
    report = drift_summary(tests).withColumn("run_date", F.lit(run_date))
    results = tests.agg(F.sort_array(F.collect_list(F.struct(*tests.columns)))).scalar()  # one entry per tested feature
    report = report.withColumn("tests", results)
    sinks.write_report(report, f"{log_path}-reports/{run_date}")
    return bool(report.first()["drift_detected"]), tests


def log_run(spark: SparkSession, path: str, started: datetime, reason: str, old: float, new: float, promoted: bool, notes: str,
            finished: datetime) -> DataFrame:
    row = spark.createDataFrame([(started, reason, old, new, promoted, notes, finished)], RETRAIN_LOG)
    sinks.append_log(row, path)
    return row


def retrain(
    spark: SparkSession, cleaned: DataFrame, work_dir: str, cfg: Config = DEFAULT, force: bool = False,
    now: datetime | None = None, batch_dir: str | None = None, reason: str = "drift_detection",
) -> DataFrame:
    """Gate, union with all batches, train, evaluate, compare test F1 with test F1, promote, log.

    ``work_dir`` holds the tables retrain_log, registry and promotions and the models. Everything is
    appended; the newest promotion event of a model name decides what is in production.
    """
    now = now or datetime.now()
    log = f"{work_dir}/retrain_log"
    if not force and readers.path_exists(spark, log):
        gate = registry.retrain_gate(
            spark.read.parquet(log), F.lit(now).cast("timestamp_ntz"), cfg.min_hours_between_retrains,
            cfg.max_retrains_per_day, cfg.count_failures,
        ).first()
        if not gate["allowed"]:
            return log_run(spark, log, now, reason, 0.0, 0.0, False, registry.DENIED + gate["reason"], now)

    rows = cleaned
    if batch_dir and readers.path_exists(spark, batch_dir):
        rows = readers.union_training(cleaned, [readers.read_batches(spark, batch_dir)])
    processed, params = prepare(settle(engineer_features(rows, cfg), "engineered"), cfg)
    fitted = fit(processed, params, cfg)
    run_id = new_run_id(now)
    path = f"{work_dir}/models/{run_id}"
    model.save_model(fitted, path)
    params.save(spark, f"{path}-preprocess")
    result = evaluate(fitted, processed, params, cfg, path)
    sinks.write_report(result.report, f"{work_dir}/reports/{run_id}")

    production = production_registry(spark, work_dir)
    old = 0.0 if production is None else float(registry.production_metrics(production).first()["f1_score"])
    new = result.test["f1_score"]
    promoted = bool(new - old >= cfg.promotion_min_delta or old == 0.0)
    register(spark, work_dir, cfg, run_id, result.test, result.val_f1, now, promoted)
    outcome = "Promoted" if promoted else f"Not promoted, gain below {cfg.promotion_min_delta}"
    notes = f"{outcome}: test F1 {new:.4f}, in production {old:.4f}."
    return log_run(spark, log, now, reason, old, new, promoted, notes, now)


def production_registry(spark: SparkSession, work_dir: str) -> DataFrame | None:
    """The registry with the promotion events applied, or None before the first run."""
    reg, promotions = f"{work_dir}/registry", f"{work_dir}/promotions"
    if not readers.path_exists(spark, reg):
        return None
    rows = spark.read.parquet(reg)
    return registry.with_promotions(rows, spark.read.parquet(promotions)) if readers.path_exists(spark, promotions) else rows


def drift_then_retrain(
    spark: SparkSession, cleaned: DataFrame, batch_dir: str, work_dir: str, run_date: str, cfg: Config = DEFAULT,
    now: datetime | None = None,
) -> DataFrame | None:
    """Check the newest batch; retrain only on drift. The log row of the run, or None."""
    drifted, _ = check_drift(cleaned, batch_dir, f"{work_dir}/drift_log", run_date, cfg)
    return retrain(spark, cleaned, work_dir, cfg, now=now, batch_dir=batch_dir) if drifted else None
