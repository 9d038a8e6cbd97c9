"""Log tables: recent activity, drift history, registry, gates and panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import query
from riskloom.catalog.sql import DRIFT_LOG, FEATURES, PREDICTIONS, REGISTRY, RETRAIN_LOG, TXN, sql
from riskloom.functions import scalars
from riskloom.operators import monitor, ranks, registry
from riskloom.sources import views



@query("recent_transactions", sql(TXN, PREDICTIONS, FEATURES, body="""SELECT id, p.transaction_id, fraud_probability, prediction, model_version,
  coalesce(f.amount, 0) AS amount, coalesce(card_type, 'debit') || CASE WHEN card_network IS NULL OR card_network = 'unknown' THEN '' ELSE ' (' || card_network || ')' END AS card_type
FROM predictions p LEFT JOIN features f USING (transaction_id) ORDER BY id DESC LIMIT 100"""))
def recent_transactions(spark, d):
    return monitor.recent_transactions(views.prediction_log(spark, d), views.feature_log(spark, d)).drop("timestamp")


@query("search_feed", sql(TXN, PREDICTIONS, FEATURES, body="""SELECT p.transaction_id, prediction, coalesce(card_type, 'debit') ||
  CASE WHEN card_network IS NULL OR card_network = 'unknown' THEN '' ELSE ' (' || card_network || ')' END AS card_label
FROM predictions p JOIN features f USING (transaction_id)
WHERE contains(lower(p.transaction_id), 'visa') OR contains(lower(prediction), 'visa') OR contains(lower(card_label), 'visa')"""))
def search_feed(spark, d):
    rows = views.prediction_log(spark, d).join(views.feature_log(spark, d), "transaction_id").select(
        "transaction_id", "prediction", scalars.log_card_label(F.col("card_type"), F.col("card_network")).alias("card_label")
    )
    return rows.where(scalars.matches_search("VISA", *[F.col(c) for c in rows.columns]))


@query("recent_fraud_rate", sql(PREDICTIONS, "r AS (SELECT * FROM predictions ORDER BY id DESC LIMIT 100)", body="""SELECT
  coalesce(avg(CASE WHEN prediction = 'FRAUD' THEN 1 ELSE 0 END), 0) AS fraud_rate, count(*) AS total_predictions FROM r"""))
def recent_fraud_rate(spark, d):
    return monitor.recent_fraud_rate(views.prediction_log(spark, d))


@query("recent_latency", """WITH r AS (SELECT value FROM events WHERE event_type NOT IN ('purchase', 'signup') ORDER BY ts DESC, event_id DESC LIMIT 1000)
SELECT round(avg(value), 6) AS avg_latency_ms FROM r""")
def recent_latency(spark, d):
    return monitor.recent_latency(views.request_log(spark, d)).select(F.round("avg_latency_ms", 6).alias("avg_latency_ms"))


@query("rate_severity", sql(PREDICTIONS, """h AS (SELECT epoch_us(date_trunc('hour', "timestamp")) // 1000000 AS hour_start,
  avg(CASE WHEN prediction = 'FRAUD' THEN 1 ELSE 0 END) AS rate FROM predictions GROUP BY ALL)""",
  body="SELECT hour_start, rate, CASE WHEN rate >= 0.06 THEN 'red' WHEN rate >= 0.04 THEN 'yellow' ELSE 'green' END AS severity FROM h"))
def rate_severity(spark, d):
    hours = views.prediction_log(spark, d).groupBy(F.window("timestamp", "1 hour")["start"].alias("h")).agg(
        F.avg((F.col("prediction") == "FRAUD").cast("int")).alias("rate")
    )
    return hours.select(views.clock("h", "1970-01-01").alias("hour_start"), "rate", scalars.rate_severity(F.col("rate")).alias("severity"))


# --- drift history ----------------------------------------------------------------------------------------


def _plain_date(df):
    return df.withColumn("run_date", F.col("run_date").cast("string"))


DRIFT_COLUMNS = "id, feature_name, drift_score, p_value, drift_detected"


@query("drift_latest_n", sql(DRIFT_LOG, "r AS (SELECT * FROM drift_log ORDER BY id DESC LIMIT 5)",
  body=f"SELECT CAST((SELECT arg_max(run_date, id) FROM r) AS VARCHAR) AS run_date, {DRIFT_COLUMNS}, bool_or(drift_detected) OVER () AS any_drift FROM r"))
def drift_latest_n(spark, d):
    return _plain_date(monitor.drift_latest_n(views.drift_log(spark, d)))


@query("drift_latest_date", sql(DRIFT_LOG, "r AS (SELECT * FROM drift_log WHERE run_date = (SELECT arg_max(run_date, id) FROM drift_log))",
  body=f"SELECT CAST(run_date AS VARCHAR) AS run_date, {DRIFT_COLUMNS}, bool_or(drift_detected) OVER () AS any_drift FROM r"))
def drift_latest_date(spark, d):
    return _plain_date(monitor.drift_latest_date(views.drift_log(spark, d)))


@query("drift_features", sql(DRIFT_LOG, body="SELECT feature_name, min(id) AS first_id FROM drift_log GROUP BY feature_name ORDER BY first_id LIMIT 5"))
def drift_features(spark, d):
    return monitor.drift_features(views.drift_log(spark, d))


@query("drift_pivot", sql(DRIFT_LOG, body="SELECT CAST(run_date AS VARCHAR) AS run_date, arg_min(drift_intensity, id) AS intensity, " + ", ".join(
    f"arg_max(drift_score, id) FILTER (WHERE feature_name = '{f}') AS {f}" for f in views.DRIFT_FEATURES) + " FROM drift_log GROUP BY run_date"))
def drift_pivot(spark, d):
    return _plain_date(monitor.drift_pivot(views.drift_log(spark, d), views.DRIFT_FEATURES))


@query("newest_drift", sql(DRIFT_LOG, body=f"SELECT CAST(run_date AS VARCHAR) AS run_date, {DRIFT_COLUMNS}, drift_intensity FROM drift_log ORDER BY id DESC LIMIT 100"))
def newest_drift(spark, d):
    return _plain_date(ranks.newest(views.drift_log(spark, d), 100, "id").drop("timestamp"))


# --- registry and retraining --------------------------------------------------------------------------------


@query("newest_retrains", sql(RETRAIN_LOG, body="SELECT id, trigger_reason, old_f1, new_f1, promoted, notes FROM retrain_log ORDER BY id DESC LIMIT 10"))
def newest_retrains(spark, d):
    return ranks.newest(views.retrain_log(spark, d), 10, "id").drop("triggered_at", "timestamp")


@query("promotion_timeline", sql(RETRAIN_LOG, body="""SELECT 'v' || CAST(row_number() OVER (ORDER BY triggered_at, id) AS VARCHAR) AS run, id, new_f1
FROM retrain_log WHERE new_f1 > 0.05"""))
def promotion_timeline(spark, d):
    return monitor.promotion_timeline(views.retrain_log(spark, d)).drop("triggered_at")


@query("production_metrics", sql(REGISTRY, body="""SELECT arg_max(f1_score, id) AS f1_score, arg_max(auc_score, id) AS auc_score,
  arg_max(precision_score, id) AS precision_score, arg_max(recall_score, id) AS recall_score FROM registry WHERE is_production"""))
def production_metrics(spark, d):
    return registry.production_metrics(views.model_registry(spark, d))


@query("promotion_decision", sql(REGISTRY, """p AS (SELECT arg_max(f1_score, id) FILTER (WHERE NOT is_production) AS candidate_f1,
  arg_max(f1_score, id) FILTER (WHERE is_production) AS production_f1 FROM registry)""", body="""SELECT candidate_f1, production_f1,
  round(candidate_f1 - production_f1, 6) AS delta, candidate_f1 - production_f1 >= 0.01::DOUBLE OR production_f1 = 0 AS promote FROM p"""))
def promotion_decision(spark, d):
    return registry.compare_with_production(views.model_registry(spark, d))


@query("promote_registry", sql(REGISTRY, "b AS (SELECT arg_max(run_id, id) AS best FROM registry WHERE model_name = 'risk-boosted-trees')", body="""SELECT id, model_name, run_id,
  CASE WHEN model_name = 'risk-boosted-trees' THEN run_id = best ELSE is_production END AS is_production FROM registry, b"""))
def promote_registry(spark, d):
    rows = views.model_registry(spark, d)
    newest_run = rows.where(F.col("model_name") == "risk-boosted-trees").agg(F.max_by("run_id", "id")).scalar()
    return registry.promote(rows, "risk-boosted-trees", newest_run).select("id", "model_name", "run_id", "is_production")


@query("retrain_gate", sql(RETRAIN_LOG, """s AS (SELECT max("timestamp") AS last_run,
  count(*) FILTER (WHERE "timestamp" >= TIMESTAMP '2024-01-31 12:00:00' - INTERVAL 1 DAY) AS runs_last_day FROM retrain_log)""",
  body="""SELECT runs_last_day, CASE WHEN last_run > TIMESTAMP '2024-01-31 12:00:00' - INTERVAL 6 HOUR THEN 'too_recent'
  WHEN runs_last_day >= 3 THEN 'daily_limit' ELSE '' END AS reason, reason = '' AS allowed FROM s"""))
def retrain_gate(spark, d):
    now = F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")
    return registry.retrain_gate(views.retrain_log(spark, d), now).drop("last_run")


@query("metric_points", sql(PREDICTIONS, body="""SELECT 'fraud_rate' AS target, avg(CASE WHEN prediction = 'FRAUD' THEN 1 ELSE 0 END) AS value,
  epoch_ms(date_trunc('hour', "timestamp")) AS ts_ms FROM predictions GROUP BY date_trunc('hour', "timestamp")"""))
def metric_points(spark, d):
    hours = views.prediction_log(spark, d).groupBy(F.window("timestamp", "1 hour")["start"].alias("h")).agg(
        F.avg((F.col("prediction") == "FRAUD").cast("int")).alias("rate"), F.count(F.lit(1)).cast("double").alias("total")
    )
    ms = (views.clock("h", "1970-01-01") * 1000).cast("double")
    documents = hours.select(
        F.to_json(F.array(*[
            F.struct(F.lit(t).alias("target"), F.array(F.array(F.col(c), ms)).alias("datapoints"))
            for t, c in (("fraud_rate", "rate"), ("total_predictions", "total"))
        ])).alias("payload")
    )
    return monitor.panel_points(documents, "payload", "fraud_rate")


# --- volume and rate over time --------------------------------------------------------------------------------


def _windows_sql(hours: int) -> str:
    return sql(PREDICTIONS, f"""p AS (SELECT prediction, unnest(range(0, {hours})) AS back, epoch_us("timestamp") // 3600000000 AS h FROM predictions)""",
               body=f"""SELECT CAST((h - back) * 3600 AS BIGINT) AS window_start, count(*) AS total,
  CAST(sum(CASE WHEN prediction = 'FRAUD' THEN 1 ELSE 0 END) AS BIGINT) AS frauds,
  sum(CASE WHEN prediction = 'FRAUD' THEN 1 ELSE 0 END) / count(*) AS fraud_rate FROM p GROUP BY h - back""")


def windows_out(df):
    return df.select(views.clock("window_start", "1970-01-01").alias("window_start"), "total", "frauds", "fraud_rate")


@query("tumbling_rate", _windows_sql(1))
def tumbling_rate(spark, d):
    return windows_out(monitor.windowed_rate(views.prediction_log(spark, d), "timestamp", "prediction", "1 hour"))


@query("sliding_rate", _windows_sql(24))
def sliding_rate(spark, d):
    return windows_out(monitor.windowed_rate(views.prediction_log(spark, d), "timestamp", "prediction", "24 hours", "1 hour"))
