"""Classification metrics on a given score."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import query
from riskloom.catalog.preprocess import CONTRIBUTIONS, contributions
from riskloom.catalog.sql import SCORED, TXN, h32, sql
from riskloom.operators import metrics
from riskloom.sources import views


@query("class_weight", sql(TXN, body="""SELECT count(*) FILTER (WHERE isFraud = 0) AS negatives, count(*) FILTER (WHERE isFraud = 1) AS positives,
  count(*) FILTER (WHERE isFraud = 0) / count(*) FILTER (WHERE isFraud = 1) AS weight FROM txn"""))
def class_weight(spark, d):
    return metrics.class_weight(views.txn(spark, d), "isFraud")


COUNTS = """SELECT count(*) FILTER (WHERE isFraud = 0 AND score < t) AS true_negatives, count(*) FILTER (WHERE isFraud = 0 AND score >= t) AS false_positives,
  count(*) FILTER (WHERE isFraud = 1 AND score < t) AS false_negatives, count(*) FILTER (WHERE isFraud = 1 AND score >= t) AS true_positives"""
SCORES = """coalesce(true_positives / nullif(true_positives + false_positives, 0), 0) AS precision_score,
  coalesce(true_positives / nullif(true_positives + false_negatives, 0), 0) AS recall_score,
  coalesce(2 * true_positives / nullif(2 * true_positives + false_positives + false_negatives, 0), 0) AS f1_score"""


@query("confusion_matrix", sql(TXN, SCORED, body=f"{COUNTS} FROM scored, (SELECT CAST(0.5 AS DOUBLE) AS t)"))
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(views.scored(spark, d), "isFraud", "score", 0.5)


@query("prf_scores", sql(TXN, SCORED, f"c AS ({COUNTS} FROM scored, (SELECT CAST(0.5 AS DOUBLE) AS t))", body=f"SELECT {SCORES} FROM c"))
def prf_scores(spark, d):
    return metrics.prf_scores(views.scored(spark, d), "isFraud", "score", 0.5)


@query("roc_auc", sql(TXN, SCORED, """g AS (SELECT score, count(*) FILTER (WHERE isFraud = 1) AS p, count(*) FILTER (WHERE isFraud = 0) AS n FROM scored GROUP BY score)""",
  """b AS (SELECT *, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)""",
  body="SELECT CAST(sum(p * (2 * below + n)) AS DOUBLE) / (2.0::DOUBLE * sum(p) * sum(n)) AS roc_auc_score FROM b"))
def roc_auc(spark, d):
    return metrics.roc_auc(views.scored(spark, d), "isFraud", "score")


SWEEP = f"""w AS (SELECT t AS threshold, * EXCLUDE (t) FROM (
  SELECT t, * EXCLUDE (t) FROM (SELECT i / 100.0::DOUBLE AS t FROM range(30, 71, 5) r(i)) x, LATERAL ({COUNTS} FROM scored)))"""


@query("threshold_sweep", sql(TXN, SCORED, SWEEP, body=f"SELECT *, {SCORES} FROM w"))
def threshold_sweep(spark, d):
    return metrics.threshold_sweep(views.scored(spark, d), "isFraud", "score", metrics.threshold_grid())


@query("best_threshold", sql(TXN, SCORED, SWEEP, f"s AS (SELECT *, {SCORES} FROM w)", body="SELECT * FROM s ORDER BY f1_score DESC, threshold LIMIT 1"))
def best_threshold(spark, d):
    return metrics.best_threshold(metrics.threshold_sweep(views.scored(spark, d), "isFraud", "score", metrics.threshold_grid()))


@query("best_trial", f"""SELECT event_id AS trial, {h32('f1', 'event_id')} % 1000 / 1000.0 AS val_f1 FROM events ORDER BY val_f1 DESC, trial LIMIT 1""")
def best_trial(spark, d):
    trials = views.events(spark, d).select(
        F.col("event_id").alias("trial"), (views.hash32(42, "f1", F.col("event_id")) % 1000 / 1000.0).alias("val_f1")
    )
    return metrics.best_trial(trials, "val_f1", "trial")


@query("global_importance", sql(CONTRIBUTIONS, body="""SELECT feature, round(avg(abs(contribution)), 9) AS importance FROM contrib GROUP BY feature
ORDER BY importance DESC, feature LIMIT 10"""))
def global_importance(spark, d):
    return metrics.global_importance(contributions(spark, d), "contributions").withColumn("importance", F.round("importance", 9))
