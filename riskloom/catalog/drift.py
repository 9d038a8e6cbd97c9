"""Shifts, shifted batches and drift tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import query
from riskloom.catalog.sql import FEATURE_COLUMNS, NEWEST_5000, TXN, engineered, normal, shifted, sql, u
from riskloom.config import DEFAULT
from riskloom.operators import drift, ranks, shift
from riskloom.plans.drift import TESTED, baseline_exclude, drift_frames, make_shifted_batch
from riskloom.sources import views

INTENSITY = 0.5


@query("shift_amount", sql(TXN, body="SELECT TransactionID, TransactionAmt * 1.3::DOUBLE AS TransactionAmt FROM txn"))
def shift_amount(spark, d):
    return shift.shift_amount(views.txn(spark, d).select("TransactionID", "TransactionAmt"), INTENSITY)


METRICS = """m AS (SELECT TransactionID, TransactionDT % 7 + 1 AS velocity_1hr, TransactionDT % 50 + 1 AS merchant_tx_count_30d,
  TransactionDT % 20 + 1 AS merchant_unique_users_30d FROM txn)"""


def _metrics(spark, d):
    dt = F.col("TransactionDT")
    return views.txn(spark, d).select(
        "TransactionID", (dt % 7 + 1).alias("velocity_1hr"), (dt % 50 + 1).alias("merchant_tx_count_30d"),
        (dt % 20 + 1).alias("merchant_unique_users_30d"),
    )


@query("shift_velocity", sql(TXN, METRICS, body="SELECT TransactionID, velocity_1hr * 2.0::DOUBLE AS velocity_1hr FROM m"))
def shift_velocity(spark, d):
    return shift.shift_velocity(_metrics(spark, d).select("TransactionID", "velocity_1hr"), INTENSITY)


@query("shift_merchant", sql(TXN, METRICS, body="""SELECT TransactionID, merchant_tx_count_30d * 1.75::DOUBLE AS merchant_tx_count_30d,
  merchant_unique_users_30d * 1.75::DOUBLE AS merchant_unique_users_30d FROM m"""))
def shift_merchant(spark, d):
    return shift.shift_merchant(_metrics(spark, d).drop("velocity_1hr"), INTENSITY)


@query("shift_label_rate", sql(TXN, shifted("txn", "s", INTENSITY), body="SELECT TransactionID, isFraud FROM s_label"))
def shift_label_rate(spark, d):
    return shift.shift_label_rate(views.txn(spark, d).select("TransactionID", "isFraud"), INTENSITY)


@query("shift_time_of_day", sql(TXN, body=f"""SELECT TransactionID, CASE WHEN isFraud = 1 AND {u('move', 'TransactionID')} < {INTENSITY} THEN
  CAST(TransactionDT // 86400 * 86400 + floor(least(greatest({normal('hour', 'TransactionID')} * 2.0 + 12.0, 9.0), 17.0)) * 3600 + TransactionDT % 3600 AS BIGINT)
  ELSE TransactionDT END AS TransactionDT FROM txn"""))
def shift_time_of_day(spark, d):
    rows = views.txn(spark, d).select("TransactionID", "TransactionDT", "isFraud")
    return shift.shift_time_of_day(rows, INTENSITY).select("TransactionID", "TransactionDT")


@query("shift_categories", sql(TXN, shifted("txn", "s", INTENSITY), body="SELECT TransactionID, ProductCD, card4, P_emaildomain FROM s"))
def shift_categories(spark, d):
    return shift.shift_categories(views.txn(spark, d).select("TransactionID", "ProductCD", "card4", "P_emaildomain"), INTENSITY)


@query("last_n_batch", sql(TXN, NEWEST_5000, body="SELECT TransactionID, TransactionDT, is_inference_batch FROM marked"))
def last_n_batch(spark, d):
    rows = views.txn(spark, d).select("TransactionID", "TransactionDT")
    return ranks.flag_newest(rows, DEFAULT.batch_rows, ["TransactionDT", "TransactionID"], "is_inference_batch")


@query("baseline_exclude", sql(TXN, body="""SELECT TransactionID, TransactionDT FROM txn
QUALIFY row_number() OVER (ORDER BY TransactionDT DESC, TransactionID DESC) > least(5000, (SELECT count(*) FROM txn) // 2)"""))
def baseline(spark, d):
    return baseline_exclude(views.txn(spark, d).select("TransactionID", "TransactionDT"))


BATCH_CTES = (
    TXN, NEWEST_5000,
    "old_rows AS (SELECT * FROM marked WHERE NOT is_inference_batch)", "new_rows AS (SELECT * FROM marked WHERE is_inference_batch)",
    shifted("new_rows", "moved", INTENSITY), "everything AS (SELECT * FROM old_rows UNION ALL BY NAME SELECT * FROM moved)",
    engineered("everything", "feat"),
)


@query("shifted_batch", sql(*BATCH_CTES, body=f"SELECT {FEATURE_COLUMNS} FROM feat WHERE is_inference_batch"))
def shifted_batch(spark, d):
    return make_shifted_batch(views.txn(spark, d).drop("ingest_seq"), INTENSITY)


def drift_ctes(numeric, categorical):
    """The drift tests of the columns of ``both_sides`` (``cur`` tells the sides apart): tables ks, chi and verdicts."""
    return (
        "nums AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature_name, CAST({c} AS DOUBLE) AS v, cur FROM both_sides" for c in numeric) + ")",
        """n AS (SELECT feature_name, v, count(*) FILTER (WHERE NOT cur) AS r, count(*) FILTER (WHERE cur) AS c FROM nums WHERE v IS NOT NULL GROUP BY ALL)""",
        """cum AS (SELECT *, sum(r) OVER w AS cr, sum(c) OVER w AS cc, sum(r) OVER (PARTITION BY feature_name) AS n_ref,
  sum(c) OVER (PARTITION BY feature_name) AS n_cur FROM n WINDOW w AS (PARTITION BY feature_name ORDER BY v))""",
        """ks AS (SELECT feature_name, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, max(abs(cr / n_ref - cc / n_cur)) AS d FROM cum GROUP BY ALL)""",
        "cats AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature_name, {c} AS v, cur FROM both_sides" for c in categorical) + ")",
        """cc AS (SELECT feature_name, v, count(*) FILTER (WHERE NOT cur) AS r, count(*) FILTER (WHERE cur) AS c FROM cats WHERE v IS NOT NULL GROUP BY ALL)""",
        """tot AS (SELECT *, sum(r) OVER w AS n_ref, sum(c) OVER w AS n_cur, count(*) OVER w - 1 AS dof FROM cc WINDOW w AS (PARTITION BY feature_name))""",
        """expd AS (SELECT *, (r + c) * n_ref / (n_ref + n_cur) AS er, (r + c) * n_cur / (n_ref + n_cur) AS ec FROM tot)""",
        """off AS (SELECT *, abs(r - er) - CASE WHEN dof = 1 THEN least(0.5, abs(r - er)) ELSE 0 END AS dr,
  abs(c - ec) - CASE WHEN dof = 1 THEN least(0.5, abs(c - ec)) ELSE 0 END AS dc FROM expd)""",
        """chi AS (SELECT feature_name, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, dof, sum(dr * dr / er + dc * dc / ec) AS stat FROM off GROUP BY ALL)""",
        # critical values at 0.05: Kolmogorov 1.3580986, chi-square 3.8414588 (1 dof), 5.9914645 (2), 7.8147279 (3)
        """verdicts AS (SELECT feature_name, 'ks' AS test, d AS drift_score, d * sqrt(n_ref * n_cur / (n_ref + n_cur)) > 1.3580986393225505 AS drift_detected FROM ks
  UNION ALL SELECT feature_name, 'chi_square', stat, stat > CASE dof WHEN 1 THEN 3.841458820694124 WHEN 2 THEN 5.991464547107979 ELSE 7.814727903251179 END FROM chi)""",
    )


REFERENCE = """ref_rows AS (SELECT * FROM txn QUALIFY row_number() OVER (ORDER BY TransactionDT DESC, TransactionID DESC)
  > least(5000, (SELECT count(*) FROM txn) // 2))"""
BUCKET = "CASE WHEN hour <= 6 THEN 'night' WHEN hour <= 12 THEN 'morning' WHEN hour <= 18 THEN 'afternoon' ELSE 'evening' END"
BOTH_CTES = (
    *BATCH_CTES, REFERENCE, engineered("ref_rows", "ref"),
    f"""both_sides AS (
  SELECT amount, velocity_1hr, user_avg_amount_30d, card6, {BUCKET} AS hour_bucket, false AS cur FROM ref
  UNION ALL SELECT amount, velocity_1hr, user_avg_amount_30d, card6, {BUCKET}, true FROM feat WHERE is_inference_batch)""",
    *drift_ctes(drift.NUMERIC, drift.CATEGORICAL),
)


def _both(spark, d, tested=TESTED):
    return drift_frames(views.txn(spark, d).drop("ingest_seq"), INTENSITY, tested=tested)


@query("drift_ks", sql(*BOTH_CTES, body="SELECT feature_name, n_ref, n_cur, round(d, 9) AS statistic FROM ks"))
def drift_ks(spark, d):
    both = drift.tagged(*_both(spark, d, drift.NUMERIC), drift.NUMERIC)
    return drift.drift_ks(both, drift.NUMERIC).withColumn("statistic", F.round("statistic", 9))


@query("drift_chi_square", sql(*BOTH_CTES, body="SELECT feature_name, n_ref, n_cur, dof, round(stat, 6) AS statistic FROM chi"))
def drift_chi_square(spark, d):
    both = drift.tagged(*_both(spark, d, drift.CATEGORICAL), drift.CATEGORICAL)
    return drift.drift_chi_square(both, drift.CATEGORICAL).withColumn("statistic", F.round("statistic", 6))


@query("drift_report", sql(*BOTH_CTES, body="SELECT feature_name, test, round(drift_score, 6) AS drift_score, drift_detected FROM verdicts"))
def drift_report(spark, d):
    tests = drift.drift_tests(*_both(spark, d))
    return tests.select("feature_name", "test", F.round("drift_score", 6).alias("drift_score"), "drift_detected")


@query("drift_summary", sql(*BOTH_CTES, body="""SELECT bool_or(drift_detected) AS drift_detected, count(*) AS features_tested,
  count(*) FILTER (WHERE drift_detected) AS features_drifted, avg(CASE WHEN drift_detected THEN 1 ELSE 0 END) AS drifted_share FROM verdicts"""))
def drift_summary(spark, d):
    return drift.drift_summary(drift.drift_tests(*_both(spark, d)))
