"""Views over the log tables: recent activity, history lookups, explanations, drift history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.scalars import from_micro, log_card_label, to_micro
from riskloom.operators.ranks import newest


def recent_transactions(predictions: DataFrame, features: DataFrame, n: int = 100) -> DataFrame:
    """Newest predictions with amount and card label. The features are cut to the n ids before the join."""
    latest = newest(predictions, n, "id")
    # n ids
    matching = features.join(F.broadcast(latest.select("transaction_id").distinct()), "transaction_id", "left_semi")
    joined = latest.join(matching.select("transaction_id", "amount", "card_type", "card_network"), "transaction_id", "left")
    return joined.select(
        "id", "transaction_id", "fraud_probability", "prediction", "model_version", "timestamp",
        F.coalesce("amount", F.lit(0.0)).alias("amount"),
        log_card_label(F.col("card_type"), F.col("card_network")).alias("card_type"),
    )


def recent_fraud_rate(predictions: DataFrame, n: int = 100) -> DataFrame:
    share = F.avg((F.col("prediction") == "FRAUD").cast("int"))
    return newest(predictions, n, "id").agg(
        F.coalesce(share, F.lit(0.0)).alias("fraud_rate"), F.count(F.lit(1)).alias("total_predictions")
    )


# fixed values: request paths that do not count
INTERNAL_PATHS = ("/grafana-metrics", "/health")


def recent_latency(requests: DataFrame, n: int = 1000) -> DataFrame:
    outside = ~(F.endswith("path", F.lit(INTERNAL_PATHS[0])) | F.endswith("path", F.lit(INTERNAL_PATHS[1])))
    return newest(requests.where(outside), n, "ts", "id").agg(
        F.coalesce(F.avg("latency_ms"), F.lit(0.0)).alias("avg_latency_ms")
    )


def history_rows(history: DataFrame, user_key: str, merchant_key: str) -> DataFrame:
    """History of one request: rows of its user or its merchant. Both conditions reach the scan."""
    return history.where((F.col("user_key") == user_key) | (F.col("merchant_key") == merchant_key))


def history_or_lookup(probes: DataFrame, history: DataFrame, probe_id: str, amount: str) -> DataFrame:
    """For each probe, rows and amount of the history of its user or its merchant, each row once.

    Rows of the user, plus rows of the merchant, minus rows of both: three pre-aggregated tables joined on
    equal keys instead of a nested-loop join or a list of matching pairs.
    """
    base = history.select("user_key", "merchant_key", F.coalesce(to_micro(F.col(amount)), F.lit(0)).alias("_a"))
    both = base.groupBy("user_key", "merchant_key").agg(F.count(F.lit(1)).alias("n_both"), F.sum("_a").alias("a_both"))
    users = both.groupBy("user_key").agg(F.sum("n_both").alias("n_user"), F.sum("a_both").alias("a_user"))
    merchants = both.groupBy("merchant_key").agg(F.sum("n_both").alias("n_merchant"), F.sum("a_both").alias("a_merchant"))
    asked = (
        probes.select(probe_id, "user_key", "merchant_key")
        .join(users, "user_key", "left").join(merchants, "merchant_key", "left")
        .join(both, ["user_key", "merchant_key"], "left")
    )

    def sides(prefix: str) -> Column:
        parts = [F.coalesce(F.col(f"{prefix}_{s}"), F.lit(0)) for s in ("user", "merchant", "both")]
        return parts[0] + parts[1] - parts[2]

    return asked.select(probe_id, sides("n").alias("history_rows"), from_micro(sides("a")).alias("history_amount"))


def ranked_explanations(df: DataFrame, row_id: str, contributions: str) -> DataFrame:
    """Contributions of each row by absolute size, with the bar length against max(largest, 0.01).

    Sorted inside the row: no shuffle.
    """
    entries = F.transform(
        F.map_entries(contributions),
        lambda e: F.struct((-F.abs(e["value"])).alias("o"), e["key"].alias("feature"), e["value"].alias("contribution")),
    )
    ordered = F.array_sort(entries)
    scale = F.greatest(F.coalesce(-F.element_at(F.col("s"), 1)["o"], F.lit(0.0)), F.lit(0.01))
    rows = df.select(row_id, ordered.alias("s")).where(F.size("s") > 0).select(
        row_id, scale.alias("scale"), F.posexplode("s").alias("pos", "e")
    )
    return rows.select(
        row_id, (F.col("pos") + 1).alias("rank"), "e.feature", "e.contribution",
        (F.abs("e.contribution") / F.col("scale")).alias("bar"),
    )


# --- drift history ------------------------------------------------------------------------------------------


def _drift_view(rows: DataFrame, verdict: Column, run_date: Column | None = None) -> DataFrame:
    return rows.select(
        (F.col("run_date") if run_date is None else run_date).alias("run_date"),
        "id", "feature_name", "drift_score", "p_value", "drift_detected", verdict.alias("any_drift"),
    )


def drift_latest_n(log: DataFrame, n: int = 5) -> DataFrame:
    """The newest n rows by id, dated by the newest, with the verdict over them."""
    rows = newest(log, n, "id")
    return _drift_view(
        rows, rows.agg(F.bool_or("drift_detected")).scalar(), rows.agg(F.max_by("run_date", "id")).scalar()
    )


def drift_latest_date(log: DataFrame) -> DataFrame:
    """All rows that share the run date of the newest row, with the verdict over them."""
    date = log.agg(F.max_by("run_date", "id")).scalar()
    rows = log.where(F.col("run_date") == date)
    return _drift_view(rows, rows.agg(F.bool_or("drift_detected")).scalar())


def drift_features(log: DataFrame, n: int = 5) -> DataFrame:
    """The first n distinct features of the history."""
    return log.groupBy("feature_name").agg(F.min("id").alias("first_id")).orderBy("first_id").limit(n)


def drift_pivot(log: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per date, one column per feature (its last score), with the first intensity of the date."""
    scores = [F.max_by("drift_score", F.when(F.col("feature_name") == f, F.col("id"))).alias(f) for f in features]
    return log.groupBy("run_date").agg(F.min_by("drift_intensity", "id").alias("intensity"), *scores)


# --- promotions and panels ------------------------------------------------------------------------------------


def numbered_in_time(df: DataFrame, ts: str, *order: str) -> DataFrame:
    """Add ``seq``, 1..n in time order: hours are numbered on their own and start from the hours before."""
    rows = df.withColumn("_hour", F.window(F.col(ts), "1 hour")["start"])
    sizes = rows.groupBy("_hour").agg(F.count(F.lit(1)).alias("_c"))  # one short row per hour
    before = Window.partitionBy(F.lit(0)).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_hour", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_hour").orderBy(ts, *order)
    return rows.join(offsets, "_hour").select(*df.columns, (F.col("_off") + F.row_number().over(inside)).alias("seq"))


def promotion_timeline(log: DataFrame, floor: float = 0.05) -> DataFrame:
    rows = numbered_in_time(log.where(F.col("new_f1") > floor), "triggered_at", "id")
    return rows.select(F.concat(F.lit("v"), F.col("seq").cast("string")).alias("run"), "id", "triggered_at", "new_f1")


def panel_points(payloads: DataFrame, column: str, target: str) -> DataFrame:
    """Data points of one panel target out of JSON documents [{target, datapoints: [[value, ms], ...]}, ...]."""
    schema = "array<struct<target:string,datapoints:array<array<double>>>>"
    series = payloads.select(F.explode(F.from_json(column, schema)).alias("s")).where(F.col("s.target") == target)
    points = series.select("s.target", F.explode("s.datapoints").alias("p"))
    return points.select("target", F.col("p")[0].alias("value"), F.col("p")[1].cast("bigint").alias("ts_ms"))


def windowed_rate(
    scored: DataFrame, ts: str, prediction: str, length: str, slide: str | None = None, stepwise: bool = True
) -> DataFrame:
    """Volume and fraud share per time window.

    Sliding windows are built from counts per slide step, so rows are not copied into every window they
    fall in. ``stepwise=False`` is the single-aggregate form that update-mode streams need.
    """
    hit = (F.col(prediction) == "FRAUD").cast("int")
    steps = F.window(F.col(ts), length, slide) if slide and not stepwise else F.window(F.col(ts), slide or length)
    rows = scored.groupBy(steps.alias("w")).agg(F.count(F.lit(1)).alias("total"), F.sum(hit).alias("frauds"))
    if slide and stepwise:
        rows = rows.groupBy(F.window(F.window_time("w"), length, slide).alias("w")).agg(
            F.sum("total").alias("total"), F.sum("frauds").alias("frauds")
        )
    return rows.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total", "frauds",
        (F.col("frauds") / F.col("total")).alias("fraud_rate"),
    )
