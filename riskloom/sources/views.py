"""The engine's tables as views over the given parquet tables (see FIXTURES.md).

``events`` is the transaction source: one row per event. Every view is a lazy projection, so column
pruning and filters reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.functions.scalars import decision, hash32, uniform

EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def clock(ts: str = "ts", origin: str = "2024-01-01") -> Column:
    """Whole seconds since midnight of ``origin``; plain timestamps read the same in every session zone."""
    days = F.datediff(F.col(ts).cast("date"), F.lit(origin).cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def pick(index: Column, *values: str | None) -> Column:
    """The value at a small computed index."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (index + 1).cast("int"))


def txn_of(source: DataFrame) -> DataFrame:
    """The transaction projection of event rows; works on batch and streaming frames alike."""
    k = F.expr("cast(substr(props, 7, length(props) - 7) as int)")
    event, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    kind = F.col("event_type")
    fraud = ((value > 150) & (event % 3 != 0)) | (event % 101 == 0)
    return source.select(
        event.alias("ingest_seq"),
        event.alias("TransactionID"),
        clock().alias("TransactionDT"),
        value.alias("TransactionAmt"),
        F.when(kind == "view", "W").when(kind == "click", "C").when(kind == "purchase", "R")
        .when(kind == "signup", "H").otherwise("S").alias("ProductCD"),
        (user + 1000).alias("card1"),
        (user % 5 + 100).cast("double").alias("card2"),
        F.lit(150.0).alias("card3"),
        F.when(event % 41 != 0, pick(user % 4, "visa", "mastercard", "discover", "american express")).alias("card4"),
        F.lit(226.0).alias("card5"),
        F.when(event % 4 == 0, "debit").otherwise("credit").alias("card6"),
        F.when(user % 9 != 0, F.lit(321.0)).alias("addr1"),
        pick(k % 4, "gmail.com", "yahoo.com", "outlook.com", None).alias("P_emaildomain"),
        F.when(event % 5 == 0, "gmail.com").alias("R_emaildomain"),
        F.when(fraud, 1).otherwise(0).alias("isFraud"),
    )


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_of(events(spark, sf_dir))


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device rows of clicks and purchases; purchases come twice, the second copy names a tablet."""
    source = events(spark, sf_dir)
    device = F.when(F.col("value") >= 60, "desktop").when(F.col("value") >= 5, "mobile")
    first = source.where(F.col("event_type").isin("click", "purchase")).select(
        F.col("event_id").alias("identity_seq"), F.col("event_id").alias("TransactionID"), device.alias("DeviceType")
    )
    again = source.where(F.col("event_type") == "purchase").select(
        (F.col("event_id") + 1_000_000_000_000).alias("identity_seq"),
        F.col("event_id").alias("TransactionID"),
        F.lit("tablet").alias("DeviceType"),
    )
    return first.unionByName(again)


def txn_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with null ids, null amounts and later copies of every purchase."""
    base = txn(spark, sf_dir)
    kind, amount = F.col("ProductCD"), F.col("TransactionAmt")
    broken = base.withColumn(
        "TransactionID", F.when(~((kind == "S") & (amount < 5)), F.col("TransactionID"))
    ).withColumn("TransactionAmt", F.when(~((kind == "H") & (amount > 90)), amount))
    copies = base.where(kind == "R").withColumn("TransactionAmt", amount + 1000).withColumn(
        "ingest_seq", F.col("ingest_seq") + 1_000_000_000_000
    )
    return broken.unionByName(copies)


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a long history (years), where 30-day windows do evict."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer"),
        clock("o_orderdate", "1990-01-01").alias("dt"),
        F.col("o_totalprice").alias("amount"),
    )


def score_of(amount: Column, row_id: Column) -> Column:
    """A repeatable score that carries signal; four decimals, so scores tie."""
    raw = F.least(amount / 300.0, F.lit(1.0)) * 0.6 + uniform(42, "score", row_id) * 0.4
    return F.floor(raw * 10000.0) / 10000.0


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn(spark, sf_dir).withColumn("score", score_of(F.col("TransactionAmt"), F.col("TransactionID")))


# --- log tables as projections of the events -------------------------------------------------------------


def prediction_log_of(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("event_id").alias("id"),
        F.col("event_id").cast("string").alias("transaction_id"),
        score_of(F.col("value"), F.col("event_id")).alias("fraud_probability"),
        F.concat(F.lit("v"), (F.col("user_id") % 3 + 1).cast("string")).alias("model_version"),
        F.col("ts").alias("timestamp"),
    ).withColumn("prediction", decision(F.col("fraud_probability")))


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prediction_log_of(events(spark, sf_dir))


def feature_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per transaction but for sign-ups, whose features never arrived."""
    base = txn(spark, sf_dir).where(F.col("ProductCD") != "H")
    return base.select(
        F.col("TransactionID").cast("string").alias("transaction_id"),
        F.when(F.col("ProductCD") != "S", F.col("TransactionAmt")).alias("amount"),
        F.coalesce("card4", F.lit("unknown")).alias("card_network"),
        F.when(F.col("card1") % 7 != 0, F.col("card6")).alias("card_type"),
    )


DRIFT_FEATURES = ("amount", "velocity_1hr", "user_avg_amount_30d", "card6", "hour_bucket")


def drift_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    return events(spark, sf_dir).select(
        event.alias("id"),
        F.col("ts").cast("date").alias("run_date"),
        F.when(F.col("event_type") == "view", "amount").when(F.col("event_type") == "click", "velocity_1hr")
        .when(F.col("event_type") == "purchase", "user_avg_amount_30d")
        .when(F.col("event_type") == "signup", "card6").otherwise("hour_bucket").alias("feature_name"),
        (F.col("value") / 1000.0).alias("drift_score"),
        uniform(42, "drift", event).alias("p_value"),
        (uniform(42, "drift", event) < 0.05).alias("drift_detected"),
        (F.lit(0.1) + (event % 10) / 100.0).alias("drift_intensity"),
        F.col("ts").alias("timestamp"),
    )


def retrain_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    new_f1 = hash32(42, "new", event) % 1000 / 1000.0
    old_f1 = hash32(42, "old", event) % 1000 / 1000.0
    return events(spark, sf_dir).where(F.col("event_type") == "purchase").select(
        event.alias("id"),
        F.col("ts").alias("triggered_at"),
        F.lit("drift_detection").alias("trigger_reason"),
        old_f1.alias("old_f1"),
        new_f1.alias("new_f1"),
        (new_f1 - old_f1 >= 0.01).alias("promoted"),
        F.concat(F.lit("run "), event.cast("string")).alias("notes"),
        F.col("ts").alias("timestamp"),
    )


def model_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")

    def rate(salt: str) -> Column:
        return hash32(42, salt, event) % 1000 / 1000.0

    return events(spark, sf_dir).where(F.col("event_type") == "signup").select(
        event.alias("id"),
        F.when(F.col("user_id") % 2 == 0, "risk-boosted-trees").otherwise("risk-linear").alias("model_name"),
        event.cast("string").alias("model_version"),
        F.concat(F.lit("run-"), event.cast("string")).alias("run_id"),
        rate("f1").alias("f1_score"),
        rate("auc").alias("auc_score"),
        rate("precision").alias("precision_score"),
        rate("recall").alias("recall_score"),
        F.lit(0.5).alias("threshold"),
        (F.col("value") > 100).alias("is_production"),
        F.col("ts").alias("created_at"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    path = (
        F.when(kind == "view", "/transactions/recent").when(kind == "click", "/predict")
        .when(kind == "purchase", "/grafana-metrics").when(kind == "signup", "/health").otherwise("/drift")
    )
    return events(spark, sf_dir).select(
        F.col("event_id").alias("id"), F.col("ts"), path.alias("path"), F.col("value").alias("latency_ms")
    )
