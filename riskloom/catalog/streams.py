"""Streams over the events, each checked against its batch meaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import query
from riskloom.catalog.drift import drift_ctes
from riskloom.catalog.models import SMALL_MODEL, follows_score, light_features
from riskloom.catalog.monitoring import _windows_sql, windows_out
from riskloom.catalog.sql import TXN, keyed, sql
from riskloom.operators import model, monitor
from riskloom.operators.cleaning import latest_per_key
from riskloom.plans.train import prepare
from riskloom.session import shared_path
from riskloom.sources import readers, views
from riskloom.streaming import events as payloads
from riskloom.streaming import jobs
from riskloom.streaming import keyed as state


def _event_stream(spark, d):
    return readers.read_event_stream(spark, d, views.EVENT_SCHEMA, name_filter="events.parquet")


def _payloads(source):
    """Request payloads of the events: some errors lack the product, some sign-ups carry a broken amount."""
    kind, value = F.col("event_type"), F.col("value")
    fields = F.struct(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.when((kind == "signup") & (value > 100), F.lit("n/a")).otherwise(value.cast("string")).alias("transaction_amt"),
        F.when(~((kind == "error") & (value < 10)), kind).alias("product_cd"),
        views.clock().alias("transaction_dt"),
        (F.col("user_id") + 1000).cast("double").alias("card1"),
    )
    # Amounts travel as numbers: the quotes around plain digits go.
    return source.select(F.regexp_replace(F.to_json(fields), r'"transaction_amt":"([0-9.E-]+)"', r'"transaction_amt":$1').alias("payload"))


PAYLOAD_SQL = """SELECT CAST(event_id AS VARCHAR) AS transaction_id, CASE WHEN event_type = 'signup' AND value > 100 THEN 'transaction_amt'
  WHEN event_type = 'error' AND value < 10 THEN 'product_cd' ELSE 'none' END AS rejected FROM events"""


def _parsed(df):
    return payloads.parse_payload(_payloads(df)).select("transaction_id", F.coalesce("rejected", F.lit("none")).alias("rejected"))


@query("payload_split", PAYLOAD_SQL)
def payload_split(spark, d):
    return _parsed(views.events(spark, d))


@query("stream_parse", PAYLOAD_SQL)
def stream_parse(spark, d):
    out = shared_path(spark, "parsed")
    jobs.run_to_parquet(_parsed(_event_stream(spark, d)), out, shared_path(spark, "checkpoint"))
    return spark.read.parquet(out)


@query("stream_dedupe", "SELECT event_id, value FROM events")
def stream_dedupe(spark, d):
    copies = F.when(F.col("event_type") == "purchase", 3).otherwise(1)
    repeated = _event_stream(spark, d).select(
        "event_id", "value", F.col("ts").cast("timestamp").alias("ts"), F.explode(F.sequence(F.lit(1), copies)).alias("copy")
    )
    out = shared_path(spark, "deduped")
    once = payloads.dedupe_stream(repeated, "event_id", "ts").select("event_id", "value")
    jobs.run_to_parquet(once, out, shared_path(spark, "checkpoint"))
    return spark.read.parquet(out)


def _features(spark, d, slices: int = 3):
    """The events in time order, one file for each slice and one micro-batch for each file; the features the stream wrote."""
    rows = views.txn(spark, d).drop("ingest_seq")
    span = rows.agg(F.min("TransactionDT").alias("lo"), F.max("TransactionDT").alias("hi")).first()
    width, source = (span["hi"] - span["lo"]) // slices + 1, shared_path(spark, "source")
    for i in range(slices):
        part = rows.where(F.floor((F.col("TransactionDT") - span["lo"]) / width) == i)
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    out, splits = shared_path(spark, "features"), state.busy_keys(rows, share=0.05, parts=4)
    state.stream_features(stream, jobs.batch_sink(out), shared_path(spark, "checkpoint"), splits=splits)
    return spark.read.parquet(out)


def _strict_sql(key: str, columns: str, own: str) -> str:
    return sql(TXN, keyed(), f"""j AS (SELECT a.TransactionID, {columns} FROM keyed a LEFT JOIN keyed b ON a.{key} = b.{key}
  AND b.TransactionDT >= a.TransactionDT - 2592000 AND b.TransactionDT < a.TransactionDT GROUP BY a.TransactionID, a.TransactionAmt)""", body=own)


@query("stream_user_state", _strict_sql(
    "user_key",
    """count(b.TransactionAmt) + 1 AS c, CAST(coalesce(sum(CAST(round(b.TransactionAmt * 1e6) AS BIGINT)), 0) + CAST(round(a.TransactionAmt * 1e6) AS BIGINT) AS DOUBLE) / 1e6 AS s,
  count(*) FILTER (WHERE b.TransactionDT >= a.TransactionDT - 3600) + 1 AS v""",
    "SELECT TransactionID, c AS user_tx_count_30d, s AS user_total_amount_30d, s / c AS user_avg_amount_30d, v AS velocity_1hr FROM j"))
def stream_user_state(spark, d):
    return _features(spark, d).select(
        "TransactionID", "user_tx_count_30d", "user_total_amount_30d", "user_avg_amount_30d", "velocity_1hr"
    )


@query("stream_merchant_state", _strict_sql(
    "merchant_key",
    """count(b.TransactionID) + 1 AS c, count(DISTINCT b.user_key) + CASE WHEN bool_or(b.user_key = a.user_key) THEN 0 ELSE 1 END AS u""",
    "SELECT TransactionID, c AS merchant_tx_count_30d, u AS merchant_unique_users_30d FROM j"))
def stream_merchant_state(spark, d):
    return _features(spark, d).select("TransactionID", "merchant_tx_count_30d", "merchant_unique_users_30d")


@query("stream_score", sql(TXN, body="SELECT TransactionID, true AS score_in_range, true AS bands_follow FROM txn"))
def stream_score(spark, d):
    rows = views.txn(spark, d).drop("ingest_seq")
    processed, params = prepare(light_features(spark, d), SMALL_MODEL)
    fitted = model.train(processed.where("split = 'train'"), params.features, SMALL_MODEL)
    history, out = shared_path(spark, "history"), shared_path(spark, "scores")
    stream = views.txn_of(_event_stream(spark, d)).drop("ingest_seq")
    jobs.stream_scores(
        stream, history, out, shared_path(spark, "checkpoint"),
        lambda features: model.score_features(fitted, features, params, ["TransactionID"]), SMALL_MODEL,
    )
    rows = spark.read.schema("TransactionID BIGINT, score DOUBLE, prediction STRING, confidence STRING").parquet(out)
    return rows.select("TransactionID", F.col("score").between(0, 1).alias("score_in_range"), follows_score().alias("bands_follow"))


@query("stream_tumbling_rate", _windows_sql(1))
def stream_tumbling_rate(spark, d):
    """Update-mode stream; the last update of each window stands."""
    log = views.prediction_log_of(_event_stream(spark, d))
    log = log.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", "1 hour")
    rates = monitor.windowed_rate(log, "timestamp", "prediction", "1 hour", None)
    out = shared_path(spark, "rates")
    jobs.run_each_batch(rates, jobs.batch_sink(out), shared_path(spark, "checkpoint"), "update")
    return windows_out(latest_per_key(spark.read.parquet(out), "window_start", "batch_id"))


@query("stream_sliding_rate", _windows_sql(24))
def stream_sliding_rate(spark, d):
    """Hourly counts chained into windows of 24 hours, each written once, when the watermark has passed it.

    A row three days behind the last event closes the last windows, as later traffic would; its own windows stay open.
    """
    source = shared_path(spark, "source")
    events = views.events(spark, d)
    events.coalesce(1).write.mode("append").parquet(source)
    events.agg(F.max("ts").alias("ts")).select(
        F.lit(-1).cast("bigint").alias("event_id"), (F.col("ts") + F.expr("INTERVAL 3 DAYS")).alias("ts"), F.lit(0).cast("bigint").alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(0.0).alias("value"), F.lit(None).cast("string").alias("props")).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(views.EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    log = views.prediction_log_of(stream).withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", "1 hour")
    rates = monitor.windowed_rate(log, "timestamp", "prediction", "24 hours", "1 hour")
    out = shared_path(spark, "rates")
    jobs.run_to_parquet(rates, out, shared_path(spark, "checkpoint"))
    return windows_out(spark.read.parquet(out))


@query("stream_late_rows", """SELECT count(*) + count(*) FILTER (event_id % 7 = 0 AND epoch_us(ts) > edge) AS taken,
  count(*) FILTER (event_id % 7 = 0 AND epoch_us(ts) <= edge) AS dropped
  FROM events, (SELECT (epoch_us(max(ts)) // 1000 - 3600000) * 1000 AS edge FROM events)""")
def stream_late_rows(spark, d):
    """Every seventh event arrives once more under a new id, after all others: rows taken, and rows dropped behind the watermark.

    A micro-batch drops by the watermark of the one before it, so the newest event comes in between once more; it is a repeat.
    """
    events, source = views.events(spark, d).select("event_id", "ts"), shared_path(spark, "source")
    events.coalesce(1).write.mode("append").parquet(source)
    events.orderBy(F.desc("ts")).limit(1).write.mode("append").parquet(source)
    again = events.where(F.col("event_id") % 7 == 0).select((F.col("event_id") + 1_000_000_000_000).alias("event_id"), "ts")
    again.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = shared_path(spark, "taken")
    once = payloads.dedupe_stream(stream.withColumn("ts", F.col("ts").cast("timestamp")), "event_id", "ts")
    dropped = jobs.LateRows().after(spark, lambda: jobs.run_to_parquet(once, out, shared_path(spark, "checkpoint")))
    return spark.read.parquet(out).agg(F.count("*").alias("taken"), F.lit(dropped).cast("bigint").alias("dropped"))


@query("stream_drift", sql(
    TXN, "both_sides AS (SELECT TransactionAmt AS amount, card6, false AS cur FROM txn UNION ALL SELECT TransactionAmt * 1.3::DOUBLE, card6, true FROM txn)",
    *drift_ctes(["amount"], ["card6"]), """lam AS (SELECT *, d * sqrt(n_ref * n_cur / (n_ref + n_cur)) AS l FROM ks)""",
    # Kolmogorov tail by the form that converges fast; the categories of both sides are the same, so their test gives 0 and 1
    """p AS (SELECT feature_name, CASE WHEN l < 0.04 THEN 1.0 WHEN l < 1.18 THEN 1 - sqrt(2 * pi()) / l * (exp(-pi() ** 2 / (8 * l * l))
  + exp(-9 * pi() ** 2 / (8 * l * l)) + exp(-25 * pi() ** 2 / (8 * l * l))) ELSE 2 * (exp(-2 * l * l) - exp(-8 * l * l) + exp(-18 * l * l)) END AS p FROM lam
  UNION ALL SELECT feature_name, CASE WHEN stat = 0 THEN 1.0 END FROM chi)""",
    body="""SELECT feature_name, test, round(drift_score, 6) AS drift_score, round(p, 6) AS p_value, drift_detected, 0::BIGINT AS batch_id
  FROM verdicts JOIN p USING (feature_name)"""))
def stream_drift(spark, d):
    reference = views.txn(spark, d).withColumnRenamed("TransactionAmt", "amount").select("amount", "card6")
    stream = views.txn_of(_event_stream(spark, d)).select((F.col("TransactionAmt") * 1.3).alias("amount"), "card6")
    out = shared_path(spark, "stream-drift")
    jobs.stream_drift(stream, reference, out, shared_path(spark, "checkpoint"))
    rows = spark.read.parquet(out)
    return rows.withColumns({c: F.round(c, 6) for c in ("drift_score", "p_value")}).withColumn("batch_id", F.col("batch_id").cast("bigint"))
