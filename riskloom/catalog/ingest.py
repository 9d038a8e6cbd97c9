"""Scans, validation, cleaning, joins, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import query
from riskloom.catalog.sql import CLEANED, DEDUPED, DIRTY, IDENTITY, IDENTITY_ONCE, TXN, keyed, sql
from riskloom.functions.scalars import temporal_parts
from riskloom.operators import cleaning, profile
from riskloom.plans.ingest import ingest
from riskloom.session import shared_path
from riskloom.sources import deltas, readers, views

TXN_COLUMNS = (
    "ingest_seq, TransactionID, TransactionDT, TransactionAmt, ProductCD, card1, card2, card3, card4, card5, card6, "
    "addr1, P_emaildomain, R_emaildomain, isFraud"
)


@query("scan_transactions", sql(TXN, body=f"SELECT {TXN_COLUMNS} FROM txn"))
def scan_transactions(spark, d):
    return views.txn(spark, d)


@query("scan_limit", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 20000")
def scan_limit(spark, d):
    """The row-limited scan, where a limit is asked for; the given table has more rows than that."""
    rows = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return readers.first_rows(rows, ["l_orderkey", "l_linenumber"], 20_000)


@query("latest_batch", """SELECT event_id, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_date FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def latest_batch(spark, d):
    rows = views.events(spark, d).select("event_id", "value", F.col("ts").cast("date").alias("batch_date"))
    return readers.latest_batch(rows).withColumn("batch_date", F.col("batch_date").cast("string"))


@query("read_json_log", """SELECT event_type, count(*) AS n, max(event_id) AS newest FROM events GROUP BY event_type""")
def read_json_log(spark, d):
    path = shared_path(spark, "json-log")
    views.events(spark, d).select("event_id", "event_type").write.json(path)
    log = readers.read_json_log(spark, path, "event_id BIGINT, event_type STRING")
    return log.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("newest"))


@query("feature_upsert", sql(TXN, DIRTY, body="""SELECT TransactionID, TransactionAmt, ingest_seq FROM dirty
WHERE TransactionID IS NOT NULL QUALIFY row_number() OVER (PARTITION BY TransactionID ORDER BY ingest_seq DESC) = 1"""))
def feature_upsert(spark, d):
    writes = views.txn_dirty(spark, d).where("TransactionID is not null").select("TransactionID", "TransactionAmt", "ingest_seq")
    path, slices = shared_path(spark, "upserts"), 3
    for n in range(slices):
        deltas.append_delta(writes.where(F.pmod(F.xxhash64("ingest_seq"), F.lit(slices)) == n), path, n, "TransactionID", "ingest_seq")
        if n == 1:
            deltas.compact(spark, path, "TransactionID", "ingest_seq")
    return deltas.read_latest(spark, path, "TransactionID", "ingest_seq").drop(deltas.BATCH)


# --- validation ------------------------------------------------------------------------------------------


@query("invalid_numeric_count", """SELECT 'TransactionAmt' AS column_name, count(*) FILTER (WHERE event_type = 'error') AS invalid_count FROM events
UNION ALL SELECT 'TransactionDT', CAST(0 AS BIGINT) UNION ALL
SELECT 'isFraud', count(*) FILTER (WHERE event_type = 'signup' AND value > 100) FROM events""")
def invalid_numeric_count(spark, d):
    text = views.events(spark, d).select(
        F.concat(F.col("value").cast("string"), F.when(F.col("event_type") == "error", " EUR").otherwise("")).alias("TransactionAmt"),
        views.clock().cast("string").alias("TransactionDT"),
        F.when((F.col("event_type") == "signup") & (F.col("value") > 100), "yes").when(F.col("value") > 50, "1")
        .when(F.col("value") > 1, "0").alias("isFraud"),
    )
    return cleaning.invalid_numeric_counts(text, ["TransactionAmt", "TransactionDT", "isFraud"])


@query("invalid_target_count", "SELECT count(*) FILTER (WHERE event_type IN ('error', 'view')) AS invalid_count FROM events")
def invalid_target_count(spark, d):
    kind = F.col("event_type")
    labelled = views.events(spark, d).select(
        F.when(kind == "error", 2).when(kind == "view", -1).when(kind == "click", 0).when(kind == "purchase", 1).alias("y")
    )
    return cleaning.invalid_target_count(labelled, "y")


# --- cleaning and joins -------------------------------------------------------------------------------------


@query("clean_transactions", sql(TXN, DIRTY, DEDUPED, CLEANED, body=f"SELECT {TXN_COLUMNS} FROM cleaned"))
def clean_transactions(spark, d):
    return cleaning.clean_transactions(views.txn_dirty(spark, d))


@query("dedupe_first", sql(TXN, DIRTY, DEDUPED, body=f"SELECT {TXN_COLUMNS} FROM deduped"))
def dedupe_first(spark, d):
    rows = cleaning.drop_null(views.txn_dirty(spark, d), "TransactionID")
    return cleaning.dedupe_first(rows, "TransactionID", "ingest_seq")


@query("median_fill", sql(TXN, DIRTY, body="""SELECT ingest_seq,
  coalesce(TransactionAmt, (SELECT median(TransactionAmt) FROM dirty)) AS TransactionAmt FROM dirty"""))
def median_fill(spark, d):
    return cleaning.median_fill(views.txn_dirty(spark, d).select("ingest_seq", "TransactionAmt"), "TransactionAmt")


def _range_sql() -> str:
    columns = [("TransactionID", True), ("TransactionDT", True), ("TransactionAmt", False), ("card1", True), ("card2", False), ("isFraud", True)]
    parts = []
    for name, whole in columns:
        kind = (
            f"CASE WHEN min({name}) > -128 AND max({name}) < 127 THEN 'tinyint' WHEN min({name}) > -32768 AND max({name}) < 32767 THEN 'smallint' "
            f"WHEN min({name}) > -2147483648 AND max({name}) < 2147483647 THEN 'int' ELSE 'bigint' END"
            if whole else "'float'"
        )
        parts.append(f"SELECT '{name}' AS column_name, CAST(min({name}) AS DOUBLE) AS min_value, CAST(max({name}) AS DOUBLE) AS max_value, {kind} AS narrow_type FROM txn")
    return sql(TXN, body=" UNION ALL ".join(parts))


@query("numeric_ranges", _range_sql())
def numeric_ranges(spark, d):
    return cleaning.numeric_ranges(
        views.txn(spark, d).select("TransactionID", "TransactionDT", "TransactionAmt", "card1", "card2", "isFraud")
    )


@query("join_identity", sql(TXN, IDENTITY, IDENTITY_ONCE, body="""SELECT TransactionID, TransactionAmt, ProductCD, DeviceType
FROM txn LEFT JOIN identity_once USING (TransactionID)"""))
def join_identity(spark, d):
    rows = views.txn(spark, d).select("TransactionID", "TransactionAmt", "ProductCD")
    return cleaning.join_identity(rows, views.identity(spark, d))


@query("ingestion_summary", sql(TXN, DIRTY, DEDUPED, IDENTITY, body="""SELECT 'train' AS split, (SELECT count(*) FROM dirty) AS transaction_rows_raw,
  (SELECT count(DISTINCT TransactionID) FROM identity) AS identity_rows_raw, count(*) AS rows_after_cleaning, count(*) AS rows_after_join,
  15 AS columns_after_join,
  (SELECT count(*) FROM dirty WHERE TransactionID IS NULL) AS missing_transaction_ids,
  (SELECT count(*) - count(DISTINCT TransactionID) - max(CASE WHEN TransactionID IS NULL THEN 1 ELSE 0 END) FROM dirty) AS duplicate_transaction_ids,
  (SELECT count(*) FROM dirty WHERE TransactionAmt IS NULL) AS transaction_amount_nulls,
  avg(isFraud) AS label_rate FROM deduped"""))
def ingestion_summary(spark, d):
    _, summary = ingest(views.txn_dirty(spark, d), views.identity(spark, d))
    return summary


# --- profiles --------------------------------------------------------------------------------------------------


@query("class_distribution", sql(TXN, body="""SELECT isFraud, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS percent
FROM txn GROUP BY isFraud"""))
def class_distribution(spark, d):
    return profile.class_distribution(views.txn(spark, d), "isFraud")


def _missing_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100.0 AS missing_percent FROM joined"
             for c in TXN_COLUMNS.split(", ") + ["DeviceType"]]
    return sql(TXN, IDENTITY, IDENTITY_ONCE, "joined AS (SELECT * FROM txn LEFT JOIN identity_once USING (TransactionID))",
               body=f"SELECT column_name, round(missing_percent, 6) AS missing_percent FROM ({' UNION ALL '.join(parts)}) ORDER BY missing_percent DESC, column_name LIMIT 15")


@query("missing_profile", _missing_sql())
def missing_profile(spark, d):
    joined = cleaning.join_identity(views.txn(spark, d), views.identity(spark, d))
    return profile.missing_profile(joined).withColumn("missing_percent", F.round("missing_percent", 6))


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("describe_by_class", sql(TXN, body="""SELECT isFraud, count(TransactionAmt) AS n, round(avg(TransactionAmt), 6) AS mean,
  round(stddev_samp(TransactionAmt), 6) AS std, min(TransactionAmt) AS min, max(TransactionAmt) AS max,
  round(quantile_cont(TransactionAmt, 0.25), 6) AS p25, round(quantile_cont(TransactionAmt, 0.5), 6) AS p50,
  round(quantile_cont(TransactionAmt, 0.75), 6) AS p75 FROM txn GROUP BY isFraud"""))
def describe_by_class(spark, d):
    out = profile.describe_by(views.txn(spark, d), "isFraud", "TransactionAmt")
    return rounded(out, "mean", "std", "p25", "p50", "p75")


@query("category_rates", sql(TXN, body="""SELECT card4, count(TransactionID) AS total_count, CAST(sum(isFraud) AS BIGINT) AS fraud_count,
  round(avg(isFraud) * 100.0, 6) AS fraud_rate FROM txn WHERE card4 IS NOT NULL GROUP BY card4"""))
def category_rates(spark, d):
    out = profile.category_rates(views.txn(spark, d), "card4", "isFraud", "TransactionID")
    return rounded(out, "fraud_rate").orderBy(F.desc("total_count"), "card4")


@query("hourly_rates", sql(TXN, keyed(), body="SELECT hour, round(avg(isFraud) * 100.0, 6) AS fraud_rate_pct FROM keyed GROUP BY hour"))
def hourly_rates(spark, d):
    rows = views.txn(spark, d).withColumns(temporal_parts(F.col("TransactionDT")))
    return rounded(profile.rates_by(rows, "hour", "isFraud"), "fraud_rate_pct")


@query("weekday_rates", sql(TXN, keyed(), body="SELECT day_of_week, round(avg(isFraud) * 100.0, 6) AS fraud_rate_pct FROM keyed GROUP BY day_of_week"))
def weekday_rates(spark, d):
    rows = views.txn(spark, d).withColumns(temporal_parts(F.col("TransactionDT")))
    return rounded(profile.rates_by(rows, "day_of_week", "isFraud"), "fraud_rate_pct")


@query("value_counts", sql(TXN, body="SELECT P_emaildomain, count(*) AS n FROM txn WHERE P_emaildomain IS NOT NULL GROUP BY P_emaildomain"))
def value_counts(spark, d):
    return profile.value_counts(views.txn(spark, d), "P_emaildomain")


@query("box_stats", sql(TXN, """q AS (SELECT isFraud, quantile_cont(TransactionAmt, 0.25) AS q1, quantile_cont(TransactionAmt, 0.5) AS median,
  quantile_cont(TransactionAmt, 0.75) AS q3 FROM txn GROUP BY isFraud)""", body="""SELECT isFraud, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  min(TransactionAmt) FILTER (WHERE TransactionAmt BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(TransactionAmt) FILTER (WHERE TransactionAmt BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (WHERE TransactionAmt NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM txn JOIN q USING (isFraud) GROUP BY isFraud, q1, median, q3"""))
def box_stats(spark, d):
    return rounded(profile.box_stats(views.txn(spark, d), "isFraud", "TransactionAmt"), "q1", "median", "q3")


@query("histogram", sql(TXN, "e AS (SELECT min(TransactionAmt) AS lo, max(TransactionAmt) AS hi FROM txn)", """b AS (
  SELECT CAST(least(floor((TransactionAmt - lo) / (hi - lo) * 30), 29) AS INT) AS bin FROM txn, e)""",
  body="""SELECT CAST(g.i AS INT) AS bin, count(b.bin) AS n FROM range(30) g(i) LEFT JOIN b ON b.bin = g.i GROUP BY g.i"""))
def histogram(spark, d):
    return profile.histogram(views.txn(spark, d), "TransactionAmt")


@query("log_density", sql(TXN, """b AS (SELECT isFraud, CAST(floor(log10(TransactionAmt) * 10) AS INT) AS log_bin FROM txn WHERE TransactionAmt > 0)""",
  body="""SELECT isFraud, log_bin, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY isFraud) * 10.0, 6) AS density
FROM b GROUP BY isFraud, log_bin"""))
def log_density(spark, d):
    return rounded(profile.log_density(views.txn(spark, d), "isFraud", "TransactionAmt"), "density")


@query("kernel_density", sql(TXN, """r AS (SELECT isFraud, log10(TransactionAmt) AS x FROM txn WHERE TransactionAmt > 0)""",
  """e AS (SELECT isFraud, n, h, lo - 3.0::DOUBLE * h AS start, (hi - lo + 6.0::DOUBLE * h) / 1024 AS step FROM (
  SELECT isFraud, count(*) AS n, stddev_samp(x) * pow(count(*), -0.2::DOUBLE) AS h, min(x) AS lo, max(x) AS hi FROM r GROUP BY isFraud))""",
  """p AS (SELECT isFraud, (x - start) / step AS pos FROM r JOIN e USING (isFraud))""",
  """w AS (SELECT isFraud, place, sum(w) AS w FROM (SELECT isFraud, floor(pos) AS place, 1 - (pos - floor(pos)) AS w FROM p
  UNION ALL SELECT isFraud, floor(pos) + 1, pos - floor(pos) FROM p) GROUP BY isFraud, place)""",
  body="""SELECT isFraud, k AS point, round(start + k * (1024 / 199.0::DOUBLE) * step, 6) AS log_value,
  round(sum(exp(-0.5::DOUBLE * pow((k * (1024 / 199.0::DOUBLE) - place) * step / h, 2)) * w) / (n * h * sqrt(2 * pi())), 6) AS density
  FROM w JOIN e USING (isFraud), (SELECT unnest(range(0, 200))::INT AS k) GROUP BY isFraud, k, start, step, n, h"""))
def kernel_density(spark, d):
    return rounded(profile.kernel_density(views.txn(spark, d), "isFraud", "TransactionAmt"), "log_value", "density")
