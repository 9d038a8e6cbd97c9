"""Temporal parts, keys, rolling windows, lookups, and the whole feature frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import query
from riskloom.catalog.sql import FEATURE_COLUMNS, TXN, engineered, keyed, sql
from riskloom.config import DAY, HOUR
from riskloom.functions.scalars import hour_bucket
from riskloom.operators import monitor, rolling
from riskloom.plans.features import add_keys, add_temporal, engineer_features
from riskloom.sources import views


@query("temporal_features", sql(TXN, keyed(), body="SELECT TransactionID, day_number, hour, day_of_week, is_weekend, month FROM keyed"))
def temporal_features(spark, d):
    rows = add_temporal(views.txn(spark, d))
    return rows.select("TransactionID", "day_number", "hour", "day_of_week", "is_weekend", "month")


@query("entity_keys", sql(TXN, keyed(), body="SELECT TransactionID, user_key, merchant_key FROM keyed"))
def entity_keys(spark, d):
    return add_keys(views.txn(spark, d)).select("TransactionID", "user_key", "merchant_key")


@query("hour_bucket", sql(TXN, keyed(), body="""SELECT TransactionID, CASE WHEN hour <= 6 THEN 'night' WHEN hour <= 12 THEN 'morning'
  WHEN hour <= 18 THEN 'afternoon' ELSE 'evening' END AS hour_bucket FROM keyed"""))
def hour_buckets(spark, d):
    return add_temporal(views.txn(spark, d)).select("TransactionID", hour_bucket(F.col("hour")).alias("hour_bucket"))


ORDERS = """o AS (SELECT o_orderkey AS order_id, o_custkey AS customer,
  (epoch_us(o_orderdate) - epoch_us(TIMESTAMP '1990-01-01')) // 1000000 AS dt, o_totalprice AS amount FROM orders)"""


@query("rolling_user_stats", sql(ORDERS, """w AS (
  SELECT a.order_id, count(b.amount) AS tx_count, CAST(sum(CAST(round(b.amount * 1e6) AS BIGINT)) AS DOUBLE) / 1e6 AS total_amount
  FROM o a JOIN o b ON a.customer = b.customer AND b.dt BETWEEN a.dt - 2592000 AND a.dt AND (b.dt < a.dt OR b.order_id <= a.order_id)
  GROUP BY a.order_id)""", body="SELECT order_id, customer, tx_count, total_amount, total_amount / tx_count AS avg_amount FROM w JOIN o USING (order_id)"))
def rolling_user_stats(spark, d):
    out = rolling.rolling_user_stats(views.order_history(spark, d), "customer", "amount", "dt", ["order_id"], 30 * DAY)
    return out.select("order_id", "customer", "tx_count", "total_amount", "avg_amount")


@query("rolling_peer_stats", """WITH l AS (
  SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity, (epoch_us(l_shipdate) - epoch_us(TIMESTAMP '1990-01-01')) // 1000000 AS dt, l_extendedprice FROM lineitem)
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity,
  count(l_extendedprice) OVER w AS tx_count,
  CAST(sum(CAST(round(l_extendedprice * 1e6) AS BIGINT)) OVER w AS DOUBLE) / 1e6 AS total_amount
FROM l WINDOW w AS (PARTITION BY l_suppkey ORDER BY dt RANGE BETWEEN 2592000 PRECEDING AND CURRENT ROW)""")
def rolling_peer_stats(spark, d):
    rows = views.table(spark, d, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        views.clock("l_shipdate", "1990-01-01").alias("dt"),
    )
    out = rolling.rolling_user_stats(rows, "l_suppkey", "l_extendedprice", "dt", [], 30 * DAY, ties="peers")
    return out.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "tx_count", "total_amount")


def _window_sql(key: str, seconds: int, value: str, name: str) -> str:
    return sql(TXN, keyed(), body=f"""SELECT a.TransactionID, {value} AS {name} FROM keyed a JOIN keyed b ON a.{key} = b.{key}
  AND b.TransactionDT BETWEEN a.TransactionDT - {seconds} AND a.TransactionDT
  AND (b.TransactionDT < a.TransactionDT OR b.TransactionID <= a.TransactionID) GROUP BY a.TransactionID""")


def _keyed(spark, d):
    return add_keys(views.txn(spark, d)).select("TransactionID", "TransactionDT", "user_key", "merchant_key")


@query("rolling_merchant_count", _window_sql("merchant_key", DAY, "count(*)", "merchant_tx_count"))
def rolling_merchant_count(spark, d):
    out = rolling.rolling_count(_keyed(spark, d), "merchant_key", "TransactionDT", ["TransactionID"], DAY, "merchant_tx_count")
    return out.select("TransactionID", "merchant_tx_count")


@query("velocity_1hr", _window_sql("user_key", HOUR, "count(*)", "velocity_1hr"))
def velocity_1hr(spark, d):
    out = rolling.rolling_count(_keyed(spark, d), "user_key", "TransactionDT", ["TransactionID"], HOUR, "velocity_1hr")
    return out.select("TransactionID", "velocity_1hr")


@query("rolling_unique_users", _window_sql("merchant_key", DAY, "count(DISTINCT b.user_key)", "merchant_unique_users"))
def rolling_unique_users(spark, d):
    out = rolling.rolling_unique(
        _keyed(spark, d), "merchant_key", "user_key", "TransactionDT", ["TransactionID"], DAY, "merchant_unique_users"
    )
    return out.select("TransactionID", "merchant_unique_users")


# A third of the cards does everything within one hour.
BURSTS = """bursts AS (SELECT * REPLACE (CASE WHEN card1 % 3 = 0 THEN TransactionDT % 3600 ELSE TransactionDT END AS TransactionDT) FROM txn)"""


@query("rolling_bursts", sql(TXN, BURSTS, keyed("bursts"), body=f"""SELECT a.TransactionID, count(*) AS merchant_tx_count,
  count(DISTINCT b.user_key) AS merchant_unique_users FROM keyed a JOIN keyed b ON a.merchant_key = b.merchant_key
  AND b.TransactionDT BETWEEN a.TransactionDT - {HOUR} AND a.TransactionDT
  AND (b.TransactionDT < a.TransactionDT OR b.TransactionID <= a.TransactionID) GROUP BY a.TransactionID"""))
def rolling_bursts(spark, d):
    """Both merchant windows where most keys are hot and busy in one hour: chunks of a 500th of all rows."""
    rows, dt = views.txn(spark, d), F.col("TransactionDT")
    rows = rows.withColumn("TransactionDT", F.when(F.col("card1") % 3 == 0, dt % 3600).otherwise(dt))
    rows = add_keys(rows).select("TransactionID", "TransactionDT", "user_key", "merchant_key")
    out = rolling.rolling_unique(
        rows, "merchant_key", "user_key", "TransactionDT", ["TransactionID"], HOUR, "merchant_unique_users",
        chunk_rows=max(1, rows.count() // 500), extra=[rolling.Measure("merchant_tx_count", HOUR, F.lit(1))],
    )
    return out.select("TransactionID", "merchant_tx_count", "merchant_unique_users")


@query("engineer_features", sql(TXN, engineered(), body=f"SELECT {FEATURE_COLUMNS} FROM feat"))
def engineered_features(spark, d):
    return engineer_features(views.txn(spark, d))


@query("pit_lookup", sql(TXN, keyed(), """j AS (
  SELECT p.TransactionID, count(h.TransactionAmt) + 1 AS c,
    CAST(coalesce(sum(CAST(round(h.TransactionAmt * 1e6) AS BIGINT)), 0) + max(CAST(round(p.TransactionAmt * 1e6) AS BIGINT)) AS DOUBLE) / 1e6 AS s,
    count(*) FILTER (WHERE h.TransactionDT >= p.TransactionDT - 3600) + 1 AS v
  FROM keyed p LEFT JOIN keyed h ON h.user_key = p.user_key AND h.TransactionDT >= p.TransactionDT - 2592000 AND h.TransactionDT < p.TransactionDT
  GROUP BY p.TransactionID)""", body="""SELECT TransactionID, c AS user_tx_count_30d, s AS user_total_amount_30d, s / c AS user_avg_amount_30d, v AS velocity_1hr FROM j"""))
def pit_lookup(spark, d):
    history = add_keys(views.txn(spark, d))
    out = rolling.history_lookup(history, history, "user_key", "TransactionDT", "TransactionID", "TransactionAmt", 30 * DAY, HOUR)
    return out.select("TransactionID", "user_tx_count_30d", "user_total_amount_30d", "user_avg_amount_30d", "velocity_1hr")


@query("history_or_lookup", sql(TXN, keyed(), body="""SELECT p.TransactionID, count(*) AS history_rows,
  CAST(sum(CAST(round(h.TransactionAmt * 1e6) AS BIGINT)) AS DOUBLE) / 1e6 AS history_amount
FROM keyed p JOIN keyed h ON h.user_key = p.user_key OR h.merchant_key = p.merchant_key
GROUP BY p.TransactionID"""))
def history_or_lookup(spark, d):
    history = add_keys(views.txn(spark, d))
    return monitor.history_or_lookup(history, history, "TransactionID", "TransactionAmt")
