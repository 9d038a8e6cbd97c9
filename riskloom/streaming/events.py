"""Request payloads as a stream: parsing, validation and de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.scalars import filled

# fixed values: the request payload; the first four are required
PAYLOAD = """transaction_id STRING, transaction_amt DOUBLE, product_cd STRING, transaction_dt BIGINT,
  card1 DOUBLE, card2 DOUBLE, card3 DOUBLE, card4 STRING, card5 DOUBLE, card6 STRING, addr1 DOUBLE,
  P_emaildomain STRING, R_emaildomain STRING, DeviceType STRING"""
REQUIRED = ("transaction_id", "transaction_amt", "product_cd", "transaction_dt")


def parse_payload(df: DataFrame, column: str = "payload") -> DataFrame:
    """Payload fields plus ``rejected``: the first required field that is missing or malformed, or null."""
    rows = df.withColumn("_p", F.from_json(column, PAYLOAD)).select(*[c for c in df.columns if c != column], "_p.*")
    missing: Column = F.lit(None).cast("string")
    for field in reversed(REQUIRED):
        missing = F.when(F.col(field).isNull(), field).otherwise(missing)
    return rows.withColumn("rejected", missing)


def split_payload(df: DataFrame, column: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows."""
    rows = parse_payload(df, column)
    return rows.where(F.col("rejected").isNull()).drop("rejected"), rows.where(F.col("rejected").isNotNull())


def to_transactions(payload: DataFrame) -> DataFrame:
    """Accepted payloads under the column names and types of the training table; one key function serves both."""
    return payload.select(
        F.col("transaction_id").alias("TransactionID"),
        F.col("transaction_dt").alias("TransactionDT"),
        F.col("transaction_amt").alias("TransactionAmt"),
        F.col("product_cd").alias("ProductCD"),
        F.col("card1").cast("bigint").alias("card1"),
        "card2", "card3", "card4", "card5", "card6", "addr1", "P_emaildomain", "R_emaildomain", "DeviceType",
    )


def with_serving_defaults(df: DataFrame) -> DataFrame:
    """Missing or empty categories become ``unknown`` after the keys are built."""
    columns = [c for c in ("card4", "card6", "P_emaildomain", "R_emaildomain", "DeviceType") if c in df.columns]
    return df.withColumns({c: filled(F.col(c), "unknown") for c in columns})


def dedupe_stream(stream: DataFrame, key: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """One row per key. State is kept for the watermark delay; rows older than that are dropped and counted
    in the query progress."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
