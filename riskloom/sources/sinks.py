"""Sinks: partitioned tables, append logs, upserts and one-row JSON reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.operators.cleaning import latest_per_key
from riskloom.session import shared_path
from riskloom.sources.readers import path_exists


def write_splits(df: DataFrame, path: str) -> None:
    """Features and target of all splits as one table, partitioned by split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_batch(df: DataFrame, path: str, batch_date: str) -> None:
    """One dated inference batch; writing a date again replaces that date only."""
    dated = df.withColumn("batch_date", F.lit(batch_date).cast("date"))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_date").parquet(path)


def next_ids(spark: SparkSession, path: str) -> int:
    """One more than the largest id of the log (parquet statistics serve it)."""
    if not path_exists(spark, path):
        return 1
    return (spark.read.parquet(path).agg(F.max("id")).first()[0] or 0) + 1


def append_log(df: DataFrame, path: str, order: str | None = None) -> None:
    """Append rows to a log table with rising ids. The rows of one append are few (one run's results)."""
    start = next_ids(df.sparkSession, path)
    rows = df.coalesce(1)
    rows = rows.sortWithinPartitions(order) if order else rows
    rows.select((F.monotonically_increasing_id() + F.lit(start)).alias("id"), *[c for c in df.columns if c != "id"]).write.mode(
        "append"
    ).parquet(path)


def upsert(updates: DataFrame, path: str, key: str, *order: str, buckets: int = 64) -> None:
    """Merge rows into a table by key: only the hash buckets the updates touch are rewritten.

    The new state is written aside first, so a lost executor can never see a half-replaced table.
    """
    spark = updates.sparkSession
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    new = updates.withColumn("key_bucket", bucket)
    if path_exists(spark, path):
        touched = [r[0] for r in new.select("key_bucket").distinct().collect()]  # at most `buckets` numbers
        old = spark.read.parquet(path).where(F.col("key_bucket").isin(touched))
        new = old.unionByName(new, allowMissingColumns=True)
    merged = latest_per_key(new, key, *order)
    aside = shared_path(spark, "upsert")
    merged.write.parquet(aside)
    spark.read.parquet(aside).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "key_bucket"
    ).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A one-row report as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)
