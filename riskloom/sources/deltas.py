"""Tables that grow by micro-batches: upserts as appended deltas, and the ids that were ever taken."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.operators.cleaning import latest_per_key
from riskloom.session import discard
from riskloom.sources.readers import path_exists

BATCH = "batch_id"
#: Hash partitions of the known ids.
ID_PARTS = 64


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the complete tables ``prefix=<number>`` in a folder."""
    if not path_exists(spark, folder):
        return []
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)
    names = [f.getPath().getName() for f in found]
    numbers = [int(n.removeprefix(prefix + "=")) for n in names if n.startswith(prefix + "=")]
    return sorted(n for n in numbers if path_exists(spark, f"{folder}/{prefix}={n}/_SUCCESS"))


def append_delta(batch: DataFrame, path: str, batch_id: int, key: str, *order: str) -> None:
    """Upsert a micro-batch: its newest row of each key, in a table of its own. A retry replaces that table; nothing else is touched."""
    latest_per_key(batch, key, *order).write.mode("overwrite").parquet(f"{path}/deltas/{BATCH}={batch_id}")


def _state(spark: SparkSession, path: str) -> tuple[int | None, list[int]]:
    """The newest base, and the deltas behind it."""
    bases = _numbers(spark, f"{path}/base", "upto")
    base = bases[-1] if bases else None
    return base, [n for n in _numbers(spark, f"{path}/deltas", BATCH) if base is None or n > base]


def read_latest(spark: SparkSession, path: str, key: str, *order: str) -> DataFrame:
    """The newest row of each key by ``order``, then by batch. Columns a batch does not have are null."""
    base, deltas = _state(spark, path)
    if base is None and not deltas:
        raise FileNotFoundError(f"No upserts under {path}")
    rows = None if base is None else spark.read.parquet(f"{path}/base/upto={base}")
    if deltas:
        places = [f"{path}/deltas/{BATCH}={n}" for n in deltas]
        newer = spark.read.option("basePath", f"{path}/deltas").option("mergeSchema", "true").parquet(*places).withColumn(BATCH, F.col(BATCH).cast("bigint"))
        rows = newer if rows is None else rows.unionByName(newer, allowMissingColumns=True)
    return latest_per_key(rows, key, *order, BATCH)


def compact(spark: SparkSession, path: str, key: str, *order: str) -> None:
    """Merge base and deltas into a new base; what it replaces is deleted when it is complete. A job of its own, run now and then."""
    base, deltas = _state(spark, path)
    if not deltas:
        return
    read_latest(spark, path, key, *order).write.mode("overwrite").parquet(f"{path}/base/upto={deltas[-1]}")
    for n in deltas:
        discard(spark, f"{path}/deltas/{BATCH}={n}")
    if base is not None:
        discard(spark, f"{path}/base/upto={base}")


def _part(key: str, parts: int):
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def known_ids(batch: DataFrame, path: str, key: str, batch_id: int, parts: int = ID_PARTS) -> DataFrame | None:
    """Ids that earlier batches took, from the hash partitions that this batch's ids fall into; None before the first batch."""
    spark = batch.sparkSession
    if not path_exists(spark, path):
        return None
    touched = [r[0] for r in batch.select(_part(key, parts).alias("p")).distinct().collect()]  # at most `parts` numbers
    return spark.read.parquet(path).where(F.col("id_part").isin(touched) & (F.col(BATCH) < batch_id)).select(key)


def take_new(batch: DataFrame, path: str, key: str, batch_id: int, parts: int = ID_PARTS) -> DataFrame:
    """Rows of a micro-batch whose id no earlier batch took; their ids are noted. A retried batch notes the same ids again.

    The batch must hold an id once. Spark meets the stored ids with the batch's by a semi-join (which it may precede with a Bloom
    filter of the batch), so what is then anti-joined is no larger than the batch.
    """
    known = known_ids(batch, path, key, batch_id, parts)
    fresh = batch
    if known is not None:
        seen = known.join(batch.select(key), key, "left_semi").distinct()
        fresh = batch.join(seen, key, "left_anti")
    marked = fresh.select(key, _part(key, parts).alias("id_part"), F.lit(batch_id).cast("bigint").alias(BATCH))
    marked.repartition("id_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("id_part", BATCH).parquet(path)
    return fresh
