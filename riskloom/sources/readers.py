"""Scans: CSV and parquet transactions, dated batches, splits, JSON logs, JDBC tables, streams."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.config import DEFAULT, Config
from riskloom.operators.cleaning import DataValidationError

# fixed values: types of the columns the engine uses; all other columns of a CSV pass as text
TRANSACTION_TYPES = {
    "TransactionID": "bigint", "isFraud": "int", "TransactionDT": "bigint", "TransactionAmt": "double",
    "ProductCD": "string", "card1": "bigint", "card2": "double", "card3": "double", "card4": "string",
    "card5": "double", "card6": "string", "addr1": "double", "P_emaildomain": "string", "R_emaildomain": "string",
    "DeviceType": "string",
}


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def split_paths(spark: SparkSession, raw_dir: str, split: str, cfg: Config = DEFAULT) -> tuple[str, str]:
    files = {
        "train": (cfg.train_transaction_file, cfg.train_identity_file),
        "test": (cfg.test_transaction_file, cfg.test_identity_file),
    }
    if split not in files:
        raise DataValidationError(f"No files are named for split {split!r}; there are {sorted(files)}")
    transactions, identity = (f"{raw_dir}/{name}" for name in files[split])
    if not path_exists(spark, transactions):
        raise FileNotFoundError(f"The split {split!r} has no transactions at {transactions}")
    return transactions, identity


def read_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """CSV with a header. Only the header is read here; known columns get their type, a value that does not
    fit stays visible as text to the validation step, so a malformed column is reported, not nulled."""
    types = TRANSACTION_TYPES if types is None else types
    text = spark.read.option("header", True).csv(path)
    typed = {}
    for column in text.columns:
        kind = types.get(column, "string")
        if kind != "string":
            typed[column] = kind
    if not typed:
        return text
    unfit = text.agg(
        *[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull() & ~F.lower(c).isin("true", "false")).alias(c)
          for c in typed]
    ).first()
    casts = {}
    for column, kind in typed.items():
        if unfit[column]:
            continue
        flag = F.when(F.lower(column) == "true", 1.0).when(F.lower(column) == "false", 0.0)
        number = F.coalesce(flag, F.col(column).try_cast("double")) if kind == "int" else F.col(column).try_cast("double")
        exact = F.coalesce(F.col(column).try_cast(kind), number.cast(kind)) if kind != "double" else number
        casts[column] = exact
    return text.withColumns(casts) if casts else text


def row_limit(cfg: Config, split: str) -> int | None:
    """Row cap of the training scan; MAX_TRAINING_ROWS overrides it, a malformed value is ignored."""
    if split != "train":
        return None
    limit = cfg.max_training_rows
    override = os.environ.get("MAX_TRAINING_ROWS")
    if override is not None:
        try:
            limit = int(override)
        except ValueError:
            pass
    return limit


def first_rows(df: DataFrame, order: str | list[str], n: int | None) -> DataFrame:
    """The first n rows in ingest order."""
    return df if n is None else df.orderBy(order).limit(n)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet unless the name says CSV."""
    return read_csv(spark, path) if path.endswith(".csv") else spark.read.parquet(path)


def with_ingest_order(df: DataFrame, order: str) -> DataFrame:
    """Row order as a column where the frame brings none."""
    return df if order in df.columns else df.withColumn(order, F.monotonically_increasing_id())


def in_file_order(df: DataFrame, order: str) -> DataFrame:
    """Order of a scan as a column where the table brings none: file name, position of the block, then of the row.
    Spark deals large files to its tasks first, so task numbers alone would not follow the files."""
    if order in df.columns:
        return df
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    return df.withColumn(order, place)


def read_split(
    spark: SparkSession, raw_dir: str, split: str, cfg: Config = DEFAULT
) -> tuple[DataFrame, DataFrame | None]:
    """Transactions and, where the file exists, identity of one split."""
    transactions, identity = split_paths(spark, raw_dir, split, cfg)
    rows = in_file_order(read_table(spark, transactions), cfg.order_column)
    rows = first_rows(rows, cfg.order_column, row_limit(cfg, split))
    side = in_file_order(read_table(spark, identity), "identity_seq") if path_exists(spark, identity) else None
    return rows, side


def read_batches(spark: SparkSession, batch_dir: str) -> DataFrame:
    """All dated inference batches, as one table partitioned by batch_date."""
    return spark.read.parquet(batch_dir)


def latest_batch(batches: DataFrame, date: str = "batch_date") -> DataFrame:
    """Rows of the newest batch; on a partitioned table only that partition is read."""
    return batches.where(F.col(date) == batches.agg(F.max(date)).scalar())


def read_latest_batch(spark: SparkSession, batch_dir: str) -> DataFrame:
    if not path_exists(spark, batch_dir):
        raise FileNotFoundError(f"No inference batches found in {batch_dir}")
    batches = read_batches(spark, batch_dir)
    if batches.isEmpty():
        raise FileNotFoundError(f"No inference batches found in {batch_dir}")
    return latest_batch(batches)


def read_processed(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of the processed table; the other partitions are not read."""
    return spark.read.parquet(path).where(F.col("split") == split)


def read_json_log(spark: SparkSession, path: str, schema: str | None = None, array_file: bool = False) -> DataFrame:
    """JSON log: one object per line, or a file holding one array (``array_file``)."""
    reader = spark.read.option("multiLine", array_file)
    return (reader.schema(schema) if schema else reader).json(path)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
              partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A database table; filters, limits and top-k go to the database. ``partition`` = column, low, high, parts."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition:
        column, low, high, parts = partition
        reader = (reader.option("partitionColumn", column).option("lowerBound", low)
                  .option("upperBound", high).option("numPartitions", parts))
    return reader.option("pushDownLimit", True).option("pushDownOffset", True).load()


def read_event_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None,
                      name_filter: str | None = None) -> DataFrame:
    """Parquet files as a stream, oldest first."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.parquet(path)


def read_kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Request payloads from Kafka as one text column; needs the Kafka connector on the class path."""
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return stream.select(F.col("value").cast("string").alias("payload"))


def union_training(raw: DataFrame, batches: Sequence[DataFrame]) -> DataFrame:
    """Raw rows plus all batches: ``amount`` named back, unknown columns dropped, missing ones null."""
    out = raw
    for batch in batches:
        if "amount" in batch.columns and "TransactionAmt" not in batch.columns:
            batch = batch.withColumnRenamed("amount", "TransactionAmt")
        out = out.unionByName(batch.select(*[c for c in raw.columns if c in batch.columns]), allowMissingColumns=True)
    return out
