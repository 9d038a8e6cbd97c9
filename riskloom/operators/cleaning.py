"""Validation, cleaning, narrowing and the identity join."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskloom.config import DEFAULT, Config
from riskloom.operators.ranks import median_of


class DataValidationError(ValueError):
    """Raised when an input table fails validation."""


_NUMERIC = (T.NumericType, T.BooleanType)


def require_columns(df: DataFrame, required: Iterable[str], source: str = "input") -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise DataValidationError(f"{source} is missing required columns: {', '.join(missing)}")


def invalid_numeric_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many non-null values of each text column are no number."""
    bad = [
        F.count_if(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").isNull()).alias(c) for c in columns
    ]
    return unpivoted(df.agg(*bad), columns, "column_name", "invalid_count")


def unpivoted(row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Turn the columns of a one-row frame into rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns])
    return row.select(F.inline(pairs))


def invalid_target_count(df: DataFrame, target: str) -> DataFrame:
    return df.agg(F.count_if(F.col(target).isNotNull() & ~F.col(target).isin(0, 1)).alias("invalid_count"))


def validate(df: DataFrame, cfg: Config = DEFAULT, train: bool = True, source: str = "input") -> None:
    """Columns, numeric types, key not entirely null, target in {0, 1}. One aggregate job; raises on failure."""
    require_columns(df, cfg.required_train_columns if train else cfg.required_test_columns, source)
    numeric = [cfg.time_column, cfg.amount_column] + ([cfg.target_column] if train else [])
    for column in numeric:
        if not isinstance(df.schema[column].dataType, _NUMERIC):
            raise DataValidationError(f"{column} must be numeric.")
    checks = [F.count(cfg.join_key).alias("keys")]
    if train:
        y = F.col(cfg.target_column).cast("double")
        checks.append(F.count_if(y.isNotNull() & ~y.isin(0.0, 1.0)).alias("bad"))
    found = df.agg(*checks).first()
    if found["keys"] == 0:
        raise DataValidationError(f"{cfg.join_key} cannot be entirely null.")
    if train and found["bad"]:
        raise DataValidationError(f"{cfg.target_column} must contain only 0 and 1.")


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def drop_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def dedupe_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keep the first row of each key. An aggregate, so copies of a hot key are dropped before the shuffle."""
    others = [c for c in df.columns if c != key]
    kept = df.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("_row"))
    return kept.select(key, "_row.*").select(*df.columns)


def latest_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The last write per key wins (upsert)."""
    others = [c for c in df.columns if c != key]
    kept = df.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return kept.select(key, "_row.*").select(*df.columns)


def median_fill(df: DataFrame, column: str, narrow: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the exact median of the column; an all-null column with rows to fill is an error.

    ``narrow`` holds the same values with fewer columns, for the counting passes behind the median.
    """
    median = median_of(df if narrow is None else narrow, column)
    missing = F.raise_error(F.lit(f"{column} cannot be entirely null.")).cast("double")
    return df.withColumn(column, F.coalesce(F.col(column), median, missing))


def clean_transactions(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Null keys out, first row per key, then missing amounts to the median of what is left."""

    def first_rows(rows: DataFrame) -> DataFrame:
        return dedupe_first(drop_null(rows, cfg.join_key), cfg.join_key, cfg.order_column)

    # Whole rows move once; the median only needs keys and amounts.
    narrow = first_rows(df.select(cfg.join_key, cfg.amount_column, cfg.order_column))
    return median_fill(first_rows(df), cfg.amount_column, narrow)


def join_identity(df: DataFrame, identity: DataFrame | None, cfg: Config = DEFAULT, order: str = "identity_seq") -> DataFrame:
    """Left join of one identity row per key; without an identity table the frame passes unchanged."""
    if identity is None:
        return df
    once = dedupe_first(drop_null(identity, cfg.join_key), cfg.join_key, order).drop(order)
    return df.join(once, cfg.join_key, "left")


# fixed values: bounds of the integer and float types; the comparison is strict on both ends
_INT_TYPES = (("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31), ("bigint", 2**63))
_FLOAT_MAX = 3.4028234663852886e38


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _narrow_type(is_int: bool, low: Column, high: Column) -> Column:
    if is_int:
        out = F.lit("bigint")
        for name, bound in reversed(_INT_TYPES[:-1]):
            out = F.when((low > -bound) & (high < bound - 1), name).otherwise(out)
        return out
    return F.when((low > -_FLOAT_MAX) & (high < _FLOAT_MAX), "float").otherwise("double")


def numeric_ranges(df: DataFrame) -> DataFrame:
    """Column, minimum, maximum and the narrowest type that holds them: one aggregate over the table."""
    names = numeric_columns(df)
    row = df.agg(*[f(F.col(c)).alias(f"{c}__{n}") for c in names for n, f in (("lo", F.min), ("hi", F.max))])
    entries = []
    for c in names:
        low, high = F.col(f"{c}__lo"), F.col(f"{c}__hi")
        is_int = isinstance(df.schema[c].dataType, T.IntegralType)
        entries.append(
            F.struct(
                F.lit(c).alias("column_name"),
                low.cast("double").alias("min_value"),
                high.cast("double").alias("max_value"),
                _narrow_type(is_int, low, high).alias("narrow_type"),
            )
        )
    return row.select(F.inline(F.array(*entries)))


def narrow(df: DataFrame) -> DataFrame:
    """Cast every numeric column to the narrowest type its values fit. Booleans stay."""
    types = {r["column_name"]: r["narrow_type"] for r in numeric_ranges(df).collect()}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def raw_counts(df: DataFrame, cfg: Config = DEFAULT) -> Column:
    """Rows, null ids, duplicate ids (repeated null ids count) and null amounts, as one struct scalar."""
    key = F.col(cfg.join_key)
    distinct = F.count_distinct(key) + F.max(key.isNull().cast("bigint"))
    return df.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(key.isNull()).alias("null_ids"),
            (F.count(F.lit(1)) - distinct).alias("duplicates"),
            F.count_if(F.col(cfg.amount_column).isNull()).alias("null_amounts"),
        )
    ).scalar()


def ingestion_summary(
    raw: DataFrame, identity: DataFrame | None, cleaned: DataFrame, joined: DataFrame,
    cfg: Config = DEFAULT, split: str = "train",
) -> DataFrame:
    spark = raw.sparkSession
    counts = raw_counts(raw, cfg)
    if identity is None:
        identity_rows = F.lit(0).cast("bigint")
    else:
        identity_rows = identity.agg(F.count_distinct(cfg.join_key)).scalar()
    if cfg.target_column in joined.columns:
        after = F.struct(F.count(F.lit(1)).alias("rows"), F.avg(F.col(cfg.target_column).cast("double")).alias("rate"))
    else:
        after = F.struct(F.count(F.lit(1)).alias("rows"), F.lit(None).cast("double").alias("rate"))
    result = joined.agg(after).scalar()
    return spark.range(1).select(
        counts.alias("c"), result.alias("j"), identity_rows.alias("identity_rows_raw"),
        cleaned.agg(F.count(F.lit(1))).scalar().alias("rows_after_cleaning"),
    ).select(
        F.lit(split).alias("split"),
        F.col("c.rows").alias("transaction_rows_raw"),
        "identity_rows_raw",
        "rows_after_cleaning",
        F.col("j.rows").alias("rows_after_join"),
        F.lit(len(joined.columns)).alias("columns_after_join"),
        F.col("c.null_ids").alias("missing_transaction_ids"),
        F.col("c.duplicates").alias("duplicate_transaction_ids"),
        F.col("c.null_amounts").alias("transaction_amount_nulls"),
        F.col("j.rate").alias("label_rate"),
    )
