"""Fit-once, apply-many preprocessing: categories, medians, population scaling, alignment."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.config import DEFAULT, Config
from riskloom.operators.cleaning import DataValidationError
from riskloom.operators.ranks import quantiles

# fixed values: identifier columns that never become features
NON_FEATURES = ("TransactionID", "TransactionDT", "user_key", "merchant_key", "day_number")
# More categories than this in one column means that it is no category; it is an error, never a cut.
MAX_CATEGORIES = 10_000


@dataclass(frozen=True)
class PreprocessParams:
    """Everything the apply path needs: a few numbers per feature."""

    categories: dict[str, list[str]]
    numeric: list[str]
    medians: dict[str, float]
    means: dict[str, float]
    deviations: dict[str, float]

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *[f"{c}_{v}" for c, vs in self.categories.items() for v in vs[1:]]]

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "value string").write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "PreprocessParams":
        return PreprocessParams(**json.loads(spark.read.text(path).first()[0]))


def fill_categorical(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in present}) if present else df


def fit_categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted categories of each column: one pass, distinct pairs only."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return {}
    pairs = F.array(*[
        F.struct(F.lit(c).alias("c"), F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias("v")) for c in present
    ])
    rows = df.select(F.inline(pairs)).distinct().limit(MAX_CATEGORIES * len(present) + 1).collect()
    wide = sorted(c for c, n in Counter(r["c"] for r in rows).items() if n > MAX_CATEGORIES)
    if wide:
        raise DataValidationError(f"More than {MAX_CATEGORIES} categories in {wide}; not categorical columns.")
    return {c: sorted(r["v"] for r in rows if r["c"] == c) for c in present}


def one_hot_columns(categories: dict[str, list[str]]) -> list[Column]:
    """Indicators named column_value; the first sorted category is dropped, unknown ones are all zero."""
    return [
        F.when(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("unknown")) == v, 1.0).otherwise(0.0).alias(f"{c}_{v}")
        for c, values in categories.items()
        for v in values[1:]
    ]


def numeric_features(df: DataFrame, cfg: Config = DEFAULT, skip: Iterable[str] = ()) -> list[str]:
    out = {*NON_FEATURES, *cfg.categorical_columns, cfg.target_column, *skip}
    return [c for c in df.columns if c not in out]


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians of all columns in one counting pass over (column, value) pairs."""
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in columns])
    found = quantiles(df.select(F.inline(pairs)), "v", {"median": 0.5}, series="c").collect()
    medians = {r["c"]: r["median"] for r in found}
    return {c: medians.get(c, 0.0) for c in columns}


def imputed(column: str, medians: dict[str, float]) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(float(medians[column])))


def impute_median(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({c: imputed(c, medians) for c in medians})


def fit_scaling(df: DataFrame, medians: dict[str, float]) -> tuple[dict[str, float], dict[str, float]]:
    """Mean and population deviation after imputation; a constant column divides by one."""
    columns = list(medians)
    stats = [f(imputed(c, medians)).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = df.agg(*stats).first()
    means = {c: float(row[f"m_{i}"] or 0.0) for i, c in enumerate(columns)}
    deviations = {c: float(row[f"s_{i}"] or 0.0) or 1.0 for i, c in enumerate(columns)}
    return means, deviations


def scaled(value: Column, mean: float, deviation: float) -> Column:
    return (value - F.lit(mean)) / F.lit(deviation)


def fit_preprocess(train: DataFrame, cfg: Config = DEFAULT, skip: Iterable[str] = ("split",)) -> PreprocessParams:
    """Learn categories, medians and scaling on the training rows: three aggregate jobs."""
    if cfg.target_column not in train.columns:
        raise DataValidationError(f"Target column '{cfg.target_column}' is missing; cannot fit without labels.")
    numeric = numeric_features(train, cfg, skip)
    categories = fit_categories(train, cfg.categorical_columns)
    medians = fit_medians(train, numeric)
    means, deviations = fit_scaling(train, medians)
    return PreprocessParams(categories, numeric, medians, means, deviations)


def apply_preprocess(df: DataFrame, params: PreprocessParams, keep: Sequence[str] = ()) -> DataFrame:
    """Encode, impute, scale and align: one projection, no shuffle. Absent columns become 0.0."""
    present = {c: v for c, v in params.categories.items() if c in df.columns}
    encoded = {f"{c}_{v}": col for (c, v), col in zip(
        [(c, v) for c, vs in present.items() for v in vs[1:]], one_hot_columns(present))}
    out = [F.col(c) for c in keep if c in df.columns]
    for feature in params.features:
        if feature in encoded:
            out.append(encoded[feature])
        elif feature in params.medians and feature in df.columns:
            value = imputed(feature, params.medians)
            out.append(scaled(value, params.means[feature], params.deviations[feature]).alias(feature))
        else:
            out.append(F.lit(0.0).alias(feature))
    return df.select(*out)


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the listed features in their order; absent ones are 0.0, unlisted ones go."""
    have = set(df.columns)
    return df.select(
        *[F.col(c) for c in keep], *[F.col(f"`{c}`") if c in have else F.lit(0.0).alias(c) for c in features]
    )
