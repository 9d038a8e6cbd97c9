"""Exploratory profiles: counts, rates, missing shares, quantiles and histograms."""

from __future__ import annotations

from math import pi

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.operators.cleaning import unpivoted
from riskloom.operators.ranks import quantiles

# With at most this many classes, per-class limits are broadcast; beyond that they are joined by shuffle.
MAX_CLASSES = 10_000


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(target)).scalar()
    return counts.where(F.col(target).isNotNull()).select(
        target, "n", F.round(F.col("n") * 100.0 / total, 4).alias("percent")
    )


def missing_profile(df: DataFrame, top: int = 15) -> DataFrame:
    """Share of missing values per column, worst first; ties in column-name order."""
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100.0).alias(c) for c in df.columns])
    rows = unpivoted(shares, df.columns, "column_name", "missing_percent")
    return rows.orderBy(F.desc("missing_percent"), "column_name").limit(top)


def describe_by(df: DataFrame, group: str, value: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per class."""
    v = F.col(value)
    moments = df.groupBy(group).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
    )
    quartiles = quantiles(df, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, group=[group])
    return moments.join(quartiles, group, "left")


def category_rates(df: DataFrame, category: str, target: str, row_id: str) -> DataFrame:
    """Rows, positives and positive share in percent per category; the null category is left out."""
    y = F.col(target)
    return df.where(F.col(category).isNotNull()).groupBy(category).agg(
        F.count(row_id).alias("total_count"),
        F.sum(y).cast("bigint").alias("fraud_count"),
        (F.avg(y) * 100.0).alias("fraud_rate"),
    )


def rates_by(df: DataFrame, part: str, target: str) -> DataFrame:
    return df.groupBy(part).agg((F.avg(target) * 100.0).alias("fraud_rate_pct"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def box_stats(df: DataFrame, group: str, value: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the last value within reach x IQR, and how many values lie outside."""
    q = quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, group=[group])
    spread = F.col("q3") - F.col("q1")
    limits = q.withColumns({"_lo": F.col("q1") - reach * spread, "_hi": F.col("q3") + reach * spread})
    v = F.col(value)
    inside = v.between(F.col("_lo"), F.col("_hi"))
    rows = limits.limit(MAX_CLASSES + 1).collect()
    if len(rows) <= MAX_CLASSES:
        limits = F.broadcast(df.sparkSession.createDataFrame(rows, limits.schema))
    return df.where(v.isNotNull()).join(limits, group).groupBy(group, "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins from minimum to maximum; the maximum belongs to the last bin, empty bins are kept."""
    v = F.col(value)
    ends = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()
    rows = df.where(v.isNotNull()).select(v.alias("v"), ends.alias("e"))
    width = F.nullif(F.col("e.hi") - F.col("e.lo"), F.lit(0.0))
    place = F.least(F.floor((F.col("v") - F.col("e.lo")) / width * bins), F.lit(bins - 1))
    counts = rows.select(F.coalesce(place, F.lit(0)).cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def log_density(df: DataFrame, group: str, value: str, per_decade: int = 10) -> DataFrame:
    """Share of each class per bin of log10(value), scaled to a density; values at or below zero have no log."""
    rows = df.where(F.col(value) > 0).select(group, F.floor(F.log10(value) * per_decade).cast("int").alias("log_bin"))
    counts = rows.groupBy(group, "log_bin").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(group))  # over counted bins: a few hundred rows per class
    return counts.select(group, "log_bin", "n", (F.col("n") / total * float(per_decade)).alias("density"))


def kernel_density(df: DataFrame, group: str, value: str, points: int = 200, grid: int = 1024, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density of log10(value) per class at evenly spaced points, ``cut`` bandwidths beyond the ends.

    Bandwidth by Scott's rule: sample deviation x n^(-1/5). Rows are dealt to the two nearest of ``grid`` + 1 places in proportion,
    so the kernel is summed over places, not over rows. Values at or below zero have no log; a class of one value has no density.
    """
    x = F.log10(value)
    rows = df.where(F.col(value) > 0).select(F.col(group).alias("class"), x.alias("x"))
    ends = rows.groupBy("class").agg(F.count("x").alias("n"), F.stddev_samp("x").alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    ends = ends.withColumn("h", F.col("s") * F.pow("n", F.lit(-0.2))).where("h > 0").select(
        "class", "n", "h", (F.col("lo") - cut * F.col("h")).alias("start"), ((F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / grid).alias("step"))
    at = (F.col("x") - F.col("start")) / F.col("step")
    placed = rows.join(ends, "class").select("class", F.floor(at).cast("int").alias("place"), (at - F.floor(at)).alias("share"))
    dealt = placed.select("class", F.explode(F.array(
        F.struct(F.col("place"), (1 - F.col("share")).alias("w")), F.struct((F.col("place") + 1).alias("place"), F.col("share").alias("w")))).alias("d"))
    weights = dealt.groupBy("class", "d.place").agg(F.sum("d.w").alias("w"))
    held = weights.groupBy("class").agg(F.collect_list(F.struct("place", "w")).alias("held"))  # at most grid + 2 places
    asked = ends.join(held, "class").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    spot = F.col("k") * F.lit(grid / (points - 1))  # in steps
    kernel = lambda d: F.exp(-0.5 * F.pow((spot - d["place"]) * F.col("step") / F.col("h"), 2)) * d["w"]
    total = F.aggregate("held", F.lit(0.0), lambda a, d: a + kernel(d))
    return asked.select(F.col("class").alias(group), F.col("k").alias("point"), (F.col("start") + spot * F.col("step")).alias("log_value"),
                        (total / (F.col("n") * F.col("h") * F.sqrt(F.lit(2 * pi)))).alias("density"))
