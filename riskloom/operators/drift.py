"""Two-sample drift tests: Kolmogorov-Smirnov on numbers, chi-square on categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.functions.pvalues import chi_square_p, ks_p
from riskloom.functions.scalars import hour_bucket
from riskloom.operators.ranks import cumulative, value_splits
from riskloom.session import settle

# fixed values: the features the drift check looks at
NUMERIC = ("amount", "velocity_1hr", "user_avg_amount_30d")
CATEGORICAL = ("card6", "hour_bucket")


# One call per tested feature, on values Spark has already reduced.
@F.udf(T.DoubleType())
def _chi_p(statistic, dof):
    return chi_square_p(statistic, dof)


@F.udf(T.DoubleType())
def _ks_p(distance, n, m):
    return ks_p(distance, n, m)


def tagged(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both samples in one frame, told apart by ``is_current``; only columns both sides have."""
    shared = [c for c in columns if c in reference.columns and c in current.columns]
    return reference.select(*shared, F.lit(False).alias("is_current")).unionByName(
        current.select(*shared, F.lit(True).alias("is_current"))
    )


def with_hour_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("hour_bucket", hour_bucket(F.col("hour"))) if "hour" in df.columns else df


def drift_ks(both: DataFrame, features: Sequence[str]) -> DataFrame:
    """Distance between the two empirical distributions per feature. All features in one counting pass."""
    present = [c for c in features if c in both.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("feature_name"), F.col(c).cast("double").alias("v")) for c in present])
    long = both.select("is_current", F.inline(pairs)).where(F.col("v").isNotNull())
    counts = long.groupBy("feature_name", "v").agg(
        F.count_if(~F.col("is_current")).alias("ref"), F.count_if(F.col("is_current")).alias("cur")
    )
    counts = settle(counts, "counts")
    ranked = cumulative(counts, "v", ["ref", "cur"], value_splits(counts, "v", "feature_name"), "feature_name")
    sizes = counts.groupBy("feature_name").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    sizes = sizes.where((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    gap = F.abs(
        (F.col("ref_below") + F.col("ref")) / F.col("n_ref") - (F.col("cur_below") + F.col("cur")) / F.col("n_cur")
    )
    # one row per tested feature: the list of features bounds it
    return ranked.join(F.broadcast(sizes), "feature_name").groupBy("feature_name", "n_ref", "n_cur").agg(
        F.max(gap).alias("statistic")
    )


def drift_chi_square(both: DataFrame, features: Sequence[str]) -> DataFrame:
    """Chi-square statistic of the category-by-sample table per feature, with Yates' correction at one
    degree of freedom. A single category or an empty sample gives 0 and p = 1."""
    present = [c for c in features if c in both.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("feature_name"), F.col(c).cast("string").alias("v")) for c in present])
    counts = both.select("is_current", F.inline(pairs)).where(F.col("v").isNotNull()).groupBy("feature_name", "v").agg(
        F.count_if(~F.col("is_current")).alias("ref"), F.count_if(F.col("is_current")).alias("cur")
    )
    totals = counts.groupBy("feature_name").agg(
        F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"), (F.count(F.lit(1)) - 1).alias("dof")
    ).where((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    rows = counts.join(F.broadcast(totals), "feature_name")  # one totals row per feature
    row_total = (F.col("ref") + F.col("cur")).cast("double")
    grand = F.col("n_ref") + F.col("n_cur")
    terms = F.lit(0.0)
    for seen, n in (("ref", "n_ref"), ("cur", "n_cur")):
        expected = row_total * F.col(n) / grand
        off = F.abs(F.col(seen) - expected)
        off = F.when(F.col("dof") == 1, off - F.least(F.lit(0.5), off)).otherwise(off)
        terms = terms + off * off / expected
    return rows.groupBy("feature_name", "n_ref", "n_cur", "dof").agg(F.sum(terms).alias("statistic"))


def drift_tests(
    reference: DataFrame, current: DataFrame, numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL, threshold: float = 0.05,
) -> DataFrame:
    """One row per tested feature: score, p-value and verdict.

    The tested columns of both samples are written once, since both tests read them.
    """
    both = settle(tagged(reference, current, [*numeric, *categorical]), "drift")
    ks = drift_ks(both, numeric).select(
        "feature_name", F.lit("ks").alias("test"), F.col("statistic").alias("drift_score"),
        _ks_p("statistic", "n_ref", "n_cur").alias("p_value"),
    )
    chi = drift_chi_square(both, categorical).select(
        "feature_name", F.lit("chi_square").alias("test"), F.col("statistic").alias("drift_score"),
        _chi_p("statistic", "dof").alias("p_value"),
    )
    return ks.unionByName(chi).withColumn("drift_detected", F.col("p_value") < threshold)


def drift_summary(tests: DataFrame) -> DataFrame:
    """Overall verdict: drift in any feature; and the share of drifted features."""
    return tests.agg(
        F.bool_or("drift_detected").alias("drift_detected"),
        F.count(F.lit(1)).alias("features_tested"),
        F.count_if("drift_detected").alias("features_drifted"),
        F.avg(F.col("drift_detected").cast("int")).alias("drifted_share"),
    )
