"""Shifted batches and the drift check against the baseline."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, functions as F

from riskloom.config import DEFAULT, Config
from riskloom.operators.drift import CATEGORICAL, NUMERIC, drift_tests, with_hour_bucket
from riskloom.operators.ranks import flag_newest
from riskloom.operators.shift import simulate_shift
from riskloom.plans.features import engineer_features
from riskloom.session import settle

FLAG = "is_inference_batch"
TESTED = (*NUMERIC, *CATEGORICAL)


def _order(cfg: Config) -> list[str]:
    return [cfg.time_column, cfg.join_key]


def baseline_exclude(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """All rows but the newest min(batch size, half the table)."""
    n = min(cfg.batch_rows, df.count() // 2)
    if n == 0:
        return df
    return flag_newest(df, n, _order(cfg), FLAG).where(~F.col(FLAG)).drop(FLAG)


def make_shifted_batch(
    df: DataFrame, intensity: float | None = None, cfg: Config = DEFAULT, wanted: Collection[str] | None = None,
) -> DataFrame:
    """Shift the newest rows and engineer their features over the joint history.

    The shifted rows (at most ``batch_rows``) are written once. Only rows of the batch are returned, so
    history older than the longest window before the batch is cut at the scan. ``wanted`` as for
    ``engineer_features``.
    """
    strength = cfg.drift_intensity if intensity is None else intensity
    marked = flag_newest(df, cfg.batch_rows, _order(cfg), FLAG)
    candidate = settle(simulate_shift(marked.where(FLAG), strength, cfg, cfg.join_key), "candidate")
    asked = None if wanted is None else {*wanted, FLAG}
    start = candidate.agg(F.min(cfg.time_column)).first()[0]
    if start is None:
        return engineer_features(candidate, cfg, wanted=asked).drop(FLAG)
    reach = max(cfg.user_window, cfg.merchant_window, cfg.velocity_window)
    history = marked.where(~F.col(FLAG) & (F.col(cfg.time_column) >= start - reach))
    return engineer_features(history.unionByName(candidate), cfg, wanted=asked).where(FLAG).drop(FLAG)


def source_columns(tested: Collection[str]) -> set[str]:
    """The engineered columns that the tested features come from."""
    return {"hour" if c == "hour_bucket" else c for c in tested}


def drift_frames(
    df: DataFrame, intensity: float | None = None, cfg: Config = DEFAULT, tested: Collection[str] = TESTED,
) -> tuple[DataFrame, DataFrame]:
    """Baseline and shifted batch with the features that are tested; only those are computed."""
    needed = source_columns(tested)
    reference = engineer_features(baseline_exclude(df, cfg), cfg, wanted=needed)
    current = make_shifted_batch(df, intensity, cfg, needed)
    return with_hour_bucket(reference), with_hour_bucket(current)


def detect_drift(reference: DataFrame, batch: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Test rows of a batch against the baseline features: the rows of the drift log."""
    tests = drift_tests(with_hour_bucket(reference), with_hour_bucket(batch), threshold=cfg.drift_threshold)
    return tests.withColumn("drift_intensity", F.lit(float(cfg.drift_intensity)))
