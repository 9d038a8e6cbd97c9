"""Controlled distribution shifts on any frame; absent columns are skipped, intensity <= 0 changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.config import DAY, DEFAULT, HOUR, Config
from riskloom.functions.scalars import normal, uniform

# fixed values: label rates at intensity 0 and 1, and the category each column concentrates on
BASE_RATE, MAX_RATE = 0.035, 0.080
COMMON = {"ProductCD": "W", "card4": "visa", "P_emaildomain": "gmail.com"}


def _scaled(df: DataFrame, columns: tuple[str, ...], factor: float) -> DataFrame:
    present = {c: F.col(c) * F.lit(factor) for c in columns if c in df.columns}
    return df.withColumns(present) if present else df


def shift_amount(df: DataFrame, intensity: float) -> DataFrame:
    return _scaled(df, ("TransactionAmt", "amount"), 1.0 + 0.60 * intensity)


def shift_velocity(df: DataFrame, intensity: float) -> DataFrame:
    return _scaled(df, ("velocity_1hr",), 1.0 + 2.0 * intensity)


def shift_merchant(df: DataFrame, intensity: float) -> DataFrame:
    return _scaled(df, ("merchant_tx_count_30d", "merchant_unique_users_30d"), 1.0 + 1.5 * intensity)


def shift_label_rate(
    df: DataFrame, intensity: float, cfg: Config = DEFAULT, row_id: str = "TransactionID"
) -> DataFrame:
    """Turn negatives positive with the probability that lifts the rate to its target; never lowers it."""
    label = cfg.target_column
    if label not in df.columns:
        return df
    target = BASE_RATE + intensity * (MAX_RATE - BASE_RATE)
    rate = df.agg(F.avg(F.col(label).cast("double"))).scalar()
    p = F.when(rate < target, (F.lit(target) - rate) / (F.lit(1.0) - rate)).otherwise(0.0)
    flip = (F.col(label) == 0) & (uniform(cfg.seed, "label", F.col(row_id)) < p)
    return df.withColumn(label, F.when(flip, 1).otherwise(F.col(label)))


def shift_time_of_day(df: DataFrame, intensity: float, cfg: Config = DEFAULT, row_id: str = "TransactionID") -> DataFrame:
    """Move positives to daytime with probability ``intensity``: same day, hour near noon in 9..17, same
    seconds within the hour."""
    if cfg.time_column not in df.columns or cfg.target_column not in df.columns:
        return df
    dt, key = F.col(cfg.time_column), F.col(row_id)
    hour = F.floor(F.least(F.greatest(normal(cfg.seed, "hour", key) * 2.0 + 12.0, F.lit(9.0)), F.lit(17.0)))
    moved = F.floor(dt / F.lit(DAY)) * DAY + hour * HOUR + F.pmod(dt, F.lit(HOUR))
    chosen = (F.col(cfg.target_column) == 1) & (uniform(cfg.seed, "move", key) < intensity)
    return df.withColumn(cfg.time_column, F.when(chosen, moved).otherwise(dt).cast("bigint"))


def shift_categories(df: DataFrame, intensity: float, cfg: Config = DEFAULT, row_id: str = "TransactionID") -> DataFrame:
    """Concentrate categories on the common value, independently per column, with probability 0.30 x intensity."""
    changes = {
        c: F.when(uniform(cfg.seed, c, F.col(row_id)) < 0.30 * intensity, F.lit(v)).otherwise(F.col(c))
        for c, v in COMMON.items()
        if c in df.columns
    }
    return df.withColumns(changes) if changes else df


def simulate_shift(df: DataFrame, intensity: float, cfg: Config = DEFAULT, row_id: str = "TransactionID") -> DataFrame:
    if intensity <= 0.0:
        return df
    out = shift_velocity(shift_amount(df, intensity), intensity)
    out = shift_time_of_day(shift_label_rate(out, intensity, cfg, row_id), intensity, cfg, row_id)
    return shift_merchant(shift_categories(out, intensity, cfg, row_id), intensity)
