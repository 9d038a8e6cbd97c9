"""Feature engineering: temporal parts, entity keys, rolling user and merchant aggregates."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, functions as F

from riskloom.config import DEFAULT, Config
from riskloom.functions.scalars import composite_key, temporal_parts
from riskloom.operators.rolling import Measure, hot_text_keys, rolling_unique, rolling_user_stats

# fixed values: the engineered columns, in the order they are delivered
KEEP = (
    "TransactionID", "TransactionDT", "isFraud", "amount",
    "day_number", "hour", "day_of_week", "is_weekend", "month",
    "user_key", "merchant_key",
    "user_tx_count_30d", "user_total_amount_30d", "user_avg_amount_30d",
    "merchant_tx_count_30d", "merchant_unique_users_30d", "velocity_1hr",
    "card1", "card2", "card3", "card5", "addr1",
    "ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain", "DeviceType",
    "is_inference_batch",
)
BY_USER = frozenset(("user_tx_count_30d", "user_total_amount_30d", "user_avg_amount_30d", "velocity_1hr"))
BY_MERCHANT = frozenset(("merchant_tx_count_30d", "merchant_unique_users_30d"))


def add_temporal(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return df.withColumns(temporal_parts(F.col(cfg.time_column)))


def add_keys(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return df.withColumns(
        {
            "user_key": composite_key(df, cfg.user_key_columns),
            "merchant_key": composite_key(df, cfg.merchant_key_columns),
        }
    )


def engineer_features(
    df: DataFrame, cfg: Config = DEFAULT, ties: str = "sequential", wanted: Collection[str] | None = None,
) -> DataFrame:
    """All features of a cleaned frame, point in time: one counting job, then two shuffles of the kept
    columns (three with hot merchants).

    ``wanted`` names the delivered columns that are needed (all by default): a sweep none of whose values is
    wanted is not planned, and only the columns wanted travel. Raw columns that do not survive are cut before
    the first shuffle.
    """
    asked = set(KEEP) if wanted is None else set(KEEP) & set(wanted)
    users, merchants = bool(asked & BY_USER), bool(asked & BY_MERCHANT)
    order = [cfg.join_key]
    time = cfg.time_column
    carried = set(asked)
    if "amount" in asked or users:
        carried.add(cfg.amount_column)
    if users or merchants:
        carried |= {time, *order, "user_key"}
    if merchants:
        carried.add("merchant_key")
    raw = carried | {time, *cfg.user_key_columns, *cfg.merchant_key_columns}
    keyed = add_keys(add_temporal(df.select(*[c for c in df.columns if c in raw]), cfg), cfg)
    rows = keyed = keyed.select(*[c for c in keyed.columns if c in carried])
    keys = [k for k, needed in (("user_key", users), ("merchant_key", merchants)) if needed]
    hot = hot_text_keys(keyed, keys, time, cfg.chunk_rows) if keys else {}
    if users:
        rows = rolling_user_stats(
            rows, "user_key", cfg.amount_column, time, order, cfg.user_window, ties, cfg.chunk_rows,
            "user_tx_count_30d", "user_total_amount_30d", "user_avg_amount_30d",
            extra=[Measure("velocity_1hr", cfg.velocity_window, F.lit(1))],
            hot=hot["user_key"],
        )
    if merchants:
        rows = rolling_unique(
            rows, "merchant_key", "user_key", time, order, cfg.merchant_window, "merchant_unique_users_30d",
            ties, cfg.chunk_rows,
            extra=[Measure("merchant_tx_count_30d", cfg.merchant_window, F.lit(1))],
            base=keyed, hot=hot["merchant_key"],
        )
    named = rows.withColumnRenamed(cfg.amount_column, "amount") if cfg.amount_column in rows.columns else rows
    return named.select(*[c for c in KEEP if c in asked and c in named.columns])
