"""Immutable parameters of the engine; every operator receives what it needs from here."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from pathlib import Path
from typing import Any

DAY = 86_400
HOUR = 3_600


class ConfigError(ValueError):
    """The configuration file is not usable."""


@dataclass(frozen=True)
class Config:
    # --- identity of the columns -------------------------------------------------------------
    join_key: str = "TransactionID"
    time_column: str = "TransactionDT"
    amount_column: str = "TransactionAmt"
    target_column: str = "isFraud"
    order_column: str = "ingest_seq"
    # fixed values: column lists the reference pins
    required_train_columns: tuple[str, ...] = (
        "TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD",
        "card1", "card2", "card3", "card4", "card5", "card6",
    )
    required_test_columns: tuple[str, ...] = (
        "TransactionID", "TransactionDT", "TransactionAmt", "ProductCD",
        "card1", "card2", "card3", "card4", "card5", "card6",
    )
    user_key_columns: tuple[str, ...] = ("card1", "card2", "card3", "card5", "addr1")
    merchant_key_columns: tuple[str, ...] = ("ProductCD", "card4", "P_emaildomain")
    categorical_columns: tuple[str, ...] = (
        "ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain", "DeviceType",
    )
    # --- files ---------------------------------------------------------------------------------
    train_transaction_file: str = "train_transaction.csv"
    train_identity_file: str = "train_identity.csv"
    test_transaction_file: str = "test_transaction.csv"
    test_identity_file: str = "test_identity.csv"
    max_training_rows: int | None = None  # None reads everything
    # --- windows, in seconds ---------------------------------------------------------------------
    user_window: int = 30 * DAY
    merchant_window: int = 30 * DAY
    velocity_window: int = HOUR
    # --- split and oversampling --------------------------------------------------------------------
    seed: int = 42
    validation_size: float = 0.15
    test_size: float = 0.15
    use_smote: bool = True
    oversample_method: str = "smote"  # or "random"
    smote_strategy: float = 0.3
    smote_neighbours: int = 5
    # --- model ---------------------------------------------------------------------------------------
    model_name: str = "risk-boosted-trees"
    max_depth: int = 6
    learning_rate: float = 0.05
    n_trees: int = 300
    subsample: float = 0.8
    column_sample: float = 0.8
    tune: bool = False
    threshold_min: float = 0.30
    threshold_max: float = 0.70
    threshold_step: float = 0.05
    # --- decisions -------------------------------------------------------------------------------------
    fraud_threshold: float = 0.5
    suspicious_threshold: float = 0.3
    # --- drift and retraining ----------------------------------------------------------------------------
    drift_threshold: float = 0.05
    drift_intensity: float = 0.1
    batch_rows: int = 5_000
    min_hours_between_retrains: float = 6.0
    max_retrains_per_day: int = 3
    promotion_min_delta: float = 0.01
    count_failures: bool = True
    # --- plan shape --------------------------------------------------------------------------------------
    # A key with more rows than this is cut into time chunks of about this many rows.
    chunk_rows: int = 1_000_000

    def with_(self, **changes: Any) -> "Config":
        return replace(self, **changes)


# YAML location -> field name; keys of the file the reference reads.
_YAML_FIELDS = {
    ("data", "join_key"): "join_key",
    ("data", "target_column"): "target_column",
    ("data", "max_training_rows"): "max_training_rows",
    ("data", "required_train_transaction_columns"): "required_train_columns",
    ("data", "required_test_transaction_columns"): "required_test_columns",
    ("data", "train_transaction_file"): "train_transaction_file",
    ("data", "train_identity_file"): "train_identity_file",
    ("data", "test_transaction_file"): "test_transaction_file",
    ("data", "test_identity_file"): "test_identity_file",
    ("features", "user_key_columns"): "user_key_columns",
    ("features", "merchant_key_columns"): "merchant_key_columns",
    ("features", "categorical_columns"): "categorical_columns",
    ("project", "random_state"): "seed",
    ("split", "validation_size"): "validation_size",
    ("split", "test_size"): "test_size",
    ("split", "use_smote"): "use_smote",
    ("split", "smote_sampling_strategy"): "smote_strategy",
    ("model", "name"): "model_name",
    ("model", "xgboost", "max_depth"): "max_depth",
    ("model", "xgboost", "learning_rate"): "learning_rate",
    ("model", "xgboost", "n_estimators"): "n_trees",
    ("model", "xgboost", "subsample"): "subsample",
    ("model", "xgboost", "colsample_bytree"): "column_sample",
    ("model", "threshold_search", "min"): "threshold_min",
    ("model", "threshold_search", "max"): "threshold_max",
    ("model", "threshold_search", "step"): "threshold_step",
    ("api", "fraud_threshold"): "fraud_threshold",
    ("api", "suspicious_threshold"): "suspicious_threshold",
    ("drift_simulation", "drift_threshold"): "drift_threshold",
    ("drift_simulation", "current_intensity"): "drift_intensity",
    ("retraining", "min_hours_between_retrains"): "min_hours_between_retrains",
    ("retraining", "max_retrains_per_day"): "max_retrains_per_day",
    ("retraining", "promotion_min_f1_delta"): "promotion_min_delta",
    ("retraining", "tune_hyperparameters"): "tune",
}
# Windows are given in days or hours in the file and held in seconds here.
_YAML_WINDOWS = {"user_days": ("user_window", DAY), "merchant_days": ("merchant_window", DAY),
                 "velocity_hours": ("velocity_window", HOUR)}


def config_from_mapping(raw: Any) -> Config:
    if not isinstance(raw, dict):
        raise ConfigError("The configuration must be a mapping.")
    values: dict[str, Any] = {}
    for path, name in _YAML_FIELDS.items():
        node: Any = raw
        for part in path[:-1]:
            node = node.get(part) if isinstance(node, dict) else None
        if not isinstance(node, dict) or path[-1] not in node:
            continue
        node = node[path[-1]]
        # Only the row cap may be switched off by an explicit null.
        if node is not None or name == "max_training_rows":
            values[name] = tuple(node) if isinstance(node, list) else node
    windows = (raw.get("features") or {}).get("rolling_windows") or {}
    for key, (name, unit) in _YAML_WINDOWS.items():
        if key in windows:
            values[name] = int(windows[key] * unit)
    known = {f.name for f in fields(Config)}
    return Config(**{k: v for k, v in values.items() if k in known})


def load_config(path: str | Path) -> Config:
    """Read a YAML (or JSON) configuration file."""
    import json

    file = Path(path)
    if not file.exists():
        raise FileNotFoundError(f"There is no configuration at {file}")
    text = file.read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        return config_from_mapping(json.loads(text))
    return config_from_mapping(yaml.safe_load(text))


DEFAULT = Config()
