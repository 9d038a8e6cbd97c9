"""Ingest: read, validate, clean, join, summarise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.config import DEFAULT, Config
from riskloom.operators.cleaning import (
    clean_transactions, ingestion_summary, join_identity, nan_to_null, require_columns, validate,
)
from riskloom.sources.readers import read_split, with_ingest_order


def ingest(
    transactions: DataFrame, identity: DataFrame | None, cfg: Config = DEFAULT, split: str = "train",
    identity_order: str = "identity_seq",
) -> tuple[DataFrame, DataFrame]:
    """Cleaned and joined transactions, and a one-row summary. Validation runs now, the rest is lazy."""
    validate(transactions, cfg, split == "train", "transactions")
    if identity is not None:
        require_columns(identity, [cfg.join_key], "identity")
        identity = with_ingest_order(identity, identity_order)
    raw = nan_to_null(with_ingest_order(transactions, cfg.order_column))
    cleaned = clean_transactions(raw, cfg).drop(cfg.order_column)
    joined = join_identity(cleaned, identity, cfg, identity_order)
    return joined, ingestion_summary(raw, identity, cleaned, joined, cfg, split)


def ingest_split(spark: SparkSession, raw_dir: str, split: str, cfg: Config = DEFAULT) -> tuple[DataFrame, DataFrame]:
    transactions, identity = read_split(spark, raw_dir, split, cfg)
    return ingest(transactions, identity, cfg, split)
