"""Exact stratified splits, folds, samples and random oversampling, all repeatable by hash."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskloom.config import DEFAULT, Config
from riskloom.functions.scalars import columns_of, hash32, hash60
from riskloom.operators.cleaning import DataValidationError
from riskloom.operators.ranks import at_or_before, numbered, rank_cuts


def proportional(counts: Sequence[int], draws: int) -> list[int]:
    """Integer quotas proportional to the counts, by largest remainder; ties go to the earlier class."""
    total = sum(counts)
    exact = [c * draws / total for c in counts]
    quota = [math.floor(x) for x in exact]
    order = sorted(range(len(counts)), key=lambda i: (-(exact[i] - quota[i]), i))
    for i in order[: draws - sum(quota)]:
        quota[i] += 1
    return quota


def split_quotas(counts: Sequence[int], cfg: Config = DEFAULT) -> list[tuple[int, int]]:
    """Rows of each class that go to train and to validation; the rest is test."""
    n = sum(counts)
    held = cfg.validation_size + cfg.test_size
    n_held = math.ceil(held * n)
    train = proportional(counts, n - n_held)
    left = [c - t for c, t in zip(counts, train)]
    n_test = math.ceil((1.0 - cfg.validation_size / held) * n_held)
    validation = proportional(left, n_held - n_test)
    return list(zip(train, validation))


def stratified_split(df: DataFrame, row_id: str, cfg: Config = DEFAULT) -> DataFrame:
    """Add ``split`` (train / val / test) with exact sizes per class.

    The cut points of a hash order are found by counting; applying them is a projection, so the rows are
    not shuffled.
    """
    target = cfg.target_column
    if target not in df.columns:
        raise DataValidationError(f"Target column '{target}' is missing; cannot split without labels.")
    counts = {r[target]: r["count"] for r in df.groupBy(target).count().collect()}
    labels = sorted(counts)
    quotas = dict(zip(labels, split_quotas([counts[v] for v in labels], cfg)))
    wanted = {v: [t, t + w] for v, (t, w) in quotas.items()}
    cuts = rank_cuts(df, row_id, cfg.seed, "split", wanted, target)
    part = F.lit("test")
    for v, (t, w) in quotas.items():
        for rank, name in ((t + w, "val"), (t, "train")):
            if rank > 0:
                first = at_or_before(row_id, cfg.seed, "split", cuts[(v, rank)])
                part = F.when((F.col(target) == F.lit(v)) & first, name).otherwise(part)
    return df.withColumn("split", part)


def kfold_assign(df: DataFrame, row_id: str, folds: int = 3, seed: int = 42) -> DataFrame:
    """Shuffled folds whose sizes differ by at most one; the first ones are the larger."""
    n = df.count()
    sizes = [n // folds + (1 if i < n % folds else 0) for i in range(folds)]
    ranks = [sum(sizes[: i + 1]) for i in range(folds - 1)]
    cuts = rank_cuts(df, row_id, seed, "fold", {0: ranks})
    fold = F.lit(folds - 1)
    for i in reversed(range(folds - 1)):
        if ranks[i] > 0:
            fold = F.when(at_or_before(row_id, seed, "fold", cuts[(0, ranks[i])]), i).otherwise(fold)
    return df.withColumn("fold", fold)


def sample_n(df: DataFrame, row_id: str, n: int = 10_000, seed: int = 42) -> DataFrame:
    """Uniform sample without replacement of min(n, rows), the same on every run."""
    return df.withColumn("_h", hash32(seed, "sample", F.col(row_id))).orderBy("_h", row_id).limit(n).drop("_h")


def class_sizes(df: DataFrame, target: str) -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(target) == 0).alias("neg"), F.count_if(F.col(target) == 1).alias("pos")).first()
    return row["neg"], row["pos"]


def new_minority_rows(negatives: int, positives: int, strategy: float) -> int:
    """How many rows bring the minority to ``strategy`` x majority; shrinking it is an error."""
    major, minor = max(negatives, positives), min(negatives, positives)
    wanted = int(strategy * major) - minor
    if wanted < 0:
        raise DataValidationError("The minority already exceeds the wanted ratio.")
    return wanted


def random_oversample(df: DataFrame, row_id: str, cfg: Config = DEFAULT) -> DataFrame:
    """Append minority rows drawn with replacement until the ratio holds; ``copy_no`` is null on originals.

    Draw j picks the row numbered by the remainder of 60 hash bits: an equi-join on a unique number, spread evenly.
    """
    target = cfg.target_column
    neg, pos = class_sizes(df, target)
    n_new, m = new_minority_rows(neg, pos, cfg.smote_strategy), min(neg, pos)
    minority = df.where(F.col(target) == (1 if pos <= neg else 0))
    indexed = numbered(minority, row_id, cfg.seed, "oversample")
    draws = df.sparkSession.range(n_new).select(
        F.col("id").alias("copy_no"), F.pmod(hash60(cfg.seed, "draw", F.col("id")), F.lit(max(m, 1)).cast("bigint")).alias("row_index")
    )
    copies = draws.join(indexed, "row_index").select(*columns_of(df), "copy_no")
    return df.withColumn("copy_no", F.lit(None).cast("bigint")).unionByName(copies)
