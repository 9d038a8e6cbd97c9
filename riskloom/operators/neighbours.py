"""Exact k nearest neighbours inside one class, and synthetic minority rows built from them.

Rows are assigned to the nearest of a few pivots. Distances to the pivots bound how far the k-th neighbour
of a row can be, and so which cells can hold one; a row is only compared with those cells (the pivot-based
kNN join of Lu et al., 2012). Cells and the rows sent to them are cut into blocks of bounded size, each pair
of blocks is one task that returns k rows per row, and block results are merged. Identical rows are
collapsed to their k + 1 smallest ids first, so a large group of copies costs one comparison.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from riskloom.config import DEFAULT, Config
from riskloom.functions.scalars import hash32, hash60
from riskloom.operators.cleaning import DataValidationError
from riskloom.operators.ranks import numbered
from riskloom.operators.sampling import class_sizes, new_minority_rows
from riskloom.session import settle

# The pivots and the distances between them go to every executor: at most this many squared numbers.
MAX_PIVOTS = 2048


def _distances(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed dimension by dimension."""
    total = np.zeros((len(rows), len(others)))
    for i in range(rows.shape[1]):
        diff = rows[:, i, None] - others[None, :, i]
        total += diff * diff
    return np.sqrt(total)


def _first_k(df: DataFrame, keys: Sequence[str], k: int, *order: str) -> DataFrame:
    """First k rows per key; Spark cuts each task's groups to k before the shuffle."""
    place = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(place)).where(F.col("_k") <= k).drop("_k")


class _Cells:
    """Pivots and, per cell, its size, radii and smallest distances: bounded by MAX_PIVOTS x (k + 1) numbers."""

    def __init__(self, pivots: np.ndarray, k: int) -> None:
        self.pivots, self.k = pivots, k
        self.between = _distances(pivots, pivots)
        self.low = np.full(len(pivots), np.inf)
        self.high = np.full(len(pivots), -np.inf)
        self.closest = np.full((len(pivots), k + 1), np.inf)
        self.blocks = np.zeros(len(pivots), dtype=int)

    def wanted(self, vectors: np.ndarray) -> np.ndarray:
        """Which cells can hold one of the k nearest of each row, worked out a few rows at a time."""
        return np.concatenate([self._wanted(vectors[i : i + 256]) for i in range(0, len(vectors), 256)])

    def _wanted(self, vectors: np.ndarray) -> np.ndarray:
        to_pivot = _distances(vectors, self.pivots)
        bounds = (to_pivot[:, :, None] + self.closest[None, :, :]).reshape(len(vectors), -1)
        reach = np.partition(bounds, self.k, axis=1)[:, self.k] if bounds.shape[1] > self.k else np.full(len(vectors), np.inf)
        reach = (reach * (1 + 1e-9) + 1e-12)[:, None]
        own = to_pivot.argmin(axis=1)
        gap = to_pivot**2 - (to_pivot[np.arange(len(vectors)), own] ** 2)[:, None]
        apart = self.between[own]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(apart > 0, gap / (2 * apart), 0.0)
        return (plane <= reach) & (to_pivot - self.high <= reach) & (self.low - to_pivot <= reach) & (self.blocks > 0)


def _collapsed(points: DataFrame, k: int) -> DataFrame:
    """Each vector once, with its k + 1 smallest ids."""
    kept = _first_k(points.select("id", "vec"), ["vec"], k + 1, "id")
    once = kept.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("members"))  # at most k + 1 ids
    return settle(once.select(F.col("members")[0].alias("vid"), "vec", "members"), "knn-points")


def nearest(points: DataFrame, k: int, block_rows: int = 4096, pivots: int | None = None) -> DataFrame:
    """``points`` (id, vec) -> (id, rank, neighbour, distance), the k nearest other rows, ties by id."""
    id_type = points.schema["id"].dataType.simpleString()
    once = _collapsed(points, k)
    n = once.count()
    if n == 0:
        return points.sparkSession.createDataFrame([], f"id {id_type}, rank int, neighbour {id_type}, distance double")
    count = min(n, pivots or max(4, min(MAX_PIVOTS, isqrt(n))))
    chosen = once.orderBy(hash32(DEFAULT.seed, "pivot", F.col("vid"))).limit(count).collect()
    cells = _Cells(np.array([r["vec"] for r in chosen], dtype=float), k)

    centres = points.sparkSession.sparkContext.broadcast(cells.pivots)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                to_pivot = _distances(np.stack(batch["vec"].to_numpy()), centres.value)
                yield batch.assign(cell=to_pivot.argmin(axis=1).astype("int32"), gap=to_pivot.min(axis=1))

    shape = f"vid {id_type}, vec array<double>, members array<{id_type}>"
    placed = settle(once.mapInPandas(assign, f"{shape}, cell int, gap double"), "knn-cells")

    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("gap").alias("lo"), F.max("gap").alias("hi")).collect():
        cells.low[r["cell"]], cells.high[r["cell"]] = r["lo"], r["hi"]
        cells.blocks[r["cell"]] = -(-r["n"] // block_rows)
    for r in _first_k(placed.select("cell", "gap", "vid"), ["cell"], k + 1, "gap", "vid").groupBy("cell").agg(
        F.sort_array(F.collect_list("gap")).alias("g")
    ).collect():
        cells.closest[r["cell"], : len(r["g"])] = r["g"]

    known = points.sparkSession.sparkContext.broadcast(cells)

    def count_targets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                hits = known.value.wanted(np.stack(batch["vec"].to_numpy())).sum(axis=0)
                yield pd.DataFrame({"cell": np.arange(len(hits), dtype="int32"), "n": hits.astype("int64")})

    asked = placed.select("vec").mapInPandas(count_targets, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    chunks = np.ones(len(cells.pivots), dtype=int)
    for r in asked.collect():
        chunks[r["cell"]] = max(1, -(-r["n"] // block_rows))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                row, cell = np.nonzero(known.value.wanted(np.stack(batch["vec"].to_numpy())))
                yield pd.DataFrame({"vid": batch["vid"].to_numpy()[row], "vec": batch["vec"].to_numpy()[row], "cell": cell.astype("int32")})

    # Every block of a cell meets every chunk of the rows sent to that cell.
    blocks_of = F.element_at(F.array(*[F.lit(int(b)) for b in cells.blocks]), F.col("cell") + 1)
    chunks_of = F.element_at(F.array(*[F.lit(int(c)) for c in chunks]), F.col("cell") + 1)
    spread = hash32(DEFAULT.seed, "block", F.col("vid"))
    questions = placed.select("vid", "vec").mapInPandas(send, f"vid {id_type}, vec array<double>, cell int").select(
        "*", F.pmod(spread, chunks_of).cast("int").alias("chunk"), F.explode(F.sequence(F.lit(0), blocks_of - 1)).alias("block")
    )
    data = placed.select("vid", "vec", "cell", F.pmod(spread, blocks_of).cast("int").alias("block"),
                         F.explode(F.sequence(F.lit(0), chunks_of - 1)).alias("chunk"))

    def compare(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        askers, others, lengths = [], [], []
        if len(asking) and len(held):
            x, names, ids = np.stack(held["vec"].to_numpy()), held["vid"].to_numpy(), asking["vid"].to_numpy()
            questions = np.stack(asking["vec"].to_numpy())
            last = min(k, len(names) - 1)
            for start in range(0, len(ids), 512):
                d = _distances(questions[start : start + 512], x)
                limits = np.partition(d, last, axis=1)[:, last]
                for i, (row, limit) in enumerate(zip(d, limits)):
                    near = np.nonzero(row <= limit)[0]
                    near = near[np.lexsort((names[near], row[near]))][: k + 1]
                    askers.append(np.repeat(ids[start + i], len(near)))
                    others.append(names[near])
                    lengths.append(row[near])
        joined = (np.concatenate(p) if p else [] for p in (askers, others, lengths))
        return pd.DataFrame(dict(zip(("vid", "other", "distance"), joined)))

    by = ["cell", "block", "chunk"]
    candidates = questions.groupBy(*by).cogroup(data.groupBy(*by)).applyInPandas(
        compare, f"vid {id_type}, other {id_type}, distance double"
    )
    return _expanded(points, once, _first_k(candidates, ["vid"], k + 1, "distance", "other"), k)


def _expanded(points: DataFrame, once: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """Neighbours of collapsed rows (vid, other, distance) as neighbours of all rows."""
    named = best.join(once.select(F.col("vid").alias("other"), "members"), "other")
    lists = named.groupBy("vid").agg(F.collect_list(F.struct("distance", "members")).alias("near"))  # k + 1 entries
    by_vector = once.select("vid", "vec").join(lists, "vid").select("vec", "near")
    others = F.flatten(F.transform("near", lambda e: F.transform(e["members"], lambda m: F.struct(e["distance"].alias("distance"), m.alias("neighbour")))))
    ranked = F.slice(F.array_sort(F.filter(others, lambda o: o["neighbour"] != F.col("id"))), 1, k)
    return points.select("id", "vec").join(by_vector, "vec").select("id", F.posexplode(ranked).alias("pos", "o")).select(
        "id", (F.col("pos") + 1).alias("rank"), "o.neighbour", "o.distance"
    )


def smote(df: DataFrame, row_id: str, features: Sequence[str], cfg: Config = DEFAULT) -> DataFrame:
    """All rows plus synthetic minority rows x + u (neighbour - x), up to the wanted ratio (Chawla et al., 2002).

    Synthetic rows carry ``copy_no`` and the two rows they lie between; originals have nulls there.
    """
    target, k = cfg.target_column, cfg.smote_neighbours
    neg, pos = class_sizes(df, target)
    n_new, m, label = new_minority_rows(neg, pos, cfg.smote_strategy), min(neg, pos), 1 if pos <= neg else 0
    if n_new and m < k + 1:
        raise DataValidationError(f"Oversampling needs at least {k + 1} minority rows, found {m}.")
    vector = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    minority = df.where(F.col(target) == label).select(F.col(row_id).alias("id"), vector.alias("vec"))
    near = nearest(minority, k).select("id", "rank", "neighbour")

    pick = F.pmod(hash60(cfg.seed, "smote", F.col("id")), F.lit(max(m * k, 1)).cast("bigint"))
    gap = hash32(cfg.seed, "gap", F.col("id")) / F.lit(4294967296.0)
    draws = df.sparkSession.range(n_new).select(
        F.col("id").alias("copy_no"), F.floor(pick / k).cast("bigint").alias("row_index"), (pick % k + 1).cast("int").alias("rank"),
        gap.alias("gap"),
    )
    base = numbered(minority, "id", cfg.seed, "smote-base")
    made = draws.join(base, "row_index").join(near, ["id", "rank"]).join(
        minority.select(F.col("id").alias("neighbour"), F.col("vec").alias("nvec")), "neighbour"
    )
    values = [
        (F.col("vec")[i] + F.col("gap") * (F.col("nvec")[i] - F.col("vec")[i])).alias(c) for i, c in enumerate(features)
    ]
    synthetic = made.select(
        *values, F.lit(label).cast(df.schema[target].dataType).alias(target), "copy_no",
        F.col("id").alias("base_id"), F.col("neighbour").alias("neighbour_id"),
    )
    return df.unionByName(synthetic, allowMissingColumns=True)
