"""Approximate nearest neighbours by random projections, for more columns than the exact join can prune in.

Each of several tables hashes a vector to a cell: on which side of the median it lies along random directions, as many as leave
about ``leaf`` vectors to a cell. A cell that holds more is halved again at its own median along a further direction, until none
does, so no vector meets more than ``tables * leaf`` others whatever the data. Neighbours within the cells of all tables are
compared exactly and the nearest kept. Identical vectors are collapsed first.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from math import log2

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from riskloom.operators.neighbours import _collapsed, _distances, _expanded, _first_k, nearest
from riskloom.session import settle

#: Halvings of large cells; each at least splits off what lies beyond its median.
MAX_TURNS = 64


def _directions(dims: int, tables: int, seed: int, turn: int) -> np.ndarray:
    return np.random.default_rng([seed, turn]).normal(size=(dims, tables))


def _hashed(once: DataFrame, dims: int, tables: int, bits: int, seed: int) -> DataFrame:
    """(vid, vec, table, cell): sides of the medians along ``bits`` directions of each table."""
    shape = once.select("vid", "vec").schema
    ways = np.concatenate([_directions(dims, tables, seed, turn) for turn in range(bits)], axis=1) if bits else np.zeros((dims, 0))
    cuts = np.zeros(0)
    if bits:
        def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield pd.DataFrame({"p": list(np.stack(batch["vec"].to_numpy()) @ ways)})

        sides = once.select("vec").mapInPandas(project, "p array<double>")
        medians = sides.agg(*[F.percentile_approx(F.col("p")[i], 0.5, 1000) for i in range(ways.shape[1])]).first()
        cuts = np.array(list(medians), float)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            side = (np.stack(batch["vec"].to_numpy()) @ ways > cuts).reshape(len(batch), bits, tables)
            cell = (side * (1 << np.arange(bits))[None, :, None]).sum(axis=1)
            yield pd.DataFrame({"vid": np.repeat(batch["vid"].to_numpy(), tables), "vec": np.repeat(batch["vec"].to_numpy(), tables),
                                "table": np.tile(np.arange(tables), len(batch)), "cell": cell.reshape(-1)})

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shape)
    return once.select("vid", "vec").mapInPandas(hashed, f"{kinds}, table int, cell long")


def _halved(rows: DataFrame, dims: int, tables: int, seed: int, turn: int) -> DataFrame:
    """Every cell cut at its median along one more direction of its table."""
    ways = _directions(dims, tables, seed, turn).T
    names = F.array(*[F.array(*[F.lit(float(x)) for x in way]) for way in ways])
    p = F.aggregate(F.zip_with("vec", F.element_at(names, F.col("table") + 1), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    rows = rows.withColumn("p", p)
    medians = rows.groupBy("table", "cell").agg(F.percentile_approx("p", 0.5, 1000).alias("cut"))
    side = F.xxhash64("cell", F.lit(turn), F.col("p") > F.col("cut"))
    return rows.join(medians, ["table", "cell"]).select("vid", "vec", "table", side.alias("cell"))


def approximate_nearest(points: DataFrame, k: int, tables: int = 12, leaf: int = 256, seed: int = 42) -> DataFrame:
    """``points`` (id, vec) -> (id, rank, neighbour, distance): near rows, most of them the nearest; ties by id.

    Distances are exact. A row can have fewer than k neighbours only where there are no more rows. An empty table gives no rows.
    """
    once = _collapsed(points, k)
    n = once.count()
    if n == 0:
        return nearest(points, k)
    dims = len(once.first()["vec"])
    bits = max(0, int(log2(n / leaf))) if n > leaf else 0
    open_, done = settle(_hashed(once, dims, tables, bits, seed), "hashed"), None
    for turn in range(bits, bits + MAX_TURNS):
        large = settle(open_.groupBy("table", "cell").count().where(F.col("count") > leaf).select("table", "cell"), "large-cells")
        small = open_.join(large, ["table", "cell"], "left_anti") if not large.isEmpty() else open_
        done = small if done is None else done.unionByName(small)
        if large.isEmpty():
            break
        open_ = settle(_halved(open_.join(large, ["table", "cell"], "left_semi"), dims, tables, seed, turn), "halved")

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        ids, x = cell["vid"].to_numpy(), np.stack(cell["vec"].to_numpy())
        d = _distances(x, x)
        near = np.argsort(d, axis=1, kind="stable")[:, : k + 1]
        return pd.DataFrame({"vid": np.repeat(ids, near.shape[1]), "other": ids[near.reshape(-1)], "distance": np.take_along_axis(d, near, 1).reshape(-1)})

    kind = once.schema["vid"].dataType.simpleString()
    ordered = done.groupBy("table", "cell").applyInPandas(lambda cell: compare(cell.sort_values("vid")), f"vid {kind}, other {kind}, distance double")
    best = _first_k(ordered.distinct(), ["vid"], k + 1, "distance", "other")
    return _expanded(points, once, best, k)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of exact neighbours (by distance, so that ties count) that were found."""
    near = found.groupBy("id").agg(F.max("distance").alias("reach"), F.count("*").alias("n"))
    hit = exact.join(found.select("id", "neighbour", F.lit(1).alias("hit")), ["id", "neighbour"], "left").join(near, "id", "left")
    return hit.agg(F.avg(F.coalesce(F.col("hit"), (F.col("distance") >= F.col("reach")).cast("int"), F.lit(0)))).first()[0] or 0.0


# Workers get this module with each job, so sessions built anywhere can run it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
