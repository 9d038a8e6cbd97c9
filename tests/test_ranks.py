import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions.scalars import hash32
from riskloom.operators import ranks


def test_quantiles_equal_numpy(spark):
    rng = random.Random(1)
    data = [(g, rng.choice([None, rng.randrange(50) / 4, rng.random() ** 8 * 1e6])) for g in "ab" for _ in range(400)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    for r in ranks.quantiles(df, "v", probs, group=["g"]).collect():
        values = [v for g, v in data if g == r["g"] and v is not None]
        for name, q in probs.items():
            assert r[name] == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_quantiles_per_series_and_single_value(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", 7.0), ("z", None)], "c string, v double")
    got = {r["c"]: r["m"] for r in ranks.quantiles(df, "v", {"m": 0.5}, series="c").collect()}
    assert got == {"x": 2.0, "y": 7.0}


def test_cumulative_over_buckets(spark):
    counts = spark.createDataFrame([(float(v), v + 1) for v in range(100)], "v double, n long")
    for buckets in (2, 16, 64):
        out = ranks.cumulative(counts, "v", ["n"], ranks.value_splits(counts, "v", buckets=buckets))
        assert all(r["n_below"] == sum(range(1, int(r["v"]) + 1)) for r in out.collect())


def test_flag_newest_with_ties(spark):
    df = spark.createDataFrame([(i, 10 if i < 8 else 5) for i in range(10)], "id long, t long")
    got = {r["id"] for r in ranks.flag_newest(df, 3, ["t", "id"], "f").where("f").collect()}
    assert got == {5, 6, 7}


def test_rank_cuts_are_exact(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7 == 0).cast("int").alias("y"))
    cuts = ranks.rank_cuts(df, "id", 42, "s", {0: [1, 1000, 4285], 1: [715, 3]}, "y")
    hashed = df.withColumn("h", hash32(42, "s", F.col("id"))).collect()
    for (label, rank), cut in cuts.items():
        order = sorted((r["h"], r["id"]) for r in hashed if r["y"] == label)
        assert order[rank - 1] == cut


def test_numbered_is_a_permutation(spark):
    got = [r["row_index"] for r in ranks.numbered(spark.range(3000), "id", 1, "n").collect()]
    assert sorted(got) == list(range(3000))
