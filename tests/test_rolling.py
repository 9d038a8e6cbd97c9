import random

import pytest
from pyspark.sql import functions as F

from riskloom.config import DEFAULT
from riskloom.operators import rolling
from riskloom.plans.features import engineer_features

CFG = DEFAULT.with_(user_key_columns=("card1", "card2"), merchant_key_columns=("ProductCD", "card4"))


def rows_of(df, *columns):
    return [tuple(r) for r in df.orderBy("TransactionID").select(*columns).collect()]


def small(spark, rows):
    return spark.createDataFrame(
        rows, "TransactionID long, TransactionDT long, TransactionAmt double, card1 long, card2 double, ProductCD string, card4 string, card6 string"
    )


def test_temporal_and_keys_golden(spark):
    df = small(spark, [(1, 0, 100.0, 1000, 100.0, "W", "visa", "debit"), (2, 432000, 200.0, 2000, 200.0, "C", "mastercard", "credit")])
    out = engineer_features(df, CFG)
    assert rows_of(out, "hour", "day_of_week", "is_weekend") == [(0, 0, 0), (0, 5, 1)]
    assert rows_of(out, "user_key", "merchant_key") == [("1000_100.0", "W_visa"), ("2000_200.0", "C_mastercard")]


def test_rolling_golden(spark):
    df = small(spark, [(i + 1, t, a, 1000, 100.0, "W", "visa", "debit") for i, (t, a) in enumerate([(0, 10.0), (100, 20.0), (2592100, 30.0)])])
    out = engineer_features(df, CFG)
    assert rows_of(out, "user_tx_count_30d") == [(1,), (2,), (2,)]
    assert rows_of(out, "user_total_amount_30d") == [(10.0,), (30.0,), (50.0,)]
    assert rows_of(out, "user_avg_amount_30d") == [(10.0,), (15.0,), (25.0,)]
    assert rows_of(out, "velocity_1hr") == [(1,), (2,), (1,)]


def brute(rows, ties, window):
    """rows: (id, key, value, t, amount) -> id -> (count of amounts, sum, distinct values)."""
    out = {}
    for i, k, v, t, a in rows:
        def seen(j, s):
            if s < t - window or s > t:
                return False
            if ties == "peers":
                return True
            if ties == "sequential":
                return s < t or j <= i
            return s < t or j == i
        near = [r for r in rows if r[1] == k and seen(r[0], r[3])]
        amounts = [r[4] for r in near if r[4] is not None]
        out[i] = (len(amounts), round(sum(amounts), 6), len({r[2] for r in near}))
    return out


@pytest.mark.parametrize("ties", ["sequential", "peers", "strict"])
@pytest.mark.parametrize("chunk_rows", [1_000_000, 7])
def test_sweep_equals_brute_force(spark, ties, chunk_rows):
    """Ties, nulls, eviction on the exact edge, and one key that holds most rows, whole and cut into chunks."""
    rng = random.Random(5)
    rows = [
        (i, "hot" if rng.random() < 0.6 else f"k{rng.randrange(4)}", f"u{rng.randrange(5)}", rng.randrange(0, 300),
         None if rng.random() < 0.1 else rng.randrange(1, 1000) / 100)
        for i in range(150)
    ]
    df = spark.createDataFrame(rows, "id long, key string, value string, t long, amount double")
    window = 40
    stats = rolling.rolling_user_stats(df, "key", "amount", "t", ["id"], window, ties, chunk_rows)
    unique = rolling.rolling_unique(df, "key", "value", "t", ["id"], window, "users", ties, chunk_rows)
    want = brute(rows, ties, window)
    got = {r["id"]: (r["tx_count"], round(r["total_amount"], 6)) for r in stats.collect()}
    assert got == {i: w[:2] for i, w in want.items()}
    if ties != "peers":  # which rows of a tie count as earlier is the point of the other two rules
        assert {r["id"]: r["users"] for r in unique.collect()} == {i: w[2] for i, w in want.items()}
    means = {r["id"]: r["avg_amount"] for r in stats.collect()}
    assert all(means[i] == 0.0 for i, w in want.items() if w[0] == 0)


def test_hot_keys_are_found_and_bounded(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("t"))
    hot = rolling.hot_keys(df, ["k"], "t", 100)
    assert [(r["k"], r["_width"]) for r in hot.table.collect()] == [("hot", 100)]
    assert not rolling.hot_keys(df, ["k"], "t", 1000)
    both = rolling.hot_text_keys(df.withColumn("other", F.lit("x")), ["k", "other"], "t", 100)
    assert [r["k"] for r in both["k"].table.collect()] == ["hot"] and [r["other"] for r in both["other"].table.collect()] == ["x"]


def test_busy_chunks_are_cut_again(spark):
    """Nine tenths of a key lie in its first hour of a year; no chunk holds more than twice the wanted rows."""
    rows = [(i, "hot", i * 7 % 3600 if i % 10 else i * 31_000 % 31_536_000) for i in range(4000)] + [(9000 + i, "cold", i) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, k string, t long")
    cut = rolling._chunked(df, rolling.hot_keys(df, ["k"], "t", 200), ["k"], F.col("t"), 400).groupBy("k", "_chunk").agg(
        F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).orderBy("k", "lo").collect()
    assert [(r["k"], r["n"]) for r in cut if r["k"] == "cold"] == [("cold", 50)]
    hot = [r for r in cut if r["k"] == "hot"]
    assert max(r["n"] for r in hot) <= 400 and sum(r["n"] for r in hot) == 4000
    assert all(a["hi"] < b["_chunk"] <= b["lo"] for a, b in zip(hot, hot[1:]))


def test_one_second_is_not_parted(spark):
    df = spark.range(100).select(F.lit("hot").alias("k"), (F.col("id") / 90).cast("long").alias("t"))
    cut = rolling._chunked(df, rolling.hot_keys(df, ["k"], "t", 5), ["k"], F.col("t"), 10)
    assert sorted(r["count"] for r in cut.groupBy("_chunk").count().collect()) == [10, 90]


def test_hot_features_equal_whole_ones(spark):
    rows = [(i, i * 977 % 5000, float(i), 1000, 1.0, "W", "visa" if i % 5 else "amex", "debit") for i in range(200)]
    plain = engineer_features(small(spark, rows), CFG.with_(user_window=700, merchant_window=900, velocity_window=90))
    cut = engineer_features(small(spark, rows), CFG.with_(user_window=700, merchant_window=900, velocity_window=90, chunk_rows=20))
    assert rows_of(plain, *plain.columns) == rows_of(cut, *plain.columns)


def test_no_hot_keys_means_one_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"), "id")
    plan = rolling.rolling_count(df, "k", "t", ["id"], 10, "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_unknown_tie_rule(spark):
    with pytest.raises(ValueError):
        rolling.rolling_count(spark.range(1).select("id", F.lit(1).alias("k")), "k", "id", ["id"], 1, "n", "other")


@pytest.mark.parametrize("chunk_rows", [1_000_000, 5])
def test_history_lookup_is_strict(spark, chunk_rows):
    history = spark.createDataFrame(
        [("a", t, 1.0) for t in (0, 10, 20, 20, 30)] + [("b", 20, 5.0)] + [("a", 20, None)], "k string, t long, amount double")
    probes = spark.createDataFrame([(1, "a", 20, 100.0), (2, "a", 40, 1.0), (3, "c", 5, 2.0)], "id long, k string, t long, amount double")
    out = rolling.history_lookup(probes, history, "k", "t", "id", "amount", 20, 10, chunk_rows).orderBy("id")
    assert [(r[0], r["user_tx_count_30d"], r["user_total_amount_30d"], r["velocity_1hr"]) for r in out.collect()] == [
        (1, 3, 102.0, 2), (2, 4, 4.0, 2), (3, 1, 2.0, 1),
    ]
