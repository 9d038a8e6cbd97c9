import random

import pytest
from pyspark.sql import functions as F

from riskloom.config import DEFAULT
from riskloom.functions.pvalues import chi_square_p, ks_p
from riskloom.functions.scalars import hour_bucket
from riskloom.operators import drift, shift
from riskloom.plans.drift import baseline_exclude, make_shifted_batch
from riskloom.sources import readers, sinks


def test_p_values_of_published_tables():
    for x, dof in ((3.841, 1), (5.991, 2), (7.815, 3), (9.488, 4), (18.307, 10)):
        assert chi_square_p(x, dof) == pytest.approx(0.05, abs=2e-5)
    assert chi_square_p(0.0, 0) == 1.0
    n = 10**6
    for lam, p in ((1.2238, 0.10), (1.3581, 0.05), (1.6276, 0.01), (0.8276, 0.5)):
        assert ks_p(lam / (n / 2) ** 0.5, n, n) == pytest.approx(p, abs=2e-4)
    assert ks_p(0.0, 5, 5) == 1.0 and ks_p(0.5, 0, 5) == 1.0


def frames(spark, ref, cur, kind="double"):
    return (spark.createDataFrame([(v,) for v in ref], f"x {kind}"), spark.createDataFrame([(v,) for v in cur], f"x {kind}"))


def test_ks_distance(spark):
    rng = random.Random(3)
    ref = [rng.choice([None, rng.randrange(30) / 2]) for _ in range(300)]
    cur = [rng.randrange(40) / 2 for _ in range(200)]
    row = drift.drift_ks(drift.tagged(*frames(spark, ref, cur), ["x"]), ["x"]).first()
    ref = [v for v in ref if v is not None]
    want = max(abs(sum(a <= v for a in ref) / len(ref) - sum(b <= v for b in cur) / len(cur)) for v in ref + cur)
    assert row["statistic"] == pytest.approx(want) and (row["n_ref"], row["n_cur"]) == (len(ref), 200)


def test_chi_square_with_and_without_yates(spark):
    two = drift.drift_chi_square(drift.tagged(*frames(spark, ["a"] * 10 + ["b"] * 20, ["a"] * 20 + ["b"] * 10, "string"), ["x"]), ["x"]).first()
    assert two["dof"] == 1 and two["statistic"] == pytest.approx(5.4)  # 4 * 4.5^2 / 15
    three = drift.drift_chi_square(drift.tagged(*frames(spark, list("aabbcc"), list("aaaabc"), "string"), ["x"]), ["x"]).first()
    assert three["dof"] == 2 and three["statistic"] == pytest.approx(2 * (1 / 3 + 0.25 / 1.5 + 0.25 / 1.5))


def test_degenerate_samples(spark):
    one = drift.drift_chi_square(drift.tagged(*frames(spark, ["a"] * 3, ["a"] * 4, "string"), ["x"]), ["x"]).first()
    assert one["statistic"] == 0.0 and chi_square_p(one["statistic"], one["dof"]) == 1.0
    assert drift.drift_ks(drift.tagged(*frames(spark, [1.0], [None]), ["x"]), ["x"]).count() == 0


def test_verdicts_and_skipped_features(spark):
    ref = spark.range(500).select(F.col("id").cast("double").alias("amount"), F.lit("debit").alias("card6"))
    cur = spark.range(500).select((F.col("id") * 1.6).alias("amount"), F.lit("debit").alias("card6"))
    tests = {r["feature_name"]: r for r in drift.drift_tests(ref, cur).collect()}
    assert set(tests) == {"amount", "card6"}
    assert tests["amount"]["drift_detected"] and not tests["card6"]["drift_detected"] and tests["card6"]["p_value"] == 1.0
    summary = drift.drift_summary(drift.drift_tests(ref, ref)).first()
    assert not summary["drift_detected"] and summary["drifted_share"] == 0.0


def test_hour_buckets(spark):
    rows = spark.createDataFrame([(h,) for h in (0, 2, 6, 7, 9, 12, 13, 14, 18, 19, 21, 23)], "h int")
    got = [r[0] for r in rows.select(hour_bucket(F.col("h"))).collect()]
    assert got == ["night"] * 3 + ["morning"] * 3 + ["afternoon"] * 3 + ["evening"] * 3


def shift_input(spark):
    return spark.range(200).select(
        F.col("id").alias("TransactionID"), F.lit(100.0).alias("TransactionAmt"), F.lit(0).alias("isFraud"),
        (1000 + F.col("id") * 1000).alias("TransactionDT"), F.lit("H").alias("ProductCD"), F.lit("discover").alias("card4"),
        F.lit("yahoo.com").alias("P_emaildomain"),
    )


def test_shift_golden(spark):
    df = shift_input(spark)
    assert shift.simulate_shift(df, 0.0) is df
    rows = shift.simulate_shift(df, 1.0).collect()
    assert {r["TransactionAmt"] for r in rows} == {160.0}
    assert 0 < sum(r["isFraud"] for r in rows) < 60
    for c, v in shift.COMMON.items():
        assert 20 < sum(r[c] == v for r in rows) < 110
    before = {r["TransactionID"]: r["TransactionDT"] for r in df.collect()}
    for r in rows:
        if r["isFraud"]:
            assert 9 <= r["TransactionDT"] % 86400 // 3600 <= 17 and r["TransactionDT"] // 86400 == before[r["TransactionID"]] // 86400
            assert r["TransactionDT"] % 3600 == before[r["TransactionID"]] % 3600
        else:
            assert r["TransactionDT"] == before[r["TransactionID"]]


def test_shift_skips_absent_columns_and_scales_engineered(spark):
    df = spark.createDataFrame([(1, 2.0, 4.0)], "TransactionID long, velocity_1hr double, merchant_tx_count_30d double")
    assert tuple(shift.simulate_shift(df, 1.0).first()) == (1, 6.0, 10.0)


def test_batches(spark, tmp_path):
    path = str(tmp_path / "batches")
    with pytest.raises(FileNotFoundError):
        readers.read_latest_batch(spark, path)
    for day, n in (("2024-01-01", 3), ("2024-01-02", 4), ("2024-01-02", 5)):
        sinks.write_batch(spark.range(n), path, day)
    assert readers.read_latest_batch(spark, path).count() == 5  # same day replaced
    assert readers.read_batches(spark, path).count() == 8  # other day kept


def test_small_tables_keep_half_as_baseline(spark):
    cfg = DEFAULT.with_(batch_rows=150)
    df = shift_input(spark)
    assert baseline_exclude(df, cfg).count() == 100
    wide = df.select("*", *[F.lit(1.0).alias(c) for c in ("card1", "card2", "card3", "card5", "addr1")], F.lit("debit").alias("card6"))
    batch = make_shifted_batch(wide, 0.5, cfg)
    assert batch.count() == 150 and "is_inference_batch" not in batch.columns
