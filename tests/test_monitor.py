import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.functions import scalars
from riskloom.operators import monitor


def test_bands_at_every_boundary(spark):
    cases = {0.0: ("CLEAN", "HIGH"), 0.1499: ("CLEAN", "HIGH"), 0.15: ("CLEAN", "MEDIUM"), 0.2999: ("CLEAN", "MEDIUM"),
             0.3: ("SUSPICIOUS", "MEDIUM"), 0.4999: ("SUSPICIOUS", "MEDIUM"), 0.5: ("FRAUD", "MEDIUM"), 0.6999: ("FRAUD", "MEDIUM"),
             0.7: ("FRAUD", "HIGH"), 1.0: ("FRAUD", "HIGH")}
    rows = spark.createDataFrame([(p,) for p in cases], "p double")
    got = rows.select("p", scalars.decision(F.col("p")).alias("d"), scalars.confidence(F.col("p")).alias("c")).collect()
    assert {r["p"]: (r["d"], r["c"]) for r in got} == cases


def test_labels_defaults_severity_search(spark):
    rows = spark.createDataFrame([("credit", "visa"), (None, None), ("", "unknown"), ("debit", "")], "k string, n string")
    k, n = F.col("k"), F.col("n")
    got = [tuple(r) for r in rows.select(scalars.scoring_card_label(k, n), scalars.log_card_label(k, n)).collect()]
    assert got == [("credit (visa)", "credit (visa)"), ("debit (visa)", "debit"), ("debit (unknown)", "debit"), ("debit (visa)", "debit")]
    rates = spark.createDataFrame([(0.0399,), (0.04,), (0.0599,), (0.06,)], "r double")
    assert [r[0] for r in rates.select(scalars.rate_severity(F.col("r"))).collect()] == ["green", "yellow", "yellow", "red"]
    assert rows.where(scalars.matches_search("ViS", k, n)).count() == 1


def test_key_text(spark):
    df = spark.createDataFrame([(1, 100.0, None), (2, 12345678.0, "x"), (3, -0.5, "")], "a int, b double, c string")
    got = [r[0] for r in df.select(scalars.composite_key(df, ["a", "b", "c"])).collect()]
    assert got == ["1_100.0_", "2_12345678.0_x", "3_-0.5_"]


def test_negative_times_floor(spark):
    df = spark.createDataFrame([(-1,)], "dt long")
    row = df.select(*[v.alias(k) for k, v in scalars.temporal_parts(F.col("dt")).items()]).first()
    assert tuple(row) == (-1, 23, 6, 1, -1)


def test_or_lookup_equals_pairs(spark):
    rng = random.Random(4)
    history = [(f"u{rng.randrange(4)}", f"m{rng.randrange(3)}", rng.randrange(100) / 4) for _ in range(80)]
    probes = [(i, f"u{rng.randrange(6)}", f"m{rng.randrange(5)}") for i in range(20)]
    out = monitor.history_or_lookup(
        spark.createDataFrame(probes, "id long, user_key string, merchant_key string"),
        spark.createDataFrame(history, "user_key string, merchant_key string, amount double"), "id", "amount")
    got = {r["id"]: (r["history_rows"], r["history_amount"]) for r in out.collect()}
    for i, u, m in probes:
        hit = [a for hu, hm, a in history if hu == u or hm == m]
        assert got[i] == (len(hit), pytest.approx(sum(hit)))
    one = monitor.history_rows(spark.createDataFrame(history, "user_key string, merchant_key string, amount double"), "u1", "m1")
    assert one.count() == sum(u == "u1" or m == "m1" for u, m, _ in history)


def test_recent_views(spark):
    ts = datetime(2024, 1, 1)
    predictions = spark.createDataFrame(
        [(i, str(i), 0.1 * (i % 10), "FRAUD" if i % 4 == 0 else "CLEAN", "v1", ts) for i in range(150)],
        "id long, transaction_id string, fraud_probability double, prediction string, model_version string, timestamp timestamp_ntz")
    features = spark.createDataFrame([("149", 250.5, "credit", "mastercard"), ("1", 1.0, "debit", "visa"), ("148", None, None, None)],
                                     "transaction_id string, amount double, card_type string, card_network string")
    rows = {r["id"]: r for r in monitor.recent_transactions(predictions, features).collect()}
    assert len(rows) == 100 and min(rows) == 50
    assert (rows[149]["amount"], rows[149]["card_type"]) == (250.5, "credit (mastercard)")
    assert (rows[148]["amount"], rows[148]["card_type"]) == (0.0, "debit") and rows[100]["amount"] == 0.0
    assert tuple(monitor.recent_fraud_rate(predictions).first()) == (0.25, 100)
    assert tuple(monitor.recent_fraud_rate(predictions.limit(0)).first()) == (0.0, 0)


def test_latency_skips_internal_paths(spark):
    rows = [(i, datetime(2024, 1, 1) + timedelta(seconds=i), p, v) for i, (p, v) in enumerate(
        [("/predict", 10.0), ("/api/health", 99.0), ("/x/grafana-metrics", 99.0), ("/drift", 20.0)])]
    log = spark.createDataFrame(rows, "id long, ts timestamp_ntz, path string, latency_ms double")
    assert monitor.recent_latency(log).first()[0] == 15.0
    assert monitor.recent_latency(log, 1).first()[0] == 20.0
    assert monitor.recent_latency(log.limit(0)).first()[0] == 0.0


def test_explanations_ranked_and_scaled(spark):
    df = spark.createDataFrame([(1, {"a": 0.1, "b": -0.4}), (2, {"a": 0.001}), (3, {})], "id long, m map<string,double>")
    got = [tuple(r) for r in monitor.ranked_explanations(df, "id", "m").orderBy("id", "rank").collect()]
    assert got == [(1, 1, "b", -0.4, 1.0), (1, 2, "a", 0.1, 0.25), (2, 1, "a", 0.001, 0.1)]
    kept = df.select(F.map_keys(scalars.explanation_kept(F.col("m"), 0.1))).collect()
    assert kept[0][0] == ["b"]


def test_drift_views(spark):
    rows = [(i, datetime(2024, 1, 1 + i // 4).date(), f"f{i % 3}", float(i), 0.5, i == 2, 0.1 * i) for i in range(9)]
    log = spark.createDataFrame(rows, "id long, run_date date, feature_name string, drift_score double, p_value double, drift_detected boolean, drift_intensity double")
    last = monitor.drift_latest_n(log, 5).collect()
    assert {r["id"] for r in last} == {4, 5, 6, 7, 8} and {str(r["run_date"]) for r in last} == {"2024-01-03"} and not last[0]["any_drift"]
    assert [r["id"] for r in monitor.drift_latest_date(log).collect()] == [8]
    pivot = {str(r["run_date"]): r for r in monitor.drift_pivot(log, ["f0", "f1", "f2"]).collect()}
    assert (pivot["2024-01-01"]["f0"], pivot["2024-01-01"]["intensity"], pivot["2024-01-03"]["f0"]) == (3.0, 0.0, None)
    assert [r["feature_name"] for r in monitor.drift_features(log, 2).collect()] == ["f0", "f1"]


def test_sliding_counts_equal_single_step(spark):
    rng = random.Random(6)
    rows = [(datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(4000)), rng.choice(["FRAUD", "CLEAN"])) for _ in range(200)]
    log = spark.createDataFrame(rows, "ts timestamp_ntz, p string")
    two = monitor.windowed_rate(log, "ts", "p", "24 hours", "1 hour").orderBy("window_start").collect()
    one = monitor.windowed_rate(log, "ts", "p", "24 hours", "1 hour", stepwise=False).orderBy("window_start").collect()
    assert two == one
