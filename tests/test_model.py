from datetime import datetime, timedelta
from itertools import combinations
from math import factorial

import pytest
from pyspark.sql import functions as F

from riskloom.config import DEFAULT
from riskloom.operators import model
from riskloom.plans import jobs
from riskloom.plans.train import evaluate, fit, prepare

CFG = DEFAULT.with_(n_trees=4, max_depth=3, learning_rate=0.3, column_sample=1.0, use_smote=False, batch_rows=60)


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return spark.range(300).select(
        i.alias("TransactionID"), (10000 + i * 977).alias("TransactionDT"), ((i * 37 % 101 > 70) | (i % 29 == 0)).cast("int").alias("isFraud"),
        (i * 37 % 101 + 1.0).alias("TransactionAmt"), F.when(i % 2 == 0, "W").otherwise("H").alias("ProductCD"),
        (15000 + i % 5).alias("card1"), F.lit(321.0).alias("card2"), F.lit(150.0).alias("card3"),
        F.when(i % 3 == 0, "visa").otherwise("mastercard").alias("card4"), F.lit(226.0).alias("card5"),
        F.when(i % 4 == 0, "debit").otherwise("credit").alias("card6"), F.lit(1.0).alias("addr1"), F.lit("gmail.com").alias("P_emaildomain"),
    )


@pytest.fixture(scope="module")
def fitted(spark, rows):
    light = rows.select("TransactionID", "isFraud", F.col("TransactionAmt").alias("amount"), "card1", "ProductCD", "card6")
    processed, params = prepare(light, CFG)
    return processed, params, fit(processed, params, CFG)


def expected_value(table, node, x, known):
    """Mean prediction of a tree when only the known features are given."""
    if node["leftChild"] < 0:
        return node["prediction"]
    left, right = table[node["leftChild"]], table[node["rightChild"]]
    f, cut = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
    if f in known:
        return expected_value(table, left if x[f] <= cut else right, x, known)
    share = left["impurityStats"][0] / node["impurityStats"][0]
    return share * expected_value(table, left, x, known) + (1 - share) * expected_value(table, right, x, known)


def test_attributions_are_shapley_values_and_add_up(spark, fitted, tmp_path):
    processed, params, gbt = fitted
    path = str(tmp_path / "m")
    model.save_model(gbt, path)
    names = params.features
    scored = model.score(model.load_model(path), processed, names, ["TransactionID", *[f"`{f}`" for f in names]])
    explained = model.tree_attributions(scored, path, names, ["TransactionID", "score", *names]).collect()
    assert len(explained) == 300
    nodes = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        nodes.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    weights = gbt.treeWeights
    value = lambda x, s: sum(w * expected_value(nodes[t], nodes[t][0], x, s) for t, w in enumerate(weights))
    d = len(names)
    for r in explained:
        assert r["margin"] == pytest.approx(r["base"] + sum(r["contributions"].values()))
        assert 1 / (1 + 2.718281828459045 ** (-2 * r["margin"])) == pytest.approx(r["score"], abs=1e-9)
    for r in explained[:3]:
        x = [r[f] for f in names]
        for i, f in enumerate(names):
            others = [j for j in range(d) if j != i]
            phi = sum(
                factorial(k) * factorial(d - k - 1) / factorial(d) * (value(x, {*s, i}) - value(x, set(s)))
                for k in range(d) for s in combinations(others, k))
            assert r["contributions"][f] == pytest.approx(phi, abs=1e-9)


def test_evaluation_report(spark, fitted):
    processed, params, gbt = fitted
    result = evaluate(gbt, processed, params, CFG)
    row = result.report.first()
    assert set(row["metrics"].asDict()) >= {"f1_score", "precision_score", "recall_score", "roc_auc_score", "threshold", "true_positives"}
    assert 0.9 < row["metrics"]["roc_auc_score"] <= 1.0 and result.threshold in (0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7)
    assert len(row["local_explanations_sample"]) == 5 and max(row["global_importance"], key=row["global_importance"].get) == "amount"


def test_tuning_keeps_the_first_best(spark, fitted):
    processed, params, _ = fitted
    part = lambda s: processed.where(F.col("split") == s)
    trials = [{"max_depth": 1, "n_trees": 1}, {"max_depth": 3, "n_trees": 3}]
    best, results = model.tune(part("train"), part("val"), params.features, CFG, trials)
    first = next(t for t in results if t["f1_score"] == max(r["f1_score"] for r in results))
    assert best.getNumTrees == first["n_trees"] and [r["trial"] for r in results] == [0, 1]
    assert model.search_draws(5, 1) == model.search_draws(5, 1) and len(model.search_draws()) == 5


def test_drift_retrain_promote_and_gate(spark, rows, tmp_path):
    folder, batches = str(tmp_path / "w"), str(tmp_path / "b")
    jobs.generate_batch(rows, batches, "2024-01-01", 1.0, CFG)
    now = datetime(2024, 1, 1, 12)
    first = jobs.drift_then_retrain(spark, rows, batches, folder, "2024-01-01", CFG, now).first()
    assert first["promoted"] and first["old_f1"] == 0.0 and first["new_f1"] > 0
    current = jobs.production_registry(spark, folder).where("is_production").collect()
    assert len(current) == 1 and current[0]["f1_score"] == first["new_f1"]
    assert spark.read.parquet(f"{folder}/drift_log").count() >= 4
    denied = jobs.retrain(spark, rows, folder, CFG, now=now + timedelta(hours=1)).first()
    assert not denied["promoted"] and denied["notes"].startswith("Denied by the gate")
    assert jobs.production_registry(spark, folder).count() == 1
    forced = jobs.retrain(spark, rows, folder, CFG, force=True, now=now + timedelta(hours=2), batch_dir=batches).first()
    assert forced["old_f1"] == first["new_f1"]
    assert spark.read.parquet(f"{folder}/retrain_log").agg(F.max("id")).first()[0] == 3
