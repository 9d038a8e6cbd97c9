import json

from riskloom.config import load_config
from riskloom.main import main
from riskloom.plans import jobs
from riskloom.plans.features import engineer_features
from riskloom.plans.ingest import ingest_split


def test_the_whole_command_line(spark, tmp_path, capsys):
    raw, work = tmp_path / "raw", str(tmp_path / "work")
    raw.mkdir()
    lines = ["TransactionID,isFraud,TransactionDT,TransactionAmt,ProductCD,card1,card2,card3,card4,card5,card6"]
    for i in range(200):
        card4 = ("visa", "american express", "mastercard")[i % 3]
        lines.append(f"{i},{int(i * 37 % 101 > 80)},{10000 + i * 977},{i * 37 % 101 + 1.5},{'WH'[i % 2]},{15000 + i % 5},321.0,150.0,{card4},226.0,{('debit', 'credit')[i % 2]}")
    (raw / "train_transaction.csv").write_text("\n".join(lines) + "\n")
    config = tmp_path / "c.json"
    config.write_text(json.dumps({
        "features": {"user_key_columns": ["card1", "card2"], "merchant_key_columns": ["ProductCD", "card4"]},
        "model": {"xgboost": {"max_depth": 2, "n_estimators": 2, "learning_rate": 0.5, "subsample": 1.0, "colsample_bytree": 1.0}},
    }))
    options = ["--raw", str(raw), "--work", work, "--config", str(config)]
    say = lambda command, *more: (main([command, *options, *more], spark), capsys.readouterr().out.strip().splitlines()[-1])[1]
    assert "'transaction_rows_raw': 200" in say("preprocess")
    run = say("train")
    assert run.startswith("run-")
    assert "f1_score" in say("evaluate", "--run", run)
    main(["batch", *options, "--date", "2024-01-31", "--intensity", "1.0"], spark)
    assert "'promoted'" in say("drift", "--date", "2024-01-31")
    assert jobs.production_registry(spark, work).where("is_production").count() == 1
    joined, _ = ingest_split(spark, str(raw), "train")
    scored = jobs.score_batch(spark, engineer_features(joined, load_config(config)), work, run)
    assert scored.count() == 200 and set(scored.columns) == {"TransactionID", "score", "prediction", "confidence"}
    log = json.loads(next((tmp_path / "work" / "drift_log-reports" / "2024-01-31").glob("part-*")).read_text())
    assert log["run_date"] == "2024-01-31" and len(log["tests"]) == log["features_tested"]
    sent = [{"transaction_id": f"r{i}", "transaction_amt": 20.0 + i, "product_cd": "W", "transaction_dt": 300000 + i, "card1": 15000.0, "card2": 321.0,
             "card6": "debit"} for i in range(3)]
    (tmp_path / "requests.json").write_text("\n".join(json.dumps(x) for x in [*sent, sent[0], {"transaction_id": "bad"}]) + "\n")
    assert "'predictions': 3" in say("score", "--run", run, "--requests", str(tmp_path / "requests.json"), "--date", "2024-01-31")
    logged = spark.read.parquet(f"{work}/predictions").orderBy("transaction_id").collect()
    assert [r["transaction_id"] for r in logged] == ["r0", "r1", "r2"] and {r["card_label"] for r in logged} == {"debit (visa)"}
    assert all(0 <= r["score"] <= 1 and r["model_version"] == run for r in logged)
