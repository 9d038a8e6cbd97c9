from datetime import datetime, timedelta

from pyspark.sql import functions as F

from riskloom.operators import registry
from riskloom.sources import readers, sinks

NOW = datetime(2024, 5, 1, 12)


def gate(spark, hours_ago, notes=None, **options):
    rows = [(i, NOW - timedelta(hours=h), (notes or {}).get(i, "")) for i, h in enumerate(hours_ago)]
    log = spark.createDataFrame(rows, "id long, timestamp timestamp_ntz, notes string")
    row = registry.retrain_gate(log, F.lit(NOW).cast("timestamp_ntz"), **options).first()
    return row["allowed"], row["reason"]


def test_gate(spark):
    assert gate(spark, []) == (True, "")
    assert gate(spark, [30, 5.9]) == (False, "too_recent")
    assert gate(spark, [30, 6]) == (True, "")
    assert gate(spark, [23, 20, 7]) == (False, "daily_limit")
    assert gate(spark, [25, 20, 7]) == (True, "")
    assert gate(spark, [24, 20, 7]) == (False, "daily_limit")  # exactly a day ago counts


def test_gate_counts_every_run_of_the_day(spark):
    assert gate(spark, [23 - h for h in range(14)], max_per_day=12) == (False, "daily_limit")
    assert gate(spark, [23 - h for h in range(14)], max_per_day=15) == (True, "")


def test_gate_can_ignore_denied_runs(spark):
    notes = {1: "Denied by the gate: too_recent"}
    assert gate(spark, [10, 1], notes) == (False, "too_recent")
    assert gate(spark, [10, 1], notes, count_failures=False) == (True, "")


def registry_rows(spark, *rows):
    return spark.createDataFrame(
        [(i, name, run, f1, 0.0, 0.0, 0.0, prod) for i, (name, run, f1, prod) in enumerate(rows)],
        "id long, model_name string, run_id string, f1_score double, auc_score double, precision_score double, recall_score double, is_production boolean")


def test_production_metrics_and_precedence(spark):
    empty = registry_rows(spark, ("m", "a", 0.9, False))
    full = registry_rows(spark, ("m", "a", 0.5, True), ("m", "b", 0.6, True), ("m", "c", 0.9, False))
    assert registry.production_metrics(empty).first()["f1_score"] == 0.0
    assert registry.production_metrics(full).first()["f1_score"] == 0.6
    assert registry.production_metrics(empty, full).first()["f1_score"] == 0.6


def test_promotion_rule(spark):
    for candidate, production, want in ((0.51, 0.5, True), (0.505, 0.5, False), (0.0, 0.0, True), (0.1, 0.0, True)):
        rows = registry_rows(spark, ("m", "p", production, True), ("m", "c", candidate, False))
        assert registry.compare_with_production(rows).first()["promote"] is want
    assert registry.compare_with_production(registry_rows(spark, ("m", "c", 0.2, False))).first()["promote"] is True


def test_promote_stays_within_the_model(spark):
    rows = registry_rows(spark, ("m", "a", 0.1, True), ("m", "b", 0.1, False), ("other", "b", 0.1, False), ("other", "c", 0.1, True))
    got = [r["is_production"] for r in registry.promote(rows, "m", "b").orderBy("id").collect()]
    assert got == [False, True, False, True]
    events = spark.createDataFrame([("m", "a", 1), ("m", "b", 2)], "model_name string, run_id string, promoted_at long")
    assert [r["is_production"] for r in registry.with_promotions(rows, events).orderBy("id").collect()] == got


def test_append_log_numbers_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    for names in (["b", "a"], ["c"]):
        sinks.append_log(spark.createDataFrame([(n,) for n in names], "name string"), path, "name")
    assert [tuple(r) for r in spark.read.parquet(path).orderBy("id").collect()] == [(1, "a"), (2, "b"), (3, "c")]


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame(rows, "k string, v int, at int")
    sinks.upsert(frame([("a", 1, 1), ("b", 2, 1), ("a", 3, 2)]), path, "k", "at", buckets=4)
    sinks.upsert(frame([("b", 9, 5), ("c", 7, 5)]), path, "k", "at", buckets=4)
    assert {(r["k"], r["v"]) for r in spark.read.parquet(path).collect()} == {("a", 3), ("b", 9), ("c", 7)}


def test_reports_and_json_logs(spark, tmp_path):
    sinks.write_report(spark.range(1).select(F.struct(F.lit(0.5).alias("f1_score")).alias("metrics")), str(tmp_path / "r"))
    assert readers.read_json_log(spark, str(tmp_path / "r")).first()["metrics"]["f1_score"] == 0.5
    (tmp_path / "log.json").write_text('[\n {"id": 1, "x": "a"},\n {"id": 2, "x": "b"}\n]')
    assert readers.read_json_log(spark, str(tmp_path / "log.json"), "id INT, x STRING", array_file=True).count() == 2
