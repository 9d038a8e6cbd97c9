import json
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from riskloom.config import DEFAULT
from riskloom.plans.features import engineer_features
from riskloom.sources import deltas
from riskloom.sources.readers import read_event_stream
from riskloom.streaming import events, jobs

CFG = DEFAULT.with_(user_key_columns=("card1",), merchant_key_columns=("ProductCD",))
SCHEMA = "TransactionID long, TransactionDT long, TransactionAmt double, card1 long, ProductCD string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_payload_rules(spark):
    good = {"transaction_id": "t1", "transaction_amt": 5.5, "product_cd": "W", "transaction_dt": 10, "card1": 1000, "card4": ""}
    texts = [good, {**good, "product_cd": None}, {**good, "transaction_amt": "abc"}, {k: v for k, v in good.items() if k != "transaction_dt"}]
    df = spark.createDataFrame([(json.dumps(t),) for t in texts] + [("not json",)], "payload string")
    ok, bad = events.split_payload(df)
    assert ok.count() == 1
    assert sorted(r["rejected"] for r in bad.collect()) == ["product_cd", "transaction_amt", "transaction_dt", "transaction_id"]
    row = events.with_serving_defaults(events.to_transactions(ok)).first()
    assert (row["card1"], row["card4"], row["DeviceType"], row["TransactionDT"]) == (1000, "unknown", "unknown", 10)


def test_features_over_batches_late_rows_and_repeated_ids(spark, tmp_path):
    rows = [(i, t, float(i), 1 + i % 2, "W" if i % 3 else "H") for i, t in enumerate([0, 10, 10, 3000, 3599, 3600, 3601, 9000, 9000, 2_592_050])]
    slices = [rows[:4], rows[4:7] + rows[:2], rows[7:], [(99, 5, 1.0, 1, "W")]]  # repeats, then a late row
    history, out, source, checkpoint = (str(tmp_path / n) for n in ("h", "o", "s", "c"))
    for part in slices:
        frame(spark, part).coalesce(1).write.mode("append").parquet(source)
        jobs.stream_features(read_event_stream(spark, source, SCHEMA), history, out, checkpoint, CFG)
    keep = ["TransactionID", "user_tx_count_30d", "user_total_amount_30d", "velocity_1hr", "merchant_tx_count_30d", "merchant_unique_users_30d"]
    got = {r["TransactionID"]: tuple(r) for r in spark.read.parquet(out).select(*keep).collect()}
    want = {r["TransactionID"]: tuple(r) for r in engineer_features(frame(spark, rows), CFG, ties="strict").select(*keep).collect()}
    late = got.pop(99)
    assert got == want
    assert late[1:4] == (2, 1.0, 2)  # one strictly earlier row of the user, then itself
    assert spark.read.parquet(out).count() == len(rows) + 1


def test_retried_batch_replaces_itself(spark, tmp_path):
    history, out = str(tmp_path / "h"), str(tmp_path / "o")
    run = jobs.feature_batch(CFG, history, jobs.batch_sink(out))
    batch = frame(spark, [(1, 0, 1.0, 1, "W"), (2, 5, 1.0, 1, "W")])
    run(batch, 0)
    run(batch, 0)
    rows = spark.read.parquet(out).orderBy("TransactionID").collect()
    assert [(r["TransactionID"], r["user_tx_count_30d"]) for r in rows] == [(1, 1), (2, 2)]


def test_an_id_is_taken_once_whatever_its_time(spark, tmp_path):
    """Sent again 40 days later and with an early time: both lie outside the windows of the first row."""
    history, out, source, checkpoint = (str(tmp_path / n) for n in ("h", "o", "s", "c"))
    for t in (100 * 86400, 140 * 86400, 0):
        frame(spark, [(1, t, 1.0, 1, "W")]).write.mode("append").parquet(source)
        jobs.stream_features(read_event_stream(spark, source, SCHEMA), history, out, checkpoint, CFG)
    assert [(r["TransactionID"], r["TransactionDT"]) for r in spark.read.parquet(out).collect()] == [(1, 100 * 86400)]


def test_dedupe_and_late_rows_in_progress(spark, tmp_path):
    start = datetime(2024, 1, 1)
    schema = "id long, ts timestamp"
    source, out, checkpoint = (str(tmp_path / n) for n in ("s", "o", "c"))
    slices = [[(1, start), (1, start), (2, start + timedelta(hours=5))], [(2, start + timedelta(hours=5)), (3, start + timedelta(hours=1)), (4, start + timedelta(hours=6))]]
    for part in slices:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        once = events.dedupe_stream(read_event_stream(spark, source, schema), "id", "ts")
        jobs.run_to_parquet(once, out, checkpoint)
    # 3 is four hours behind the watermark; 2 is a repeat
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 4]


def test_scores_are_banded(spark, tmp_path):
    history, out, source, checkpoint = (str(tmp_path / n) for n in ("h", "o", "s", "c"))
    frame(spark, [(1, 0, 90.0, 1, "W"), (2, 5, 10.0, 1, "W")]).write.parquet(source)
    score = lambda f: f.select("TransactionID", (F.col("amount") / 100).alias("score"))
    jobs.stream_scores(read_event_stream(spark, source, SCHEMA), history, out, checkpoint, score, CFG)
    got = {r["TransactionID"]: (r["prediction"], r["confidence"]) for r in spark.read.parquet(out).collect()}
    assert got == {1: ("FRAUD", "HIGH"), 2: ("CLEAN", "HIGH")}


def test_feature_rows_are_upserted(spark, tmp_path):
    table, source, checkpoint = (str(tmp_path / n) for n in ("t", "s", "c"))
    latest = lambda: {r["TransactionID"]: r["TransactionAmt"] for r in deltas.read_latest(spark, table, "TransactionID", "TransactionDT").collect()}
    parts = [[(1, 0, 1.0, 1, "W"), (2, 5, 1.0, 1, "W")], [(1, 9, 7.0, 1, "W")], [(3, 1, 2.0, 1, "W"), (1, 2, 99.0, 1, "W")]]
    for n, part in enumerate(parts):
        frame(spark, part).write.mode("append").parquet(source)
        stream = read_event_stream(spark, source, SCHEMA)
        jobs.run_each_batch(stream, jobs.upsert_sink(table, "TransactionID", "TransactionDT"), checkpoint)
        assert sorted(os.listdir(f"{table}/deltas")) == [f"batch_id={k}" for k in range(n + 1)]  # each batch wrote its own
        assert latest() == [{1: 1.0, 2: 1.0}, {1: 7.0, 2: 1.0}, {1: 7.0, 2: 1.0, 3: 2.0}][n]
        if n == 0:
            deltas.compact(spark, table, "TransactionID", "TransactionDT")
            deltas.append_delta(frame(spark, parts[0]), table, 0, "TransactionID", "TransactionDT")  # a retry of what the base holds
            assert latest() == {1: 1.0, 2: 1.0}
    deltas.compact(spark, table, "TransactionID", "TransactionDT")
    assert latest() == {1: 7.0, 2: 1.0, 3: 2.0} and os.listdir(f"{table}/base") == ["upto=2"]


def test_known_ids_read_only_their_partitions(spark, tmp_path):
    path = str(tmp_path / "ids")
    take = lambda ids, n: sorted(r["id"] for r in deltas.take_new(spark.createDataFrame([(i,) for i in ids], "id long"), path, "id", n, 16).collect())
    assert take(range(200), 0) == list(range(200))
    assert take([5, 300], 1) == [300] and take([5, 300], 1) == [300]  # retried
    assert take([300, 7, 301], 2) == [301]
    few = deltas.known_ids(spark.createDataFrame([(5,), (300,)], "id long"), path, "id", 9, 16)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "id_part" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = {r[0].split("id_part=")[1].split("/")[0] for r in few.select(F.input_file_name()).collect()}
    assert 1 <= len(read) <= 2


def test_late_rows_are_counted(spark, tmp_path):
    start = datetime(2024, 1, 1)
    source, out, checkpoint = (str(tmp_path / n) for n in ("s", "o", "c"))
    counts = []
    for part in ([(1, start), (2, start + timedelta(hours=5))], [(3, start + timedelta(hours=1)), (4, start), (5, start + timedelta(hours=6))]):
        spark.createDataFrame(part, "id long, ts timestamp").coalesce(1).write.mode("append").parquet(source)
        once = events.dedupe_stream(read_event_stream(spark, source, "id long, ts timestamp"), "id", "ts")
        counts.append(jobs.LateRows().after(spark, lambda: jobs.run_to_parquet(once, out, checkpoint)))
    assert counts == [0, 2]
