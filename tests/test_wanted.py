"""Only the wanted features are planned, with the values of the whole frame."""

from riskloom.plans.drift import drift_frames
from riskloom.plans.features import engineer_features
from riskloom.sources import views

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wanted_columns_equal_those_of_the_whole_frame(spark):
    rows = views.txn(spark, SF)
    whole = engineer_features(rows)
    for wanted in (["TransactionID", "velocity_1hr", "amount"], ["TransactionID", "merchant_unique_users_30d"], ["TransactionID", "hour", "card6"]):
        some = engineer_features(rows, wanted=wanted)
        assert set(some.columns) == set(wanted)
        expected = whole.select(*some.columns)
        assert some.exceptAll(expected).isEmpty() and expected.exceptAll(some).isEmpty()


def test_unwanted_sweeps_are_not_planned(spark):
    rows = views.txn(spark, SF)
    plain = plan(engineer_features(rows, wanted=["hour", "card6"]))
    assert "Window" not in plain and "Exchange" not in plain
    user = plan(engineer_features(rows, wanted=["velocity_1hr"]))
    assert user.count("Exchange hashpartitioning") == 1


def test_category_drift_reads_no_window(spark):
    for side in drift_frames(views.txn(spark, SF).drop("ingest_seq"), 0.5, tested=["card6", "hour_bucket"]):
        assert "Window" not in plan(side)
