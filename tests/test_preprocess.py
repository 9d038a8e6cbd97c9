import pytest
from pyspark.sql import functions as F

from riskloom.config import DEFAULT
from riskloom.operators import encode, sampling
from riskloom.operators.cleaning import DataValidationError
from riskloom.operators.neighbours import smote
from riskloom.plans.train import prepare
from riskloom.sources.readers import read_processed
from riskloom.sources.sinks import write_splits

CFG = DEFAULT.with_(validation_size=0.2, test_size=0.2, smote_strategy=1.0, categorical_columns=("ProductCD", "card4", "card6"))


@pytest.fixture(scope="module")
def forty(spark):
    i = F.col("id")
    pick = lambda n, *v: F.element_at(F.array(*[F.lit(x) for x in v]), (i % n + 1).cast("int"))
    return spark.range(40).select(
        i.alias("TransactionID"), (i * 2500).alias("TransactionDT"), (i >= 28).cast("int").alias("isFraud"),
        (i * 7 % 40 + 5.0).alias("amount"), (i % 24).cast("int").alias("hour"), (i * 13 % 17).cast("double").alias("card2"),
        pick(3, "W", "C", "R").alias("ProductCD"), pick(2, "visa", "mastercard").alias("card4"), pick(2, "debit", "credit").alias("card6"),
    )


def test_quotas():
    assert sampling.split_quotas([28, 12], CFG) == [(17, 6), (7, 2)]
    assert sampling.proportional([1, 1, 1], 2) == [1, 1, 0]


def test_split_sizes_and_smote(spark, forty):
    processed, params = prepare(forty, CFG)
    counts = {(r["split"], r["isFraud"]): r["count"] for r in processed.groupBy("split", "isFraud").count().collect()}
    assert counts[("train", 0)] == counts[("train", 1)] == 17
    assert counts[("val", 0)] + counts[("val", 1)] == 8 and counts[("test", 0)] + counts[("test", 1)] == 8
    inference = encode.apply_preprocess(forty.drop("isFraud").limit(5), params)
    assert inference.columns == params.features and inference.count() == 5


def test_random_oversampling_counts(spark, forty):
    out = sampling.random_oversample(forty, "TransactionID", CFG)
    assert out.where("isFraud = 1").count() == out.where("isFraud = 0").count() == 28
    assert out.where("copy_no is not null and isFraud = 0").count() == 0


def test_category_limit_holds_for_each_column(spark):
    wide = spark.range(6000).selectExpr("concat('a', id) AS p", "concat('b', id) AS q")
    assert [len(v) for v in encode.fit_categories(wide, ["p", "q"]).values()] == [6000, 6000]
    with pytest.raises(DataValidationError):
        encode.fit_categories(spark.range(encode.MAX_CATEGORIES + 1).selectExpr("concat('a', id) AS p"), ["p"])


def test_smote_rows_lie_on_their_segments(spark, forty):
    out = smote(forty, "TransactionID", ["amount", "card2"], CFG)
    rows = {r["TransactionID"]: r for r in out.where("copy_no is null").collect()}
    made = out.where("copy_no is not null").collect()
    assert len(made) == 16
    for r in made:
        a, b = rows[r["base_id"]], rows[r["neighbour_id"]]
        assert a["isFraud"] == b["isFraud"] == r["isFraud"] == 1 and r["base_id"] != r["neighbour_id"]
        for c in ("amount", "card2"):
            assert min(a[c], b[c]) - 1e-9 <= r[c] <= max(a[c], b[c]) + 1e-9


def test_oversampling_errors(spark, forty):
    with pytest.raises(DataValidationError, match="at least 6"):
        smote(forty.where("TransactionID < 31"), "TransactionID", ["amount"], CFG)
    with pytest.raises(DataValidationError, match="already exceeds"):
        sampling.random_oversample(forty, "TransactionID", CFG.with_(smote_strategy=0.1))


def test_missing_label(spark, forty):
    with pytest.raises(DataValidationError, match="missing"):
        sampling.stratified_split(forty.drop("isFraud"), "TransactionID", CFG)


def test_one_hot_drops_first_and_zeroes_unknown(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    categories = encode.fit_categories(train, ["c"])
    assert categories == {"c": ["a", "b", "unknown"]}
    rows = spark.createDataFrame([("a",), ("b",), ("zzz",), (None,)], "c string").select(*encode.one_hot_columns(categories))
    assert [tuple(r) for r in rows.collect()] == [(0.0, 0.0), (1.0, 0.0), (0.0, 0.0), (0.0, 1.0)]


def test_constant_columns_and_absent_columns(spark):
    train = spark.createDataFrame([(i, i % 2, 4.0, float(i) if i else None) for i in range(5)], "TransactionID long, isFraud int, k double, v double")
    params = encode.fit_preprocess(train)
    assert params.medians == {"k": 4.0, "v": 2.5} and params.deviations["k"] == 1.0
    out = encode.apply_preprocess(train, params, ["TransactionID"]).orderBy("TransactionID").first()
    assert out["k"] == 0.0 and out["v"] == 0.0  # imputed with the median, which is the mean here
    assert encode.apply_preprocess(train.drop("v"), params).select("v").distinct().collect()[0][0] == 0.0


def test_params_round_trip(spark, forty, tmp_path):
    params = encode.fit_preprocess(forty, CFG)
    params.save(spark, str(tmp_path / "p"))
    assert encode.PreprocessParams.load(spark, str(tmp_path / "p")) == params


def test_processed_table(spark, forty, tmp_path):
    rows = sampling.stratified_split(forty, "TransactionID", CFG)
    write_splits(rows, str(tmp_path / "p"))
    part = read_processed(spark, str(tmp_path / "p"), "val")
    assert part.count() == 8
    assert "PartitionFilters: [isnotnull(split" in part._jdf.queryExecution().executedPlan().toString()


def test_folds(spark):
    sizes = {r["fold"]: r["count"] for r in sampling.kfold_assign(spark.range(11), "id").groupBy("fold").count().collect()}
    assert sizes == {0: 4, 1: 4, 2: 3}
    assert sampling.sample_n(spark.range(100), "id", 7).count() == 7 and sampling.sample_n(spark.range(5), "id", 7).count() == 5
