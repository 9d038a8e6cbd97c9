import pytest
from pyspark.sql import functions as F

from riskloom.config import DEFAULT, ConfigError, config_from_mapping, load_config
from riskloom.functions.scalars import to_micro
from riskloom.operators import cleaning
from riskloom.operators.cleaning import DataValidationError
from riskloom.plans.ingest import ingest, ingest_split
from riskloom.sources import readers

HEADER = "TransactionID,isFraud,TransactionDT,TransactionAmt,ProductCD,card1,card2,card3,card4,card5,card6,extra"
ROWS = [
    "1,0,100,10.0,W,1000,100.0,150.0,visa,226.0,debit,x",
    "2,1,200,,H,1000,,150.0,visa,226.0,credit,y",
    "2,1,300,999.0,H,1000,100.0,150.0,visa,226.0,credit,z",
    ",0,400,30.0,C,1000,100.0,150.0,visa,226.0,debit,w",
]


def write(folder, split="train", rows=ROWS, header=HEADER, identity=True):
    (folder / f"{split}_transaction.csv").write_text("\n".join([header, *rows]) + "\n")
    if identity:
        (folder / f"{split}_identity.csv").write_text("TransactionID,DeviceType\n1,mobile\n1,desktop\n2,desktop\n")
    return str(folder)


def test_ingest_golden(spark, tmp_path):
    joined, summary = ingest_split(spark, write(tmp_path), "train")
    got = {r["TransactionID"]: r for r in joined.collect()}
    assert sorted(got) == [1, 2]
    assert got[2]["TransactionAmt"] == 10.0  # median after dedupe
    assert got[1]["DeviceType"] == "mobile"  # first identity row
    s = summary.first().asDict()
    assert (s["transaction_rows_raw"], s["identity_rows_raw"], s["rows_after_cleaning"], s["rows_after_join"]) == (4, 2, 2, 2)
    assert (s["missing_transaction_ids"], s["duplicate_transaction_ids"], s["transaction_amount_nulls"]) == (1, 1, 1)
    assert s["label_rate"] == 0.5 and s["columns_after_join"] == len(joined.columns) == 13


def test_test_split_without_label_or_identity(spark, tmp_path):
    rows = [r.split(",", 2)[0] + "," + r.split(",", 2)[2] for r in ROWS]
    raw = write(tmp_path, "test", rows, HEADER.replace("isFraud,", ""), identity=False)
    joined, summary = ingest_split(spark, raw, "test")
    assert "DeviceType" not in joined.columns and joined.count() == 2
    assert summary.first()["label_rate"] is None and summary.first()["identity_rows_raw"] == 0


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda r, h: ([x.rsplit(",", 2)[0] + "," + x.rsplit(",", 1)[1] for x in r], h.replace("card6,", "")), "missing required columns: card6"),
        (lambda r, h: ([x.replace("10.0", "ten") for x in r], h), "TransactionAmt must be numeric"),
        (lambda r, h: ([x.replace("1,0,100", "1,2,100") for x in r], h), "must contain only 0 and 1"),
        (lambda r, h: (["," + x.split(",", 1)[1] for x in r], h), "cannot be entirely null"),
    ],
)
def test_validation_errors(spark, tmp_path, change, message):
    rows, header = change(ROWS, HEADER)
    with pytest.raises(DataValidationError, match=message):
        ingest_split(spark, write(tmp_path, "train", rows, header), "train")


def test_all_null_amounts_fail(spark, tmp_path):
    rows = [",".join("" if i == 3 else v for i, v in enumerate(x.split(","))) for x in ROWS]
    joined, _ = ingest_split(spark, write(tmp_path, rows=rows), "train")
    with pytest.raises(Exception, match="cannot be entirely null"):
        joined.collect()


def test_split_paths(spark, tmp_path):
    with pytest.raises(DataValidationError, match="No files are named"):
        readers.split_paths(spark, str(tmp_path), "other")
    with pytest.raises(FileNotFoundError):
        readers.split_paths(spark, str(tmp_path), "train")


def test_row_limit(spark, tmp_path, monkeypatch):
    raw = write(tmp_path)
    cfg = DEFAULT.with_(max_training_rows=2)
    assert [r["TransactionDT"] for r in readers.read_split(spark, raw, "train", cfg)[0].collect()] == [100, 200]
    monkeypatch.setenv("MAX_TRAINING_ROWS", "3")
    assert readers.read_split(spark, raw, "train", cfg)[0].count() == 3
    monkeypatch.setenv("MAX_TRAINING_ROWS", "many")
    assert readers.row_limit(cfg, "train") == 2 and readers.row_limit(cfg, "test") is None


def test_no_row_limit_by_default(spark):
    assert readers.row_limit(DEFAULT, "train") is None


def test_amounts_without_a_number(spark):
    rows = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "a double").select(to_micro(F.col("a")).alias("m")).collect()
    assert [r.m for r in rows] == [1_500_000, None, None]


def test_bool_labels_and_null_duplicates(spark, tmp_path):
    rows = [",True,1,1.0,W,1,1.0,1.0,visa,1.0,debit,a", ",False,2,1.0,W,1,1.0,1.0,visa,1.0,debit,b", "5,True,3,2.0,W,1,1.0,1.0,visa,1.0,debit,c"]
    joined, summary = ingest_split(spark, write(tmp_path, rows=rows), "train")
    assert joined.first()["isFraud"] == 1
    assert summary.first()["duplicate_transaction_ids"] == 1  # the second null id


def test_narrowing(spark):
    df = spark.createDataFrame([(1, 127, 40000, 1.5, True, "a"), (2, 3, 2, 2.5, False, "b")], "a long, b long, c long, d double, e boolean, f string")
    types = dict(cleaning.narrow(df).dtypes)
    assert types == {"a": "tinyint", "b": "smallint", "c": "int", "d": "float", "e": "boolean", "f": "string"}


def test_ingest_takes_frames_without_order_column(spark):
    df = spark.createDataFrame([(1, 0, 5, 1.0, "W", 1, 1.0, 1.0, "visa", 1.0, "debit")], ", ".join(
        f"{c} {readers.TRANSACTION_TYPES[c]}" for c in DEFAULT.required_train_columns))
    joined, _ = ingest(df.coalesce(1), None)
    assert joined.columns == list(DEFAULT.required_train_columns)


def test_config_file(tmp_path):
    file = tmp_path / "c.yaml"
    file.write_text('{"data": {"max_training_rows": 7}, "features": {"rolling_windows": {"user_days": 2}}, "model": {"xgboost": {"n_estimators": 9}}}')
    cfg = load_config(file)
    assert (cfg.max_training_rows, cfg.user_window, cfg.n_trees, cfg.velocity_window) == (7, 172800, 9, 3600)
    assert config_from_mapping({"data": {"max_training_rows": None}}).max_training_rows is None
    assert config_from_mapping({"data": {}, "model": {"name": None}}) == DEFAULT
    with pytest.raises(FileNotFoundError):
        load_config(tmp_path / "none.yaml")
    with pytest.raises(ConfigError):
        config_from_mapping([1])


def test_first_rows_follow_the_files_not_their_sizes(spark, tmp_path):
    folder = tmp_path / "raw" / "train_transaction.csv"
    folder.mkdir(parents=True)
    first = 0
    for part, n in enumerate((5, 5000, 50)):
        lines = [f"{first + i},0,{i},1.0" for i in range(n)]
        (folder / f"part-{part}.csv").write_text("\n".join(["TransactionID,isFraud,TransactionDT,TransactionAmt", *lines]) + "\n")
        first += n
    rows, _ = readers.read_split(spark, str(tmp_path / "raw"), "train", DEFAULT.with_(max_training_rows=7))
    assert sorted(r.TransactionID for r in rows.select("TransactionID").collect()) == list(range(7))
