"""Encoding, imputation, scaling, splits, samples, oversampling, decisions and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import query
from riskloom.catalog.sql import SCORED, SPLIT, TXN, h32, h60, keyed, sql, u
from riskloom.functions import scalars
from riskloom.operators import cleaning, encode, monitor, neighbours, projections, sampling
from riskloom.plans.features import add_temporal
from riskloom.sources import readers, views

CATEGORICAL = ("ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain")
NUMERIC = ("amount", "hour", "day_of_week", "is_weekend", "month", "card1", "card2", "card3", "card5", "addr1")
# What the given tables hold, in sorted order; the first of each is dropped by the encoder.
CATEGORIES = {
    "ProductCD": ["C", "H", "R", "S", "W"],
    "card4": ["american express", "discover", "mastercard", "unknown", "visa"],
    "card6": ["credit", "debit"],
    "P_emaildomain": ["gmail.com", "outlook.com", "unknown", "yahoo.com"],
    "R_emaildomain": ["gmail.com", "unknown"],
}


def plain(name: str) -> str:
    return name.replace(".", "_").replace(" ", "_")


def with_plain_names(df):
    return df.toDF(*[plain(c) for c in df.columns])


def base_frame(spark, d):
    """Transactions with temporal parts; sign-ups above 90 have lost their amount."""
    rows = add_temporal(views.txn(spark, d)).withColumnRenamed("TransactionAmt", "amount").drop("ingest_seq", "TransactionDT")
    return rows.withColumn("amount", F.when(~((F.col("ProductCD") == "H") & (F.col("amount") > 90)), F.col("amount")))


BASE = """base AS (SELECT * EXCLUDE (TransactionAmt),
  CASE WHEN ProductCD = 'H' AND TransactionAmt > 90 THEN NULL ELSE TransactionAmt END AS amount FROM split_keyed)"""
BASE_CTES = (TXN, SPLIT, keyed("split", "split_keyed"), BASE)

ONE_HOT_SQL = ", ".join(
    f"CASE WHEN coalesce({c}, 'unknown') = '{v}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS {plain(f'{c}_{v}')}"
    for c, vs in CATEGORIES.items() for v in vs[1:]
)
MEDIANS = "med AS (SELECT " + ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}_med" for c in NUMERIC) + " FROM base WHERE split = 'train')"
STATS = ("st AS (SELECT " + ", ".join(
    f"avg(coalesce(CAST({c} AS DOUBLE), {c}_med)) AS {c}_mean, coalesce(nullif(stddev_pop(coalesce(CAST({c} AS DOUBLE), {c}_med)), 0), 1) AS {c}_sd"
    for c in NUMERIC) + " FROM base, med WHERE split = 'train')")


def fitted(spark, d):
    """The split frame and its training rows."""
    rows = sampling.stratified_split(base_frame(spark, d), "TransactionID")
    return rows, rows.where(F.col("split") == "train")


@query("fill_categorical", sql(TXN, body="SELECT TransactionID, " + ", ".join(f"coalesce({c}, 'unknown') AS {c}" for c in CATEGORICAL) + " FROM txn"))
def fill_categorical(spark, d):
    return encode.fill_categorical(views.txn(spark, d).select("TransactionID", *CATEGORICAL), CATEGORICAL)


@query("stratified_split", sql(TXN, SPLIT, body="SELECT TransactionID, isFraud, split FROM split"))
def stratified_split(spark, d):
    return sampling.stratified_split(views.txn(spark, d).select("TransactionID", "isFraud"), "TransactionID")


@query("one_hot", sql(*BASE_CTES, body=f"SELECT TransactionID, {ONE_HOT_SQL} FROM base"))
def one_hot(spark, d):
    rows, train = fitted(spark, d)
    categories = encode.fit_categories(train, CATEGORICAL)
    return with_plain_names(rows.select("TransactionID", *encode.one_hot_columns(categories)))


@query("impute_median", sql(*BASE_CTES, MEDIANS, body="SELECT TransactionID, " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), {c}_med) AS {c}" for c in NUMERIC) + " FROM base, med"))
def impute_median(spark, d):
    rows, train = fitted(spark, d)
    return encode.impute_median(rows, encode.fit_medians(train, NUMERIC)).select("TransactionID", *NUMERIC)


@query("standard_scale", sql(*BASE_CTES, MEDIANS, STATS, body="SELECT TransactionID, " + ", ".join(
    f"round((coalesce(CAST({c} AS DOUBLE), {c}_med) - {c}_mean) / {c}_sd, 6) + 0 AS {c}" for c in NUMERIC) + " FROM base, med, st"))
def standard_scale(spark, d):
    rows, train = fitted(spark, d)
    medians = encode.fit_medians(train, NUMERIC)
    means, deviations = encode.fit_scaling(train, medians)
    scaled = [F.round(encode.scaled(encode.imputed(c, medians), means[c], deviations[c]), 6).alias(c) for c in NUMERIC]
    return rows.select("TransactionID", *scaled)


@query("apply_preprocess", sql(*BASE_CTES, MEDIANS, STATS, body="SELECT TransactionID, isFraud, split, " + ", ".join(
    f"round((coalesce(CAST({c} AS DOUBLE), {c}_med) - {c}_mean) / {c}_sd, 6) + 0 AS {c}" for c in NUMERIC) + f", {ONE_HOT_SQL} FROM base, med, st"))
def apply_preprocess(spark, d):
    rows, train = fitted(spark, d)
    params = encode.fit_preprocess(train)
    out = encode.apply_preprocess(rows, params, ("TransactionID", "isFraud", "split"))
    return with_plain_names(out.withColumns({c: F.round(c, 6) for c in params.numeric}))


@query("align_features", sql(TXN, body="""SELECT TransactionID, TransactionAmt, CAST(0 AS DOUBLE) AS velocity_1hr, card2,
  CAST(0 AS DOUBLE) AS ProductCD_W FROM txn"""))
def align_features(spark, d):
    return encode.align_features(views.txn(spark, d), ["TransactionAmt", "velocity_1hr", "card2", "ProductCD_W"], ["TransactionID"])


UNLABELLED = "CASE WHEN ProductCD = 'S' THEN NULL ELSE isFraud END AS isFraud"


@query("drop_null_label", sql(TXN, f"l AS (SELECT TransactionID, {UNLABELLED} FROM txn)", body="SELECT * FROM l WHERE isFraud IS NOT NULL"))
def drop_null_label(spark, d):
    rows = views.txn(spark, d).select("TransactionID", F.when(F.col("ProductCD") != "S", F.col("isFraud")).alias("isFraud"))
    return cleaning.drop_null(rows, "isFraud")


@query("training_union", sql(TXN, body="""SELECT TransactionID, TransactionAmt, TransactionDT, ProductCD, card6, CAST(isFraud AS VARCHAR) AS isFraud FROM txn
UNION ALL SELECT TransactionID, TransactionAmt * 1.5::DOUBLE, TransactionDT, ProductCD, NULL,
  CASE WHEN ProductCD <> 'S' THEN CAST(isFraud AS VARCHAR) END FROM txn"""))
def training_union(spark, d):
    raw = views.txn(spark, d).select("TransactionID", "TransactionAmt", "TransactionDT", "ProductCD", "card6", "isFraud")
    batch = raw.select(
        "TransactionID", (F.col("TransactionAmt") * 1.5).alias("amount"), "TransactionDT", "ProductCD",
        F.when(F.col("ProductCD") != "S", F.col("isFraud")).alias("isFraud"), F.lit(1).alias("hour"),
    )
    return readers.union_training(raw, [batch]).withColumn("isFraud", F.col("isFraud").cast("string"))


@query("category_union", sql(TXN, body="SELECT DISTINCT P_emaildomain AS category FROM txn WHERE P_emaildomain IS NOT NULL UNION SELECT R_emaildomain FROM txn WHERE R_emaildomain IS NOT NULL"))
def category_union(spark, d):
    rows = views.txn(spark, d)
    sides = [rows.where(F.col(c).isNotNull()).select(F.col(c).alias("category")) for c in ("P_emaildomain", "R_emaildomain")]
    return sides[0].union(sides[1]).distinct()


# --- samples ----------------------------------------------------------------------------------------------


@query("sample_n", f"""SELECT line_id, l_quantity FROM (SELECT l_orderkey * 10 + l_linenumber AS line_id, l_quantity FROM lineitem)
ORDER BY {h32('sample', 'line_id')}, line_id LIMIT 10000""")
def sample_n(spark, d):
    """A sampling operator, on a table with more rows than the sample."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    return sampling.sample_n(lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"), "l_quantity"), "line_id")


@query("kfold_assign", sql(TXN, f"""r AS (SELECT TransactionID, row_number() OVER (ORDER BY {h32('fold', 'TransactionID')}, TransactionID) - 1 AS k, count(*) OVER () AS n FROM txn)""",
  """s AS (SELECT *, n // 3 AS q, n % 3 AS extra FROM r)""", body="""SELECT TransactionID, CAST(CASE
  WHEN k < q + CASE WHEN extra > 0 THEN 1 ELSE 0 END THEN 0
  WHEN k < 2 * q + least(extra, 2) THEN 1 ELSE 2 END AS INT) AS fold FROM s"""))
def kfold_assign(spark, d):
    return sampling.kfold_assign(views.txn(spark, d).select("TransactionID"), "TransactionID")


@query("random_oversample", sql(TXN, f"""m AS (SELECT TransactionID, isFraud, TransactionAmt,
    row_number() OVER (ORDER BY {h32('oversample', 'TransactionID')}, TransactionID) - 1 AS i FROM txn WHERE isFraud = 1)""",
  """c AS (SELECT count(*) FILTER (WHERE isFraud = 0) AS neg, count(*) FILTER (WHERE isFraud = 1) AS pos FROM txn)""",
  f"""draws AS (SELECT j, {h60('draw', 'j')} % pos AS i
    FROM c, (SELECT unnest(range(CAST((SELECT floor(0.3::DOUBLE * neg) - pos FROM c) AS BIGINT))) AS j))""",
  body="""SELECT TransactionID, isFraud, TransactionAmt, CAST(-1 AS BIGINT) AS copy_no FROM txn
UNION ALL SELECT TransactionID, isFraud, TransactionAmt, j FROM draws JOIN m USING (i)"""))
def random_oversample(spark, d):
    rows = views.txn(spark, d).select("TransactionID", "isFraud", "TransactionAmt")
    return sampling.random_oversample(rows, "TransactionID").fillna(-1, ["copy_no"])


# --- decisions and labels -----------------------------------------------------------------------------------


@query("decision_bands", sql(TXN, SCORED, body="""SELECT TransactionID, score,
  CASE WHEN score >= 0.5 THEN 'FRAUD' WHEN score >= 0.3 THEN 'SUSPICIOUS' ELSE 'CLEAN' END AS prediction,
  CASE WHEN score >= 0.7 THEN 'HIGH' WHEN score >= 0.15 THEN 'MEDIUM' ELSE 'HIGH' END AS confidence FROM scored"""))
def decision_bands(spark, d):
    p = F.col("score")
    return views.scored(spark, d).select(
        "TransactionID", "score", scalars.decision(p).alias("prediction"), scalars.confidence(p).alias("confidence")
    )


@query("card_label", sql(TXN, """c AS (SELECT TransactionID, CASE WHEN card1 % 7 <> 0 THEN card6 END AS kind, CASE WHEN card1 % 11 = 0 THEN '' ELSE card4 END AS net FROM txn)""",
  body="""SELECT TransactionID, coalesce(kind, 'debit') || ' (' || coalesce(nullif(net, ''), 'visa') || ')' AS scoring_label,
  coalesce(kind, 'debit') || CASE WHEN net IS NULL OR net IN ('', 'unknown') THEN '' ELSE ' (' || net || ')' END AS log_label FROM c"""))
def card_label(spark, d):
    rows = views.txn(spark, d).select(
        "TransactionID", F.when(F.col("card1") % 7 != 0, F.col("card6")).alias("kind"),
        F.when(F.col("card1") % 11 == 0, "").otherwise(F.col("card4")).alias("net"),
    )
    kind, net = F.col("kind"), F.col("net")
    return rows.select(
        "TransactionID", scalars.scoring_card_label(kind, net).alias("scoring_label"), scalars.log_card_label(kind, net).alias("log_label")
    )


@query("serve_defaults", sql(TXN, body="""SELECT TransactionID, coalesce(nullif(CASE WHEN card1 % 11 = 0 THEN '' ELSE card4 END, ''), 'unknown') AS card4,
  coalesce(P_emaildomain, 'unknown') AS P_emaildomain, coalesce(R_emaildomain, 'unknown') AS R_emaildomain FROM txn"""))
def serve_defaults(spark, d):
    net = F.when(F.col("card1") % 11 == 0, "").otherwise(F.col("card4"))
    return views.txn(spark, d).select(
        "TransactionID", scalars.filled(net, "unknown").alias("card4"),
        *[scalars.filled(F.col(c), "unknown").alias(c) for c in ("P_emaildomain", "R_emaildomain")],
    )


# Contributions of each event, as given numbers: amount, velocity and hour.
CONTRIBUTIONS = f"""contrib AS (
  SELECT event_id, 'amount' AS feature, (value - 50.0) / 100.0 AS contribution FROM events
  UNION ALL SELECT event_id, 'velocity_1hr', {u('velocity', 'event_id')} - 0.5::DOUBLE FROM events
  UNION ALL SELECT event_id, 'hour', ({u('hour', 'event_id')} - 0.5::DOUBLE) / 2000.0 FROM events)"""


def contributions(spark, d):
    event = F.col("event_id")
    return views.events(spark, d).select(
        "event_id",
        F.create_map(
            F.lit("amount"), (F.col("value") - 50.0) / 100.0,
            F.lit("velocity_1hr"), scalars.uniform(42, "velocity", event) - 0.5,
            F.lit("hour"), (scalars.uniform(42, "hour", event) - 0.5) / 2000.0,
        ).alias("contributions"),
    )


@query("explanation_filter", sql(CONTRIBUTIONS, body="SELECT event_id, feature, contribution FROM contrib WHERE abs(contribution) > 0.0001::DOUBLE"))
def explanation_filter(spark, d):
    kept = contributions(spark, d).select("event_id", scalars.explanation_kept(F.col("contributions")).alias("c"))
    return kept.select("event_id", F.explode("c").alias("feature", "contribution"))


@query("explanation_rank", sql(CONTRIBUTIONS, body="""SELECT event_id, feature, contribution,
  CAST(row_number() OVER (PARTITION BY event_id ORDER BY abs(contribution) DESC, feature) AS INT) AS rank,
  abs(contribution) / greatest(max(abs(contribution)) OVER (PARTITION BY event_id), 0.01::DOUBLE) AS bar FROM contrib"""))
def explanation_rank(spark, d):
    return monitor.ranked_explanations(contributions(spark, d), "event_id", "contributions")


def _knn_features(rows):
    """Two scaled numbers per row: amount and hour of the month."""
    return F.array(F.col("TransactionAmt") / 100.0, F.col("TransactionDT") / 864000.0)


@query("minority_knn", sql(TXN, """m AS (SELECT TransactionID AS id, TransactionAmt / 100.0 AS a, TransactionDT / 864000.0 AS b FROM txn WHERE isFraud = 1)""",
  """d AS (SELECT x.id, sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b)) AS dist, y.id AS other FROM m x JOIN m y ON x.id <> y.id)""",
  """k AS (SELECT id, dist, row_number() OVER (PARTITION BY id ORDER BY dist, other) AS rank FROM d)""",
  body="SELECT id, CAST(rank AS INT) AS rank, round(dist, 6) AS distance FROM k WHERE rank <= 5"))
def minority_knn(spark, d):
    rows = views.txn(spark, d).where(F.col("isFraud") == 1)
    points = rows.select(F.col("TransactionID").alias("id"), _knn_features(rows).alias("vec"))
    found = neighbours.nearest(points, 5)
    return found.select("id", "rank", F.round("distance", 6).alias("distance"))


@query("approximate_knn")
def approximate_knn(spark, d):
    """Five near rows of every positive over all encoded columns, by random projections; recall is held against the exact join in tests."""
    from riskloom.catalog.models import SMALL_MODEL, light_features
    from riskloom.plans.train import prepare

    processed, params = prepare(light_features(spark, d), SMALL_MODEL)
    vector = F.array(*[F.col(f"`{c}`").cast("double") for c in params.features])
    points = processed.where(F.col("isFraud") == 1).select(F.col("TransactionID").alias("id"), vector.alias("vec"))
    return projections.approximate_nearest(points, 5).select("id", "rank", "neighbour", F.round("distance", 6).alias("distance"))


SMOTE_SQL = sql(
    TXN, f"""m AS (SELECT TransactionID AS id, TransactionAmt / 100.0 AS a, TransactionDT / 864000.0 AS b,
  row_number() OVER (ORDER BY {h32('smote-base', 'TransactionID')}, TransactionID) - 1 AS i FROM txn WHERE isFraud = 1)""",
    """k AS (SELECT x.id, y.id AS other, row_number() OVER (PARTITION BY x.id ORDER BY sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b)), y.id) AS rank
  FROM m x JOIN m y ON x.id <> y.id)""",
    """c AS (SELECT count(*) FILTER (WHERE isFraud = 0) AS neg, count(*) FILTER (WHERE isFraud = 1) AS pos FROM txn)""",
    f"""draws AS (SELECT j, {h60('smote', 'j')} % (pos * 5) AS pick, {u('gap', 'j')} AS g
  FROM c, (SELECT unnest(range(CAST((SELECT floor(0.3::DOUBLE * neg) - pos FROM c) AS BIGINT))) AS j))""",
    body="""SELECT TransactionID, isFraud, round(TransactionAmt / 100.0, 9) AS amount, round(TransactionDT / 864000.0, 9) AS time,
  CAST(-1 AS BIGINT) AS copy_no, CAST(-1 AS BIGINT) AS base_id, CAST(-1 AS BIGINT) AS neighbour_id FROM txn
UNION ALL SELECT -1, 1, round(x.a + g * (y.a - x.a), 9), round(x.b + g * (y.b - x.b), 9), j, x.id, y.id
  FROM draws JOIN m x ON x.i = pick // 5 JOIN k ON k.id = x.id AND k.rank = pick % 5 + 1 JOIN m y ON y.id = k.other""")


@query("smote_oversample", SMOTE_SQL)
def smote_oversample(spark, d):
    rows = views.txn(spark, d).select(
        "TransactionID", "isFraud", (F.col("TransactionAmt") / 100.0).alias("amount"), (F.col("TransactionDT") / 864000.0).alias("time")
    )
    grown = neighbours.smote(rows, "TransactionID", ["amount", "time"]).withColumns({c: F.round(c, 9) for c in ("amount", "time")})
    return grown.fillna(-1, ["TransactionID", "copy_no", "base_id", "neighbour_id"])
