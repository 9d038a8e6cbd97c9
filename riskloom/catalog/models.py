"""Model jobs: training, tuning, scoring, attributions, evaluation, retraining.

The ensembles here are smaller than the default configuration; the rows are the whole tables. SQL cannot grow trees, so
these queries return what must hold whatever the trees are, next to the ids, splits, counts and parameters that SQL can
state: rows and positives of each split, scores that follow from the confusion counts, bands that follow from the score,
attributions that add up to the margin and explain the score.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from riskloom.catalog import query
from riskloom.catalog.sql import SPLIT, TXN, keyed, sql
from riskloom.config import DEFAULT
from riskloom.functions.scalars import confidence, decision
from riskloom.operators import boosting, metrics, model
from riskloom.operators.sampling import stratified_split
from riskloom.plans.features import add_temporal
from riskloom.plans import jobs
from riskloom.plans.train import evaluate, fit, prepare
from riskloom.session import shared_path
from riskloom.sources import views

SMALL_MODEL = DEFAULT.with_(n_trees=5, max_depth=3, learning_rate=0.3, use_smote=False, column_sample=1.0)
SMALL_TRIALS = tuple({**t, "n_trees": max(2, t["n_trees"] // 60), "max_depth": t["max_depth"] // 2} for t in model.TRIALS)
SMALL_DRAWS = tuple({**x, "n_trees": x["n_trees"] // 50 + 1, "max_depth": x["max_depth"] // 2 + 1} for x in model.search_draws())


def light_features(spark, d):
    """Transactions with temporal parts and no rolling windows."""
    return add_temporal(views.txn(spark, d).drop("ingest_seq")).withColumnRenamed("TransactionAmt", "amount")


def _fitted(spark, d, cfg=SMALL_MODEL):
    processed, params = prepare(light_features(spark, d), cfg)
    return processed, params, fit(processed, params, cfg)


def _part(processed, split):
    return processed.where(F.col("split") == split)


def _near(a, b):
    return F.abs(a - b) < 1e-9


def follows_counts(tp, fp, fn):
    """Whether precision, recall and F1 are those of the confusion counts."""
    ratio = lambda top, bottom: F.when(bottom > 0, top / bottom).otherwise(0.0)
    return (_near(F.col("precision_score"), ratio(tp, tp + fp)) & _near(F.col("recall_score"), ratio(tp, tp + fn))
            & _near(F.col("f1_score"), ratio(2 * tp, 2 * tp + fp + fn)))


def follows_score():
    """Whether band and confidence are those of the score, by its cut points in rising order."""
    band = F.element_at(F.array(*[F.lit(x) for x in ("CLEAN", "CLEAN", "SUSPICIOUS", "FRAUD", "FRAUD")]), _place())
    sure = F.element_at(F.array(*[F.lit(x) for x in ("HIGH", "MEDIUM", "MEDIUM", "MEDIUM", "HIGH")]), _place())
    return (F.col("prediction") == band) & (F.col("confidence") == sure)


def _place():
    return sum((F.col("score") >= cut).cast("int") for cut in (0.15, 0.3, 0.5, 0.7)) + F.lit(1)


@query("train_model", sql(TXN, SPLIT, body="""SELECT split, count(*) AS n_rows, CAST(sum(isFraud) AS BIGINT) AS n_positive,
  true AS scores_follow, true AS beats_all_positive FROM split WHERE split <> 'train' GROUP BY split"""))
def train_model(spark, d):
    """A model trained on oversampled rows: confusion totals of the held-out splits; F1 above that of calling all positive."""
    processed, params, fitted = _fitted(spark, d, SMALL_MODEL.with_(use_smote=True, oversample_method="random"))
    rows = model.score(fitted, processed.where(F.col("split") != "train"), params.features, ["isFraud", "split"])
    counts = rows.groupBy("split").agg(*metrics.confusion_aggregates("isFraud", "score", 0.5))
    tn, fp, fn, tp = (F.col(c) for c in ("true_negatives", "false_positives", "false_negatives", "true_positives"))
    share = (fn + tp) / (tn + fp + fn + tp)
    return metrics.with_scores(counts).select(
        "split", (tn + fp + fn + tp).alias("n_rows"), (fn + tp).alias("n_positive"), follows_counts(tp, fp, fn).alias("scores_follow"),
        (F.col("f1_score") > 2 * share / (1 + share)).alias("beats_all_positive"),
    )


def _values(rows: list[dict], number: str) -> str:
    """Parameter sets as SQL rows."""
    kinds = {"max_depth": "BIGINT", "learning_rate": "DOUBLE", "n_trees": "BIGINT", "subsample": "DOUBLE"}
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS {number}, " + ", ".join(f"CAST({r[k]} AS {t}) AS {k}" for k, t in kinds.items()) + ", true AS scores_in_range"
        for i, r in enumerate(rows))


@query("tune_trials", _values(SMALL_TRIALS, "trial"))
def tune_trials(spark, d):
    processed, params = prepare(light_features(spark, d), SMALL_MODEL)
    _, trials = model.tune(_part(processed, "train"), _part(processed, "val"), params.features, SMALL_MODEL, SMALL_TRIALS)
    p, r, f1 = (F.col(c) for c in ("precision_score", "recall_score", "f1_score"))
    middle = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return spark.createDataFrame(trials).select("trial", *SMALL_TRIALS[0], (f1.between(0, 1) & _near(f1, middle)).alias("scores_in_range"))


@query("random_search", _values(SMALL_DRAWS, "draw"))
def random_search(spark, d):
    processed, params = prepare(light_features(spark, d), SMALL_MODEL)
    _, results = model.random_search(_part(processed, "train"), "TransactionID", params.features, SMALL_MODEL, SMALL_DRAWS)
    return spark.createDataFrame(results).select("draw", *SMALL_DRAWS[0], F.col("mean_f1").between(0, 1).alias("scores_in_range"))


@query("score", sql(TXN, SPLIT, body="SELECT TransactionID, isFraud, split, true AS score_in_range, true AS bands_follow FROM split"))
def score(spark, d):
    processed, params, fitted = _fitted(spark, d)
    rows = model.score(fitted, processed, params.features, ["TransactionID", "isFraud", "split"])
    rows = rows.withColumns({"prediction": decision(F.col("score")), "confidence": confidence(F.col("score"))})
    return rows.select("TransactionID", "isFraud", "split", F.col("score").between(0, 1).alias("score_in_range"), follows_score().alias("bands_follow"))


@query("score_requests", sql(TXN, body="""SELECT CAST(TransactionID AS VARCHAR) AS transaction_id, 'run-1' AS model_version,
  coalesce(card6, 'debit') || ' (' || coalesce(card4, 'visa') || ')' AS card_label, true AS score_in_range, true AS bands_follow,
  true AS explanation_kept FROM txn WHERE ProductCD IN ('R', 'C')"""))
def score_requests(spark, d):
    """Clicks and purchases as requests over the history of all other events: payload to prediction log."""
    _, params, fitted = _fitted(spark, d)
    folder, rows = shared_path(spark, "serving"), views.txn(spark, d).drop("ingest_seq")
    model.save_model(fitted, f"{folder}/models/run-1")
    params.save(spark, f"{folder}/models/run-1-preprocess")
    asked = F.col("ProductCD").isin("R", "C")
    fields = {"TransactionID": "transaction_id", "TransactionDT": "transaction_dt", "TransactionAmt": "transaction_amt", "ProductCD": "product_cd"}
    payload = F.to_json(F.struct(*[
        (F.col(c).cast("string") if c == "TransactionID" else F.col(c)).alias(fields.get(c, c)) for c in rows.columns if c != "isFraud"]))
    log, _ = jobs.predict_requests(spark, rows.where(asked).select(payload.alias("payload")), rows.where(~asked), folder, "run-1", SMALL_MODEL)
    return log.select(
        "transaction_id", "model_version", "card_label", F.col("score").between(0, 1).alias("score_in_range"),
        follows_score().alias("bands_follow"), F.forall(F.map_values("explanation"), lambda v: F.abs(v) > 1e-4).alias("explanation_kept"),
    )


@query("tree_attributions", sql(TXN, body="SELECT TransactionID, true AS adds_up, true AS explains_score FROM txn"))
def tree_attributions(spark, d):
    """Attributions add up to the margin, and 1 / (1 + exp(-2 margin)) is the score they must explain."""
    processed, params, fitted = _fitted(spark, d)
    path = shared_path(spark, "model")
    model.save_model(fitted, path)
    scored = model.score(fitted, processed, params.features, ["TransactionID", *[f"`{f}`" for f in params.features]])
    out = model.tree_attributions(scored, path, params.features, ["TransactionID", "score"])
    total = F.aggregate(F.map_values("contributions"), F.col("base"), lambda a, x: a + x)
    explained = 1.0 / (1.0 + F.exp(-2.0 * F.col("margin")))
    return out.select("TransactionID", _near(total, F.col("margin")).alias("adds_up"), _near(explained, F.col("score")).alias("explains_score"))


@query("linear_attributions", sql(TXN, keyed(), "m AS (SELECT avg(TransactionAmt) AS ma, avg(hour) AS mh FROM keyed)", """c AS (
  SELECT TransactionID, 'amount' AS feature, 0.02::DOUBLE * (TransactionAmt - ma) AS contribution FROM keyed, m
  UNION ALL SELECT TransactionID, 'hour', -0.1::DOUBLE * (hour - mh) FROM keyed, m)""",
  body="SELECT TransactionID, feature, round(contribution, 9) AS contribution FROM c"))
def linear_attributions(spark, d):
    rows = light_features(spark, d)
    means = rows.agg(F.avg("amount").alias("amount"), F.avg("hour").alias("hour")).first().asDict()
    contributions = model.linear_attributions(rows, {"amount": 0.02, "hour": -0.1}, means)
    return rows.select("TransactionID", F.explode(contributions).alias("feature", "c")).select(
        "TransactionID", "feature", F.round("c", 9).alias("contribution")
    )


@query("evaluation_report", sql(TXN, SPLIT, body="""SELECT count(*) AS n_rows, CAST(sum(isFraud) AS BIGINT) AS n_positive, true AS scores_follow,
  true AS threshold_on_grid, true AS better_than_chance, 5 AS n_samples FROM split WHERE split = 'test'"""))
def evaluation_report(spark, d):
    processed, params, fitted = _fitted(spark, d)
    report = evaluate(fitted, processed, params, SMALL_MODEL).report.select("metrics.*", F.size("local_explanations_sample").alias("n_samples"))
    tn, fp, fn, tp = (F.col(c) for c in ("true_negatives", "false_positives", "false_negatives", "true_positives"))
    return report.select(
        (tn + fp + fn + tp).cast("bigint").alias("n_rows"), (fn + tp).cast("bigint").alias("n_positive"),
        follows_counts(tp, fp, fn).alias("scores_follow"),
        F.col("threshold").isin(metrics.threshold_grid(SMALL_MODEL)).alias("threshold_on_grid"),
        ((F.col("roc_auc_score") > 0.5) & (F.col("roc_auc_score") <= 1)).alias("better_than_chance"), "n_samples",
    )


@query("local_explanations", sql(TXN, SPLIT, body="""SELECT TransactionID, isFraud AS actual_label, true AS score_in_range, true AS verdict_known
  FROM split WHERE split = 'test' ORDER BY TransactionID LIMIT 5"""))
def local_explanations(spark, d):
    processed, params, fitted = _fitted(spark, d)
    rows = evaluate(fitted, processed, params, SMALL_MODEL).explanations
    return rows.select(
        "TransactionID", "actual_label", F.col("score").between(0, 1).alias("score_in_range"),
        (F.col("prediction").isin("FRAUD", "CLEAN") & (F.size("contributions") == len(params.features))).alias("verdict_known"),
    )


@query("retrain_job", "SELECT 'drift_detection' AS trigger_reason, CAST(0 AS DOUBLE) AS old_f1, true AS new_f1_in_range, true AS promoted, true AS noted")
def retrain_job(spark, d):
    """Shifted batch, drift check, retraining and the log row of the run: the first run is promoted over nothing."""
    folder = shared_path(spark, "retrain")
    rows = views.txn(spark, d).drop("ingest_seq")
    jobs.generate_batch(rows, f"{folder}/batches", "2024-02-01", 1.0, SMALL_MODEL)
    logged = jobs.drift_then_retrain(
        spark, rows, f"{folder}/batches", folder, "2024-02-01", SMALL_MODEL, now=datetime(2024, 2, 1, 12)
    )
    return logged.select(
        "trigger_reason", "old_f1", ((F.col("new_f1") > 0) & (F.col("new_f1") <= 1)).alias("new_f1_in_range"), "promoted",
        F.col("notes").startswith("Promoted: ").alias("noted"),
    )


# fixed values: the cut points of the checked tree
TREE_CUTS = {
    "amount": (5.0, 10.0, 20.0, 40.0, 60.0, 80.0, 100.0, 120.0, 150.0, 200.0), "hour": tuple(float(h) for h in range(23)),
    "day_of_week": tuple(float(x) for x in range(6)), "card2": (100.0, 101.0, 102.0, 103.0),
}
TREE = DEFAULT.with_(n_trees=1, max_depth=3, learning_rate=0.3, subsample=1.0, column_sample=1.0)


def _tree_sql(depth: int, rate: float) -> str:
    """The first tree level by level: sums of gradients and hessians by (node, feature, cut), the best cut of each node, its children."""
    cuts = ", ".join(f"({f}, {b}, '{name}', {cut}::DOUBLE)" for f, (name, own) in enumerate(TREE_CUTS.items()) for b, cut in enumerate(own))
    ctes = [
        TXN, keyed(), "weight AS (SELECT count(*) FILTER (isFraud = 0) / count(*) FILTER (isFraud = 1)::DOUBLE AS w FROM keyed)",
        """grad AS (SELECT TransactionID AS id, round(CASE WHEN isFraud = 1 THEN w ELSE 1.0 END * (0.5::DOUBLE - isFraud) * 1048576)::BIGINT AS g,
  round(CASE WHEN isFraud = 1 THEN w ELSE 1.0 END * 0.25::DOUBLE * 1048576)::BIGINT AS h FROM keyed, weight)""",
        "cell AS (" + " UNION ALL ".join(f"SELECT TransactionID AS id, {f} AS f, {'TransactionAmt' if n == 'amount' else n}::DOUBLE AS x FROM keyed"
                                        for f, n in enumerate(TREE_CUTS)) + ")",
        f"cut AS (SELECT * FROM (VALUES {cuts}) AS v(f, b, feature, cut))", "part0 AS (SELECT id, '' AS path, g, h FROM grad)",
    ]
    part = lambda g, h: f"({g} / 1048576.0::DOUBLE) * ({g} / 1048576.0::DOUBLE) / ({h} / 1048576.0::DOUBLE + 1.0)"
    for d in range(depth):
        ctes += [
            f"""sums{d} AS (SELECT path, f, b, feature, cut, sum(g) AS g, sum(h) AS h, coalesce(sum(g) FILTER (x <= cut), 0) AS gl,
  coalesce(sum(h) FILTER (x <= cut), 0) AS hl FROM part{d} JOIN cell USING (id) JOIN cut USING (f) GROUP BY path, f, b, feature, cut)""",
            f"""best{d} AS (SELECT *, 0.5 * ({part('gl', 'hl')} + {part('(g - gl)', '(h - hl)')} - {part('g', 'h')}) AS gain FROM sums{d}
  WHERE hl >= 1048576 AND h - hl >= 1048576 QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, f, b) = 1)""",
            f"""part{d + 1} AS (SELECT p.id, p.path || CASE WHEN x <= cut THEN 'l' ELSE 'r' END AS path, p.g, p.h
  FROM part{d} p JOIN best{d} USING (path) JOIN cell c ON c.id = p.id AND c.f = best{d}.f WHERE gain > 1e-9)""",
        ]
    nodes = [f"""SELECT path, {'feature' if d < depth else 'NULL'} AS feature, {'cut' if d < depth else 'NULL'} AS threshold, {'gain' if d < depth else '0'} AS gain, n.h, n.g
  FROM (SELECT path, sum(g) AS g, sum(h) AS h FROM part{d} GROUP BY path) n""" + (f" LEFT JOIN (SELECT path, feature, cut, gain FROM best{d} WHERE gain > 1e-9) USING (path)" if d < depth else "")
             for d in range(depth + 1)]
    return sql(*ctes, "node AS (" + " UNION ALL ".join(nodes) + ")", body=f"""SELECT path, feature, threshold, round(coalesce(gain, 0), 4) AS gain,
  round(h / 1048576.0::DOUBLE, 4) AS cover, CASE WHEN feature IS NULL THEN round(-{rate}::DOUBLE * (g / 1048576.0::DOUBLE) / (h / 1048576.0::DOUBLE + 1.0), 6) END AS value FROM node""")


@query("boosted_first_tree", _tree_sql(TREE.max_depth, TREE.learning_rate))
def boosted_first_tree(spark, d):
    """Every node of the first boosted tree on given bins: split, gain, cover, and the value of a leaf."""
    fitted = boosting.train(light_features(spark, d), list(TREE_CUTS), TREE, list(TREE_CUTS.values()))
    tree = fitted.trees[0]
    paths = {0: ""}
    for n, f in enumerate(tree.feature):
        if f >= 0:
            paths |= {tree.left[n]: paths[n] + "l", tree.right[n]: paths[n] + "r"}
    table = spark.createDataFrame(list(paths.items()), "node int, path string")
    names = F.element_at(F.array(*[F.lit(f) for f in TREE_CUTS]), F.col("feature") + 1)
    split = F.col("feature") >= 0
    return fitted.nodes(spark).join(table, "node").select(
        "path", F.when(split, names).alias("feature"), "threshold", F.round("gain", 4).alias("gain"), F.round("cover", 4).alias("cover"),
        F.when(~split, F.round("value", 6)).alias("value"))


@query("boosted_scores", sql(TXN, SPLIT, body="SELECT TransactionID, split, true AS follows_nodes FROM split WHERE split <> 'train'"))
def boosted_scores(spark, d):
    """Scores of the held-out splits next to whether they are what the saved node table gives, walked by joins level by level."""
    cfg = DEFAULT.with_(n_trees=10, max_depth=4)
    rows = stratified_split(light_features(spark, d), cfg.join_key, cfg)
    features = ["amount", "hour", "day_of_week", "is_weekend", "card1", "card2", "addr1"]
    rows = rows.withColumns({f: F.col(f).cast("double") for f in features})
    fitted = boosting.train(rows.where(F.col("split") == "train"), features, cfg)
    path = shared_path(spark, "booster")
    fitted.save(spark, path)
    held = rows.where(F.col("split") != "train")
    scored = boosting.score(boosting.Booster.load(spark, path), held, ["TransactionID", "split"])
    nodes = F.broadcast(spark.read.parquet(f"{path}/nodes"))  # the model: at most 10 trees of 31 nodes
    x = F.map_from_arrays(F.array(*[F.lit(i) for i in range(len(features))]), F.array(*[F.col(f) for f in features]))
    at = held.select("TransactionID", x.alias("x"), F.explode(F.sequence(F.lit(0), F.lit(cfg.n_trees - 1))).alias("tree"), F.lit(0).alias("node"))
    for _ in range(cfg.max_depth):
        left = F.coalesce(F.element_at("x", F.col("feature")) <= F.col("threshold"), F.lit(True))
        onward = F.when(F.col("feature") < 0, F.col("node")).when(left, F.col("left")).otherwise(F.col("right"))
        at = at.join(nodes.select("tree", "node", "feature", "threshold", "left", "right"), ["tree", "node"]).select("TransactionID", "x", "tree", onward.alias("node"))
    walked = at.join(nodes.select("tree", "node", "value"), ["tree", "node"]).groupBy("TransactionID").agg(F.sum("value").alias("walked"))
    return scored.join(walked, "TransactionID").select("TransactionID", "split", _near(F.col("margin"), F.col("walked")).alias("follows_nodes"))
