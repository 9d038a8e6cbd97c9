"""Check SQL shared by the registered queries: the views of FIXTURES.md as common table expressions."""

from __future__ import annotations


def h32(salt: str, row_id: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5('{seed}|{salt}|' || {row_id}), 1, 8))::BIGINT"


def h60(salt: str, row_id: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5('{seed}|{salt}|' || {row_id}), 1, 15))::BIGINT"


def u(salt: str, row_id: str, seed: int = 42) -> str:
    return f"({h32(salt, row_id, seed)} / 4294967296.0)"


def normal(salt: str, row_id: str) -> str:
    return (
        f"(sqrt(-2.0 * ln(({h32(salt + '-r', row_id)} + 1) / 4294967296.0)) "
        f"* cos(6.283185307179586::DOUBLE * {u(salt + '-a', row_id)}))"
    )


CLOCK = "((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1000000)"

TXN = f"""txn AS (
  SELECT event_id AS ingest_seq, event_id AS TransactionID, {CLOCK} AS TransactionDT, value AS TransactionAmt,
    CASE event_type WHEN 'view' THEN 'W' WHEN 'click' THEN 'C' WHEN 'purchase' THEN 'R' WHEN 'signup' THEN 'H' ELSE 'S' END AS ProductCD,
    1000 + user_id AS card1, CAST(100 + user_id % 5 AS DOUBLE) AS card2, CAST(150 AS DOUBLE) AS card3,
    CASE WHEN event_id % 41 = 0 THEN NULL WHEN user_id % 4 = 0 THEN 'visa' WHEN user_id % 4 = 1 THEN 'mastercard'
         WHEN user_id % 4 = 2 THEN 'discover' ELSE 'american express' END AS card4,
    CAST(226 AS DOUBLE) AS card5,
    CASE WHEN event_id % 4 = 0 THEN 'debit' ELSE 'credit' END AS card6,
    CASE WHEN user_id % 9 = 0 THEN NULL ELSE CAST(321 AS DOUBLE) END AS addr1,
    CASE CAST(substr(props, 7, length(props) - 7) AS INT) % 4 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'yahoo.com'
         WHEN 2 THEN 'outlook.com' ELSE NULL END AS P_emaildomain,
    CASE WHEN event_id % 5 = 0 THEN 'gmail.com' ELSE NULL END AS R_emaildomain,
    CASE WHEN (value > 150 AND event_id % 3 <> 0) OR event_id % 101 = 0 THEN 1 ELSE 0 END AS isFraud
  FROM events)"""

IDENTITY = """identity AS (
  SELECT event_id AS identity_seq, event_id AS TransactionID,
    CASE WHEN value >= 60 THEN 'desktop' WHEN value >= 5 THEN 'mobile' END AS DeviceType
  FROM events WHERE event_type IN ('click', 'purchase')
  UNION ALL
  SELECT event_id + 1000000000000, event_id, 'tablet' FROM events WHERE event_type = 'purchase')"""

DIRTY = """dirty AS (
  SELECT * REPLACE (
    CASE WHEN ProductCD = 'S' AND TransactionAmt < 5 THEN NULL ELSE TransactionID END AS TransactionID,
    CASE WHEN ProductCD = 'H' AND TransactionAmt > 90 THEN NULL ELSE TransactionAmt END AS TransactionAmt)
  FROM txn
  UNION ALL
  SELECT * REPLACE (TransactionAmt + 1000 AS TransactionAmt, ingest_seq + 1000000000000 AS ingest_seq)
  FROM txn WHERE ProductCD = 'R')"""

DEDUPED = """deduped AS (
  SELECT * FROM dirty WHERE TransactionID IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY TransactionID ORDER BY ingest_seq) = 1)"""

CLEANED = """cleaned AS (
  SELECT * REPLACE (coalesce(TransactionAmt, (SELECT median(TransactionAmt) FROM deduped)) AS TransactionAmt) FROM deduped)"""

IDENTITY_ONCE = """identity_once AS (
  SELECT TransactionID, DeviceType FROM identity
  QUALIFY row_number() OVER (PARTITION BY TransactionID ORDER BY identity_seq) = 1)"""


def keyed(source: str = "txn", name: str = "keyed", time: str = "TransactionDT") -> str:
    """Temporal parts and entity keys over a transaction-shaped table."""
    return f"""{name} AS (
  SELECT *, CAST({time} // 86400 AS INT) AS day_number,
    CAST(({time} % 86400) // 3600 AS INT) AS hour,
    CAST(({time} // 86400) % 7 AS INT) AS day_of_week,
    CASE WHEN ({time} // 86400) % 7 IN (5, 6) THEN 1 ELSE 0 END AS is_weekend,
    CAST(({time} // 86400) // 30 AS INT) AS month,
    coalesce(CAST(card1 AS VARCHAR), '') || '_' || coalesce(CAST(card2 AS VARCHAR), '') || '_' || coalesce(CAST(card3 AS VARCHAR), '')
      || '_' || coalesce(CAST(card5 AS VARCHAR), '') || '_' || coalesce(CAST(addr1 AS VARCHAR), '') AS user_key,
    coalesce(ProductCD, '') || '_' || coalesce(card4, '') || '_' || coalesce(P_emaildomain, '') AS merchant_key
  FROM {source})"""


FEATURE_COLUMNS = """TransactionID, TransactionDT, isFraud, amount, day_number, hour, day_of_week, is_weekend, month, user_key,
  merchant_key, user_tx_count_30d, user_total_amount_30d, user_avg_amount_30d, merchant_tx_count_30d,
  merchant_unique_users_30d, velocity_1hr, card1, card2, card3, card5, addr1, ProductCD, card4, card6,
  P_emaildomain, R_emaildomain"""


def engineered(source: str = "txn", name: str = "feat", extra: str = "") -> str:
    """The whole feature frame over ``source``; joins state the window rules directly."""
    k = f"{name}_keyed"
    return f"""{keyed(source, k)},
{name}_user AS (
  SELECT a.TransactionID, count(b.TransactionAmt) AS c,
    CAST(coalesce(sum(CAST(round(b.TransactionAmt * 1e6) AS BIGINT)), 0) AS DOUBLE) / 1e6 AS s,
    count(*) FILTER (WHERE b.TransactionDT >= a.TransactionDT - 3600) AS v
  FROM {k} a JOIN {k} b ON a.user_key = b.user_key
    AND b.TransactionDT BETWEEN a.TransactionDT - 2592000 AND a.TransactionDT
    AND (b.TransactionDT < a.TransactionDT OR b.TransactionID <= a.TransactionID)
  GROUP BY a.TransactionID),
{name}_merchant AS (
  SELECT a.TransactionID, count(*) AS c, count(DISTINCT b.user_key) AS d
  FROM {k} a JOIN {k} b ON a.merchant_key = b.merchant_key
    AND b.TransactionDT BETWEEN a.TransactionDT - 2592000 AND a.TransactionDT
    AND (b.TransactionDT < a.TransactionDT OR b.TransactionID <= a.TransactionID)
  GROUP BY a.TransactionID),
{name} AS (
  SELECT k.*, k.TransactionAmt AS amount, x.c AS user_tx_count_30d, x.s AS user_total_amount_30d,
    CASE WHEN x.c > 0 THEN x.s / x.c ELSE CAST(0 AS DOUBLE) END AS user_avg_amount_30d,
    m.c AS merchant_tx_count_30d, m.d AS merchant_unique_users_30d, x.v AS velocity_1hr
  FROM {k} k JOIN {name}_user x USING (TransactionID) JOIN {name}_merchant m USING (TransactionID))"""


def shifted(source: str, name: str, i: float) -> str:
    """All raw-column shifts at intensity ``i`` over a transaction-shaped table."""
    rid = "TransactionID"
    target = 0.035 + i * (0.080 - 0.035)
    return f"""{name}_rate AS (SELECT avg(isFraud) AS r FROM {source}),
{name}_label AS (
  SELECT t.* REPLACE (
    t.TransactionAmt * CAST({1.0 + 0.60 * i!r} AS DOUBLE) AS TransactionAmt,
    CASE WHEN t.isFraud = 0 AND {u('label', 't.' + rid)} <
      (CASE WHEN r < CAST({target!r} AS DOUBLE) THEN (CAST({target!r} AS DOUBLE) - r) / (1.0 - r) ELSE 0.0 END) THEN 1 ELSE t.isFraud END AS isFraud)
  FROM {source} t, {name}_rate),
{name} AS (
  SELECT * REPLACE (
    CASE WHEN isFraud = 1 AND {u('move', rid)} < {i} THEN CAST(TransactionDT // 86400 * 86400
      + floor(least(greatest({normal('hour', rid)} * 2.0 + 12.0, 9.0), 17.0)) * 3600 + TransactionDT % 3600 AS BIGINT)
      ELSE TransactionDT END AS TransactionDT,
    CASE WHEN {u('ProductCD', rid)} < CAST({0.30 * i!r} AS DOUBLE) THEN 'W' ELSE ProductCD END AS ProductCD,
    CASE WHEN {u('card4', rid)} < CAST({0.30 * i!r} AS DOUBLE) THEN 'visa' ELSE card4 END AS card4,
    CASE WHEN {u('P_emaildomain', rid)} < CAST({0.30 * i!r} AS DOUBLE) THEN 'gmail.com' ELSE P_emaildomain END AS P_emaildomain)
  FROM {name}_label)"""


NEWEST_5000 = """edge AS (
  SELECT TransactionID AS e_id, TransactionDT AS e_dt FROM txn ORDER BY TransactionDT DESC, TransactionID DESC LIMIT 1
  OFFSET (SELECT least(5000, count(*)) - 1 FROM txn)),
marked AS (
  SELECT txn.*, (TransactionDT > e_dt OR (TransactionDT = e_dt AND TransactionID >= e_id)) AS is_inference_batch FROM txn, edge)"""

SCORE = f"floor((least(value / 300.0, 1.0) * 0.6 + {u('score', 'event_id')} * 0.4) * 10000.0) / 10000.0"

SCORED = f"""scored AS (
  SELECT txn.*, floor((least(TransactionAmt / 300.0, 1.0) * 0.6 + {u('score', 'TransactionID')} * 0.4) * 10000.0) / 10000.0 AS score
  FROM txn)"""

SPLIT = f"""sizes AS (SELECT isFraud, count(*) AS c, sum(count(*)) OVER () AS n FROM txn GROUP BY isFraud),
held AS (SELECT *, CAST(ceil(CAST({0.15 + 0.15!r} AS DOUBLE) * n) AS BIGINT) AS n_held FROM sizes),
train_exact AS (SELECT *, c * (n - n_held) / CAST(n AS DOUBLE) AS x FROM held),
train_quota AS (
  SELECT *, floor(x) + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, isFraud) <= (n - n_held) - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS q_train
  FROM train_exact),
val_exact AS (
  SELECT *, n_held - CAST(ceil(0.5 * n_held) AS BIGINT) AS n_val,
    (c - q_train) * (n_held - CAST(ceil(0.5 * n_held) AS BIGINT)) / CAST(n_held AS DOUBLE) AS y FROM train_quota),
quota AS (
  SELECT *, floor(y) + CASE WHEN row_number() OVER (ORDER BY y - floor(y) DESC, isFraud) <= n_val - sum(floor(y)) OVER () THEN 1 ELSE 0 END AS q_val
  FROM val_exact),
placed AS (
  SELECT txn.*, row_number() OVER (PARTITION BY isFraud ORDER BY {h32('split', 'TransactionID')}, TransactionID) AS k FROM txn),
split AS (
  SELECT p.* EXCLUDE (k), CASE WHEN k <= q_train THEN 'train' WHEN k <= q_train + q_val THEN 'val' ELSE 'test' END AS split
  FROM placed p JOIN quota USING (isFraud))"""

PREDICTIONS = f"""predictions AS (
  SELECT event_id AS id, CAST(event_id AS VARCHAR) AS transaction_id, {SCORE} AS fraud_probability,
    'v' || CAST(1 + user_id % 3 AS VARCHAR) AS model_version, ts AS "timestamp",
    CASE WHEN {SCORE} >= 0.5 THEN 'FRAUD' WHEN {SCORE} >= 0.3 THEN 'SUSPICIOUS' ELSE 'CLEAN' END AS prediction
  FROM events)"""

FEATURES = """features AS (
  SELECT CAST(TransactionID AS VARCHAR) AS transaction_id, CASE WHEN ProductCD <> 'S' THEN TransactionAmt END AS amount,
    coalesce(card4, 'unknown') AS card_network, CASE WHEN card1 % 7 <> 0 THEN card6 END AS card_type
  FROM txn WHERE ProductCD <> 'H')"""

DRIFT_LOG = f"""drift_log AS (
  SELECT event_id AS id, CAST(ts AS DATE) AS run_date,
    CASE event_type WHEN 'view' THEN 'amount' WHEN 'click' THEN 'velocity_1hr' WHEN 'purchase' THEN 'user_avg_amount_30d'
      WHEN 'signup' THEN 'card6' ELSE 'hour_bucket' END AS feature_name,
    value / 1000.0 AS drift_score, {u('drift', 'event_id')} AS p_value, {u('drift', 'event_id')} < 0.05 AS drift_detected,
    0.1 + (event_id % 10) / 100.0 AS drift_intensity, ts AS "timestamp"
  FROM events)"""

RETRAIN_LOG = f"""retrain_log AS (
  SELECT event_id AS id, ts AS triggered_at, 'drift_detection' AS trigger_reason,
    {h32('old', 'event_id')} % 1000 / 1000.0 AS old_f1, {h32('new', 'event_id')} % 1000 / 1000.0 AS new_f1,
    {h32('new', 'event_id')} % 1000 / 1000.0 - {h32('old', 'event_id')} % 1000 / 1000.0 >= CAST(0.01 AS DOUBLE) AS promoted,
    'run ' || CAST(event_id AS VARCHAR) AS notes, ts AS "timestamp"
  FROM events WHERE event_type = 'purchase')"""

REGISTRY = f"""registry AS (
  SELECT event_id AS id, CASE WHEN user_id % 2 = 0 THEN 'risk-boosted-trees' ELSE 'risk-linear' END AS model_name,
    CAST(event_id AS VARCHAR) AS model_version, 'run-' || CAST(event_id AS VARCHAR) AS run_id,
    {h32('f1', 'event_id')} % 1000 / 1000.0 AS f1_score, {h32('auc', 'event_id')} % 1000 / 1000.0 AS auc_score,
    {h32('precision', 'event_id')} % 1000 / 1000.0 AS precision_score, {h32('recall', 'event_id')} % 1000 / 1000.0 AS recall_score,
    CAST(0.5 AS DOUBLE) AS threshold, value > 100 AS is_production, ts AS created_at
  FROM events WHERE event_type = 'signup')"""


def sql(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
