"""SQL twins of the queries, over the same test tables.

Common table expressions spell the stand-in inputs and the products; each query's statement is
prefixed with the ones it needs.
"""

from __future__ import annotations

import re

WEEKS = 104
WIDTH = 64
WINDOWS = (30, 60, 90, 120, 365)
GAPS = (
    "days_since_last_purchase_p25",
    "days_since_last_purchase_p50",
    "days_since_last_purchase_p75",
    "avg_days_since_last_purchase",
    "stddev_days_since_last_purchase",
)
MEASURES = {
    "base_points": "base",
    "credit_points": "credit",
    "bonus_points": "bonus",
    "redemption_points": "redemption",
    "total_loyalty_point_balance": "total",
}

CALENDAR = """
SELECT start_date, end_date, deal_yr, deal_wk,
       CAST(deal_yr AS VARCHAR) || '_3' || lpad(CAST(deal_wk AS VARCHAR), 2, '0') AS week_identifier,
       CAST(least(4, 1 + floor((deal_wk - 1) / 13.0)) AS INTEGER) AS deal_season_num
FROM (
  SELECT start_date, start_date + 6 AS end_date,
         CAST(year(start_date + 6) AS INTEGER) AS deal_yr,
         CAST(row_number() OVER (PARTITION BY year(start_date + 6) ORDER BY start_date) AS INTEGER) AS deal_wk
  FROM (
    SELECT CAST(unnest(generate_series(DATE '1994-12-31', DATE '2024-01-27', INTERVAL 7 DAY)) AS DATE) AS start_date
  )
)
"""

FX_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            WHEN o_custkey % 10 = 0 AND o_orderkey % 2 = 0 THEN 'B' || CAST(o_custkey AS VARCHAR)
            ELSE 'A' || CAST(o_custkey AS VARCHAR) END AS cardnumber,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'B2' ELSE 'B1' END AS banner,
       CAST(o_orderdate AS DATE) AS tx_date,
       strftime(o_orderdate, '%Y%m%d') AS p_trans_dateid
FROM orders
"""

LINES = """
SELECT cardnumber, banner, tx_date, p_trans_dateid, o_orderkey AS lms_transaction_id,
       CASE WHEN o_orderstatus = 'P' THEN 'Return' ELSE 'Purchase' END AS transactiontype,
       l_extendedprice * (1 - l_discount) AS sales
FROM fx_orders JOIN lineitem ON l_orderkey = o_orderkey
"""

ACCOUNTS = """
SELECT 'A' || CAST(c_custkey AS VARCHAR) AS cardnumber, c_custkey AS customerid,
       'P' || CAST(c_custkey AS VARCHAR) AS epcl_profileid,
       md5(upper(trim(CAST(c_custkey AS VARCHAR)))) AS epsilon_id
FROM customer
UNION ALL
SELECT 'B' || CAST(c_custkey AS VARCHAR), c_custkey,
       CASE WHEN c_custkey % 20 = 0 THEN 'Q' ELSE 'P' END || CAST(c_custkey AS VARCHAR),
       md5(upper(trim(CAST(c_custkey AS VARCHAR))))
FROM customer WHERE c_custkey % 10 = 0
"""

CLEAN = """
SELECT DISTINCT cardnumber, banner, lms_transaction_id, p_trans_dateid, tx_date,
       round(sum(sales) OVER (PARTITION BY cardnumber, banner, lms_transaction_id), 4) AS sales
FROM lines
WHERE p_trans_dateid BETWEEN '19980701' AND '20010629'
  AND transactiontype = 'Purchase' AND banner = 'B1' AND cardnumber IS NOT NULL
"""

TRANSACTIONS = """
SELECT cardnumber, banner, lms_transaction_id, p_trans_dateid, tx_date, max(sales) AS sales,
       lag(tx_date) OVER (PARTITION BY cardnumber, banner ORDER BY tx_date, lms_transaction_id) AS prev_tx_date
FROM clean GROUP BY cardnumber, banner, lms_transaction_id, p_trans_dateid, tx_date
"""

SUMMARY = """
SELECT cardnumber, banner, o_orderkey AS lms_transaction_id, p_trans_dateid, tx_date,
       base, credit, bonus, redemption, base + credit + bonus - redemption AS total,
       CAST(round(o_totalprice) AS BIGINT) * 0.01::DOUBLE AS dollarbalance,
       DATE '1990-01-01' + CAST(o_custkey % 1500 AS INTEGER) AS enrolldate,
       DATE '1990-01-01' + CAST(o_custkey % 1500 AS INTEGER) + 30 AS registerdate,
       lag(tx_date) OVER (PARTITION BY cardnumber, banner ORDER BY tx_date, o_orderkey) AS prev_tx_date
FROM (
  SELECT *, o_totalprice * 0.004::DOUBLE AS base,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 0.01::DOUBLE ELSE 0.0::DOUBLE END AS credit,
         CASE WHEN o_orderpriority = '2-HIGH' THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS bonus,
         CASE WHEN o_orderstatus = 'F' THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS redemption
  FROM fx_orders WHERE banner = 'B1' AND p_trans_dateid BETWEEN '19980701' AND '20010629'
)
"""

OWNED = """
SELECT t.banner, t.lms_transaction_id, t.tx_date, t.p_trans_dateid, t.sales, a.epcl_profileid, a.epsilon_id
FROM transactions t JOIN accounts a ON t.cardnumber = a.cardnumber
"""


def _profile(rows: str, keys: str) -> str:
    """Purchase profile of ``rows`` grouped by ``keys`` (SQL text)."""
    same = " AND ".join(f"b.{k.strip()} = q.{k.strip()}" for k in keys.split(","))
    windows = ",\n".join(
        f"""CAST(sum(CASE WHEN age <= {d} THEN 1 ELSE 0 END) AS BIGINT) AS num_of_purchases_last_{d}_days,
        round(sum(CASE WHEN age <= {d} THEN sales ELSE 0 END), 4) AS sales_last_{d}_days"""
        for d in WINDOWS
    )
    quartiles = ", ".join(
        f"max(CASE WHEN position = CAST(ceil({p} * n) AS BIGINT) THEN gap END) AS days_since_last_purchase_{name}"
        for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    )
    return f"""
    SELECT b.*, q.days_since_last_purchase_p25, q.days_since_last_purchase_p50, q.days_since_last_purchase_p75,
           q.avg_gap AS avg_days_since_last_purchase, q.dev_gap AS stddev_days_since_last_purchase
    FROM (
      SELECT {keys}, count(*) AS total_purchases,
             min(p_trans_dateid) AS first_purchase_date, max(p_trans_dateid) AS last_purchase_date,
             max(age) AS days_since_first_purchase, min(age) AS days_since_last_purchase,
             {windows}
      FROM (SELECT *, date_diff('day', tx_date, DATE '2001-06-30') AS age FROM {rows})
      GROUP BY {keys}
    ) b LEFT JOIN (
      SELECT {keys}, {quartiles}, avg(gap) AS avg_gap, stddev_samp(gap) AS dev_gap
      FROM (
        SELECT {keys}, gap,
               row_number() OVER (PARTITION BY {keys} ORDER BY gap) AS position,
               count(*) OVER (PARTITION BY {keys}) AS n
        FROM (
          SELECT {keys}, date_diff('day', lag(tx_date) OVER (
                   PARTITION BY {keys} ORDER BY tx_date, lms_transaction_id), tx_date) AS gap
          FROM {rows}
        ) WHERE gap IS NOT NULL
      ) GROUP BY {keys}
    ) q ON {same}
    """


def _points(rows: str, keys: str) -> str:
    windows = ",\n".join(
        f"round(sum(CASE WHEN age <= {d} THEN {column} ELSE 0 END), 4) AS {name}_last_{d}_days"
        for d in WINDOWS
        for name, column in MEASURES.items()
    )
    return f"""
    SELECT {keys}, max(registerdate) AS register_date, max(enrolldate) AS enroll_date,
           max(CASE WHEN newest = 1 THEN dollarbalance END) AS dollarbalance,
           {windows}
    FROM (
      SELECT *, date_diff('day', tx_date, DATE '2001-06-30') AS age,
             row_number() OVER (PARTITION BY {keys}
                                ORDER BY p_trans_dateid DESC, lms_transaction_id DESC) AS newest
      FROM {rows}
    ) GROUP BY {keys}
    """


CUSTOMER = "epsilon_id, banner"


def _with_profile_id(rows: str, profile: str) -> str:
    return f"""
    SELECT p.*, i.epcl_profileid FROM ({profile}) p
    JOIN (SELECT {CUSTOMER}, min(epcl_profileid) AS epcl_profileid FROM {rows} GROUP BY {CUSTOMER}) i
    ON i.epsilon_id = p.epsilon_id AND i.banner = p.banner
    """


OWNED_POINTS = """
SELECT s.*, a.epcl_profileid, a.epsilon_id FROM summary s JOIN accounts a ON s.cardnumber = a.cardnumber
"""

HISTORY = """
SELECT min(o.epcl_profileid) AS epcl_profileid, o.epsilon_id, o.banner, c.week_identifier, c.start_date,
       c.deal_season_num
FROM owned o JOIN calendar c ON o.tx_date BETWEEN c.start_date AND c.end_date
WHERE c.start_date >= DATE '2001-06-30' - 728 AND c.end_date <= DATE '2001-07-06'
GROUP BY o.epsilon_id, o.banner, c.week_identifier, c.start_date, c.deal_season_num
"""

MATRIX = (
    "SELECT epsilon_id, "
    + ", ".join(
        f"max(CASE WHEN back = {n} THEN 1 ELSE 0 END) AS \"{n}_weeks_back_purchase\"" for n in range(1, WEEKS + 1)
    )
    + " FROM (SELECT epsilon_id, date_diff('day', start_date, DATE '2001-06-30') // 7 AS back FROM history)"
    + f" WHERE back BETWEEN 1 AND {WEEKS} GROUP BY epsilon_id"
)

SEASONS = (
    "SELECT epsilon_id, "
    + ", ".join(
        f"max(CASE WHEN deal_season_num = {n} THEN 1 ELSE 0 END) AS deal_season_num_{n}" for n in range(1, 5)
    )
    + " FROM history WHERE start_date < DATE '2001-06-30' GROUP BY epsilon_id"
)

OFFERS = """
SELECT p_type || ' ' || p_name AS offer_description, start_date,
       start_date + CAST(p_size % 21 AS INTEGER) AS end_date,
       'BC' || CAST(p_partkey AS VARCHAR) AS bonus_code, npp, p_brand AS funding, CAST(NULL AS VARCHAR) AS notes
FROM (
  SELECT *, DATE '1995-01-01' + CAST(p_partkey * 7 % 2300 AS INTEGER) AS start_date,
         CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN 'Y' ELSE 'N' END AS npp
  FROM part
) WHERE npp IS NOT NULL AND year(start_date) BETWEEN 1995 AND 2001
"""

PROMO = """
SELECT c.week_identifier, c.deal_yr, c.deal_wk, CASE WHEN f.week_identifier IS NULL THEN 0 ELSE 1 END AS npp_flag,
       c.start_date
FROM calendar c LEFT JOIN (
  SELECT DISTINCT k.week_identifier
  FROM offers o JOIN calendar k ON o.start_date <= k.end_date AND o.end_date >= k.start_date
  WHERE o.npp = 'Y' AND o.funding LIKE '%Brand#1%' AND upper(o.offer_description) LIKE '%RING%'
    AND upper(o.offer_description) NOT LIKE '%PROMO%' AND upper(o.offer_description) NOT LIKE '%SMALL%'
) f ON f.week_identifier = c.week_identifier
WHERE c.deal_yr BETWEEN 1999 AND 2001
"""

PROMO_ROW = (
    "SELECT "
    + ", ".join(
        f"coalesce(max(CASE WHEN back = {n} THEN npp_flag END), 0) AS \"{n}_weeks_back_NPP_npp_flag\""
        for n in range(1, WEEKS + 1)
    )
    + " FROM (SELECT npp_flag, date_diff('day', start_date, DATE '2001-06-30') // 7 AS back FROM promo"
    + " WHERE week_identifier <= '2001_327')"
)

LABELS = """
SELECT min(a.epcl_profileid) AS epcl_profileid, a.epsilon_id, l.banner, 'Y' AS purchase_flag
FROM lines l JOIN accounts a ON l.cardnumber = a.cardnumber
WHERE l.p_trans_dateid BETWEEN '20010714' AND '20010720' AND l.transactiontype = 'Purchase' AND l.banner = 'B1'
GROUP BY a.epsilon_id, l.banner
"""

ACTIVE = """
SELECT c_custkey AS customerid, md5(upper(trim(CAST(c_custkey AS VARCHAR)))) AS epsilon_id
FROM customer WHERE c_acctbal > 0
"""

BASE = """
SELECT a.customerid, c.deal_yr, c.deal_wk, c.start_date, c.end_date, c.week_identifier, 'B1' AS p_banner
FROM active a CROSS JOIN calendar c
WHERE c.end_date > DATE '2024-01-27' - 372 AND c.start_date <= DATE '2024-01-27'
"""

VIEWS = """
SELECT DISTINCT a.customerid, 1 AS view_ind, 'B1' AS p_banner, e.view_date,
       c.start_date, c.end_date, c.deal_yr, c.deal_wk, c.week_identifier, c.deal_season_num
FROM (
  SELECT user_id, event_type, CAST(ts AS DATE) AS view_date FROM events
  WHERE event_type IN ('view', 'click', 'signup') AND user_id % 7 <> 0
) e
JOIN customer m ON m.c_custkey = e.user_id
JOIN active a ON a.epsilon_id = md5(upper(trim(CAST(m.c_custkey AS VARCHAR))))
JOIN calendar c ON e.view_date BETWEEN c.start_date AND c.end_date
WHERE e.view_date >= DATE '2024-01-27' - 1095 AND e.view_date < DATE '2024-01-27'
"""

EVENT_SHOPS = """
SELECT e.user_id AS customerid, 'B1' AS p_banner, CAST(e.ts AS DATE) AS transaction_date,
       c.deal_yr, c.deal_wk, c.start_date
FROM events e JOIN customer k ON k.c_custkey = e.user_id
JOIN calendar c ON CAST(e.ts AS DATE) BETWEEN c.start_date AND c.end_date
WHERE e.event_type = 'purchase' AND CAST(e.ts AS DATE) < DATE '2024-01-27'
  AND CAST(e.ts AS DATE) >= DATE '2024-01-27' - 1095
"""

WEEKLY = """
SELECT b.customerid, b.p_banner, b.deal_yr, b.deal_wk, b.start_date, b.end_date,
       max(t.transaction_date) AS last_shop_date,
       max(CASE WHEN t.customerid IS NULL THEN 0 ELSE 1 END) AS weekly_shop_ind,
       max(CASE WHEN v.customerid IS NULL THEN 0 ELSE 1 END) AS weekly_view_ind,
       count(DISTINCT t.transaction_date) AS weekly_trips,
       max(CASE WHEN t.customerid IS NOT NULL AND v.customerid IS NOT NULL THEN 1 ELSE 0 END) AS weekly_shop_view_ind
FROM base b
LEFT JOIN event_shops t ON t.customerid = b.customerid AND t.deal_yr = b.deal_yr AND t.deal_wk = b.deal_wk
     AND t.p_banner = b.p_banner
LEFT JOIN (SELECT DISTINCT customerid, deal_yr, deal_wk, p_banner FROM views) v
     ON v.customerid = b.customerid AND v.deal_yr = b.deal_yr AND v.deal_wk = b.deal_wk AND v.p_banner = b.p_banner
WHERE b.start_date BETWEEN DATE '2024-01-27' - 365 AND DATE '2024-01-27'
GROUP BY b.customerid, b.p_banner, b.deal_yr, b.deal_wk, b.start_date, b.end_date
"""

STATISTICS = """
SELECT b.customerid AS customer_id, md5(upper(trim(CAST(b.customerid AS VARCHAR)))) AS epsilon_id, b.p_banner,
       b.start_date, b.end_date, b.deal_yr, b.deal_wk, s.weeks_views, s.shop_view_weeks, s.lambda_views
FROM base b
LEFT JOIN (
  SELECT customerid, p_banner, CAST(sum(weekly_view_ind) AS BIGINT) AS weeks_views,
         CAST(sum(weekly_shop_view_ind) AS BIGINT) AS shop_view_weeks,
         sum(weekly_view_ind) / 52.0::DOUBLE AS lambda_views
  FROM weekly GROUP BY customerid, p_banner
) s ON s.customerid = b.customerid AND s.p_banner = b.p_banner
LEFT JOIN (
  SELECT customerid, p_banner, min(transaction_date) AS earliest FROM event_shops GROUP BY customerid, p_banner
) t ON t.customerid = b.customerid AND t.p_banner = b.p_banner
WHERE b.start_date = DATE '2024-01-27' AND t.earliest <= b.start_date
"""

PREDICTIONS = """
SELECT c_custkey, md5(upper(trim(CAST(c_custkey AS VARCHAR)))) AS epsilon_id,
       round(1 / (1 + exp(-((c_acctbal - 4000) / 2000))), 6) AS predicted_purchase_prob
FROM customer
"""

LIKELIHOOD = """
SELECT customer_id, epsilon_id, predicted_purchase_prob, prob_shop_n_view_exp_01w, prob_view_exp_01w, aided_prob,
       shop_prob_label, aided_prob / nullif(predicted_purchase_prob, 0) AS lift_ratio,
       CASE WHEN aided_prob / nullif(predicted_purchase_prob, 0) >= 1.07 THEN 'H' ELSE 'L' END AS lift_label
FROM (
  SELECT *, prob_shop_n_view_exp_01w / nullif(prob_view_exp_01w, 0) AS aided_prob
  FROM (
    SELECT s.customer_id, p.epsilon_id, p.predicted_purchase_prob,
           CASE WHEN s.weeks_views = 0 THEN 0.0::DOUBLE
                ELSE 1 - exp(-(s.shop_view_weeks / 52.0::DOUBLE)) END AS prob_shop_n_view_exp_01w,
           1 - exp(-s.lambda_views) AS prob_view_exp_01w,
           CASE WHEN p.predicted_purchase_prob >= (
             SELECT round(0.3 + n_nationkey / 100.0::DOUBLE, 4) FROM nation
             WHERE n_regionkey % 2 = 0 ORDER BY n_nationkey DESC LIMIT 1
           ) THEN 'H' ELSE 'L' END AS shop_prob_label
    FROM predictions p LEFT JOIN statistics s ON s.epsilon_id = p.epsilon_id
  )
)
"""

PREVIOUS = """
SELECT c_custkey AS customer_id, b.banner, CASE WHEN c_custkey % 3 = 0 THEN 'H' ELSE 'L' END AS shop_prob_label,
       CASE WHEN c_custkey % 5 = 0 THEN 'H' ELSE 'L' END AS lift_label
FROM customer CROSS JOIN (SELECT unnest(['B1', 'B2']) AS banner) b WHERE c_nationkey < 20
"""


def _fraction(key: str, purpose: str) -> str:
    return f"CAST('0x' || substr(md5('{purpose}:42:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"


ASSIGNED = f"""
SELECT l.*, CASE WHEN {_fraction('l.customer_id', 'group')} <= 0.1 THEN 'T' ELSE 'C' END AS group_flag
FROM likelihood l WHERE l.customer_id IN (SELECT customer_id FROM previous)
"""

EMBEDDED = (
    "SELECT vec_id AS lightfm_id, "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS latent_{i}" for i in range(WIDTH))
    + ", vec_id % 400 AS user_id, md5(upper(trim(CAST(vec_id % 400 AS VARCHAR)))) AS epsilon_id FROM embeddings"
)

LABELLED = """
SELECT p.epsilon_id, p.days_since_last_purchase, p.total_purchases, coalesce(l.purchase_flag, 'N') AS purchase_flag,
       CASE WHEN l.purchase_flag = 'Y' THEN 1 ELSE 0 END AS label
FROM profile p LEFT JOIN labelled_buyers l ON l.epsilon_id = p.epsilon_id
"""

SCORED_CUSTOMERS = """
SELECT c.epsilon_id, c.label AS actual, p.predicted_purchase_prob AS score,
       CASE WHEN p.predicted_purchase_prob >= 0.5 THEN 1 ELSE 0 END AS predicted, c.days_since_last_purchase
FROM labelled c JOIN predictions p ON p.epsilon_id = c.epsilon_id
"""

SCORED = """
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS actual, l_discount AS score_ties,
       round(l_extendedprice / 110000, 6) AS score_fine
FROM lineitem
"""


def _curve(score: str, rows: str = "scored", by: str = "") -> str:
    """Counts at or above each distinct score."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""
    SELECT {keys}threshold, pos, neg,
           CAST(sum(pos) OVER ({part} ORDER BY threshold DESC) AS DOUBLE) AS tp,
           CAST(sum(neg) OVER ({part} ORDER BY threshold DESC) AS DOUBLE) AS fp,
           CAST(sum(pos) OVER ({part}) AS DOUBLE) AS positives,
           CAST(sum(neg) OVER ({part}) AS DOUBLE) AS negatives
    FROM (
      SELECT {keys}{score} AS threshold, sum(actual) AS pos, sum(1 - actual) AS neg
      FROM {rows} GROUP BY {keys}{score}
    )
    """


SEGMENTED = """
SELECT 'all' AS segment, * FROM scored_customers
UNION ALL SELECT 'within_365_days', * FROM scored_customers WHERE days_since_last_purchase <= 365
UNION ALL SELECT 'within_730_days', * FROM scored_customers WHERE days_since_last_purchase <= 730
"""

_FEATURE_DOUBLES = (
    ["dollarbalance"]
    + [f"{name}_last_{d}_days" for d in WINDOWS for name in MEASURES]
    + [f"sales_last_{d}_days" for d in WINDOWS]
)
_FEATURE_INTS = (
    ["total_purchases", "days_since_first_purchase", "days_since_last_purchase"]
    + [f"num_of_purchases_last_{d}_days" for d in WINDOWS]
    + [f"{n}_weeks_back_purchase" for n in range(1, WEEKS + 1)]
    + [f"deal_season_num_{n}" for n in range(1, 5)]
)

def _features(join: str, more: str = "") -> str:
    """Feature matrix; customers without a point profile, if kept, have NULL profile columns."""

    def filled(column: str) -> str:
        return f"CASE WHEN pt.epsilon_id IS NOT NULL THEN {column} END"

    doubles = ", ".join(
        f"{filled(f'round(coalesce({chr(34)}{c}{chr(34)}, 0), 4)')} AS {chr(34)}{c}{chr(34)}" for c in _FEATURE_DOUBLES
    )
    ints = ", ".join(f"{filled(f'coalesce({chr(34)}{c}{chr(34)}, 0)')} AS {chr(34)}{c}{chr(34)}" for c in _FEATURE_INTS)
    gaps = ", ".join(
        f"""{filled(f"""CASE WHEN pr.epsilon_id IS NULL THEN 0
        ELSE round(coalesce(CAST(pr.{c} AS DOUBLE), md.{c}), 4) END""")} AS {c}"""
        for c in GAPS
    )
    medians = ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in GAPS)
    return f"""
    SELECT e.*, pt.epcl_profileid, CAST(pt.register_date AS VARCHAR) AS register_date,
           CAST(pt.enroll_date AS VARCHAR) AS enroll_date, pr.first_purchase_date, pr.last_purchase_date,
           {doubles}, {ints}, {gaps}, {more} n.*, coalesce(l.purchase_flag, 'N') AS purchase_flag
    FROM (SELECT * FROM embedded QUALIFY row_number() OVER (PARTITION BY epsilon_id ORDER BY lightfm_id) = 1) e
    {join} JOIN points pt ON pt.epsilon_id = e.epsilon_id
    LEFT JOIN profile pr ON pr.epsilon_id = pt.epsilon_id
    LEFT JOIN matrix m ON m.epsilon_id = pt.epsilon_id
    LEFT JOIN seasons s ON s.epsilon_id = pt.epsilon_id
    LEFT JOIN labelled_buyers l ON l.epsilon_id = e.epsilon_id
    LEFT JOIN statistics st ON st.epsilon_id = e.epsilon_id
    CROSS JOIN promo_row n
    CROSS JOIN (SELECT {medians} FROM profile) md
    """


CTES: dict[str, str] = {
    "calendar": CALENDAR,
    "fx_orders": FX_ORDERS,
    "lines": LINES,
    "accounts": ACCOUNTS,
    "clean": CLEAN,
    "transactions": TRANSACTIONS,
    "summary": SUMMARY,
    "owned": OWNED,
    "owned_points": OWNED_POINTS,
    "profile": _with_profile_id("owned", _profile("owned", CUSTOMER)),
    "points": _with_profile_id("owned_points", _points("owned_points", CUSTOMER)),
    "history": HISTORY,
    "matrix": MATRIX,
    "seasons": SEASONS,
    "offers": OFFERS,
    "promo": PROMO,
    "promo_row": PROMO_ROW,
    "labelled_buyers": LABELS,
    "active": ACTIVE,
    "base": BASE,
    "views": VIEWS,
    "event_shops": EVENT_SHOPS,
    "weekly": WEEKLY,
    "statistics": STATISTICS,
    "predictions": PREDICTIONS,
    "likelihood": LIKELIHOOD,
    "previous": PREVIOUS,
    "assigned": ASSIGNED,
    "embedded": EMBEDDED,
    "labelled": LABELLED,
    "scored_customers": SCORED_CUSTOMERS,
    "scored": SCORED,
    "ties_curve": _curve("score_ties"),
    "fine_curve": _curve("score_fine"),
    "segmented": SEGMENTED,
    "segment_curve": _curve("score", "segmented", "segment"),
    "features": _features("INNER"),
    "features_unprofiled": _features(
        "LEFT", "st.weeks_views, st.shop_view_weeks, round(st.lambda_views, 4) AS lambda_views, "
    ),
}


def with_ctes(statement: str) -> str:
    """Prefix a statement with the expressions it names, directly or through others."""
    needed: set[str] = set()
    pending = [statement]
    while pending:
        words = set(re.findall(r"\b[a-z_]+\b", pending.pop()))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            pending.append(CTES[name])
    parts = [f"{name} AS ({CTES[name]})" for name in CTES if name in needed]
    return f"WITH {', '.join(parts)} {statement}" if parts else statement


STATEMENTS: dict[str, str] = {
    "week_calendar": """
        SELECT CAST(c.start_date AS VARCHAR) AS start_date, CAST(c.end_date AS VARCHAR) AS end_date,
               c.deal_yr, c.deal_wk, c.week_identifier, c.deal_season_num,
               CAST(substr(c.week_identifier, 1, 4) AS INTEGER) AS id_year,
               CAST(substr(c.week_identifier, 7, 2) AS INTEGER) AS id_week,
               CAST(c.deal_yr - 1 AS VARCHAR) || substr(c.week_identifier, 5) AS previous_year_week,
               count(o.o_orderkey) AS orders
        FROM calendar c LEFT JOIN orders o ON CAST(o.o_orderdate AS DATE) BETWEEN c.start_date AND c.end_date
        GROUP BY c.start_date, c.end_date, c.deal_yr, c.deal_wk, c.week_identifier, c.deal_season_num""",
    "clean_transactions": """
        SELECT cardnumber, banner, lms_transaction_id, p_trans_dateid, CAST(tx_date AS VARCHAR) AS tx_date,
               CAST(epoch(tx_date) AS BIGINT) AS tx_epoch, 1 AS purchase_flag, sales,
               CAST(prev_tx_date AS VARCHAR) AS prev_tx_date
        FROM transactions""",
    "interpurchase_gaps": """
        SELECT cardnumber, banner, lms_transaction_id, CAST(tx_date AS VARCHAR) AS tx_date,
               date_diff('day', prev_tx_date, tx_date) AS gap_days
        FROM transactions""",
    "purchase_profile": "SELECT * REPLACE (round(avg_days_since_last_purchase, 4) AS avg_days_since_last_purchase, "
    "round(stddev_days_since_last_purchase, 4) AS stddev_days_since_last_purchase) FROM profile",
    "purchase_profile_by_card": f"""
        SELECT p.* EXCLUDE (cardnumber) REPLACE (
                 round(avg_days_since_last_purchase, 4) AS avg_days_since_last_purchase,
                 round(stddev_days_since_last_purchase, 4) AS stddev_days_since_last_purchase),
               a.epcl_profileid, a.epsilon_id
        FROM ({_profile("transactions", "cardnumber, banner")}) p JOIN accounts a ON a.cardnumber = p.cardnumber""",
    "point_summary": """
        SELECT cardnumber, banner, lms_transaction_id, p_trans_dateid, CAST(tx_date AS VARCHAR) AS tx_date,
               CAST(epoch(tx_date) AS BIGINT) AS tx_epoch, CAST(prev_tx_date AS VARCHAR) AS prev_tx_date,
               round(base, 4) AS loyalty_base_points_dol, round(credit, 4) AS loyalty_credit_points_dol,
               round(bonus, 4) AS loyalty_bonus_points_dol, round(redemption, 4) AS loyalty_redemption_points_dol,
               round(total, 4) AS loyalty_total_points_dol, round(dollarbalance, 4) AS dollarbalance,
               CAST(enrolldate AS VARCHAR) AS enrolldate, CAST(registerdate AS VARCHAR) AS registerdate
        FROM summary""",
    "point_profile": """
        SELECT * REPLACE (CAST(register_date AS VARCHAR) AS register_date,
                          CAST(enroll_date AS VARCHAR) AS enroll_date,
                          round(dollarbalance, 4) AS dollarbalance)
        FROM points""",
    "point_profile_by_card": f"""
        SELECT p.* EXCLUDE (cardnumber) REPLACE (CAST(register_date AS VARCHAR) AS register_date,
                          CAST(enroll_date AS VARCHAR) AS enroll_date,
                          round(dollarbalance, 4) AS dollarbalance),
               a.epcl_profileid, a.epsilon_id
        FROM ({_points("summary", "cardnumber, banner")}) p JOIN accounts a ON a.cardnumber = p.cardnumber""",
    "recent_balance": """
        SELECT cardnumber, banner, round(dollarbalance, 4) AS dollarbalance
        FROM summary
        QUALIFY row_number() OVER (PARTITION BY cardnumber, banner
                                   ORDER BY p_trans_dateid DESC, lms_transaction_id DESC) = 1""",
    "purchase_history_range": """
        SELECT epcl_profileid, epsilon_id, banner, week_identifier, 1 AS made_purchase FROM history""",
    "purchase_history_daygrain": """
        SELECT epcl_profileid, epsilon_id, banner, week_identifier, 1 AS made_purchase FROM history""",
    "purchase_history_matrix": "SELECT * FROM matrix",
    "season_matrix": "SELECT * FROM seasons",
    "adhoc_offers": "SELECT * REPLACE (CAST(start_date AS VARCHAR) AS start_date, "
    "CAST(end_date AS VARCHAR) AS end_date) FROM offers",
    "promo_weeks_overlap": "SELECT week_identifier, deal_yr, deal_wk, npp_flag FROM promo",
    "promo_weeks_explode": "SELECT week_identifier, deal_yr, deal_wk, npp_flag FROM promo",
    "promo_year_totals": "SELECT deal_yr, sum(npp_flag) AS flagged_weeks FROM promo GROUP BY deal_yr",
    "promo_without_oldest": """
        SELECT week_identifier, deal_yr, deal_wk, npp_flag FROM promo
        WHERE week_identifier <= '2001_327' AND week_identifier NOT IN (
          SELECT DISTINCT week_identifier FROM promo ORDER BY week_identifier LIMIT 2)""",
    "promo_matrix": "SELECT * FROM promo_row",
    "purchase_labels": "SELECT * FROM labelled_buyers",
    "labelled_customers": "SELECT * FROM labelled",
    "customer_base": """
        SELECT customerid, deal_yr, deal_wk, CAST(start_date AS VARCHAR) AS start_date,
               CAST(end_date AS VARCHAR) AS end_date, week_identifier, p_banner
        FROM base""",
    "offer_views_by_week": """
        SELECT customerid, view_ind, p_banner, CAST(view_date AS VARCHAR) AS view_date,
               CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
               deal_yr, deal_wk, week_identifier, deal_season_num
        FROM views""",
    "transaction_base": """
        SELECT a.customerid, t.p_trans_dateid, CAST(t.tx_date AS VARCHAR) AS transaction_date,
               t.banner AS p_banner, t.lms_transaction_id, 1 AS purchase_flag, t.sales,
               CAST(epoch(t.tx_date) AS BIGINT) AS tx_epoch, CAST(t.prev_tx_date AS VARCHAR) AS prev_tx_date,
               CAST(c.start_date AS VARCHAR) AS start_date, CAST(c.end_date AS VARCHAR) AS end_date,
               c.deal_yr, c.deal_wk, c.week_identifier, c.deal_season_num
        FROM transactions t JOIN accounts a ON a.cardnumber = t.cardnumber
        JOIN calendar c ON t.tx_date BETWEEN c.start_date AND c.end_date""",
    "weekly_shop_view": """
        SELECT * REPLACE (CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
                          CAST(last_shop_date AS VARCHAR) AS last_shop_date)
        FROM weekly""",
    "statistic_features": """
        SELECT * REPLACE (CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
                          round(lambda_views, 6) AS lambda_views)
        FROM statistics""",
    "embedding_table": "SELECT * FROM embedded",
    "feature_matrix": "SELECT * FROM features",
    "score_matrix": "SELECT * EXCLUDE (purchase_flag) FROM features",
    "feature_matrix_unprofiled": "SELECT * FROM features_unprofiled",
    "labelled_embeddings": "SELECT e.*, coalesce(l.purchase_flag, 'N') AS purchase_flag, "
    "CASE WHEN l.purchase_flag = 'Y' THEN 1 ELSE 0 END AS label "
    "FROM embedded e LEFT JOIN labelled_buyers l ON l.epsilon_id = e.epsilon_id",
    "null_audit": "SELECT column_name, CAST(nulls AS BIGINT) AS null_count FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM profile"
        for c in ("epcl_profileid", "epsilon_id", "banner", "total_purchases", "first_purchase_date",
                  "last_purchase_date", "days_since_first_purchase", "days_since_last_purchase",
                  *(f"num_of_purchases_last_{d}_days" for d in WINDOWS),
                  *(f"sales_last_{d}_days" for d in WINDOWS), *GAPS)
    )
    + ") WHERE nulls > 0",
    "median_fill": f"""
        SELECT pr.epsilon_id, {", ".join(
            f"round(coalesce(CAST(pr.{c} AS DOUBLE), md.{c}), 4) AS {c}" for c in GAPS)}
        FROM profile pr
        CROSS JOIN (SELECT {", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in GAPS)} FROM profile) md""",
    "class_balance": """
        SELECT count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives,
               CAST(sum(1 - label) AS BIGINT) AS negatives,
               round(CAST(sum(1 - label) AS DOUBLE) / greatest(sum(label), 1), 6) AS scale_pos_weight
        FROM labelled""",
    "binary_columns": "SELECT column_name, by_name, CASE WHEN outside = 0 THEN 1 ELSE 0 END AS by_value FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {int('weeks_back' in c or 'deal_season' in c)} AS by_name, "
        f"count(CASE WHEN \"{c}\" NOT IN (0, 1) THEN 1 END) AS outside FROM {t}"
        for t, names in (
            ("matrix", [f"{n}_weeks_back_purchase" for n in range(1, WEEKS + 1)]),
            ("seasons", [f"deal_season_num_{n}" for n in range(1, 5)]),
            ("profile", ["total_purchases", "days_since_first_purchase", "days_since_last_purchase", *GAPS]
             + [f"{kind}_last_{d}_days" for d in WINDOWS for kind in ("num_of_purchases", "sales")]),
        )
        for c in names
    )
    + ")",
    "likelihood_labels": """
        SELECT * REPLACE (round(predicted_purchase_prob, 6) AS predicted_purchase_prob,
                          round(prob_shop_n_view_exp_01w, 6) AS prob_shop_n_view_exp_01w,
                          round(prob_view_exp_01w, 6) AS prob_view_exp_01w,
                          round(aided_prob, 6) AS aided_prob, round(lift_ratio, 6) AS lift_ratio)
        FROM likelihood""",
    "test_control": "SELECT customer_id, epsilon_id, 'B1' AS banner, group_flag FROM assigned",
    "final_labels": """
        SELECT DISTINCT p.customer_id AS customerid, p.banner,
               coalesce(a.shop_prob_label, p.shop_prob_label) AS shop_prob_label,
               coalesce(a.lift_label, p.lift_label) AS lift_label
        FROM previous p LEFT JOIN assigned a
          ON a.customer_id = p.customer_id AND p.banner = 'B1' AND a.group_flag = 'T'""",
    "group_counts": "SELECT group_flag, count(*) AS count FROM assigned GROUP BY group_flag",
    "banner_counts": "SELECT banner, count(*) AS count FROM previous GROUP BY banner",
    "stratified_split": """
        SELECT c_custkey, c_mktsegment,
               CASE WHEN place < 0.6 THEN 'train' WHEN place < 0.8 THEN 'validation' ELSE 'test' END AS split
        FROM (
          SELECT c_custkey, c_mktsegment,
                 CAST(row_number() OVER (PARTITION BY c_mktsegment
                        ORDER BY md5('split:42:' || CAST(c_custkey AS VARCHAR))) - 1 AS DOUBLE)
                 / count(*) OVER (PARTITION BY c_mktsegment) AS place
          FROM customer
        )""",
    "stratified_sample": """
        SELECT o_orderkey, o_orderstatus FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_orderstatus
                                   ORDER BY md5('sample:42:' || CAST(o_orderkey AS VARCHAR)))
                <= ceil(0.02::DOUBLE * count(*) OVER (PARTITION BY o_orderstatus))""",
    "balanced_copies": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
               count(*) AS copies
        FROM lineitem
        JOIN (SELECT 1 AS lo UNION ALL SELECT 2) k ON k.lo <= CASE WHEN l_returnflag <> 'R' THEN 1
             ELSE 1 + CASE WHEN {_fraction("l_orderkey", "copies")} < 2.5::DOUBLE - 2 THEN 1 ELSE 0 END END
        GROUP BY ALL""",
    "roc_auc": "SELECT 'score_ties' AS score, round(sum(neg * (tp - pos / 2.0::DOUBLE)) "
    "/ nullif(max(positives * negatives), 0), 6) AS roc_auc FROM ties_curve "
    "UNION ALL SELECT 'score_fine', round(sum(neg * (tp - pos / 2.0::DOUBLE)) "
    "/ nullif(max(positives * negatives), 0), 6) FROM fine_curve",
    "average_precision": "SELECT 'score_ties' AS score, round(sum(pos / positives * (tp / (tp + fp))), 6) "
    "AS average_precision FROM ties_curve UNION ALL "
    "SELECT 'score_fine', round(sum(pos / positives * (tp / (tp + fp))), 6) FROM fine_curve",
    "optimal_threshold": """
        SELECT threshold AS optimal_threshold, round(f1, 6) AS optimal_f1
        FROM (
          SELECT threshold, 2 * p * r / (p + r + 1e-9) AS f1
          FROM (SELECT threshold, tp / (tp + fp) AS p, tp / positives AS r FROM fine_curve)
        ) ORDER BY f1 DESC, threshold LIMIT 1""",
    "roc_curve": "SELECT threshold, round(fp / negatives, 6) AS fpr, round(tp / positives, 6) AS tpr FROM fine_curve",
    "pr_curve": "SELECT threshold, round(tp / (tp + fp), 6) AS precision, round(tp / positives, 6) AS recall "
    "FROM fine_curve",
    "confusion_matrix": """
        SELECT actual, CASE WHEN score_fine >= 0.5 THEN 1 ELSE 0 END AS predicted, count(*) AS count
        FROM scored GROUP BY ALL""",
}

_REPORT = """
    SELECT {keys} round(coalesce(tn / nullif(tn + fn, 0), 0), 6) AS precision_0,
           round(coalesce(tn / nullif(tn + fp, 0), 0), 6) AS recall_0,
           round(coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0), 6) AS f1_0,
           CAST(tn + fp AS BIGINT) AS support_0,
           round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision_1,
           round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall_1,
           round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1_1,
           CAST(tp + fn AS BIGINT) AS support_1,
           round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
           CAST(tp + tn + fp + fn AS BIGINT) AS support_total,
           round((coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0)
                  + coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)) / 2, 6) AS macro_f1,
           round((coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) * (tn + fp)
                  + coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) * (tp + fn)) / (tp + tn + fp + fn), 6)
             AS weighted_f1
           {extra}
    FROM (
      SELECT {keys} CAST(count(CASE WHEN actual = 1 AND predicted = 1 THEN 1 END) AS DOUBLE) AS tp,
             CAST(count(CASE WHEN actual = 0 AND predicted = 1 THEN 1 END) AS DOUBLE) AS fp,
             CAST(count(CASE WHEN actual = 1 AND predicted = 0 THEN 1 END) AS DOUBLE) AS fn,
             CAST(count(CASE WHEN actual = 0 AND predicted = 0 THEN 1 END) AS DOUBLE) AS tn
      FROM {rows} GROUP BY ALL
    ) {join}
"""

STATEMENTS["classification_report"] = _REPORT.format(
    keys="",
    rows="(SELECT actual, CASE WHEN score_fine >= 0.5 THEN 1 ELSE 0 END AS predicted FROM scored)",
    extra="",
    join="",
)
STATEMENTS["segment_metrics"] = _REPORT.format(
    keys="segment,",
    rows="segmented",
    extra=", round(auc, 6) AS roc_auc",
    join="""JOIN (
      SELECT segment AS name, sum(neg * (tp - pos / 2.0::DOUBLE)) / nullif(max(positives * negatives), 0) AS auc
      FROM segment_curve GROUP BY segment
    ) ON name = segment""",
)
STATEMENTS["threshold_sweep"] = """
    SELECT threshold, round(p, 6) AS precision, round(r, 6) AS recall,
           round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1, tp, fp, fn, tn
    FROM (
      SELECT *, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 1) AS p,
             coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS r
      FROM (
        SELECT threshold, count(CASE WHEN actual = 1 AND score_fine >= threshold THEN 1 END) AS tp,
               count(CASE WHEN actual = 0 AND score_fine >= threshold THEN 1 END) AS fp,
               count(CASE WHEN actual = 1 AND score_fine < threshold THEN 1 END) AS fn,
               count(CASE WHEN actual = 0 AND score_fine < threshold THEN 1 END) AS tn
        FROM scored CROSS JOIN (
          SELECT CAST(unnest([0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS DOUBLE) AS threshold
        ) GROUP BY threshold
      )
    )"""
STATEMENTS["standard_scale"] = (
    "SELECT vec_id, "
    + ", ".join(
        f"round((CAST(embedding[{i + 1}] AS DOUBLE) - avg(CAST(embedding[{i + 1}] AS DOUBLE)) OVER ()) "
        f"/ stddev_pop(CAST(embedding[{i + 1}] AS DOUBLE)) OVER (), 4) AS scaled_{i}"
        for i in range(WIDTH)
    )
    + " FROM embeddings"
)
STATEMENTS["queried_views"] = """
    SELECT md5(upper(trim(CAST(c_custkey AS VARCHAR)))) AS epsilon_id, 'B1' AS p_banner,
           strftime(ts, '%Y-%m-%d') AS view_date, count(*) AS impressions
    FROM events JOIN customer ON c_custkey = user_id
    WHERE event_type IN ('view', 'click', 'signup') AND user_id % 7 <> 0
      AND CAST(ts AS DATE) >= DATE '2021-01-27' AND CAST(ts AS DATE) < DATE '2024-01-27'
    GROUP BY ALL"""
STATEMENTS["offer_files_roundtrip"] = STATEMENTS["adhoc_offers"]
STATEMENTS["csv_sample_roundtrip"] = STATEMENTS["stratified_sample"]
STATEMENTS["feature_export_roundtrip"] = """
    SELECT epsilon_id, days_since_last_purchase, total_purchases, purchase_flag FROM labelled"""
STATEMENTS["class_weights"] = """
    SELECT epsilon_id, label, CASE WHEN label = 1 THEN round((
             SELECT CAST(sum(1 - label) AS DOUBLE) / greatest(sum(label), 1) FROM labelled), 6)
           ELSE 1.0::DOUBLE END AS weight
    FROM labelled"""
STATEMENTS["write_snapshot_roundtrip"] = """
    SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment,
           CASE WHEN c_custkey % 2 = 0 THEN '2001_327' ELSE '2001_329' END AS week_identifier
    FROM customer"""

_NULL_AUDITED = {
    "purchase_profile": ("profile", [
        "epcl_profileid", "epsilon_id", "banner", "total_purchases", "first_purchase_date", "last_purchase_date",
        "days_since_first_purchase", "days_since_last_purchase", *GAPS,
        *(f"{kind}_last_{d}_days" for d in WINDOWS for kind in ("num_of_purchases", "sales"))]),
    "point_profile": ("points", [
        "epcl_profileid", "epsilon_id", "banner", "register_date", "enroll_date", "dollarbalance",
        *(f"{name}_last_{d}_days" for d in WINDOWS for name in MEASURES)]),
    "purchase_history": ("history", ["epcl_profileid", "epsilon_id", "banner", "week_identifier"]),
    "promo_matrix": ("promo_row", [f"{n}_weeks_back_NPP_npp_flag" for n in range(1, WEEKS + 1)]),
    "purchase_labels": ("labelled_buyers", ["epcl_profileid", "epsilon_id", "banner", "purchase_flag"]),
    "embedding_table": ("embedded", ["lightfm_id", "user_id", "epsilon_id", *(f"latent_{i}" for i in range(WIDTH))]),
}
STATEMENTS["null_audits"] = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) - count(\"{c}\") AS null_count FROM {rows}"
    for table, (rows, columns) in _NULL_AUDITED.items()
    for c in columns
) + ") WHERE null_count > 0"
STATEMENTS["exported_matrix"] = """
    SELECT * EXCLUDE (lightfm_id, user_id, register_date, enroll_date, first_purchase_date, last_purchase_date)
    FROM features"""
STATEMENTS["sampled_matrix"] = """
    SELECT * EXCLUDE (lightfm_id, user_id, epcl_profileid, register_date, enroll_date, first_purchase_date,
                      last_purchase_date)
    FROM features
    QUALIFY row_number() OVER (PARTITION BY purchase_flag ORDER BY md5('sample:42:' || epsilon_id))
            <= ceil(0.02::DOUBLE * count(*) OVER (PARTITION BY purchase_flag))"""
STATEMENTS["saved_scaling"] = STATEMENTS["standard_scale"]
STATEMENTS["stored_tables"] = """
    SELECT o_orderkey, o_orderstatus, 'replaced' AS stored_as FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_orderstatus, 'parts' FROM orders
    UNION ALL SELECT o_orderkey, o_orderstatus, 'log' FROM orders WHERE o_orderstatus IN ('F', 'O')"""
STATEMENTS["best_suppliers"] = """
    SELECT s_name, CAST(floor(s_acctbal / 500) AS BIGINT) AS score FROM supplier
    ORDER BY score DESC, s_name LIMIT 40"""


def _auc_of(curve: str, by: str) -> str:
    return f"""
    SELECT {by}, sum(neg * (tp - pos / 2.0::DOUBLE)) / nullif(max(positives * negatives), 0) AS auc
    FROM ({curve}) GROUP BY {by}"""


_STACKED = """(
    SELECT 'ties' AS model, CASE WHEN l_linenumber % 2 = 0 THEN 'validation' ELSE 'test' END AS split,
           CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS actual, CAST(l_discount AS DOUBLE) AS p FROM lineitem
    UNION ALL
    SELECT 'fine', CASE WHEN l_linenumber % 2 = 0 THEN 'validation' ELSE 'test' END,
           CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END, round(l_extendedprice / 110000, 6) FROM lineitem)"""
STATEMENTS["compared_scores"] = f"""
    SELECT model, round(max(CASE WHEN split = 'validation' THEN auc END), 4) AS validation_auc,
           round(max(CASE WHEN split = 'test' THEN auc END), 4) AS test_auc
    FROM ({_auc_of(_curve("p", _STACKED, "model, split"), "model, split")}) GROUP BY model"""

_TOP_JSON = """(
    SELECT '[' || string_agg('{{"feature":"' || n_name || '","mean_abs_shap_value":' || CAST({value} AS VARCHAR) || '}}',
                             ',' ORDER BY {value} DESC) || ']' FROM nation)"""
STATEMENTS["performance_of_lines"] = _REPORT.format(
    keys="",
    rows="(SELECT actual, CASE WHEN score_fine >= 0.5 THEN 1 ELSE 0 END AS predicted FROM scored)",
    extra=f""", round(auc, 6) AS roc_auc, threshold AS optimal_threshold, round(f1, 6) AS optimal_f1,
      'boosted_trees' AS model_type, 'B1' AS banner, '2001-06-30 00:00:00' AS train_timestamp,
      'balance_cents,nation,segment_length' AS feature_cols,
      '{{"max_depth": 4, "learning_rate": 0.5}}' AS hyperparameters,
      {_TOP_JSON.format(value="(n_nationkey / 32.0::DOUBLE)")} AS top_20_shap_features_class_1,
      {_TOP_JSON.format(value="(1 - n_nationkey / 32.0::DOUBLE)")} AS top_20_shap_features_class_0,
      '2001_327' AS week_identifier""",
    join=f"""CROSS JOIN ({_auc_of(_curve("score_fine"), "'all'")}) CROSS JOIN (
      SELECT threshold, 2 * p * r / (p + r + 1e-9) AS f1
      FROM (SELECT threshold, tp / (tp + fp) AS p, tp / positives AS r FROM fine_curve)
      ORDER BY f1 DESC, threshold LIMIT 1
    )""",
).replace("{{", "{").replace("}}", "}")

# Receivers of rank r take one value from the donor of rank r; hash orders are those of the operator.
_PERMUTED = """
    WITH v AS (
      SELECT c_custkey, CASE WHEN c_acctbal + c_nationkey * 150 > 5000 THEN 1 ELSE 0 END AS actual,
             round(c_acctbal * 100) AS x0, CAST(c_nationkey AS DOUBLE) AS x1, CAST(length(c_mktsegment) AS DOUBLE) AS x2
      FROM customer
    ), receivers AS (
      SELECT v.*, k.turn, row_number() OVER (PARTITION BY k.turn ORDER BY
               md5('receiver:' || CAST(c_custkey AS VARCHAR) || '#' || CAST(k.turn AS VARCHAR))) AS place
      FROM v CROSS JOIN (SELECT unnest(range(1, 6)) AS turn) k
    ), donors AS (
      SELECT x0 AS d0, x1 AS d1, x2 AS d2, row_number() OVER (ORDER BY md5('donor:' || CAST(c_custkey AS VARCHAR))) AS place
      FROM v
    ), shuffled AS (
      SELECT turn, f.i AS i, actual,
             (CASE WHEN f.i = 0 THEN d0 ELSE x0 END + CASE WHEN f.i = 1 THEN d1 ELSE x1 END * 20000
              + CASE WHEN f.i = 2 THEN d2 ELSE x2 END * 30000 + 1000000) / 10000000::DOUBLE AS p
      FROM receivers JOIN donors USING (place) CROSS JOIN (SELECT unnest(range(0, 3)) AS i) f
      UNION ALL
      SELECT 0, 9, actual, (x0 + x1 * 20000 + x2 * 30000 + 1000000) / 10000000::DOUBLE FROM v
    ), found AS (
"""
STATEMENTS["permutation_of_customers"] = (
    _PERMUTED
    + _auc_of(_curve("p", "shuffled", "turn, i"), "turn, i")
    + """)
    SELECT CASE i WHEN 0 THEN 'balance_cents' WHEN 1 THEN 'nation' ELSE 'segment_length' END AS feature,
           round((SELECT auc FROM found WHERE i = 9) - avg(auc), 6) AS importance
    FROM found WHERE i < 9 GROUP BY i"""
)
STATEMENTS["shapley_of_fixed_tree"] = """
    WITH t AS (
      SELECT CASE WHEN c_acctbal > 4000 THEN 1.0::DOUBLE ELSE 0.0 END AS m0,
             CASE WHEN c_nationkey > 10 THEN 1.0::DOUBLE ELSE 0.0 END AS m1
      FROM customer
    ), v AS (
      SELECT avg(0.2 * ((1 - m0) - 0.6) + (m0 - 0.4) * (0.3 * (0.5 + 1 - m1) + 0.9 * (0.5 + m1)) / 2) AS balance,
             avg((0.4 + m0) / 2 * (0.3 * ((1 - m1) - 0.5) + 0.9 * (m1 - 0.5))) AS nation
      FROM t
    ), one AS (
      SELECT 'balance' AS feature, 0.36 + balance AS p FROM v
      UNION ALL SELECT 'nation', 0.36 + nation FROM v
      UNION ALL SELECT 'unused', 0.36
    )
    SELECT feature, 'class_1' AS class, round(p, 6) AS mean_abs_shap_value FROM one
    UNION ALL SELECT feature, 'class_0', round(1 - p, 6) FROM one"""

STATEMENTS["refitted_leaves"] = """
    WITH r AS (
      SELECT CASE WHEN c_acctbal <= 4000 THEN 0 WHEN c_nationkey <= 10 THEN 1 ELSE 2 END AS leaf,
             CASE WHEN c_acctbal + c_nationkey * 150 > 5000 THEN 1 ELSE 0 END AS label,
             1 / (1 + exp(-(c_nationkey / 10.0 - 1.0))) AS p,
             CASE WHEN c_mktsegment = 'BUILDING' THEN 2.0::DOUBLE ELSE 1.0 END AS weight
      FROM customer
    ), g AS (
      SELECT leaf, count(*) AS rows, sum(weight * (p - label)) AS gradient, sum(weight * p * (1 - p)) AS hessian
      FROM r GROUP BY leaf
    )
    SELECT leaf, rows, round(gradient, 6) AS gradient, round(hessian, 6) AS hessian,
           round(CASE WHEN hessian >= 2.0 THEN 0.5 * greatest(-0.9, least(0.9,
             -sign(gradient) * greatest(abs(gradient) - 1.5, 0) / (hessian + 3.0))) ELSE 0 END, 6) AS value
    FROM g"""
STATEMENTS["gap_sketch_quartiles"] = f"""
    SELECT cardnumber, banner, CAST(days_since_last_purchase_p25 AS BIGINT) AS p25,
           CAST(days_since_last_purchase_p50 AS BIGINT) AS p50, CAST(days_since_last_purchase_p75 AS BIGINT) AS p75,
           total_purchases - 1 AS n_values
    FROM ({_profile("transactions", "cardnumber, banner")}) WHERE total_purchases > 1"""
STATEMENTS["json_records"] = """
    SELECT CASE WHEN s_suppkey % 7 = 0 THEN 1 ELSE 0 END AS _broken_record,
           CASE WHEN s_suppkey % 7 <> 0 THEN s_nationkey END AS s_nationkey,
           count(*) AS records, CAST(sum(CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey END) AS BIGINT) AS keys
    FROM supplier GROUP BY 1, 2"""
STATEMENTS["upserted_log"] = """
    SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice
    FROM orders GROUP BY o_custkey"""
STATEMENTS["weeks_of_runs"] = """
    SELECT c.week_identifier, CAST(c.start_date AS VARCHAR) AS start_date, CAST(c.end_date AS VARCHAR) AS end_date,
           count(o.o_orderkey) AS orders
    FROM calendar c LEFT JOIN orders o ON CAST(o.o_orderdate AS DATE) BETWEEN c.start_date AND c.end_date
    WHERE c.week_identifier IN ('2001_327', '2001_329', '2024_305')
    GROUP BY c.week_identifier, c.start_date, c.end_date"""


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(statement) for name, statement in STATEMENTS.items()}
