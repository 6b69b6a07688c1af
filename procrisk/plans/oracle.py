"""The test views and derived tables as SQL, to check the DataFrame results against."""

VIEWS = """
contracts AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS lot_id, o_orderstatus AS provider_bin,
         CAST(o_custkey AS VARCHAR) AS customer_bin,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS contract_sum,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - 2 * CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE)
           AS paid_sum,
         MAX(l_shipdate) AS accept_date, MAX(l_linenumber) AS order_method_id
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2, 3
),
lots AS (
  SELECT CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS lot_id,
         CAST(o_custkey AS VARCHAR) AS plan_id, 'T' || o_custkey AS tender_id,
         o_totalprice AS lot_amount, o_orderpriority AS title_ru,
         CAST(CAST(SUBSTR(o_orderpriority, 1, 1) AS INTEGER) + 1 AS INTEGER) AS lot_method_id,
         o_orderdate AS lot_start_date
  FROM orders
),
plans AS (
  SELECT CAST(c_custkey AS VARCHAR) AS plan_id, c_acctbal AS plan_price,
         c_nationkey AS plan_method_id, CAST(c_nationkey AS VARCHAR) AS plan_customer_bin
  FROM customer WHERE c_acctbal > 0
)"""

_JOINED_COLUMNS = """
  o.lot_id, provider_bin, customer_bin, contract_sum, paid_sum, accept_date, order_method_id,
  l.plan_id, tender_id, lot_amount, title_ru, lot_method_id, lot_start_date,
  plan_price, plan_method_id, plan_customer_bin,
  contract_sum / NULLIF(lot_amount, 0) AS price_ratio,
  paid_sum / NULLIF(contract_sum, 0) AS payment_ratio,
  CAST(CASE WHEN order_method_id = 6 OR lot_method_id = 6 THEN 1 ELSE 0 END AS INTEGER)
    AS single_bidder_flag,
  CAST(CASE WHEN paid_sum < 0.9::DOUBLE * contract_sum THEN 1 ELSE 0 END AS INTEGER)
    AS underpaid_flag"""

JOINED = f"""{VIEWS},
joined AS (
  SELECT {_JOINED_COLUMNS}
  FROM contracts o LEFT JOIN lots l ON o.lot_id = l.lot_id
       LEFT JOIN plans p ON l.plan_id = p.plan_id
  WHERE o.lot_id IS NOT NULL
)"""

CHAINS = f"""{VIEWS},
joined AS (
  SELECT {_JOINED_COLUMNS}
  FROM contracts o JOIN lots l ON o.lot_id = l.lot_id JOIN plans p ON l.plan_id = p.plan_id
)"""

FEATURED = f"""{JOINED},
prices AS (
  SELECT title_ru, median(contract_sum) AS md, mad(contract_sum) AS d, count(contract_sum) AS n
  FROM joined GROUP BY 1
),
flags AS (
  SELECT j.* EXCLUDE (underpaid_flag),
    CAST(year(lot_start_date) AS INTEGER) AS year, CAST(month(lot_start_date) AS INTEGER) AS month,
    CAST(quarter(lot_start_date) AS INTEGER) AS quarter,
    CAST(isodow(lot_start_date) - 1 AS INTEGER) AS day_of_week,
    CAST(year(lot_start_date) AS INTEGER) AS fiscal_year,
    CAST(floor(epoch(accept_date - lot_start_date) / 86400) AS INTEGER) AS processing_days,
    CASE WHEN n >= 3 AND d > 0 THEN coalesce(0.6745::DOUBLE * (contract_sum - md) / d, 0)
         ELSE 0 END AS price_z,
    CAST(CASE WHEN order_method_id = 6 OR lot_method_id = 6 THEN 1 ELSE 0 END AS INTEGER)
      AS single_flag,
    CAST(CASE WHEN customer_bin IS NOT NULL AND provider_bin IS NOT NULL
      AND count(*) OVER (PARTITION BY customer_bin) >= 5
      AND count(*) OVER (PARTITION BY customer_bin, provider_bin)
          / count(*) OVER (PARTITION BY customer_bin) > 0.6::DOUBLE THEN 1 ELSE 0 END AS INTEGER)
      AS repeat_flag,
    CAST(CASE WHEN customer_bin IS NOT NULL AND j.title_ru IS NOT NULL AND contract_sum <= 250000
      AND count(lot_start_date) FILTER (contract_sum <= 250000) OVER g >= 3
      AND max(lot_start_date) FILTER (contract_sum <= 250000) OVER g
        - min(lot_start_date) FILTER (contract_sum <= 250000) OVER g <= INTERVAL 365 DAY
      THEN 1 ELSE 0 END AS INTEGER) AS split_flag,
    CAST(CASE WHEN contract_sum > 0 AND paid_sum < 0.9::DOUBLE * contract_sum THEN 1 ELSE 0 END
      AS INTEGER) AS underpaid_flag
  FROM joined j LEFT JOIN prices p ON j.title_ru = p.title_ru
  WINDOW g AS (PARTITION BY customer_bin, j.title_ru)
),
scored AS (
  SELECT *, CAST(price_z > 3 AS INTEGER) AS price_flag,
    CAST(2 * CAST(price_z > 3 AS INTEGER) + 1.5 * single_flag + 1.5 * repeat_flag + split_flag
      + underpaid_flag AS DOUBLE) AS risk_score, '' AS composite_key
  FROM flags
),
featured AS (
  SELECT *, CASE WHEN risk_score <= 1 THEN 'Low' WHEN risk_score <= 3 THEN 'Medium' ELSE 'High' END
    AS risk_category
  FROM scored
)"""


def over(tables: str, body: str) -> str:
    """A query over one of the chains above."""
    return f"WITH {tables}\n{body}"
