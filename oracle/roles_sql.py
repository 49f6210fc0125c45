"""DuckDB definitions of the raw role frames (mirror of lakeworks/sources/roles.py)."""

CUR = "['USD','EUR','GBP','JPY','CAD','AUD']"

ROLES = {
    "r_team": """
SELECT 'BU_' || CAST(r_regionkey AS VARCHAR) AS source_key,
       'EK_BU_' || CAST(r_regionkey AS VARCHAR) AS enterprise_key,
       'team_' || lower(replace(r_name, ' ', '_')) AS bu_code,
       r_name AS bu_name, 'TEAM' AS bu_type,
       CASE WHEN r_regionkey % 2 = 0 THEN 'PD_' ELSE 'PM_' END || upper(replace(r_name, ' ', '_')) AS strategy_name,
       make_date(1990, CAST(r_regionkey + 1 AS INTEGER), 1) AS established_date,
       CAST(r_regionkey AS BIGINT) AS region_key
FROM region""",
    "r_compliance": """
SELECT DISTINCT 'RISK_' || substring(o_orderpriority, 1, 1) AS risk_team_code FROM orders""",
    "r_portfolio": f"""
SELECT 'SUP_' || CAST(s_suppkey AS VARCHAR) AS source_key,
       'EK_SUP_' || CAST(s_suppkey AS VARCHAR) AS enterprise_key,
       s_name AS portfolio_name, 'STRAT_' || n_name AS strategy_name,
       {CUR}[n_nationkey % 6 + 1] AS currency_code,
       'BU_' || CAST(n_regionkey AS VARCHAR) AS bu_source_key,
       n_name AS nation_name, CAST(s_suppkey AS BIGINT) AS supplier_key
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "r_security": """
WITH b AS (SELECT *, CAST(DATE '1994-01-01' + CAST(p_partkey % 365 AS INTEGER) AS DATE) AS d0 FROM part),
v AS (
  SELECT 'PRT_' || CAST(p_partkey AS VARCHAR) AS source_key, p_name AS security_name, d0 AS issue_date, 1 AS version_no, * FROM b
  UNION ALL
  SELECT 'PRT_' || CAST(p_partkey AS VARCHAR) || '_v2', p_name || ' (Reissued)', CAST(d0 + 1460 AS DATE), 2, * FROM b WHERE p_partkey % 20 = 0)
SELECT source_key, 'EK_PRT_' || CAST(p_partkey AS VARCHAR) AS enterprise_key, security_name,
       p_type AS security_type, p_type AS asset_class, 'SIZE_' || CAST(p_size % 5 AS VARCHAR) AS sub_asset_class,
       issue_date, CAST(issue_date + 3650 AS DATE) AS maturity_date,
       round((p_size % 10) / 100.0, 4) AS coupon_rate, 'USD' AS currency_code,
       'BRD_' || substring(p_brand, 7, 4) AS issuer_source_key,
       CAST(p_retailprice AS DECIMAL(18,2)) AS par_value, CAST(version_no AS INTEGER) AS version_no,
       CAST(p_partkey AS BIGINT) AS part_key, p_brand AS brand
FROM v""",
    "r_entity": """
WITH b AS (SELECT c_custkey, c_name, c_mktsegment, n_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey),
v AS (
  SELECT 'CUS_' || CAST(c_custkey AS VARCHAR) AS source_key, c_name AS entity_name,
         CAST(DATE '1990-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS DATE) AS formation_date, 1 AS version_no, * FROM b
  UNION ALL
  SELECT 'CUS_' || CAST(c_custkey AS VARCHAR) || '_v2', c_name || ' (Restructured)',
         CAST(DATE '1998-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE), 2, * FROM b WHERE c_custkey % 10 = 0)
SELECT source_key, 'EK_CUS_' || CAST(c_custkey AS VARCHAR) AS enterprise_key, entity_name,
       c_mktsegment AS entity_type, n_name AS jurisdiction, formation_date, n_name AS country,
       CAST(version_no AS INTEGER) AS version_no, CAST(c_custkey AS BIGINT) AS customer_key,
       CAST(n_regionkey AS BIGINT) AS region_key
FROM v""",
    "r_contract": f"""
WITH b AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
                  CAST(o_totalprice AS DECIMAL(18,2)) AS principal, CAST(o_orderdate AS DATE) AS signing FROM orders),
v AS (
  SELECT 'ORD_' || CAST(o_orderkey AS VARCHAR) AS source_key, signing AS signing_date, principal AS principal_local,
         1 AS version_no, * FROM b
  UNION ALL
  SELECT 'ORD_' || CAST(o_orderkey AS VARCHAR) || '_v2', CAST(signing + 365 AS DATE),
         CAST(CAST(principal AS DECIMAL(38,2)) * 1.5 AS DECIMAL(18,2)), 2, * FROM b WHERE o_orderkey % 20 = 0)
SELECT source_key, 'EK_ORD_' || CAST(o_orderkey AS VARCHAR) AS enterprise_key,
       'Contract ' || CAST(o_orderkey AS VARCHAR) AS contract_name,
       'CUS_' || CAST(o_custkey AS VARCHAR) AS entity_source_key,
       substring(o_orderpriority, 3, 20) AS contract_type, signing_date,
       CAST(signing_date + 1825 AS DATE) AS maturity_date, principal_local,
       {CUR}[o_custkey % 6 + 1] AS currency_code,
       round((o_orderkey % 7) / 100.0, 4) AS coupon_rate,
       round((o_orderkey % 5) / 1000.0, 4) AS spread_over_benchmark,
       CASE WHEN o_orderstatus = 'P' THEN 'RESTRUCTURED' ELSE 'ACTIVE' END AS status,
       CAST(version_no AS INTEGER) AS version_no, CAST(o_orderkey AS BIGINT) AS order_key
FROM v""",
    "r_rating": """
WITH d AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS rating_date,
                  row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn
           FROM orders)
SELECT 'RAT_' || CAST(o_orderkey AS VARCHAR) AS source_key,
       'CUS_' || CAST(o_custkey AS VARCHAR) AS entity_source_key,
       'EK_CUS_' || CAST(o_custkey AS VARCHAR) AS rated_enterprise_key,
       rating_date,
       ['MOODY','SP','FITCH'][o_custkey % 3 + 1] AS rating_agency,
       ['AAA','AA','A','BBB','BB'][CAST(substring(o_orderpriority, 1, 1) AS INTEGER)] AS rating_value,
       CASE WHEN o_orderstatus = 'F' THEN 'STABLE' WHEN o_orderstatus = 'O' THEN 'POSITIVE' ELSE 'NEGATIVE' END AS rating_outlook,
       'AFFIRM' AS rating_action_type, CAST(o_orderkey AS BIGINT) AS order_key
FROM d WHERE rn = 1""",
    "r_position": """
WITH b AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS source_key,
         'SUP_' || CAST(l_suppkey AS VARCHAR) AS portfolio_source_key,
         'PRT_' || CAST(l_partkey AS VARCHAR) AS security_source_key,
         'ORD_' || CAST(l_orderkey AS VARCHAR) AS contract_source_key,
         CAST(l_shipdate AS DATE) AS position_date,
         CAST(l_quantity AS DECIMAL(18,4)) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS market_value_local,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS book_value_local,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS cost_basis_local,
         CASE WHEN l_linestatus = 'F' THEN 'SETTLED' ELSE 'PENDING' END AS settlement_status,
         l_returnflag AS return_flag,
         ['USD','EUR','GBP','JPY','CAD','AUD'][l_suppkey % 6 + 1] AS currency_code,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus
  FROM lineitem),
b2 AS (SELECT *, CAST(market_value_local - cost_basis_local AS DECIMAL(18,2)) AS unrealized_gl_local FROM b)
SELECT *, 'EK_POS_' || source_key AS enterprise_key FROM b2
UNION ALL
SELECT * REPLACE (CAST(position_date + 1 AS DATE) AS position_date), 'REMAPPED_EK_POS_' || source_key FROM b2
WHERE l_orderkey % 500 = 0""",
    "r_order_lines": """
SELECT l_orderkey, min(l_suppkey) AS first_suppkey, min(l_partkey) AS first_partkey,
       sum(CAST(l_quantity AS DECIMAL(18,4))) AS line_quantity,
       sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS line_amount
FROM lineitem GROUP BY l_orderkey""",
    "r_txn_base": f"""
SELECT 'TXN_' || CAST(o_orderkey AS VARCHAR) AS source_key,
       'EK_TXN_' || CAST(o_orderkey AS VARCHAR) AS enterprise_key,
       'SUP_' || CAST(first_suppkey AS VARCHAR) AS portfolio_source_key,
       'PRT_' || CAST(first_partkey AS VARCHAR) AS security_source_key,
       CAST(o_orderdate AS DATE) AS transaction_date,
       CASE WHEN o_orderkey % 3 = 0 THEN 'SELL' ELSE 'BUY' END AS transaction_type,
       CAST(line_quantity AS DECIMAL(18,4)) AS quantity,
       CAST(line_amount AS DECIMAL(18,2)) AS gross_amount_local,
       {CUR}[o_custkey % 6 + 1] AS currency_code,
       o_orderstatus AS order_status, CAST(o_orderkey AS BIGINT) AS order_key
FROM orders JOIN r_order_lines ON o_orderkey = l_orderkey""",
    "r_settled_transaction": """
SELECT source_key, enterprise_key, portfolio_source_key, security_source_key, transaction_date,
       CAST(transaction_date + 3 AS DATE) AS settlement_date, transaction_type, quantity, gross_amount_local,
       CAST(CAST(gross_amount_local AS DECIMAL(38,2)) * 0.0015 AS DECIMAL(18,2)) AS fees_local,
       CAST(gross_amount_local - CAST(CAST(gross_amount_local AS DECIMAL(38,2)) * 0.0015 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS net_amount_local,
       currency_code, order_key
FROM r_txn_base WHERE order_status = 'F'""",
    "r_trade_blotter": """
SELECT source_key, enterprise_key, portfolio_source_key, security_source_key, transaction_date,
       CASE WHEN order_status = 'F' THEN 'SETTLED' WHEN order_status = 'O' THEN 'PENDING' ELSE 'EXECUTED' END AS trade_status,
       quantity, CASE WHEN transaction_type = 'SELL' THEN 'S' ELSE 'B' END AS side, currency_code, order_key
FROM r_txn_base""",
    "r_collateral_position": """
SELECT 'ORD_' || CAST(l_orderkey AS VARCHAR) AS contract_source_key,
       'PRT_' || CAST(l_partkey AS VARCHAR) AS security_source_key,
       CAST(l_shipdate AS DATE) AS position_date,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS position_value_local,
       CASE WHEN l_linenumber = 1 THEN 'PRIMARY' ELSE 'SECONDARY' END AS collateral_role,
       CAST(l_orderkey AS BIGINT) AS order_key, l_linenumber
FROM lineitem""",
    "r_collateral_exposure": f"""
SELECT 'ORD_' || CAST(o_orderkey AS VARCHAR) AS contract_source_key,
       CAST(o_orderdate AS DATE) AS exposure_date,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.85 AS DECIMAL(18,2)) AS exposure_amount_local,
       {CUR}[o_custkey % 6 + 1] AS currency_code,
       CASE WHEN starts_with(o_orderpriority, '1') THEN 'CASH' ELSE 'SECURITIES' END AS collateral_type,
       CAST(v AS DECIMAL(18,2)) AS collateral_value_local,
       CAST(o_orderkey AS BIGINT) AS order_key
FROM orders JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY l_orderkey) x
  ON o_orderkey = x.l_orderkey""",
    "r_contract_summary": f"""
WITH m AS (
  SELECT l_orderkey, last_day(CAST(l_shipdate AS DATE)) AS summary_date,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS shipped,
         sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS returned
  FROM lineitem GROUP BY 1, 2),
c AS (
  SELECT *, sum(shipped) OVER (PARTITION BY l_orderkey ORDER BY summary_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS shipped_to_date,
            sum(returned) OVER (PARTITION BY l_orderkey ORDER BY summary_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS returned_to_date
  FROM m)
SELECT 'ORD_' || CAST(o_orderkey AS VARCHAR) AS contract_source_key, summary_date,
       CAST(greatest(CAST(o_totalprice AS DECIMAL(18,2)) - shipped_to_date, 0) AS DECIMAL(18,2)) AS outstanding_principal_local,
       CAST(CAST(shipped AS DECIMAL(38,2)) * 0.01 AS DECIMAL(18,2)) AS accrued_interest_local,
       CAST(shipped_to_date AS DECIMAL(18,2)) AS paid_to_date_local,
       {CUR}[o_custkey % 6 + 1] AS currency_code,
       CASE WHEN returned_to_date * 2 > shipped_to_date THEN 'IMPAIRED' WHEN returned_to_date > 0 THEN 'WATCH' ELSE 'CURRENT' END AS performance_status,
       CAST(o_orderkey AS BIGINT) AS order_key
FROM c JOIN orders ON l_orderkey = o_orderkey""",
    "r_covenant": """
SELECT 'ORD_' || CAST(l_orderkey AS VARCHAR) AS contract_source_key, CAST(l_shipdate AS DATE) AS covenant_date,
       'LTV' AS covenant_type, CASE WHEN l_returnflag = 'R' THEN 'TRIPPED' ELSE 'PASS' END AS covenant_status
FROM lineitem""",
    "r_portfolio_month": """
SELECT l_suppkey, last_day(CAST(l_shipdate AS DATE)) AS risk_date,
       max(CAST(l_discount AS DECIMAL(18,6))) AS var_95, max(CAST(l_tax AS DECIMAL(18,6))) AS var_99,
       sum(CAST(l_tax AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS ret_sum, count(*) AS ret_n,
       sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS exposure
FROM lineitem GROUP BY 1, 2""",
    "r_portfolio_risk": """
SELECT 'SUP_' || CAST(l_suppkey AS VARCHAR) AS portfolio_source_key, risk_date, var_95, var_99,
       CAST(var_95 + var_99 AS DECIMAL(18,6)) AS expected_shortfall, 'USD' AS risk_currency,
       'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS portfolio_name,
       CAST(l_suppkey AS BIGINT) AS supplier_key
FROM r_portfolio_month""",
    "r_portfolio_performance": """
SELECT 'SUP_' || CAST(l_suppkey AS VARCHAR) AS portfolio_source_key, risk_date AS performance_date,
       CAST(ret_sum AS DOUBLE) / CAST(ret_n AS DOUBLE) AS period_return_pct, ret_sum AS return_sum,
       CAST(ret_n AS BIGINT) AS return_count, 'BM_GLOBAL' AS benchmark_code,
       CAST(l_suppkey AS BIGINT) AS supplier_key
FROM r_portfolio_month""",
    "r_capital_activity": """
SELECT 'SUP_' || CAST(first_suppkey AS VARCHAR) AS portfolio_source_key, CAST(o_orderdate AS DATE) AS activity_date,
       CASE WHEN o_orderstatus = 'O' THEN 'CAPITAL_CALL' ELSE 'DISTRIBUTION' END AS activity_type,
       CAST(line_amount AS DECIMAL(18,2)) AS amount_local, CAST(o_orderkey AS BIGINT) AS order_key
FROM orders JOIN r_order_lines ON o_orderkey = l_orderkey
WHERE o_orderstatus IN ('O', 'F')""",
    "r_security_price": """
SELECT 'PRT_' || CAST(l_partkey AS VARCHAR) AS security_source_key, CAST(l_shipdate AS DATE) AS price_date,
       max(CAST(l_extendedprice AS DECIMAL(18,6))) AS close_price_local, 'USD' AS currency_code, 'CLOSE' AS price_type
FROM lineitem GROUP BY l_partkey, CAST(l_shipdate AS DATE)""",
    "r_cash_flow": """
SELECT CAST(event_id AS BIGINT) AS event_id, 'SUP_' || CAST(user_id % 10 AS VARCHAR) AS portfolio_source_key,
       CAST(ts AS DATE) AS cash_flow_date,
       CASE WHEN event_type = 'purchase' THEN 'INCOME' WHEN event_type = 'signup' THEN 'CONTRIBUTION'
            WHEN event_type = 'error' THEN 'FEE' WHEN event_type = 'click' THEN 'EXPENSE' ELSE 'DISTRIBUTION' END AS cash_flow_type,
       CAST(value AS DECIMAL(18,2)) AS amount_local, 'USD' AS currency_code
FROM events""",
    "r_asset": """
SELECT 'AST_' || CAST(brand_no AS VARCHAR) AS source_key, 'EK_AST_' || CAST(brand_no AS VARCHAR) AS enterprise_key,
       p_brand AS asset_name, 'BRAND' AS asset_type, asset_class,
       ['US','GB','DE','FR','JP','CA','AU'][brand_no % 7 + 1] AS country_code,
       CAST(1990 + brand_no % 10 AS INTEGER) AS vintage_year, CAST(total_size_local AS DECIMAL(18,2)) AS total_size_local,
       'USD' AS currency_code, brand_no
FROM (SELECT CAST(substring(p_brand, 7, 4) AS BIGINT) AS brand_no, p_brand, min(p_type) AS asset_class,
             sum(CAST(p_retailprice AS DECIMAL(18,2))) AS total_size_local FROM part GROUP BY 1, 2)""",
    "r_security_rating": """
SELECT 'SRAT_' || CAST(p_partkey AS VARCHAR) AS source_key, 'PRT_' || CAST(p_partkey AS VARCHAR) AS security_source_key,
       CAST(DATE '1994-01-01' + CAST(p_partkey % 365 AS INTEGER) AS DATE) AS rating_date,
       ['MOODY','SP','FITCH'][p_partkey % 3 + 1] AS rating_agency,
       ['AAA','AA','A','BBB','BB','B','CCC'][p_size % 7 + 1] AS rating_value,
       'STABLE' AS rating_outlook, 'NEW' AS rating_action_type
FROM part""",
    "r_industry": """
SELECT DISTINCT 'IND_' || substring(p_brand, 7, 4) AS classification_code, p_brand AS classification_name,
       'IND_ROOT' AS parent_code, 2 AS classification_level, 'BRAND' AS classification_system
FROM part""",
    "r_reporting_group": """
SELECT DISTINCT 'SEG_' || c_mktsegment AS group_code, c_mktsegment AS group_name, 'RG_ROOT' AS parent_group_code,
       2 AS group_level, 'SEGMENT' AS group_type FROM customer
UNION ALL
SELECT 'REG_' || CAST(r_regionkey AS VARCHAR), r_name, 'RG_ROOT', 2, 'REGION' FROM region""",
    "r_fx_rate": """
WITH span AS (
  SELECT min(d) AS lo, max(d) AS hi FROM (
    SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem UNION ALL
    SELECT CAST(o_orderdate AS DATE) FROM orders UNION ALL
    SELECT CAST(ts AS DATE) FROM events)),
days AS (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi + 730 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS rate_date
  FROM span),
d2 AS (SELECT rate_date, (rate_date - DATE '1995-01-01') AS day_idx FROM days),
pairs AS (SELECT * FROM (VALUES ('EUR', 1, 12000), ('GBP', 2, 15000), ('JPY', 3, 100), ('CAD', 4, 8000), ('AUD', 5, 7000)) t(from_currency, pair, base_e4))
SELECT from_currency, 'USD' AS to_currency, rate_date,
       CAST(CAST(CAST(base_e4 AS BIGINT) * (980 + (day_idx * 7 + pair * 13) % 41) AS DECIMAL(18,0)) * CAST(0.0000001 AS DECIMAL(8,7)) AS DECIMAL(18,8)) AS fx_rate,
       'SPOT' AS rate_type
FROM d2 CROSS JOIN pairs
WHERE day_idx % 97 <> 0""",
}
