"""DuckDB twins of the star schema and mart views."""

from oracle.bronze_sql import _res

MART = {
    "k_entity_of_contract": f"""
SELECT c.source_key AS ck, x.enterprise_key AS eek
FROM r_contract c {_res('x', 'efront', 'c.entity_source_key')} WHERE c.version_no = 1""",
    "k_dim_portfolio_group": """
SELECT CAST(r_regionkey AS BIGINT) AS portfolio_group_sk, 'EK_PG_' || CAST(r_regionkey AS VARCHAR) AS enterprise_portfolio_group_id,
       r_name AS group_name, 'REGION' AS group_type, TRUE AS is_current FROM region""",
    "k_dim_portfolio": """
SELECT pd.portfolio_sk, pd.enterprise_key AS enterprise_portfolio_id,
       CAST(substring(rp.bu_source_key, 4, 10) AS BIGINT) AS portfolio_group_sk, rp.portfolio_name,
       ['FUND','SMA','CO_INVEST'][rp.supplier_key % 3 + 1] AS portfolio_type, rp.currency_code, pd.is_current,
       pd.effective_start_date, pd.effective_end_date
FROM s_portfolio_dim pd LEFT JOIN r_portfolio rp ON rp.enterprise_key = pd.enterprise_key""",
    "k_dim_entity": """
SELECT e.entity_sk, e.enterprise_key AS enterprise_entity_id, e.entity_name, e.entity_type, e.jurisdiction,
       r.region_key AS portfolio_group_sk, e.is_current, e.effective_start_date, e.effective_end_date
FROM s_entity_dim e LEFT JOIN r_entity r ON r.source_key = e.source_key""",
    "k_dim_security": """
SELECT security_sk, enterprise_key AS enterprise_security_id, CAST(substring(brand, 7, 4) AS BIGINT) AS asset_sk,
       security_name, security_type, source_key AS cusip, is_current, effective_start_date, effective_end_date
FROM s_security_dim""",
    "k_dim_asset": """
SELECT brand_no AS asset_sk, enterprise_key AS enterprise_asset_id, asset_name, asset_type,
       'CITY_' || CAST(brand_no % 5 AS VARCHAR) AS city, country_code, brand_no % 5 AS managing_group_id,
       TRUE AS is_current
FROM r_asset""",
    "k_fact_position": """
SELECT p.position_sk AS position_id, p.position_date, p.portfolio_sk, ed.entity_sk, p.security_sk, p.quantity,
       p.market_value_usd AS market_value, p.book_value_usd AS book_value, p.cost_basis_usd AS cost_basis,
       p.unrealized_gl_usd AS unrealized_gain_loss, p.currency_code AS local_currency_code,
       'USD' AS reporting_currency_code, p.fx_rate_to_usd AS fx_rate, 'state_street' AS record_source
FROM s_position p JOIN k_entity_of_contract k ON k.ck = p.contract_source_key
JOIN s_entity_dim ed ON ed.enterprise_key = k.eek
 AND p.position_date BETWEEN ed.effective_start_date AND ed.effective_end_date""",
    "k_fact_transaction": """
WITH t AS (SELECT *, 'ORD_' || substring(enterprise_key, 8, 20) AS ck,
                  CASE WHEN transaction_type = 'SELL' THEN -1 ELSE 1 END AS sgn
           FROM s_transaction WHERE transaction_status = 'SETTLED')
SELECT t.transaction_sk AS transaction_id, t.transaction_date, t.settlement_date, t.portfolio_sk, ed.entity_sk,
       t.security_sk, t.transaction_type, CAST(t.quantity * t.sgn AS DECIMAL(18,4)) AS quantity,
       CAST(t.gross_amount_usd * t.sgn AS DECIMAL(18,2)) AS gross_amount, t.fees_usd AS fees,
       CAST(CAST(t.gross_amount_usd * t.sgn AS DECIMAL(18,2)) - t.fees_usd AS DECIMAL(18,2)) AS net_amount,
       'CPTY_' || CAST(t.transaction_sk % 7 AS VARCHAR) AS counterparty, t.fx_rate_to_usd AS fx_rate,
       'state_street' AS record_source
FROM t JOIN k_entity_of_contract k ON k.ck = t.ck
JOIN s_entity_dim ed ON ed.enterprise_key = k.eek
 AND t.transaction_date BETWEEN ed.effective_start_date AND ed.effective_end_date""",
    "k_key_crosswalk": """
WITH c AS (SELECT CAST(c_custkey AS BIGINT) AS c FROM customer),
x AS (
  SELECT 'ENTITY' AS domain_code, 'STATE_STREET' AS source_system, 'SS_ENT_' || CAST(c AS VARCHAR) AS source_key,
         'ENTERPRISE' AS target_system, 'EK_CUS_' || CAST(c AS VARCHAR) AS target_key, 'ONE_TO_ONE' AS relationship_type,
         1 AS split_sequence, DATE '1990-01-01' AS effective_start_date,
         CASE WHEN c % 25 = 0 THEN DATE '1998-06-30' END AS effective_end_date, NOT (c % 25 = 0) AS is_current
  FROM c
  UNION ALL
  SELECT 'ENTITY', 'STATE_STREET', 'SS_ENT_' || CAST(c AS VARCHAR), 'ENTERPRISE', 'REMAPPED_EK_CUS_' || CAST(c AS VARCHAR),
         'ONE_TO_ONE', 1, DATE '1998-07-01', CAST(NULL AS DATE), TRUE FROM c WHERE c % 25 = 0
  UNION ALL
  SELECT 'ENTITY', 'EFRONT', 'EF_ENT_' || CAST(c AS VARCHAR), 'ENTERPRISE', 'EK_CUS_' || CAST(c AS VARCHAR),
         'ONE_TO_ONE', 1, DATE '1990-01-01', CAST(NULL AS DATE), TRUE FROM c
  UNION ALL
  SELECT 'ENTITY', 'STATE_STREET', 'SS_ENT_' || CAST(c AS VARCHAR) || '_' || CAST(k AS VARCHAR), 'ENTERPRISE',
         'EK_CUS_' || CAST(c AS VARCHAR), 'MANY_TO_ONE', k, DATE '1990-01-01', CAST(NULL AS DATE), TRUE
  FROM c CROSS JOIN (SELECT unnest([1, 2, 3]) AS k) WHERE c < 10
  UNION ALL
  SELECT 'ENTITY', 'STATE_STREET', 'SS_GRP_' || CAST(c AS VARCHAR), 'ENTERPRISE', 'EK_CUS_' || CAST(c + k - 1 AS VARCHAR),
         'ONE_TO_MANY', k, DATE '1990-01-01', CAST(NULL AS DATE), TRUE
  FROM c CROSS JOIN (SELECT unnest([1, 2]) AS k) WHERE c >= 10 AND c < 30
  UNION ALL
  SELECT 'SECURITY', 'BLOOMBERG', 'BBG_' || CAST(p_partkey AS VARCHAR), 'ENTERPRISE', 'EK_PRT_' || CAST(p_partkey AS VARCHAR),
         'ONE_TO_ONE', 1, DATE '1990-01-01', CAST(NULL AS DATE), TRUE FROM part
  UNION ALL
  SELECT 'ENTITY', 'BLOOMBERG', 'BBG_ENT_' || CAST(c AS VARCHAR), 'ENTERPRISE', 'EK_CUS_' || CAST(c AS VARCHAR),
         'ONE_TO_ONE', 1, DATE '1990-01-01', CAST(NULL AS DATE), TRUE FROM c WHERE c % 2 = 0),
n AS (SELECT *, row_number() OVER (ORDER BY domain_code, source_system, source_key, effective_start_date, target_key)
                AS crosswalk_sk FROM x)
SELECT a.domain_code, a.source_system, a.source_key, a.target_system, a.target_key, a.relationship_type,
       CAST(a.split_sequence AS INTEGER) AS split_sequence, a.effective_start_date, a.effective_end_date, a.is_current,
       a.crosswalk_sk, nx.crosswalk_sk AS succeeding_record_sk, pv.crosswalk_sk AS preceding_record_sk
FROM n a
LEFT JOIN n nx ON nx.domain_code = a.domain_code AND nx.source_system = a.source_system
  AND nx.source_key = a.source_key AND a.effective_end_date + 1 = nx.effective_start_date
LEFT JOIN n pv ON pv.domain_code = a.domain_code AND pv.source_system = a.source_system
  AND pv.source_key = a.source_key AND a.effective_start_date - 1 = pv.effective_end_date""",
    "k_investor_pg_alloc": """
SELECT CAST(c_custkey AS BIGINT) AS investor_sk, CAST(r_regionkey AS BIGINT) AS portfolio_group_sk,
       CAST(0.5 + 0.1 * ((c_custkey * 3 + r_regionkey) % 245) AS DECIMAL(8,5)) AS ownership_percentage,
       TRUE AS is_current
FROM customer CROSS JOIN region WHERE (c_custkey * 7 + r_regionkey) % 5 = 0""",
    "k_portfolio_entity_alloc": """
SELECT portfolio_sk, entity_sk, CAST(((portfolio_sk + entity_sk) % 20 + 1) * 5 AS DECIMAL(8,5)) AS ownership_percentage,
       TRUE AS is_current
FROM (SELECT DISTINCT portfolio_sk, entity_sk FROM k_fact_position)""",
    "k_pg_portfolio_alloc": """
SELECT portfolio_group_sk, portfolio_sk, CAST(100 AS DECIMAL(8,5)) AS ownership_percentage, TRUE AS is_current
FROM k_dim_portfolio""",
    "k_pos_base": """
SELECT f.*, pf.portfolio_name, pf.portfolio_type, e.enterprise_entity_id, e.entity_name, e.entity_type,
       e.jurisdiction, s.asset_sk, s.security_name, s.security_type, s.cusip, s.enterprise_security_id,
       a.asset_name, a.asset_type, a.city AS asset_city, a.country_code
FROM k_fact_position f JOIN k_dim_portfolio pf ON pf.portfolio_sk = f.portfolio_sk
JOIN k_dim_entity e ON e.entity_sk = f.entity_sk JOIN k_dim_security s ON s.security_sk = f.security_sk
JOIN k_dim_asset a ON a.asset_sk = s.asset_sk""",
    "k_txn_base": """
SELECT f.*, pf.portfolio_name, pf.portfolio_type, e.enterprise_entity_id, e.entity_name, e.entity_type,
       e.jurisdiction, s.asset_sk, s.security_name, s.security_type, s.cusip, s.enterprise_security_id,
       a.asset_name, a.asset_type, a.city AS asset_city, a.country_code
FROM k_fact_transaction f JOIN k_dim_portfolio pf ON pf.portfolio_sk = f.portfolio_sk
JOIN k_dim_entity e ON e.entity_sk = f.entity_sk JOIN k_dim_security s ON s.security_sk = f.security_sk
JOIN k_dim_asset a ON a.asset_sk = s.asset_sk""",
    "k_aum_daily": """
SELECT f.position_date, f.portfolio_sk, pf.portfolio_name, pf.portfolio_type, sum(f.market_value) AS aum,
       sum(f.book_value) AS book_value, sum(f.unrealized_gain_loss) AS unrealized_pnl, count(*) AS position_count
FROM k_fact_position f JOIN k_dim_portfolio pf ON pf.portfolio_sk = f.portfolio_sk
GROUP BY f.position_date, f.portfolio_sk, pf.portfolio_name, pf.portfolio_type""",
    "k_position_enriched": """
SELECT position_id, position_date, portfolio_sk, portfolio_name, portfolio_type, entity_sk, entity_name, entity_type,
       jurisdiction, asset_sk, asset_name, asset_type, asset_city, country_code AS asset_country, security_sk,
       security_name, security_type, cusip, quantity, market_value, book_value, cost_basis, unrealized_gain_loss,
       local_currency_code, reporting_currency_code, fx_rate, record_source
FROM k_pos_base""",
    "k_portfolio_kpi": """
WITH da AS (SELECT position_date, portfolio_sk, sum(market_value) AS aum, sum(unrealized_gain_loss) AS unrealized_pnl,
                   count(DISTINCT entity_sk) AS active_entity_count, count(*) AS position_count
            FROM k_fact_position GROUP BY 1, 2)
SELECT da.position_date, da.portfolio_sk, pf.portfolio_name, pf.portfolio_type, da.aum, da.unrealized_pnl,
       da.active_entity_count, da.position_count,
       CAST(sum(da.aum) OVER w7 AS DOUBLE) / CAST(count(*) OVER w7 AS DOUBLE) AS aum_7day_ma,
       CAST(sum(da.aum) OVER w30 AS DOUBLE) / CAST(count(*) OVER w30 AS DOUBLE) AS aum_30day_ma,
       lag(da.aum, 365) OVER w AS aum_year_ago,
       dense_rank() OVER (PARTITION BY da.position_date ORDER BY da.aum DESC) AS aum_rank_on_date
FROM da JOIN k_dim_portfolio pf ON pf.portfolio_sk = da.portfolio_sk
WINDOW w AS (PARTITION BY da.portfolio_sk ORDER BY da.position_date),
       w7 AS (PARTITION BY da.portfolio_sk ORDER BY da.position_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w30 AS (PARTITION BY da.portfolio_sk ORDER BY da.position_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    "k_external_keys": """
SELECT b.position_id, b.position_date, b.portfolio_name, b.entity_name, b.security_name, b.asset_name, b.country_code,
       b.quantity, b.market_value, ss.source_key AS state_street_entity_id, bb.source_key AS bloomberg_security_id
FROM k_pos_base b
LEFT JOIN k_key_crosswalk ss ON ss.target_key = b.enterprise_entity_id AND ss.relationship_type = 'ONE_TO_ONE'
  AND ss.domain_code = 'ENTITY' AND ss.source_system = 'STATE_STREET' AND ss.effective_start_date <= b.position_date
  AND (ss.effective_end_date IS NULL OR ss.effective_end_date >= b.position_date)
LEFT JOIN k_key_crosswalk bb ON bb.target_key = b.enterprise_security_id AND bb.relationship_type = 'ONE_TO_ONE'
  AND bb.domain_code = 'SECURITY' AND bb.source_system = 'BLOOMBERG' AND bb.effective_start_date <= b.position_date
  AND (bb.effective_end_date IS NULL OR bb.effective_end_date >= b.position_date)""",
    "k_portfolio_book": """
WITH be AS (SELECT position_date, portfolio_name, portfolio_type, enterprise_entity_id, country_code,
                   sum(market_value) AS entity_mv
            FROM k_pos_base GROUP BY 1, 2, 3, 4, 5),
r AS (SELECT *, row_number() OVER (PARTITION BY position_date, portfolio_name
                                   ORDER BY entity_mv DESC, enterprise_entity_id, country_code) AS rn FROM be)
SELECT position_date, portfolio_name, portfolio_type, sum(entity_mv) AS aum,
       CAST(sum(CASE WHEN rn <= 3 THEN entity_mv ELSE 0 END) AS DOUBLE) / NULLIF(CAST(sum(entity_mv) AS DOUBLE), 0)
         AS top_3_concentration_pct,
       count(DISTINCT enterprise_entity_id) AS entity_count, count(DISTINCT country_code) AS country_count,
       dense_rank() OVER (PARTITION BY position_date ORDER BY sum(entity_mv) DESC) AS aum_rank_on_date
FROM r GROUP BY position_date, portfolio_name, portfolio_type""",
    "k_security_book": """
WITH ps AS (SELECT position_date, portfolio_name, portfolio_type, entity_name, asset_name, country_code, security_name,
                   security_type, sum(market_value) AS market_value, sum(unrealized_gain_loss) AS unrealized_pnl
            FROM k_pos_base GROUP BY 1, 2, 3, 4, 5, 6, 7, 8)
SELECT *, CAST(market_value AS DOUBLE)
          / NULLIF(CAST(sum(market_value) OVER (PARTITION BY position_date, portfolio_name) AS DOUBLE), 0)
          AS pct_of_portfolio_aum
FROM ps""",
    "k_transaction_book": """
SELECT pf.portfolio_name, pf.portfolio_type, t.transaction_date, sum(t.gross_amount) AS net_gross_flow,
       sum(abs(t.gross_amount)) AS turnover_gross, sum(t.net_amount) AS net_cash_flow, sum(t.fees) AS total_fees,
       count(*) AS transaction_count, count(DISTINCT t.security_sk) AS distinct_securities_traded,
       sum(CASE WHEN t.transaction_type = 'BUY' THEN 1 ELSE 0 END) AS buy_count,
       sum(CASE WHEN t.transaction_type = 'SELL' THEN 1 ELSE 0 END) AS sell_count,
       sum(CASE WHEN t.transaction_type = 'ACQUISITION' THEN 1 ELSE 0 END) AS acquisition_count,
       sum(CASE WHEN t.transaction_type = 'DISPOSAL' THEN 1 ELSE 0 END) AS disposal_count,
       dense_rank() OVER (PARTITION BY t.transaction_date ORDER BY sum(abs(t.gross_amount)) DESC) AS turnover_rank_on_date
FROM k_fact_transaction t JOIN k_dim_portfolio pf ON pf.portfolio_sk = t.portfolio_sk
GROUP BY pf.portfolio_name, pf.portfolio_type, t.transaction_date""",
    "k_transaction_detail": """
SELECT transaction_id, transaction_date, settlement_date, portfolio_name, portfolio_type, entity_name, asset_name,
       country_code, security_name, security_type, transaction_type, quantity, gross_amount, fees, net_amount,
       counterparty, record_source,
       CAST(abs(gross_amount) AS DOUBLE)
         / NULLIF(CAST(sum(abs(gross_amount)) OVER (PARTITION BY portfolio_name, transaction_date) AS DOUBLE), 0)
         AS pct_of_daily_turnover
FROM k_txn_base""",
}
