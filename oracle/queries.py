"""Oracle SQL per registered query key (DuckDB dialect)."""

from oracle.bronze_sql import BRONZE
from oracle.compose import compose
from oracle.fin import fin
from oracle.roles_sql import ROLES
from oracle.silver_sql import SILVER
from oracle.gold_sql import GOLD
from oracle.mart_sql import MART

CTES: dict[str, str] = {}
CTES.update(ROLES)
CTES.update(BRONZE)
CTES.update(SILVER)
CTES.update(GOLD)
CTES.update(MART)

FINAL: dict[str, str] = {}

_B = {
    "security": "$latest_close_price, ~_sources_in_conflict",
    "entity": "~_sources_in_conflict",
    "asset": "$total_size_local, #vintage_year, ~_sources_in_conflict",
    "portfolio": "$total_called_local, $total_distributed_local, ~_sources_in_conflict",
    "contract": "$principal_local, ~_sources_in_conflict",
    "business_unit": "~associated_risk_team_codes, ~_sources_in_conflict",
    "position": "$quantity, $market_value_local, $book_value_local, $cost_basis_local, $unrealized_gl_local, ~_sources_in_conflict",
    "transaction": "$quantity, $gross_amount_local, $fees_local, $net_amount_local, ~_sources_in_conflict",
    "security_price": "$close_price_local, ~_sources_in_conflict",
    "portfolio_risk": "$var_95, $var_99, $expected_shortfall, ~_sources_in_conflict",
    "portfolio_performance": "$return_sum, ~_sources_in_conflict",
    "rating": "~_sources_in_conflict",
    "collateral": "$position_value_local, #l_linenumber, ~_sources_in_conflict",
    "fx_rate": "$fx_rate, ~_sources_in_conflict",
}
for _e, _c in _B.items():
    FINAL[f"bronze_{_e}"] = fin(f"b_{_e}", _c)
FINAL["lineage_audit"] = fin("b_lineage_audit")
FINAL["conflict_detection"] = fin("b_conflicts", "~_sources_in_conflict")
FINAL["crosswalk_build"] = fin("b_crosswalk")
FINAL["resolve_current"] = """
WITH k AS (
  SELECT DISTINCT * FROM (
    SELECT 'state_street' AS source_system, portfolio_source_key AS source_key FROM r_position UNION ALL
    SELECT 'state_street', security_source_key FROM r_position UNION ALL
    SELECT 'efront', entity_source_key FROM r_contract UNION ALL
    SELECT 'aladdin', portfolio_source_key FROM r_cash_flow))
SELECT k.source_system, k.source_key, x.enterprise_key
FROM k LEFT JOIN b_xw_current x ON x.source_system = k.source_system AND x.source_key = k.source_key"""
FINAL["resolve_source_keys"] = """
SELECT enterprise_key, page, CAST(count(*) AS BIGINT) AS n_source_keys,
       string_agg(source_system || ':' || source_key, ',' ORDER BY source_system, source_key) AS source_keys
FROM (SELECT *, (row_number() OVER (PARTITION BY enterprise_key ORDER BY source_system, source_key) - 1) // 10000 AS page
      FROM b_crosswalk) GROUP BY enterprise_key, page"""
FINAL["crosswalk_merge"] = """
SELECT source_system, count(DISTINCT source_key) AS mapping_count
FROM b_crosswalk GROUP BY source_system"""

_S = {
    "security_dim": ("s_security_dim", ""),
    "rating_dim": ("s_rating_dim", "#rating_numeric_score"),
    "contract_dim": ("s_contract_dim", "$principal_local"),
    "portfolio_dim": ("s_portfolio_dim", ""),
    "entity_dim": ("s_entity_dim", ""),
    "industry_dim": ("s_industry_dim", "#classification_level"),
    "reporting_group_dim": ("s_reporting_group_dim", "#group_level"),
    "business_unit_dim": ("s_business_unit_dim", "~associated_risk_team_codes"),
    "fx_rates": ("s_fx_rate_dim", "$fx_rate"),
    "silver_position": ("s_position", "$quantity, $market_value_local, $market_value_usd, $book_value_local, "
                        "$book_value_usd, $cost_basis_local, $cost_basis_usd, $unrealized_gl_local, "
                        "$unrealized_gl_usd, $fx_rate_to_usd"),
    "position_monthend": ("s_position_monthend", "$quantity, $market_value_local, $market_value_usd, "
                          "$book_value_local, $cost_basis_usd, $unrealized_gl_usd"),
    "security_master": ("s_security_master", "$latest_close_price, $latest_close_price_usd"),
    "silver_security_price": ("s_security_price", "$close_price_local, $close_price_usd, $fx_rate_to_usd"),
    "contract_details": ("s_contract_details", "$principal_local, $principal_usd, $fx_rate_to_usd"),
    "silver_contract_summary": ("s_contract_summary", "$outstanding_principal_local, $outstanding_principal_usd, "
                                "$accrued_interest_local, $accrued_interest_usd, $paid_to_date_local, "
                                "$paid_to_date_usd, $fx_rate_to_usd"),
    "portfolio_analytics": ("s_portfolio_analytics", "$var_95, $var_99, $expected_shortfall, $benchmark_return_pct, $return_sum"),
    "analytics_monthend": ("s_analytics_monthend", "$var_95, $var_99"),
    "collateral_exposure": ("s_collateral_exposure", "$exposure_amount_local, $exposure_amount_usd, "
                            "$collateral_value_local, $collateral_value_usd"),
    "collateral_positions": ("s_collateral_positions", "$position_value_local, $position_value_usd"),
    "silver_transaction": ("s_transaction", "$quantity, $gross_amount_local, $gross_amount_usd, $fees_usd, "
                           "$net_amount_usd, $fx_rate_to_usd"),
    "cancels_amendment": ("s_cancels_amendment", "$cancelled_principal_usd"),
    "cancels_remap": ("s_cancels_remap", "$cancelled_market_value_usd"),
    "price_cancels": ("s_price_cancels", "$cancelled_close_price_usd"),
    "income_bridge": ("s_income_bridge", "$income_amount_local, $income_amount_usd"),
}
for _k, (_src, _c) in _S.items():
    FINAL[_k] = fin(_src, _c)
FINAL["covenant_breach"] = """
SELECT contract_source_key, covenant_date,
       max(CASE WHEN covenant_status = 'TRIPPED' THEN 1 ELSE 0 END) > 0 AS has_active_breach,
       count(*) AS covenant_rows
FROM r_covenant GROUP BY 1, 2"""
FINAL["surrogate_keys"] = """
SELECT enterprise_key, position_date, row_number() OVER (ORDER BY position_date, enterprise_key) AS row_id
FROM b_position"""

_G = {
    "team_position": ("g_team_position", "$quantity, $market_value_usd, $book_value_usd, $cost_basis_usd, "
                      "$unrealized_gl_usd"),
    "team_contract_details": ("g_team_contract_details", "$principal_usd"),
    "team_contract_summary": ("g_team_contract_summary", "$outstanding_principal_usd, $accrued_interest_usd, "
                              "$paid_to_date_usd"),
    "team_portfolio_analytics": ("g_team_portfolio_analytics", "$var_95, $var_99, $expected_shortfall, "
                                 "$benchmark_return_pct"),
    "team_security_dim": ("g_team_security_dim", ""),
    "team_security_master": ("g_team_security_master", "$latest_close_price_usd"),
    "team_security_price": ("g_team_security_price", "$close_price_usd"),
    "team_rating": ("g_team_rating", "#rating_numeric_score"),
    "team_collateral_exposure": ("g_team_collateral_exposure", "$exposure_amount_usd, $collateral_value_usd"),
    "team_collateral_positions": ("g_team_collateral_positions", "$position_value_usd"),
    "consolidated_positions": ("g_consolidated_positions", "$market_value_usd, $book_value_usd, $cost_basis_usd, "
                               "$unrealized_gl_usd"),
    "consolidated_contracts": ("g_consolidated_contracts", "$outstanding_principal_usd, $accrued_interest_usd, "
                               "$paid_to_date_usd"),
    "consolidated_transactions": ("g_consolidated_transactions", "$gross_amount_usd, $net_amount_usd, $fees_usd"),
}
for _k, (_src, _c) in _G.items():
    FINAL[_k] = fin(_src, _c)

_M = {
    "aum_daily": ("k_aum_daily", "$aum, $book_value, $unrealized_pnl"),
    "position_enriched": ("k_position_enriched", "$quantity, $market_value, $book_value, $cost_basis, "
                          "$unrealized_gain_loss, $fx_rate"),
    "portfolio_kpi": ("k_portfolio_kpi", "$aum, $unrealized_pnl, $aum_year_ago"),
    "position_external_keys": ("k_external_keys", "$quantity, $market_value"),
    "portfolio_book": ("k_portfolio_book", "$aum"),
    "security_book": ("k_security_book", "$market_value, $unrealized_pnl"),
    "transaction_book": ("k_transaction_book", "$net_gross_flow, $turnover_gross, $net_cash_flow, $total_fees, "
                         "#buy_count, #sell_count, #acquisition_count, #disposal_count"),
    "transaction_detail": ("k_transaction_detail", "$quantity, $gross_amount, $fees, $net_amount"),
}
for _k, (_src, _c) in _M.items():
    FINAL[_k] = fin(_src, _c)

FINAL["current_entity"] = """
WITH ids AS (
  SELECT target_key AS enterprise_entity_id,
         max(CASE WHEN source_system = 'STATE_STREET' THEN source_key END) AS state_street_id,
         max(CASE WHEN source_system = 'BLOOMBERG' THEN source_key END) AS bloomberg_id,
         max(CASE WHEN source_system = 'EFRONT' THEN source_key END) AS efront_id
  FROM k_key_crosswalk WHERE is_current AND domain_code = 'ENTITY' AND relationship_type = 'ONE_TO_ONE'
  GROUP BY target_key),
own AS (SELECT entity_sk, portfolio_sk, row_number() OVER (PARTITION BY entity_sk ORDER BY ownership_percentage DESC,
                                                           portfolio_sk) AS rn FROM k_portfolio_entity_alloc)
SELECT e.entity_sk, e.enterprise_entity_id, e.entity_name, e.entity_type, e.jurisdiction, g.group_name,
       p.enterprise_portfolio_id, p.portfolio_name, ids.state_street_id, ids.bloomberg_id, ids.efront_id
FROM k_dim_entity e LEFT JOIN k_dim_portfolio_group g ON g.portfolio_group_sk = e.portfolio_group_sk
LEFT JOIN ids ON ids.enterprise_entity_id = e.enterprise_entity_id
LEFT JOIN own ON own.entity_sk = e.entity_sk AND own.rn = 1
LEFT JOIN (SELECT * FROM k_dim_portfolio WHERE is_current) p ON p.portfolio_sk = own.portfolio_sk
WHERE e.is_current"""
FINAL["portfolio_hierarchy"] = """
SELECT p.portfolio_sk, p.enterprise_portfolio_id, p.portfolio_name, p.portfolio_type, p.portfolio_group_sk,
       g.group_name, g.group_type
FROM k_dim_portfolio p LEFT JOIN (SELECT * FROM k_dim_portfolio_group WHERE is_current) g
  ON g.portfolio_group_sk = p.portfolio_group_sk
WHERE p.is_current"""
FINAL["security_with_asset"] = """
SELECT s.security_sk, s.enterprise_security_id, s.security_name, s.security_type, s.asset_sk, a.asset_name,
       a.asset_type, a.country_code, t.bu_code AS team_code
FROM k_dim_security s LEFT JOIN k_dim_asset a ON a.asset_sk = s.asset_sk
LEFT JOIN r_team t ON t.region_key = a.managing_group_id
WHERE s.is_current"""
FINAL["demo_aum_window"] = """
SELECT position_date, portfolio_name, portfolio_type, CAST(aum AS DOUBLE) AS aum, position_count
FROM k_aum_daily WHERE position_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'
ORDER BY position_date DESC, aum DESC, portfolio_sk LIMIT 100"""
FINAL["demo_position_window"] = """
SELECT position_id, position_date, portfolio_name, entity_name, asset_name, asset_city, security_name, security_type,
       CAST(market_value AS DOUBLE) AS market_value, CAST(unrealized_gain_loss AS DOUBLE) AS unrealized_gain_loss
FROM k_position_enriched
WHERE portfolio_type = 'FUND' AND position_date BETWEEN DATE '2000-10-01' AND DATE '2000-12-31'"""
FINAL["demo_point_lookup"] = """
SELECT p.position_id, p.position_date, p.security_sk, CAST(p.market_value AS DOUBLE) AS market_value,
       CAST(p.quantity AS DOUBLE) AS quantity
FROM k_fact_position p
JOIN (SELECT security_sk FROM k_dim_security WHERE is_current ORDER BY security_sk LIMIT 1) ss
  ON ss.security_sk = p.security_sk
WHERE p.position_date BETWEEN DATE '2000-06-01' AND DATE '2000-06-30'"""
FINAL["kpi_top_yoy"] = """
SELECT portfolio_name, portfolio_type, CAST(aum AS DOUBLE) AS aum, CAST(aum_year_ago AS DOUBLE) AS aum_year_ago,
       CASE WHEN aum_year_ago IS NULL OR aum_year_ago = 0 THEN NULL
            ELSE CAST(aum - aum_year_ago AS DOUBLE) / CAST(aum_year_ago AS DOUBLE) * 100 END AS yoy_pct_change,
       aum_7day_ma, aum_30day_ma, aum_rank_on_date
FROM k_portfolio_kpi WHERE position_date = (SELECT max(position_date) FROM k_portfolio_kpi)
ORDER BY aum DESC, portfolio_name LIMIT 20"""
FINAL["kpi_timeline"] = """
SELECT position_date, CAST(aum AS DOUBLE) AS aum, aum_7day_ma, aum_30day_ma, CAST(aum_year_ago AS DOUBLE) AS aum_year_ago,
       aum_rank_on_date, active_entity_count
FROM k_portfolio_kpi WHERE portfolio_sk = 1"""
FINAL["recon_month"] = """
SELECT position_id, position_date, portfolio_name, entity_name, security_name, state_street_entity_id,
       bloomberg_security_id, CAST(market_value AS DOUBLE) AS market_value
FROM k_external_keys WHERE position_date BETWEEN DATE '2000-01-01' AND DATE '2000-01-31'"""
FINAL["external_by_country"] = """
SELECT country_code, count(DISTINCT state_street_entity_id) AS distinct_ss_entities,
       count(DISTINCT bloomberg_security_id) AS distinct_bbg_securities,
       CAST(sum(market_value) AS DOUBLE) AS total_market_value, count(*) AS row_count
FROM k_external_keys GROUP BY country_code"""
FINAL["book_x_security"] = """
SELECT pb.portfolio_name, pb.position_date, CAST(pb.aum AS DOUBLE) AS aum, pb.aum_rank_on_date,
       pb.top_3_concentration_pct, pb.entity_count, sb.security_name, sb.entity_name, sb.asset_name,
       CAST(sb.market_value AS DOUBLE) AS market_value, sb.pct_of_portfolio_aum
FROM k_portfolio_book pb JOIN k_security_book sb
  ON pb.portfolio_name = sb.portfolio_name AND pb.position_date = sb.position_date"""
FINAL["peak_concentration"] = """
WITH r AS (SELECT *, CAST(year(position_date) AS BIGINT) AS yr,
                  row_number() OVER (PARTITION BY portfolio_name, year(position_date)
                                     ORDER BY top_3_concentration_pct DESC, position_date) AS rank_in_year
           FROM k_portfolio_book)
SELECT r.portfolio_name, r.yr, r.position_date AS peak_date, r.top_3_concentration_pct AS peak_concentration,
       CAST(r.aum AS DOUBLE) AS aum_on_peak_date, r.entity_count, r.rank_in_year, sb.security_name, sb.entity_name,
       sb.country_code, CAST(sb.market_value AS DOUBLE) AS market_value, sb.pct_of_portfolio_aum
FROM r JOIN k_security_book sb ON sb.portfolio_name = r.portfolio_name AND sb.position_date = r.position_date"""
FINAL["turnover_ratio"] = """
SELECT tb.portfolio_name, tb.portfolio_type, tb.transaction_date, tb.transaction_count, tb.distinct_securities_traded,
       CAST(tb.turnover_gross AS DOUBLE) AS turnover_gross, CAST(tb.net_gross_flow AS DOUBLE) AS net_gross_flow,
       CAST(tb.total_fees AS DOUBLE) AS total_fees, CAST(tb.buy_count AS BIGINT) AS buy_count,
       CAST(tb.sell_count AS BIGINT) AS sell_count, tb.turnover_rank_on_date, CAST(pb.aum AS DOUBLE) AS aum,
       pb.aum_rank_on_date, pb.top_3_concentration_pct, pb.entity_count,
       CAST(tb.turnover_gross AS DOUBLE) / NULLIF(CAST(pb.aum AS DOUBLE), 0) AS turnover_ratio
FROM k_transaction_book tb JOIN k_portfolio_book pb
  ON tb.portfolio_name = pb.portfolio_name AND tb.transaction_date = pb.position_date"""
FINAL["txn_three_way"] = """
SELECT td.transaction_id, td.transaction_date, td.portfolio_name, td.security_name, td.entity_name, td.country_code,
       td.transaction_type, CAST(td.quantity AS DOUBLE) AS txn_quantity, CAST(td.gross_amount AS DOUBLE) AS txn_gross,
       td.counterparty, td.pct_of_daily_turnover, CAST(sb.market_value AS DOUBLE) AS position_market_value,
       sb.pct_of_portfolio_aum, CAST(tb.turnover_gross AS DOUBLE) AS portfolio_day_turnover,
       tb.transaction_count AS portfolio_day_txn_count, tb.turnover_rank_on_date,
       CAST(abs(td.gross_amount) AS DOUBLE) / NULLIF(CAST(tb.turnover_gross AS DOUBLE), 0) AS txn_share_of_portfolio_day
FROM k_transaction_detail td
JOIN k_security_book sb ON td.portfolio_name = sb.portfolio_name AND td.security_name = sb.security_name
  AND td.transaction_date = sb.position_date
JOIN k_transaction_book tb ON td.portfolio_name = tb.portfolio_name AND td.transaction_date = tb.transaction_date"""
FINAL["allocation_summary"] = """
SELECT g.group_name, count(DISTINCT a.investor_sk) AS investors_in_group,
       CAST(round(sum(a.ownership_percentage), 2) AS DOUBLE) AS total_pct_committed
FROM k_dim_portfolio_group g LEFT JOIN (SELECT * FROM k_investor_pg_alloc WHERE is_current) a
  ON g.portfolio_group_sk = a.portfolio_group_sk
WHERE g.is_current GROUP BY g.group_name"""
FINAL["ownership_distribution"] = """
SELECT CAST(ownership_percentage AS DOUBLE) AS ownership_percentage, count(*) AS entity_count
FROM k_portfolio_entity_alloc WHERE is_current GROUP BY 1"""
FINAL["dimension_counts"] = """
SELECT 'investors' AS entity_type, count(*) AS row_count FROM customer
UNION ALL SELECT 'portfolio_groups', count(*) FROM k_dim_portfolio_group WHERE is_current
UNION ALL SELECT 'portfolios', count(*) FROM k_dim_portfolio WHERE is_current
UNION ALL SELECT 'entities', count(*) FROM k_dim_entity WHERE is_current
UNION ALL SELECT 'assets', count(*) FROM k_dim_asset WHERE is_current
UNION ALL SELECT 'securities', count(*) FROM k_dim_security WHERE is_current
UNION ALL SELECT 'crosswalk_mappings', count(*) FROM k_key_crosswalk WHERE is_current
UNION ALL SELECT 'positions', count(*) FROM k_fact_position
UNION ALL SELECT 'investor_pg_alloc', count(*) FROM k_investor_pg_alloc
UNION ALL SELECT 'pg_portfolio_alloc', count(*) FROM k_pg_portfolio_alloc
UNION ALL SELECT 'portfolio_entity_alloc', count(*) FROM k_portfolio_entity_alloc"""
FINAL["position_summary"] = """
SELECT min(position_date) AS earliest_date, max(position_date) AS latest_date,
       count(DISTINCT position_date) AS distinct_dates, count(*) AS total_rows,
       CAST(round(sum(market_value), 2) AS DOUBLE) AS total_market_value,
       CAST(sum(market_value) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_market_value
FROM k_fact_position"""
FINAL["adhoc_top_positions"] = """
SELECT team_code, enterprise_key, security_sk, position_date, CAST(market_value_usd AS DOUBLE) AS market_value_usd,
       concentration_pct, portfolio_rank
FROM g_consolidated_positions ORDER BY market_value_usd DESC, enterprise_key, team_code LIMIT 10"""
FINAL["adhoc_team_aum"] = """
SELECT team_code, count(DISTINCT enterprise_key) AS unique_positions,
       CAST(sum(market_value_usd) AS DOUBLE) AS total_aum_usd, round(avg(concentration_pct), 9) AS avg_concentration_pct,
       max(portfolio_rank) AS deepest_rank
FROM g_consolidated_positions WHERE position_date = (SELECT max(position_date) FROM g_consolidated_positions)
GROUP BY team_code"""
FINAL["adhoc_contract_concentration"] = """
SELECT team_code, contract_sk, summary_date, CAST(outstanding_principal_usd AS DOUBLE) AS outstanding_principal_usd,
       CAST(accrued_interest_usd AS DOUBLE) AS accrued_interest_usd, performance_status, has_active_breach
FROM g_consolidated_contracts WHERE summary_date = (SELECT max(summary_date) FROM g_consolidated_contracts)
ORDER BY outstanding_principal_usd DESC, team_code, enterprise_key LIMIT 20"""
FINAL["txn_by_quarter"] = """
SELECT team_code, CAST(date_trunc('quarter', transaction_date) AS DATE) AS quarter, count(*) AS txn_count,
       CAST(sum(gross_amount_usd) AS DOUBLE) AS gross_volume_usd, CAST(sum(fees_usd) AS DOUBLE) AS total_fees_usd
FROM g_consolidated_transactions GROUP BY 1, 2"""
FINAL["scd2_version_counts"] = """
SELECT 'contract_dim' AS dimension, count(*) AS total_versions, count(DISTINCT enterprise_key) AS unique_keys,
       count(*) - count(DISTINCT enterprise_key) AS amendments FROM s_contract_dim
UNION ALL SELECT 'security_dim', count(*), count(DISTINCT enterprise_key), count(*) - count(DISTINCT enterprise_key)
FROM s_security_dim
UNION ALL SELECT 'entity_dim', count(*), count(DISTINCT enterprise_key), count(*) - count(DISTINCT enterprise_key)
FROM s_entity_dim"""
FINAL["provenance_share"] = """
SELECT _source_pref, count(*) AS rows_won_by_source,
       CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS pct_of_total
FROM b_security GROUP BY _source_pref"""
FINAL["fx_latest"] = """
SELECT from_currency, to_currency, rate_date, CAST(fx_rate AS DOUBLE) AS fx_rate
FROM s_fx_rate_dim WHERE rate_date = (SELECT max(rate_date) FROM s_fx_rate_dim)"""

CTES["k_entity_soft_deleted"] = """
SELECT entity_sk, enterprise_key, effective_start_date,
       CASE WHEN del THEN DATE '1999-06-30' ELSE effective_end_date END AS effective_end_date,
       CASE WHEN del THEN FALSE ELSE is_current END AS is_current, preceding_record_sk,
       CASE WHEN del THEN NULL ELSE succeeding_record_sk END AS succeeding_record_sk, entity_name
FROM (SELECT *, is_current AND entity_type = 'HOUSEHOLD' AS del FROM s_entity_dim)"""
_SEG = "FROM customer WHERE c_mktsegment = "
FINAL["mapping_add"] = f"""
WITH b AS (
  SELECT 'ENTITY' AS domain_code, 'STATE_STREET' AS source_system, 'SS_NEW_' || CAST(c_custkey AS VARCHAR) AS source_key,
         'ENTERPRISE' AS target_system, 'EK_CUS_' || CAST(c_custkey AS VARCHAR) AS target_key {_SEG}'BUILDING'
  UNION ALL SELECT 'ENTITY', 'STATE_STREET', 'SS_ENT_' || CAST(c_custkey AS VARCHAR), 'ENTERPRISE',
         'EK_CUS_' || CAST(c_custkey AS VARCHAR) {_SEG}'AUTOMOBILE'
  UNION ALL SELECT 'FUND', 'STATE_STREET', 'SS_F_' || CAST(c_custkey AS VARCHAR), 'ENTERPRISE',
         'EK_CUS_' || CAST(c_custkey AS VARCHAR) {_SEG}'FURNITURE'
  UNION ALL SELECT 'ENTITY', 'CUSTODIAN_X', 'SS_H_' || CAST(c_custkey AS VARCHAR), 'ENTERPRISE',
         'EK_CUS_' || CAST(c_custkey AS VARCHAR) {_SEG}'HOUSEHOLD'
  UNION ALL SELECT 'ENTITY', 'STATE_STREET', 'SS_M_' || CAST(c_custkey AS VARCHAR), 'LEDGER_X',
         'EK_CUS_' || CAST(c_custkey AS VARCHAR) {_SEG}'MACHINERY'),
v AS (
  SELECT b.*, CASE
      WHEN domain_code NOT IN ('ENTITY', 'SECURITY', 'PORTFOLIO') THEN 45001
      WHEN source_system NOT IN ('STATE_STREET', 'BLOOMBERG', 'EFRONT', 'ENTERPRISE') THEN 45002
      WHEN target_system NOT IN ('STATE_STREET', 'BLOOMBERG', 'EFRONT', 'ENTERPRISE') THEN 45003
      WHEN EXISTS (SELECT 1 FROM k_key_crosswalk x WHERE x.is_current AND x.domain_code = b.domain_code
                   AND x.source_system = b.source_system AND x.source_key = b.source_key
                   AND x.target_system = b.target_system) THEN 45004 END AS error_code
  FROM b)
SELECT domain_code, source_system, source_key, target_system, target_key,
       CASE WHEN error_code IS NULL THEN 'INSERTED' ELSE 'REJECTED' END AS status,
       CAST(error_code AS BIGINT) AS error_code,
       CASE WHEN error_code IS NULL THEN (SELECT max(crosswalk_sk) FROM k_key_crosswalk)
            + row_number() OVER (PARTITION BY error_code IS NULL
                                 ORDER BY domain_code, source_system, source_key, target_system, target_key) END
         AS crosswalk_sk
FROM v"""
FINAL["mapping_supersede"] = f"""
WITH b AS (
  SELECT 'ENTITY' AS domain_code, 'STATE_STREET' AS source_system, 'SS_ENT_' || CAST(c_custkey AS VARCHAR) AS source_key,
         'ENTERPRISE' AS target_system, 'EK_CUS_' || CAST(c_custkey AS VARCHAR) || '_M' AS target_key {_SEG}'BUILDING'
  UNION ALL SELECT 'ENTITY', 'STATE_STREET', 'SS_MISSING_' || CAST(c_custkey AS VARCHAR), 'ENTERPRISE',
         'EK_CUS_' || CAST(c_custkey AS VARCHAR) {_SEG}'FURNITURE'),
cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain_code, source_system, source_key, target_system
                                                    ORDER BY crosswalk_sk DESC) AS rn
                       FROM k_key_crosswalk WHERE is_current) WHERE rn = 1),
j AS (SELECT b.*, cur.crosswalk_sk AS old_sk FROM b LEFT JOIN cur
        ON cur.domain_code = b.domain_code AND cur.source_system = b.source_system
       AND cur.source_key = b.source_key AND cur.target_system = b.target_system),
ok AS (SELECT *, (SELECT max(crosswalk_sk) FROM k_key_crosswalk)
                 + row_number() OVER (ORDER BY domain_code, source_system, source_key, target_system) AS new_sk
       FROM j WHERE old_sk IS NOT NULL)
SELECT x.crosswalk_sk, x.source_key, x.target_key, x.effective_start_date, DATE '2000-12-31' AS effective_end_date,
       FALSE AS is_current, x.preceding_record_sk, ok.new_sk AS succeeding_record_sk, 'SUPERSEDED' AS status,
       CAST(NULL AS BIGINT) AS error_code
FROM k_key_crosswalk x JOIN ok ON ok.old_sk = x.crosswalk_sk
UNION ALL
SELECT ok.new_sk, ok.source_key, ok.target_key, DATE '2001-01-01', CAST(NULL AS DATE), TRUE, ok.old_sk,
       CAST(NULL AS BIGINT), 'SUPERSEDED', CAST(NULL AS BIGINT) FROM ok
UNION ALL
SELECT CAST(NULL AS BIGINT), source_key, target_key, CAST(NULL AS DATE), CAST(NULL AS DATE), CAST(NULL AS BOOLEAN),
       CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), 'REJECTED', 45005 FROM j WHERE old_sk IS NULL"""
FINAL["resolve_as_of"] = """
WITH f AS (SELECT p.position_id, p.position_date, 'SS_ENT_' || substring(e.enterprise_entity_id, 8, 20) AS source_key
           FROM k_fact_position p JOIN k_dim_entity e ON e.entity_sk = p.entity_sk),
m AS (SELECT f.*, x.target_key, row_number() OVER (PARTITION BY f.position_id ORDER BY x.crosswalk_sk DESC NULLS LAST) AS rn
      FROM f LEFT JOIN k_key_crosswalk x ON x.domain_code = 'ENTITY' AND x.source_system = 'STATE_STREET'
        AND x.target_system = 'ENTERPRISE' AND x.source_key = f.source_key
        AND x.effective_start_date <= f.position_date
        AND (x.effective_end_date IS NULL OR x.effective_end_date >= f.position_date))
SELECT position_id, position_date, source_key, target_key FROM m WHERE rn = 1"""
FINAL["resolve_all_targets"] = """
WITH cur AS (SELECT * FROM k_key_crosswalk WHERE is_current AND domain_code = 'ENTITY' AND source_system = 'STATE_STREET')
SELECT c.source_key, CAST(c.split_sequence AS BIGINT) AS split_sequence, c.target_key, c.relationship_type, n.n_targets
FROM cur c JOIN (SELECT source_key, count(*) AS n_targets FROM cur GROUP BY source_key) n ON n.source_key = c.source_key"""
FINAL["resolve_all_sources"] = """
WITH cur AS (SELECT * FROM k_key_crosswalk WHERE is_current)
SELECT c.target_key, c.source_system, c.source_key, c.relationship_type, n.n_sources
FROM cur c JOIN (SELECT target_key, count(*) AS n_sources FROM cur GROUP BY target_key) n ON n.target_key = c.target_key"""
FINAL["scd2_close_chain"] = """
SELECT d.entity_sk, d.enterprise_key, d.effective_start_date,
       COALESCE(CAST(s.effective_start_date - 1 AS DATE), DATE '9999-12-31') AS effective_end_date,
       s.entity_sk IS NULL AS is_current, d.preceding_record_sk, s.entity_sk AS succeeding_record_sk, d.entity_name
FROM s_entity_dim d LEFT JOIN s_entity_dim s ON s.preceding_record_sk = d.entity_sk"""
FINAL["scd2_apply"] = """
WITH ch AS (SELECT enterprise_key, DATE '2001-01-01' AS effective_start_date, entity_name || ' (Merged)' AS entity_name,
                   entity_sk AS prev_sk
            FROM s_entity_dim WHERE is_current AND entity_type = 'BUILDING'),
n AS (SELECT ch.*, (SELECT max(entity_sk) FROM s_entity_dim)
                   + row_number() OVER (ORDER BY enterprise_key, effective_start_date) AS new_sk FROM ch)
SELECT d.entity_sk, d.enterprise_key, d.effective_start_date,
       CASE WHEN n.new_sk IS NOT NULL THEN DATE '2000-12-31' ELSE d.effective_end_date END AS effective_end_date,
       CASE WHEN n.new_sk IS NOT NULL THEN FALSE ELSE d.is_current END AS is_current, d.preceding_record_sk,
       COALESCE(n.new_sk, d.succeeding_record_sk) AS succeeding_record_sk, d.entity_name
FROM s_entity_dim d LEFT JOIN n ON n.prev_sk = d.entity_sk
UNION ALL
SELECT new_sk, enterprise_key, effective_start_date, DATE '9999-12-31', TRUE, prev_sk, CAST(NULL AS BIGINT), entity_name
FROM n"""
FINAL["scd2_soft_delete"] = "SELECT * FROM k_entity_soft_deleted"
FINAL["hash_delta"] = """
WITH prev AS (SELECT enterprise_key, entity_name, entity_type, jurisdiction FROM r_entity
              WHERE version_no = 1 AND entity_type <> 'MACHINERY'),
cur AS (SELECT enterprise_key, entity_name, entity_type, jurisdiction FROM b_entity WHERE entity_type <> 'FURNITURE'),
j AS (SELECT CASE WHEN p.enterprise_key IS NULL THEN 'INSERT' WHEN c.enterprise_key IS NULL THEN 'SOFT_DELETE'
                  WHEN c.entity_name IS DISTINCT FROM p.entity_name OR c.entity_type IS DISTINCT FROM p.entity_type
                       OR c.jurisdiction IS DISTINCT FROM p.jurisdiction THEN 'UPDATE' ELSE 'UNCHANGED' END AS action
      FROM cur c FULL OUTER JOIN prev p ON c.enterprise_key = p.enterprise_key)
SELECT CAST(sum(CASE WHEN action <> 'SOFT_DELETE' THEN 1 ELSE 0 END) AS BIGINT) AS source_row_count,
       CAST(sum(CASE WHEN action = 'INSERT' THEN 1 ELSE 0 END) AS BIGINT) AS rows_inserted,
       CAST(sum(CASE WHEN action = 'UPDATE' THEN 1 ELSE 0 END) AS BIGINT) AS rows_updated,
       CAST(sum(CASE WHEN action = 'SOFT_DELETE' THEN 1 ELSE 0 END) AS BIGINT) AS rows_soft_deleted,
       CAST(sum(CASE WHEN action = 'UNCHANGED' THEN 1 ELSE 0 END) AS BIGINT) AS rows_unchanged
FROM j"""
FINAL["watermark_delta"] = """
WITH tgt AS (SELECT * FROM r_contract WHERE signing_date <= DATE '1998-12-31'),
wm AS (SELECT max(signing_date) AS wm FROM tgt),
fresh AS (SELECT s.* FROM r_contract s CROSS JOIN wm WHERE wm.wm IS NULL OR s.signing_date > wm.wm)
SELECT CASE WHEN k.enterprise_key IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS action, count(*) AS row_count,
       CAST(sum(f.principal_local) AS DOUBLE) AS principal_local
FROM fresh f LEFT JOIN (SELECT DISTINCT enterprise_key FROM tgt) k ON k.enterprise_key = f.enterprise_key
GROUP BY 1"""
FINAL["anchor_chain"] = """
WITH sa AS (SELECT enterprise_key AS sek, security_sk AS security_anchor_sk FROM s_security_dim
            WHERE preceding_record_sk IS NULL),
owners AS (SELECT source_key AS ck, 'EK_' || entity_source_key AS eek FROM r_contract WHERE version_no = 1),
ea AS (SELECT enterprise_key AS eek2, entity_sk AS entity_anchor_sk FROM k_entity_soft_deleted
       WHERE preceding_record_sk IS NULL)
SELECT p.enterprise_key, p.position_date, sa.security_anchor_sk, sv.security_sk AS security_sk_on_date,
       ea.entity_anchor_sk, ev.entity_sk AS entity_sk_on_date
FROM b_position p JOIN sa ON p.security_enterprise_key = sa.sek
JOIN owners o ON o.ck = p.contract_source_key JOIN ea ON ea.eek2 = o.eek
JOIN s_security_dim s1 ON s1.security_sk = sa.security_anchor_sk
JOIN s_security_dim sv ON sv.enterprise_key = s1.enterprise_key
 AND p.position_date BETWEEN sv.effective_start_date AND sv.effective_end_date
JOIN k_entity_soft_deleted e1 ON e1.entity_sk = ea.entity_anchor_sk
JOIN k_entity_soft_deleted ev ON ev.enterprise_key = e1.enterprise_key
 AND p.position_date BETWEEN ev.effective_start_date AND ev.effective_end_date"""
FINAL["json_techniques"] = """
WITH kv AS (
  SELECT event_type, k AS json_key, CAST(json_extract(props, '$."' || k || '"') AS INTEGER) AS json_value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_path
  FROM events, unnest(json_keys(props)) AS t(k))
SELECT event_type, json_key, count(*) AS n_events, CAST(sum(json_value) AS BIGINT) AS sum_value,
       CAST(min(json_value) AS BIGINT) AS min_value, CAST(max(json_value) AS BIGINT) AS max_value,
       CAST(sum(k_path) AS BIGINT) AS sum_k_path
FROM kv GROUP BY 1, 2"""

_DIMS = {"security_dim": ("security_sk", "enterprise_key"), "contract_dim": ("contract_sk", "enterprise_key"),
         "entity_dim": ("entity_sk", "enterprise_key"), "rating_dim": ("security_rating_sk", "rated_enterprise_key")}


def _gate_row(gate, subject, metric, expected, ok):
    return (f"SELECT '{gate}' AS gate, {subject} AS subject, CAST({metric} AS DOUBLE) AS metric, "
            f"CAST({expected} AS DOUBLE) AS expected, CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status")


FINAL["gate_fk_orphans"] = "\nUNION ALL\n".join(
    _gate_row("fk_orphans", f"'{c}'", "n", 0, "n = 0")
    + f" FROM (SELECT count(*) AS n FROM s_position p LEFT JOIN {d} d ON d.{c} = p.{c} WHERE d.{c} IS NULL)"
    for c, d in (("portfolio_sk", "s_portfolio_dim"), ("security_sk", "s_security_dim")))
FINAL["gate_duplicates"] = "\nUNION ALL\n".join(
    _gate_row("duplicates", f"'{d}'", "n", 0, "n = 0")
    + f" FROM (SELECT count(*) AS n FROM (SELECT enterprise_key, effective_start_date FROM s_{d} GROUP BY 1, 2 "
      f"HAVING count(*) > 1))" for d in _DIMS)
FINAL["gate_team_nonempty"] = _gate_row("team_nonempty", "t.bu_code", "COALESCE(c.n, 0)", 1, "COALESCE(c.n, 0) >= 1") + """
FROM s_business_unit_dim t LEFT JOIN (SELECT team_code, count(*) AS n FROM g_team_position GROUP BY 1) c
  ON c.team_code = t.bu_code WHERE t.is_current"""
FINAL["gate_consolidated_sum"] = _gate_row("consolidated_sum", "'consolidated_position_book'", "c.n", "t.n",
                                           "c.n = t.n") + """
FROM (SELECT count(*) AS n FROM g_consolidated_positions) c
CROSS JOIN (SELECT count(*) AS n FROM g_team_position
            WHERE team_code IN (SELECT bu_code FROM s_business_unit_dim WHERE is_current AND is_pd_strategy)) t"""
FINAL["gate_scd2_current"] = "\nUNION ALL\n".join(
    _gate_row("scd2_current", f"'{d}'", "n", 0, "n = 0")
    + f" FROM (SELECT count(*) AS n FROM (SELECT {k} FROM s_{d} GROUP BY 1 "
      f"HAVING sum(CAST(is_current AS INTEGER)) <> 1))" for d, (sk, k) in _DIMS.items())
FINAL["gate_scd2_overlap"] = "\nUNION ALL\n".join(
    _gate_row("scd2_overlap", f"'{d}'", "n", 0, "n = 0")
    + f" FROM (SELECT count(*) AS n FROM (SELECT effective_start_date, lag(effective_end_date) OVER "
      f"(PARTITION BY {k} ORDER BY effective_start_date, {sk}) AS pe FROM s_{d}) "
      f"WHERE pe IS NOT NULL AND effective_start_date <= pe)" for d, (sk, k) in _DIMS.items())
FINAL["gate_scd2_dates"] = "\nUNION ALL\n".join(
    _gate_row("scd2_dates", f"'{d}'", "n", 0, "n = 0")
    + f" FROM (SELECT count(*) AS n FROM s_{d} WHERE effective_start_date > effective_end_date)" for d in _DIMS)
FINAL["gate_scd2_links"] = "\nUNION ALL\n".join(
    _gate_row("scd2_links", f"'{d}'", "n", 0, "n = 0")
    + f" FROM (SELECT count(*) AS n FROM s_{d} a LEFT JOIN s_{d} b ON b.{sk} = a.preceding_record_sk "
      f"WHERE a.preceding_record_sk IS NOT NULL AND b.{sk} IS NULL)" for d, (sk, k) in _DIMS.items())
_BR = ["security", "entity", "asset", "portfolio", "contract", "business_unit", "position", "transaction",
       "security_price", "portfolio_risk", "portfolio_performance", "rating", "collateral", "fx_rate"]
FINAL["gate_nonempty"] = "\nUNION ALL\n".join(
    _gate_row("nonempty", f"'{e}'", "n", 1, "n >= 1") + f" FROM (SELECT count(*) AS n FROM b_{e})" for e in _BR)
FINAL["gate_conflict_density"] = _gate_row(
    "conflict_density", "entity_name", "CAST(conf AS DOUBLE) / NULLIF(CAST(rows AS DOUBLE), 0)", 0.5,
    "COALESCE(CAST(conf AS DOUBLE) / NULLIF(CAST(rows AS DOUBLE), 0), 0.0) < 0.5") + """
FROM (SELECT entity_name, sum(row_count) AS rows, sum(conflict_rows) AS conf FROM b_lineage_audit GROUP BY 1)"""
FINAL["gate_missing_fx"] = _gate_row("missing_fx", "currency_code", "n", 0, "n = 0") + """
FROM (SELECT currency_code, count(*) FILTER (WHERE fx_rate_to_usd IS NULL) AS n
      FROM s_position WHERE currency_code <> 'USD' GROUP BY currency_code)"""
FINAL["triplet_coverage"] = """
WITH teams AS (SELECT bu_code AS team_code FROM s_business_unit_dim WHERE is_current),
covered AS (SELECT team_code FROM g_team_position INTERSECT SELECT team_code FROM g_team_portfolio_analytics)
SELECT team_code, 'MISSING' AS coverage FROM (SELECT team_code FROM teams EXCEPT SELECT team_code FROM covered)
UNION ALL
SELECT team_code, 'COVERED' FROM (SELECT team_code FROM teams INTERSECT SELECT team_code FROM covered)"""
_PAR = [("bronze.position", "b_position", "market_value_local"),
        ("silver.position_analytics_fact", "s_position", "market_value_usd"),
        ("gold.position_analytics_fact", "g_team_position", "market_value_usd")]
# the second row of each entity is a snapshot that ends before 2000
_PARITY = """
SELECT 'parity' AS gate, '{n}{tag}' AS subject, v.n AS view_rows, s.n AS mv_rows, CAST(v.s AS DOUBLE) AS view_sum,
       CAST(s.s AS DOUBLE) AS mv_sum,
       CASE WHEN v.n IS NOT DISTINCT FROM s.n AND v.s IS NOT DISTINCT FROM s.s THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT count(*) AS n, sum({m}) AS s FROM {c}) v, (SELECT count(*) AS n, sum({m}) AS s FROM {c} WHERE {f}) s"""
_OLD = "position_date < DATE '2000-01-01'"
FINAL["gate_parity"] = "\nUNION ALL\n".join(
    _PARITY.format(n=n, c=c, m=m, tag=tag, f=f) for n, c, m in _PAR for tag, f in (("", "TRUE"), ("@old", _OLD)))
FINAL["gate_set_difference"] = f"""
WITH v AS (SELECT count(*) AS n, count(*) FILTER (WHERE {_OLD}) AS old FROM g_team_position),
d AS (SELECT 'gold.position_analytics_fact' AS subject, n - n AS a, n - n AS b FROM v UNION ALL
      SELECT 'gold.position_analytics_fact@old', n - old, CAST(0 AS BIGINT) FROM v UNION ALL
      SELECT 'gold.position_analytics_fact@changed', n - old, n - old FROM v)
SELECT subject, a AS view_minus_mv, b AS mv_minus_view, CASE WHEN a = 0 AND b = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM d"""
FINAL["parity_pivot"] = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS entity, count(*) AS v_count, count(*) AS mv_count, count(*) AS t_count, "
    f"count(*) FILTER (WHERE {_OLD}) AS old_count FROM {c}" for n, c, m in _PAR)
FINAL["incremental_aum"] = """
SELECT portfolio_sk, position_date, CAST(sum(market_value_usd) AS DOUBLE) AS aum_usd, count(*) AS position_count
FROM s_position WHERE NOT (return_flag = 'R' AND position_date >= DATE '2001-01-01')
GROUP BY portfolio_sk, position_date"""
FINAL["incremental_refresh"] = fin("(SELECT *, 'incremental' AS strategy FROM k_aum_daily)", "$aum, $book_value, $unrealized_pnl")
_VERSIONED = {"security_dim": "enterprise_key", "contract_dim": "enterprise_key", "portfolio_dim": "enterprise_key",
              "entity_dim": "enterprise_key", "business_unit_dim": "enterprise_key", "industry_dim": "enterprise_key",
              "reporting_group_dim": "enterprise_key", "rating_dim": "rated_enterprise_key"}
FINAL["valid_at"] = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS dimension, {k} AS key, max(effective_start_date) AS effective_start_date FROM s_{n} "
    f"WHERE DATE '1998-07-01' BETWEEN effective_start_date AND effective_end_date GROUP BY {k}" for n, k in _VERSIONED.items())
FINAL["predicate_delete"] = """
SELECT CAST(year(transaction_date) AS INTEGER) AS year, count(*) AS transaction_count,
       CAST(sum(gross_amount) AS DOUBLE) AS gross_amount,
       CAST(sum(CASE WHEN year(transaction_date) = 1999 THEN 0 ELSE fees END) AS DOUBLE) AS fees
FROM k_fact_transaction WHERE NOT (year(transaction_date) = 1998 AND transaction_type = 'SELL') GROUP BY 1"""
FINAL["clone_shape"] = """
SELECT 't' AS table_name, count(*) AS rows, count(asset_name) AS named, max(vintage_year) AS newest FROM b_asset
UNION ALL SELECT 't_like', 0, 0, NULL"""
FINAL["streaming_refresh"] = """
SELECT portfolio_source_key, cash_flow_date, cash_flow_type, CAST(sum(amount_local) AS DOUBLE) AS amount_local,
       count(*) AS flow_count
FROM r_cash_flow GROUP BY 1, 2, 3"""
FINAL["hash_attributes"] = """
SELECT p_partkey,
       100 + CAST(('0x' || substring(sha256(concat_ws('|', 'size', CAST(p_partkey AS VARCHAR))), 1, 8)) AS BIGINT) % 1000
         AS size_bucket,
       ['DIRECT_LENDING', 'MEZZANINE', 'DISTRESSED', 'REAL_ESTATE_DEBT', 'SPECIALTY_FINANCE'][
         CAST(('0x' || substring(sha256(concat_ws('|', 'strategy', CAST(p_partkey AS VARCHAR))), 1, 8)) AS BIGINT) % 5 + 1]
         AS strategy,
       CAST(('0x' || substring(sha256(concat_ws('|', 'subset', CAST(p_partkey AS VARCHAR))), 1, 8)) AS BIGINT) % 2 = 0
         AS in_subset
FROM part"""


# twins whose shared parts DuckDB would otherwise run again for every use
MATERIALIZED = {"demo_point_lookup"}


def oracle(key: str) -> str:
    return compose(FINAL[key], CTES, materialized=key in MATERIALIZED)
