"""DuckDB twins of the gold builders (team-tagged marts, consolidated books)."""

GOLD = {
    "g_teams": """
SELECT business_unit_sk, bu_code AS team_code, is_pd_strategy, enterprise_key AS bu_enterprise_key
FROM s_business_unit_dim WHERE is_current""",
    "g_team_position": """
WITH p AS (SELECT p.*, t.team_code FROM s_position p JOIN g_teams t ON t.business_unit_sk = p.business_unit_sk)
SELECT team_code, position_sk, enterprise_key, position_date, portfolio_sk, security_sk, business_unit_sk, quantity,
       market_value_usd, book_value_usd, cost_basis_usd, unrealized_gl_usd,
       CAST(market_value_usd AS DOUBLE) / NULLIF(CAST(sum(market_value_usd) OVER (PARTITION BY team_code, position_date) AS DOUBLE), 0) AS concentration_pct,
       dense_rank() OVER (PARTITION BY team_code, position_date ORDER BY market_value_usd DESC NULLS LAST) AS portfolio_rank,
       currency_code
FROM p""",
    "g_team_securities": """
SELECT DISTINCT team_code, security_sk FROM g_team_position WHERE security_sk IS NOT NULL""",
    "g_team_contract_details": """
WITH tc AS (SELECT DISTINCT ts.team_code, cp.contract_sk FROM s_collateral_positions cp
            JOIN g_team_securities ts ON ts.security_sk = cp.security_sk WHERE cp.contract_sk IS NOT NULL)
SELECT tc.team_code, c.contract_details_sk, c.enterprise_key, c.detail_date, c.contract_sk, c.entity_sk,
       c.contract_type, c.principal_usd, c.coupon_rate, c.spread_over_benchmark, c.days_to_maturity, c.status,
       c.has_active_breach, CAST(year(cd.signing_date) AS BIGINT) AS vintage_year
FROM s_contract_details c JOIN tc ON tc.contract_sk = c.contract_sk
LEFT JOIN s_contract_dim cd ON cd.contract_sk = c.contract_sk AND cd.is_current""",
    "g_team_contracts": "SELECT DISTINCT team_code, contract_sk FROM g_team_contract_details",
    "g_team_contract_summary": """
SELECT t.team_code, s.contract_summary_sk, s.enterprise_key, s.summary_date, s.contract_sk,
       s.outstanding_principal_usd, s.accrued_interest_usd, s.paid_to_date_usd, s.performance_status
FROM s_contract_summary s JOIN g_team_contracts t ON t.contract_sk = s.contract_sk""",
    "g_team_portfolio_analytics": """
SELECT t.team_code, a.portfolio_analytics_sk, a.analytics_date, a.portfolio_sk, a.business_unit_sk, a.var_95,
       a.var_99, a.expected_shortfall, a.period_return_pct, a.ytd_return_pct, a.benchmark_return_pct, a.benchmark_code
FROM s_portfolio_analytics a JOIN g_teams t ON t.business_unit_sk = a.business_unit_sk""",
    "g_team_security_dim": """
SELECT t.team_code, s.security_sk, s.enterprise_key, s.effective_start_date, s.effective_end_date, s.is_current,
       s.security_name, s.asset_class, s.sub_asset_class, s.issue_date, s.maturity_date, s.coupon_rate, s.currency_code
FROM s_security_dim s JOIN g_team_securities t ON t.security_sk = s.security_sk""",
    "g_team_security_master": """
SELECT t.team_code, m.security_master_sk, m.snapshot_date, m.security_sk, m.enterprise_key, m.security_name,
       m.asset_class, m.latest_close_price_usd, m.days_to_maturity, m.is_matured
FROM s_security_master m JOIN g_team_security_dim t ON t.security_sk = m.security_sk""",
    "g_team_security_price": """
SELECT t.team_code, p.security_price_sk, p.enterprise_key, p.price_date, p.security_sk, p.close_price_usd,
       p.currency_code, p.price_type
FROM s_security_price p JOIN g_team_security_dim t ON t.security_sk = p.security_sk""",
    "g_team_rating": """
SELECT k.team_code, r.security_rating_sk, r.enterprise_key, r.effective_start_date, r.effective_end_date,
       r.is_current, r.rated_enterprise_key, r.rating_agency, r.rating_value, r.rating_outlook, r.rating_numeric_score
FROM s_rating_dim r JOIN (SELECT DISTINCT team_code, enterprise_key FROM g_team_security_dim) k
  ON k.enterprise_key = r.rated_enterprise_key""",
    "g_team_collateral_exposure": """
SELECT t.team_code, e.collateral_exposure_sk, e.enterprise_key, e.exposure_date, e.contract_sk,
       e.exposure_amount_usd, e.collateral_value_usd, e.collateral_type, e.ltv_pct
FROM s_collateral_exposure e JOIN g_team_contracts t ON t.contract_sk = e.contract_sk""",
    "g_team_collateral_positions": """
SELECT t.team_code, c.collateral_position_sk, c.enterprise_key, c.position_date, c.contract_sk, c.security_sk,
       c.position_value_usd, c.collateral_role
FROM s_collateral_positions c JOIN g_team_contracts t ON t.contract_sk = c.contract_sk""",
    "g_consolidated_positions": """
SELECT row_number() OVER (ORDER BY position_date, team_code, enterprise_key) AS pd_position_book_sk,
       team_code, enterprise_key, position_date, portfolio_sk, security_sk, business_unit_sk, market_value_usd,
       book_value_usd, cost_basis_usd, unrealized_gl_usd, concentration_pct, portfolio_rank, currency_code
FROM g_team_position WHERE team_code IN (SELECT team_code FROM g_teams WHERE is_pd_strategy)""",
    "g_consolidated_contracts": """
WITH s AS (SELECT * FROM g_team_contract_summary WHERE team_code IN (SELECT team_code FROM g_teams WHERE is_pd_strategy))
SELECT row_number() OVER (ORDER BY s.summary_date, s.team_code, s.enterprise_key) AS pd_contract_book_sk,
       s.team_code, s.enterprise_key, s.summary_date, s.contract_sk, s.outstanding_principal_usd,
       s.accrued_interest_usd, s.paid_to_date_usd, s.performance_status,
       COALESCE(d.has_active_breach, FALSE) AS has_active_breach
FROM s LEFT JOIN g_team_contract_details d
  ON d.team_code = s.team_code AND d.contract_sk = s.contract_sk AND d.detail_date = s.summary_date""",
    "g_consolidated_transactions": """
WITH pp AS (SELECT p.portfolio_sk, t.team_code FROM s_portfolio_dim p
            JOIN g_teams t ON t.bu_enterprise_key = p.business_unit_enterprise_key
            WHERE p.is_current AND t.is_pd_strategy)
SELECT row_number() OVER (ORDER BY t.transaction_date, pp.team_code, t.enterprise_key) AS pd_transaction_book_sk,
       pp.team_code, t.enterprise_key, t.transaction_date, t.settlement_date, t.portfolio_sk, t.security_sk,
       t.transaction_type, t.gross_amount_usd, t.net_amount_usd, t.fees_usd, t.currency_code
FROM s_transaction t JOIN pp ON pp.portfolio_sk = t.portfolio_sk""",
}
