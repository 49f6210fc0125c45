"""DuckDB twins of the silver builders."""

from oracle.bronze_sql import EMPTY, _latest, _res  # noqa: F401

AS_OF = "DATE '2001-12-31'"
SCD = "effective_start_date, effective_end_date, is_current, preceding_record_sk, succeeding_record_sk"


def chain(src: str, key: str, order: str, start: str, sk: str, cols: str, key_alias: str = "") -> str:
    ka = f"{key} AS {key_alias}" if key_alias else key
    return f"""
WITH o AS (SELECT *, row_number() OVER (ORDER BY {key}, {order}) AS {sk} FROM {src})
SELECT {sk}, {ka}, COALESCE({start}, DATE '1900-01-01') AS effective_start_date,
       COALESCE(CAST(lead({start}) OVER w - 1 AS DATE), DATE '9999-12-31') AS effective_end_date,
       (row_number() OVER w = count(*) OVER (PARTITION BY {key})) AS is_current,
       lag({sk}) OVER w AS preceding_record_sk, lead({sk}) OVER w AS succeeding_record_sk, {cols}
FROM o WINDOW w AS (PARTITION BY {key} ORDER BY {order})"""


def single(src: str, order: str, sk: str, cols: str) -> str:
    return f"""
SELECT row_number() OVER (ORDER BY {order}) AS {sk}, DATE '1900-01-01' AS effective_start_date,
       DATE '9999-12-31' AS effective_end_date, TRUE AS is_current, CAST(NULL AS BIGINT) AS preceding_record_sk,
       CAST(NULL AS BIGINT) AS succeeding_record_sk, {cols}
FROM {src}"""


def usd(expr: str, rate: str = "fx.fx_rate", scale: int = 2) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(38,{scale})) * COALESCE({rate}, 1.0) AS DECIMAL(18,{scale}))"


def fxj(alias: str, ccy: str, date: str) -> str:
    return (f"LEFT JOIN s_fx_rate_dim {alias} ON {alias}.from_currency = {ccy} AND {alias}.to_currency = 'USD' "
            f"AND {alias}.rate_date = {date}")


def tj(alias: str, dim: str, key: str, date: str) -> str:
    return (f"LEFT JOIN {dim} {alias} ON {alias}.enterprise_key = {key} "
            f"AND {date} BETWEEN {alias}.effective_start_date AND {alias}.effective_end_date")


def cj(alias: str, dim: str, key: str, kind: str = "LEFT") -> str:
    return f"{kind} JOIN {dim} {alias} ON {alias}.enterprise_key = {key} AND {alias}.is_current"


SILVER = {
    "s_security_dim": chain(
        f"(SELECT s.*, x.enterprise_key AS issuer_enterprise_key FROM r_security s {_res('x', 'aspen', 's.issuer_source_key')})",
        "enterprise_key", "issue_date NULLS LAST, version_no", "issue_date", "security_sk",
        "source_key, security_name, security_type, asset_class, sub_asset_class, issue_date, maturity_date, "
        "coupon_rate, currency_code, issuer_enterprise_key, brand"),
    "s_rating_dim": chain(
        "(SELECT * FROM b_rating WHERE rated_enterprise_key IS NOT NULL)", "rated_enterprise_key",
        "rating_date, source_key", "rating_date", "security_rating_sk",
        "source_key AS enterprise_key, rated_object_type, rating_agency, rating_value, rating_outlook, "
        "CAST(CASE rating_value WHEN 'AAA' THEN 1 WHEN 'AA' THEN 2 WHEN 'A' THEN 3 WHEN 'BBB' THEN 4 WHEN 'BB' THEN 5 "
        "WHEN 'B' THEN 6 WHEN 'CCC' THEN 7 WHEN 'CC' THEN 8 WHEN 'C' THEN 9 WHEN 'D' THEN 10 END AS INTEGER) "
        "AS rating_numeric_score"),
    "s_contract_dim": chain(
        "r_contract", "enterprise_key", "signing_date, version_no", "signing_date", "contract_sk",
        "source_key, contract_name, entity_source_key, contract_type, signing_date, maturity_date, principal_local, "
        "currency_code, coupon_rate, spread_over_benchmark, status"),
    "s_portfolio_dim": single(
        f"(SELECT p.*, x.enterprise_key AS business_unit_enterprise_key FROM b_portfolio p "
        f"{_res('x', 'internal_admin', 'p.bu_source_key')})",
        "enterprise_key", "portfolio_sk",
        "enterprise_key, portfolio_name, base_currency, custodian_currency, business_unit_enterprise_key"),
    "s_entity_dim": chain(
        "r_entity", "enterprise_key", "formation_date, version_no", "formation_date", "entity_sk",
        "source_key, entity_name, entity_type, jurisdiction, formation_date, country, "
        "COALESCE((SELECT b.has_contracts FROM b_entity b WHERE b.enterprise_key = o.enterprise_key), FALSE) AS has_contracts"),
    "s_industry_dim": single(
        "r_industry", "classification_code", "industry_sk",
        "classification_code AS enterprise_key, classification_name, parent_code, classification_level, classification_system"),
    "s_reporting_group_dim": single(
        "r_reporting_group", "group_code", "reporting_group_sk",
        "group_code AS enterprise_key, group_name, parent_group_code, group_level, group_type"),
    "s_business_unit_dim": single(
        "(SELECT * FROM b_business_unit CROSS JOIN (SELECT count(*) AS risk_team_code_count FROM r_compliance))",
        "enterprise_key", "business_unit_sk",
        "enterprise_key, bu_code, bu_name, bu_type, strategy_name, strategy_name LIKE 'PD\\_%' ESCAPE '\\' AS is_pd_strategy, "
        "associated_risk_team_codes, risk_team_code_count"),
    "s_fx_rate_dim": """
SELECT row_number() OVER (ORDER BY from_currency, to_currency, rate_date) AS fx_rate_sk,
       from_currency, to_currency, rate_date, fx_rate, rate_type FROM b_fx_rate""",
    "s_position": f"""
SELECT row_number() OVER (ORDER BY p.enterprise_key) AS position_sk, p.enterprise_key, p.position_date,
       pd.portfolio_sk, sd.security_sk, bu.business_unit_sk, p.quantity,
       p.market_value_local, {usd('p.market_value_local')} AS market_value_usd,
       p.book_value_local, {usd('p.book_value_local')} AS book_value_usd,
       p.cost_basis_local, {usd('p.cost_basis_local')} AS cost_basis_usd,
       p.unrealized_gl_local, {usd('p.unrealized_gl_local')} AS unrealized_gl_usd,
       p.currency_code, fx.fx_rate AS fx_rate_to_usd, p.settlement_status, p.contract_source_key, p.return_flag
FROM b_position p
{tj('pd', 's_portfolio_dim', 'p.portfolio_enterprise_key', 'p.position_date')}
{cj('bu', 's_business_unit_dim', 'pd.business_unit_enterprise_key')}
{tj('sd', 's_security_dim', 'p.security_enterprise_key', 'p.position_date')}
{fxj('fx', 'p.currency_code', 'p.position_date')}""",
    "s_position_monthend": """
WITH m AS (
  SELECT last_day(position_date) AS monthend_date, portfolio_sk, security_sk, business_unit_sk, currency_code,
         sum(quantity) AS quantity, sum(market_value_local) AS market_value_local,
         sum(market_value_usd) AS market_value_usd, sum(book_value_local) AS book_value_local,
         sum(cost_basis_usd) AS cost_basis_usd, sum(unrealized_gl_usd) AS unrealized_gl_usd,
         count(*) AS position_count
  FROM s_position WHERE position_date = last_day(position_date)
  GROUP BY 1, 2, 3, 4, 5)
SELECT *, row_number() OVER (ORDER BY monthend_date, portfolio_sk NULLS LAST, security_sk NULLS LAST,
                                      business_unit_sk NULLS LAST, currency_code) AS position_monthend_sk
FROM m""",
    "s_security_master": f"""
SELECT row_number() OVER (ORDER BY d.security_sk) AS security_master_sk, {AS_OF} AS snapshot_date, d.security_sk,
       d.enterprise_key, d.security_name, d.asset_class, b.latest_close_price,
       {usd('b.latest_close_price', scale=6)} AS latest_close_price_usd, b.latest_price_date,
       CAST(d.maturity_date - {AS_OF} AS BIGINT) AS days_to_maturity, d.maturity_date < {AS_OF} AS is_matured
FROM s_security_dim d LEFT JOIN b_security b ON b.enterprise_key = d.enterprise_key
{fxj('fx', 'b.latest_close_price_currency', 'b.latest_price_date')}
WHERE d.is_current""",
    "s_security_price": f"""
SELECT row_number() OVER (ORDER BY p.security_enterprise_key, p.price_date) AS security_price_sk,
       p.security_enterprise_key AS enterprise_key, p.price_date, sd.security_sk, p.close_price_local,
       {usd('p.close_price_local', scale=6)} AS close_price_usd, p.currency_code, p.price_type,
       fx.fx_rate AS fx_rate_to_usd
FROM b_security_price p
{tj('sd', 's_security_dim', 'p.security_enterprise_key', 'p.price_date')}
{fxj('fx', 'p.currency_code', 'p.price_date')}""",
    "s_breach": f"""
SELECT contract_source_key, covenant_date, has_active_breach FROM (
  SELECT *, row_number() OVER (PARTITION BY contract_source_key ORDER BY covenant_date DESC) AS rn FROM (
    SELECT contract_source_key, covenant_date,
           max(CASE WHEN covenant_status = 'TRIPPED' THEN 1 ELSE 0 END) > 0 AS has_active_breach
    FROM r_covenant WHERE covenant_date <= {AS_OF} GROUP BY 1, 2)) WHERE rn = 1""",
    "s_contract_details": f"""
WITH km AS (SELECT DISTINCT enterprise_key, source_key AS csk FROM r_contract WHERE source_key NOT LIKE '%\\_v2' ESCAPE '\\')
SELECT row_number() OVER (ORDER BY c.enterprise_key) AS contract_details_sk, c.enterprise_key,
       {AS_OF} AS detail_date, cd.contract_sk, ed.entity_sk, c.contract_type, c.principal_local,
       {usd('c.principal_local')} AS principal_usd, c.coupon_rate, c.spread_over_benchmark,
       CAST(c.maturity_date - {AS_OF} AS BIGINT) AS days_to_maturity, c.status,
       COALESCE(br.has_active_breach, FALSE) AS has_active_breach, c.currency_code, fx.fx_rate AS fx_rate_to_usd
FROM b_contract c
{cj('cd', 's_contract_dim', 'c.enterprise_key')}
{cj('ed', 's_entity_dim', 'c.entity_enterprise_key')}
{fxj('fx', 'c.currency_code', AS_OF)}
LEFT JOIN km ON km.enterprise_key = c.enterprise_key
LEFT JOIN s_breach br ON br.contract_source_key = km.csk""",
    "s_contract_summary": f"""
SELECT row_number() OVER (ORDER BY x.enterprise_key, s.summary_date) AS contract_summary_sk,
       x.enterprise_key, s.summary_date, cd.contract_sk,
       s.outstanding_principal_local, {usd('s.outstanding_principal_local')} AS outstanding_principal_usd,
       s.accrued_interest_local, {usd('s.accrued_interest_local')} AS accrued_interest_usd,
       s.paid_to_date_local, {usd('s.paid_to_date_local')} AS paid_to_date_usd,
       s.currency_code, fx.fx_rate AS fx_rate_to_usd, s.performance_status
FROM r_contract_summary s {_res('x', 'efront', 's.contract_source_key')}
{tj('cd', 's_contract_dim', 'x.enterprise_key', 's.summary_date')}
{fxj('fx', 's.currency_code', 's.summary_date')}""",
    "s_portfolio_analytics": """
WITH a AS (
  SELECT r.*, r.risk_date AS analytics_date, pf.period_return_pct, pf.return_sum, pf.return_count, pf.benchmark_code
  FROM b_portfolio_risk r LEFT JOIN b_portfolio_performance pf
    ON pf.portfolio_source_key = r.portfolio_source_key AND pf.performance_date = r.risk_date),
a2 AS (
  SELECT *, CAST(sum(return_sum) OVER y AS DOUBLE) / CAST(sum(return_count) OVER y AS DOUBLE) AS ytd_return_pct
  FROM a WINDOW y AS (PARTITION BY portfolio_enterprise_key, year(analytics_date) ORDER BY analytics_date
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT row_number() OVER (ORDER BY a2.portfolio_enterprise_key, a2.analytics_date) AS portfolio_analytics_sk,
       a2.analytics_date, pd.portfolio_sk, bu.business_unit_sk, a2.var_95, a2.var_99, a2.expected_shortfall,
       a2.period_return_pct, a2.return_sum, a2.return_count, a2.ytd_return_pct, 0.01 AS benchmark_return_pct, a2.benchmark_code
FROM a2
LEFT JOIN s_portfolio_dim pd ON pd.enterprise_key = a2.portfolio_enterprise_key
  AND a2.analytics_date BETWEEN pd.effective_start_date AND pd.effective_end_date
LEFT JOIN s_business_unit_dim bu ON bu.enterprise_key = pd.business_unit_enterprise_key AND bu.is_current""",
    "s_analytics_monthend": """
WITH m AS (
  SELECT last_day(analytics_date) AS monthend_date, portfolio_sk, business_unit_sk,
         max(var_95) AS var_95, max(var_99) AS var_99, CAST(sum(return_sum) AS DOUBLE) / CAST(sum(return_count) AS DOUBLE) AS avg_period_return_pct,
         max(ytd_return_pct) AS ytd_return_pct
  FROM s_portfolio_analytics WHERE analytics_date = last_day(analytics_date) GROUP BY 1, 2, 3)
SELECT *, row_number() OVER (ORDER BY monthend_date, portfolio_sk NULLS LAST, business_unit_sk NULLS LAST)
          AS analytics_monthend_sk FROM m""",
    "s_collateral_exposure": f"""
WITH e AS (
  SELECT e.*, x.enterprise_key, cd.contract_sk,
         {usd('e.exposure_amount_local')} AS exposure_amount_usd,
         {usd('e.collateral_value_local')} AS collateral_value_usd
  FROM r_collateral_exposure e {_res('x', 'efront', 'e.contract_source_key')}
  {tj('cd', 's_contract_dim', 'x.enterprise_key', 'e.exposure_date')}
  {fxj('fx', 'e.currency_code', 'e.exposure_date')})
SELECT row_number() OVER (ORDER BY enterprise_key, exposure_date) AS collateral_exposure_sk, enterprise_key,
       exposure_date, contract_sk, exposure_amount_local, exposure_amount_usd, collateral_value_local,
       collateral_value_usd, collateral_type,
       CAST(exposure_amount_usd AS DOUBLE) / NULLIF(CAST(collateral_value_usd AS DOUBLE), 0) AS ltv_pct
FROM e""",
    "s_collateral_positions": f"""
WITH c AS (
  SELECT c.*, xs.enterprise_key AS security_enterprise_key, cd.contract_sk, sd.security_sk,
         cd.currency_code AS currency_code
  FROM b_collateral c {_res('xs', 'state_street', 'c.security_source_key')}
  {tj('cd', 's_contract_dim', 'c.contract_enterprise_key', 'c.position_date')}
  {tj('sd', 's_security_dim', 'xs.enterprise_key', 'c.position_date')})
SELECT row_number() OVER (ORDER BY c.contract_enterprise_key, c.security_enterprise_key, c.position_date,
                                   c.l_linenumber, c.position_value_local, c.collateral_role) AS collateral_position_sk,
       c.contract_enterprise_key AS enterprise_key, c.position_date, c.contract_sk, c.security_sk,
       c.position_value_local, {usd('c.position_value_local')} AS position_value_usd, c.currency_code,
       c.collateral_role
FROM c {fxj('fx', 'c.currency_code', 'c.position_date')}""",
    "s_transaction": f"""
WITH t AS ({_latest('b_transaction', 'enterprise_key', 'transaction_date DESC, transaction_status')})
SELECT row_number() OVER (ORDER BY t.enterprise_key) AS transaction_sk, t.enterprise_key, t.transaction_date,
       t.settlement_date, pd.portfolio_sk, sd.security_sk, bu.business_unit_sk, t.transaction_type,
       t.transaction_status, t.quantity, t.gross_amount_local, {usd('t.gross_amount_local')} AS gross_amount_usd,
       {usd('t.fees_local')} AS fees_usd, {usd('t.net_amount_local')} AS net_amount_usd, t.currency_code,
       fx.fx_rate AS fx_rate_to_usd, t._source_pref
FROM t
{tj('pd', 's_portfolio_dim', 't.portfolio_enterprise_key', 't.transaction_date')}
{cj('bu', 's_business_unit_dim', 'pd.business_unit_enterprise_key')}
{tj('sd', 's_security_dim', 't.security_enterprise_key', 't.transaction_date')}
{fxj('fx', 't.currency_code', 't.transaction_date')}""",
    "s_cancels_amendment": f"""
WITH a AS (
  SELECT regexp_replace(c2.source_key, '_v2$', '') AS original_source_key, c2.signing_date AS amendment_date,
         c1.principal_local AS original_principal_local, c1.currency_code AS original_currency_code
  FROM r_contract c2 JOIN r_contract c1 ON c1.source_key = regexp_replace(c2.source_key, '_v2$', '')
  WHERE c2.source_key LIKE '%\\_v2' ESCAPE '\\')
SELECT row_number() OVER (ORDER BY a.amendment_date, a.original_source_key) AS cancel_sk,
       old.contract_sk AS cancelled_contract_details_sk, old.contract_sk, a.amendment_date AS cancel_event_date,
       CAST(NULL AS DATE) AS original_detail_date, 'AMENDMENT' AS cancel_reason,
       {usd('a.original_principal_local')} AS cancelled_principal_usd, a.original_source_key
FROM a {_res('x', 'efront', 'a.original_source_key')}
LEFT JOIN s_contract_dim old ON old.enterprise_key = x.enterprise_key AND NOT old.is_current
{fxj('fx', 'a.original_currency_code', 'a.amendment_date')}""",
    "s_cancels_remap": f"""
WITH p AS (SELECT * FROM r_position WHERE enterprise_key LIKE 'REMAPPED\\_%' ESCAPE '\\')
SELECT row_number() OVER (ORDER BY p.position_date, p.source_key, p.market_value_local) AS cancel_sk,
       CAST('0x' || substr(sha256('cancelled_position|' || p.source_key), 1, 12) AS BIGINT) AS cancelled_position_sk,
       pd.portfolio_sk, sd.security_sk, p.position_date AS cancel_event_date,
       p.position_date AS original_position_date, 'CROSSWALK_REMAP' AS cancel_reason,
       {usd('p.market_value_local')} AS cancelled_market_value_usd
FROM p {_res('x', 'state_street', 'p.portfolio_source_key')}
{_res('y', 'aspen', 'p.security_source_key')}
{cj('pd', 's_portfolio_dim', 'x.enterprise_key')}
{tj('sd', 's_security_dim', 'y.enterprise_key', 'p.position_date')}
{fxj('fx', 'p.currency_code', 'p.position_date')}""",
    "s_price_cancels": """
SELECT CAST(NULL AS BIGINT) AS cancel_sk, CAST(NULL AS BIGINT) AS cancelled_security_price_sk,
       CAST(NULL AS BIGINT) AS security_sk, CAST(NULL AS DATE) AS cancel_event_date,
       CAST(NULL AS DATE) AS original_price_date, CAST(NULL AS VARCHAR) AS cancel_reason,
       CAST(NULL AS DECIMAL(18,6)) AS cancelled_close_price_usd
WHERE 1 = 0""",
    "s_income_bridge": f"""
SELECT row_number() OVER (ORDER BY cf.cash_flow_date, cf.portfolio_source_key, cf.event_id) AS income_bridge_sk,
       pd.portfolio_sk, CAST(NULL AS BIGINT) AS security_sk, CAST(NULL AS BIGINT) AS contract_sk,
       cf.cash_flow_date AS income_date, 'COUPON' AS income_type, cf.amount_local AS income_amount_local,
       {usd('cf.amount_local')} AS income_amount_usd, cf.currency_code
FROM r_cash_flow cf {_res('x', 'state_street', 'cf.portfolio_source_key')}
{cj('pd', 's_portfolio_dim', 'x.enterprise_key', 'INNER')}
{fxj('fx', 'cf.currency_code', 'cf.cash_flow_date')}
WHERE cf.cash_flow_type = 'INCOME'""",
}
