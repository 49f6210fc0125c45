"""DuckDB twins of the bronze builders."""

XW = "b_xw_current"


def _res(alias: str, system: str, key: str) -> str:
    return f"LEFT JOIN {XW} {alias} ON {alias}.source_system = '{system}' AND {alias}.source_key = {key}"


def _latest(table: str, part: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (rn__) FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS rn__ "
            f"FROM {table}) WHERE rn__ = 1")


POSITION_ORDER = ("position_date DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
                  "l_returnflag, l_linestatus")
EMPTY = "CAST([] AS VARCHAR[])"

BRONZE = {
    "b_crosswalk": """
SELECT DISTINCT source_system, source_key, enterprise_key, TRUE AS mapping_active FROM (
  SELECT 'aspen' AS source_system, source_key, enterprise_key FROM r_security UNION ALL
  SELECT 'aspen', source_key, enterprise_key FROM r_entity UNION ALL
  SELECT 'aspen', source_key, enterprise_key FROM r_asset UNION ALL
  SELECT 'efront', source_key, enterprise_key FROM r_contract UNION ALL
  SELECT 'state_street', source_key, enterprise_key FROM r_portfolio UNION ALL
  SELECT 'internal_admin', source_key, enterprise_key FROM r_team UNION ALL
  SELECT 'state_street', source_key, enterprise_key FROM r_position UNION ALL
  SELECT 'state_street', source_key, enterprise_key FROM r_settled_transaction UNION ALL
  SELECT 'aladdin', source_key, enterprise_key FROM r_trade_blotter UNION ALL
  SELECT 'state_street', security_source_key, 'EK_' || security_source_key FROM r_position UNION ALL
  SELECT 'efront', entity_source_key, 'EK_' || entity_source_key FROM r_contract UNION ALL
  SELECT 'aspen', issuer_source_key, 'EK_' || issuer_source_key FROM r_security UNION ALL
  SELECT 'aladdin', portfolio_source_key, 'EK_' || portfolio_source_key FROM r_portfolio_risk UNION ALL
  SELECT 'efront', contract_source_key, 'EK_' || contract_source_key FROM r_collateral_position UNION ALL
  SELECT 'state_street', portfolio_source_key, 'EK_' || portfolio_source_key FROM r_cash_flow UNION ALL
  SELECT 'aspen', source_key, 'EK_' || source_key FROM r_rating UNION ALL
  SELECT 'aspen', source_key, 'EK_' || source_key FROM r_security_rating UNION ALL
  SELECT 'aspen', classification_code, 'EK_' || classification_code FROM r_industry UNION ALL
  SELECT 'aspen', group_code, 'EK_' || group_code FROM r_reporting_group UNION ALL
  SELECT 'aladdin', risk_team_code, 'EK_' || risk_team_code FROM r_compliance UNION ALL
  SELECT 'state_street', portfolio_source_key, 'EK_' || portfolio_source_key FROM r_position UNION ALL
  SELECT 'efront', security_source_key, 'EK_' || security_source_key FROM r_collateral_position UNION ALL
  SELECT 'state_street', portfolio_source_key, 'EK_' || portfolio_source_key FROM r_settled_transaction UNION ALL
  SELECT 'state_street', security_source_key, 'EK_' || security_source_key FROM r_settled_transaction UNION ALL
  SELECT 'aladdin', portfolio_source_key, 'EK_' || portfolio_source_key FROM r_trade_blotter UNION ALL
  SELECT 'aladdin', security_source_key, 'EK_' || security_source_key FROM r_trade_blotter UNION ALL
  SELECT 'aspen', entity_source_key, 'EK_' || entity_source_key FROM r_rating UNION ALL
  SELECT 'aspen', security_source_key, 'EK_' || security_source_key FROM r_security_rating
) WHERE source_key IS NOT NULL""",
    "b_xw_current": _latest("(SELECT * FROM b_crosswalk WHERE mapping_active)", "source_system, source_key",
                            "enterprise_key DESC"),
    "b_security": f"""
WITH m AS ({_latest('r_security', 'enterprise_key', 'version_no DESC')}),
p AS ({_latest('r_security_price', 'security_source_key', 'price_date DESC')})
SELECT m.enterprise_key, m.source_key, m.security_name, 'aspen' AS security_name_source, m.security_type,
       m.asset_class, m.sub_asset_class, m.issue_date, m.maturity_date, m.coupon_rate, m.currency_code,
       x.enterprise_key AS issuer_enterprise_key, p.close_price_local AS latest_close_price,
       p.currency_code AS latest_close_price_currency, p.price_date AS latest_price_date,
       CASE WHEN p.security_source_key IS NOT NULL THEN 'aspen+state_street' ELSE 'aspen' END AS _source_pref,
       CASE WHEN p.currency_code IS NOT NULL AND m.currency_code IS DISTINCT FROM p.currency_code
            THEN ['state_street'] ELSE {EMPTY} END AS _sources_in_conflict
FROM m LEFT JOIN p ON p.security_source_key = m.source_key
{_res('x', 'aspen', 'm.issuer_source_key')}""",
    "b_entity": f"""
WITH m AS ({_latest('r_entity', 'enterprise_key', 'version_no DESC')}),
o AS (SELECT DISTINCT x.enterprise_key AS owner_key FROM r_contract c {_res('x', 'efront', 'c.entity_source_key')}
      WHERE x.enterprise_key IS NOT NULL)
SELECT m.enterprise_key, m.source_key, m.entity_name, m.entity_type, m.jurisdiction, m.formation_date, m.country,
       o.owner_key IS NOT NULL AS has_contracts,
       CASE WHEN o.owner_key IS NOT NULL THEN 'aspen+efront' ELSE 'aspen' END AS _source_pref,
       {EMPTY} AS _sources_in_conflict
FROM m LEFT JOIN o ON o.owner_key = m.enterprise_key""",
    "b_asset": f"""
SELECT enterprise_key, source_key, asset_name, asset_type, asset_class, country_code, vintage_year, total_size_local,
       currency_code, 'aspen' AS _source_pref, {EMPTY} AS _sources_in_conflict
FROM ({_latest('r_asset', 'enterprise_key', 'source_key DESC')})""",
    "b_portfolio": f"""
WITH rk AS ({_latest('r_portfolio_risk', 'portfolio_source_key', 'risk_date DESC')}),
cap AS (SELECT portfolio_source_key,
               sum(CASE WHEN activity_type = 'CAPITAL_CALL' THEN amount_local END) AS total_called_local,
               sum(CASE WHEN activity_type = 'DISTRIBUTION' THEN amount_local END) AS total_distributed_local,
               max(activity_date) AS last_activity_date
        FROM r_capital_activity GROUP BY portfolio_source_key)
SELECT x.enterprise_key, rk.portfolio_source_key, rk.portfolio_name, rk.risk_currency AS base_currency,
       rk.risk_date AS last_risk_date, cap.total_called_local, cap.total_distributed_local, cap.last_activity_date,
       sp.bu_source_key, sp.currency_code AS custodian_currency,
       concat_ws('+', 'aladdin', CASE WHEN cap.portfolio_source_key IS NOT NULL THEN 'efront' END,
                 CASE WHEN sp.source_key IS NOT NULL THEN 'state_street' END) AS _source_pref,
       list_sort(list_distinct(list_filter([
           CASE WHEN sp.currency_code IS NOT NULL AND rk.risk_currency IS DISTINCT FROM sp.currency_code THEN 'state_street' END,
           CASE WHEN sp.portfolio_name IS NOT NULL AND rk.portfolio_name IS DISTINCT FROM sp.portfolio_name THEN 'state_street' END],
           lambda s: s IS NOT NULL))) AS _sources_in_conflict
FROM rk {_res('x', 'aladdin', 'rk.portfolio_source_key')}
LEFT JOIN cap ON cap.portfolio_source_key = rk.portfolio_source_key
LEFT JOIN r_portfolio sp ON sp.source_key = rk.portfolio_source_key""",
    "b_contract": f"""
WITH c AS ({_latest('r_contract', 'enterprise_key', 'version_no DESC')})
SELECT c.enterprise_key, c.source_key, c.contract_name, x.enterprise_key AS entity_enterprise_key, c.contract_type,
       c.signing_date, c.maturity_date, c.principal_local, c.currency_code, c.coupon_rate, c.spread_over_benchmark,
       c.status, 'efront' AS _source_pref, {EMPTY} AS _sources_in_conflict
FROM c {_res('x', 'efront', 'c.entity_source_key')}""",
    "b_business_unit": f"""
SELECT t.enterprise_key, t.source_key, t.bu_code, t.bu_name, t.bu_type, t.strategy_name, t.established_date,
       k.codes AS associated_risk_team_codes, 'internal_admin+aladdin' AS _source_pref, {EMPTY} AS _sources_in_conflict
FROM r_team t CROSS JOIN (SELECT list_sort(list(DISTINCT risk_team_code)) AS codes FROM r_compliance) k""",
    "b_position": f"""
WITH p AS ({_latest('r_position', 'enterprise_key', POSITION_ORDER)})
SELECT p.enterprise_key, p.source_key, xp.enterprise_key AS portfolio_enterprise_key,
       xs.enterprise_key AS security_enterprise_key, p.contract_source_key, p.position_date, p.quantity,
       p.market_value_local, p.book_value_local, p.cost_basis_local, p.unrealized_gl_local, p.currency_code,
       p.settlement_status, p.return_flag, 'state_street' AS _source_pref, {EMPTY} AS _sources_in_conflict
FROM p {_res('xp', 'state_street', 'p.portfolio_source_key')}
{_res('xs', 'state_street', 'p.security_source_key')}""",
    "b_transaction": f"""
WITH s AS ({_latest('r_settled_transaction', 'enterprise_key', 'transaction_date DESC, source_key')}),
u AS (
  SELECT enterprise_key, source_key, portfolio_source_key, security_source_key, transaction_date, settlement_date,
         transaction_type, quantity, gross_amount_local, fees_local, net_amount_local, currency_code,
         'SETTLED' AS transaction_status, 'state_street' AS _source_pref FROM s
  UNION ALL
  SELECT enterprise_key, source_key, portfolio_source_key, security_source_key, transaction_date, CAST(NULL AS DATE),
         CASE WHEN side = 'S' THEN 'SELL' ELSE 'BUY' END, quantity, CAST(NULL AS DECIMAL(18,2)),
         CAST(NULL AS DECIMAL(18,2)), CAST(NULL AS DECIMAL(18,2)), currency_code, trade_status, 'aladdin'
  FROM r_trade_blotter WHERE trade_status IN ('PENDING', 'EXECUTED', 'CANCELLED'))
SELECT u.*, xp.enterprise_key AS portfolio_enterprise_key, xs.enterprise_key AS security_enterprise_key,
       {EMPTY} AS _sources_in_conflict
FROM u {_res('xp', 'state_street', 'u.portfolio_source_key')}
{_res('xs', 'state_street', 'u.security_source_key')}""",
    "b_security_price": f"""
SELECT p.*, x.enterprise_key AS security_enterprise_key, 'state_street' AS _source_pref, {EMPTY} AS _sources_in_conflict
FROM r_security_price p {_res('x', 'state_street', 'p.security_source_key')}""",
    "b_portfolio_risk": f"""
SELECT p.*, x.enterprise_key AS portfolio_enterprise_key, 'aladdin' AS _source_pref, {EMPTY} AS _sources_in_conflict
FROM r_portfolio_risk p {_res('x', 'aladdin', 'p.portfolio_source_key')}""",
    "b_portfolio_performance": f"""
SELECT p.*, x.enterprise_key AS portfolio_enterprise_key, 'aladdin' AS _source_pref, {EMPTY} AS _sources_in_conflict
FROM r_portfolio_performance p {_res('x', 'aladdin', 'p.portfolio_source_key')}""",
    "b_rating": f"""
SELECT r.source_key, 'SECURITY' AS rated_object_type, x.enterprise_key AS rated_enterprise_key, r.rating_date,
       r.rating_agency, r.rating_value, r.rating_outlook, r.rating_action_type,
       'aspen' AS _source_pref, {EMPTY} AS _sources_in_conflict
FROM r_security_rating r {_res('x', 'aspen', 'r.security_source_key')}
UNION ALL
SELECT source_key, 'ENTITY', rated_enterprise_key, rating_date, rating_agency, rating_value, rating_outlook,
       rating_action_type, 'aspen', {EMPTY} FROM r_rating""",
    "b_collateral": f"""
SELECT c.*, x.enterprise_key AS contract_enterprise_key, 'efront' AS _source_pref, {EMPTY} AS _sources_in_conflict
FROM r_collateral_position c {_res('x', 'efront', 'c.contract_source_key')}""",
    "b_fx_rate": f"""
SELECT *, 'bloomberg' AS _source_pref, {EMPTY} AS _sources_in_conflict FROM r_fx_rate""",
}

_ENTS = ["security", "entity", "asset", "portfolio", "contract", "business_unit", "position", "transaction",
         "security_price", "portfolio_risk", "portfolio_performance", "rating", "collateral", "fx_rate"]

BRONZE["b_lineage_audit"] = (
    "SELECT entity_name, _source_pref, count(*) AS row_count, CAST(sum(c) AS BIGINT) AS conflict_rows FROM (\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{e}' AS entity_name, _source_pref, CASE WHEN len(_sources_in_conflict) > 0 THEN 1 ELSE 0 END AS c FROM b_{e}"
        for e in _ENTS)
    + "\n) GROUP BY entity_name, _source_pref")

BRONZE["b_conflicts"] = """
SELECT 'security' AS entity_name, enterprise_key, _source_pref, _sources_in_conflict FROM b_security
WHERE len(_sources_in_conflict) > 0
UNION ALL
SELECT 'portfolio', enterprise_key, _source_pref, _sources_in_conflict FROM b_portfolio
WHERE len(_sources_in_conflict) > 0"""
