"""Gold layer: per-team marts and the cross-team consolidated books.

The reference repeats ten view bodies per team. Here each mart is ONE frame
tagged with ``team_code`` (one pass over silver for all teams); a team's view
is a filter on ``team_code``, which prunes partitions when the frame is
stored partitioned by team.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.operators.temporal import temporal_join
from lakeworks.operators.windows import dense_rank_within
from lakeworks.plans.registry import entity, live_step
from lakeworks.plans.silver import keyed_versions
from lakeworks.session import cut_lineage


def _teams(lake) -> DataFrame:
    """Current business units with their team code (a handful of rows)."""
    bu = lake.get("silver.business_unit_dim").filter(F.col("is_current"))
    if lake.cfg.skip_teams:
        bu = bu.filter(~F.col("bu_code").isin(list(lake.cfg.skip_teams)))
    return bu.select("business_unit_sk", F.col("bu_code").alias("team_code"), "is_pd_strategy",
                     F.col("enterprise_key").alias("bu_enterprise_key"))


def team_filter(df: DataFrame, team: str) -> DataFrame:
    """One team's view of a tagged mart."""
    return df.filter(F.col("team_code") == team)


TEAM_POSITION = ("team_code", "position_sk", "enterprise_key", "position_date", "portfolio_sk", "security_sk", "business_unit_sk",
                 "quantity", "market_value_usd", "book_value_usd", "cost_basis_usd", "unrealized_gl_usd", "currency_code")


@entity("gold.position_analytics_fact", cluster=("team_code", "position_date"), dated="position_date",
        sk="position_sk")
def team_position(lake) -> DataFrame:
    p = lake.get("silver.position_analytics_fact", ids=lake.ids)
    p = p.join(F.broadcast(_teams(lake).select("business_unit_sk", "team_code")), "business_unit_sk", "inner")
    # read three times below: the joins above aren't made for each of them
    p = cut_lineage(p.select(*[c for c in p.columns if c in TEAM_POSITION]))
    p = dense_rank_within(p, ["team_code", "position_date"], "market_value_usd", "portfolio_rank", share="concentration_pct")
    return p.select("team_code", "position_sk", "enterprise_key", "position_date", "portfolio_sk", "security_sk",
                    "business_unit_sk", "quantity", "market_value_usd", "book_value_usd", "cost_basis_usd",
                    "unrealized_gl_usd", "concentration_pct", "portfolio_rank", "currency_code")


def teams_with_positions(lake) -> DataFrame:
    """Team codes of the positions' mart. Where that is made here they are read off the positions
    of the teams' units: a share or rank adds no team."""
    if lake.placement.stored("gold"):
        return lake.get("gold.position_analytics_fact", ids=False).select("team_code").distinct()
    p = lake.get("silver.position_analytics_fact", ids=False).select("business_unit_sk").distinct()
    return p.join(F.broadcast(_teams(lake).select("business_unit_sk", "team_code")), "business_unit_sk", "inner") \
        .select("team_code").distinct()


@entity("gold.team_securities")
def team_securities(lake) -> DataFrame:
    """A share or rank adds no security to a team: they are read off the positions of its units."""
    p = lake.live("positions' versions")
    if p is None:
        p = lake.get("silver.position_analytics_fact", ids=False).select("business_unit_sk", "security_sk")
    p = p.filter(F.col("security_sk").isNotNull()).distinct()
    return p.join(F.broadcast(_teams(lake).select("business_unit_sk", "team_code")), "business_unit_sk", "inner") \
        .select("team_code", "security_sk").distinct()


@entity("gold.team_contracts")
def team_contracts(lake) -> DataFrame:
    """Contracts whose collateral includes a security the team holds (semi-join per team)."""
    tc = lake.live("teams by collateral")
    if tc is not None:
        return tc
    cp = lake.get("silver.collateral_positions_fact", ids=False).select("contract_sk", "security_sk")
    cp = cp.filter(F.col("contract_sk").isNotNull() & F.col("security_sk").isNotNull())
    return cp.join(lake.get("gold.team_securities"), "security_sk", "inner").select("team_code", "contract_sk").distinct()


@live_step("teams by collateral")
def _collateral_teams(lake) -> DataFrame | None:
    """As above, made here: the securities' versions bring their teams (a handful) along, and
    rows that met their contract by its source key are told apart before they are dealt again."""
    if not (lake.makes("silver.collateral_positions_fact") and lake.makes("bronze.collateral")):
        return None
    teams = lake.get("gold.team_securities").groupBy("security_sk").agg(F.sort_array(F.collect_set("team_code")).alias("teams"))
    securities = keyed_versions(lake, "silver.security_dim", "security_sk", "state_street", "security", "sd_")
    held = cut_lineage(securities.join(teams, "security_sk", "inner").drop("security_sk"))
    contracts = keyed_versions(lake, "silver.contract_dim", "contract_sk", "efront", "contract", "cd_")
    c = lake.roles.collateral_position.select("contract_source_key", "security_source_key", "position_date")
    c = temporal_join(c, held, "security_source_key", "sd_vk", "position_date", "sd_start", "sd_end", how="inner")
    c = temporal_join(c.select("contract_source_key", "position_date", "teams"), contracts,
                      "contract_source_key", "cd_vk", "position_date", "cd_start", "cd_end", how="inner")
    c = c.select("contract_source_key", "contract_sk", F.explode("teams").alias("team_code")).distinct()
    return cut_lineage(c.select("team_code", "contract_sk").repartition("contract_sk").distinct())


@entity("gold.contract_details_fact", sk="contract_details_sk")
def team_contract_details(lake) -> DataFrame:
    tc = lake.get("gold.team_contracts")
    c = lake.get("silver.contract_details_fact", ids=lake.ids)
    cd = lake.get("silver.contract_dim").filter(F.col("is_current")).select(
        F.col("contract_sk").alias("__csk"), F.year("signing_date").cast("bigint").alias("vintage_year"))
    out = c.join(tc, "contract_sk", "inner").join(cd, F.col("contract_sk") == F.col("__csk"), "left").drop("__csk")
    return out.select("team_code", "contract_details_sk", "enterprise_key", "detail_date", "contract_sk", "entity_sk",
                      "contract_type", "principal_usd", "coupon_rate", "spread_over_benchmark", "days_to_maturity",
                      "status", "has_active_breach", "vintage_year")


def _team_contracts(lake) -> DataFrame:
    tc = lake.live("teams' contracts")
    if tc is not None:
        return tc
    return lake.get("gold.contract_details_fact", ids=False).select("team_code", "contract_sk").distinct()


@live_step("teams' contracts")
def _current_team_contracts(lake) -> DataFrame | None:
    """As above, made here: the details' contracts are the current versions of all contracts."""
    if not all(lake.makes(n) for n in ("gold.contract_details_fact", "silver.contract_details_fact", "bronze.contract")):
        return None
    current = lake.get("silver.contract_dim").filter(F.col("is_current") & F.col("enterprise_key").isNotNull())
    return cut_lineage(lake.get("gold.team_contracts").join(current.select("contract_sk"), "contract_sk", "left_semi"))


@entity("gold.contract_summary_fact", sk="contract_summary_sk")
def team_contract_summary(lake) -> DataFrame:
    s = lake.get("silver.contract_summary_fact", ids=lake.ids).select(
        "contract_summary_sk", "enterprise_key", "summary_date", "contract_sk", "outstanding_principal_usd", "accrued_interest_usd",
        "paid_to_date_usd", "performance_status")
    if not lake.ids and lake.makes("silver.contract_summary_fact"):  # numbered rows lie in files already
        s = cut_lineage(s)
    s = s.join(_team_contracts(lake), "contract_sk", "inner")
    return s.select("team_code", "contract_summary_sk", "enterprise_key", "summary_date", "contract_sk",
                    "outstanding_principal_usd", "accrued_interest_usd", "paid_to_date_usd", "performance_status")


@entity("gold.portfolio_analytics_fact")
def team_portfolio_analytics(lake) -> DataFrame:
    a = lake.get("silver.portfolio_analytics_fact")
    a = a.join(F.broadcast(_teams(lake).select("business_unit_sk", "team_code")), "business_unit_sk", "inner")
    return a.select("team_code", "portfolio_analytics_sk", "analytics_date", "portfolio_sk", "business_unit_sk",
                    "var_95", "var_99", "expected_shortfall", "period_return_pct", "ytd_return_pct",
                    "benchmark_return_pct", "benchmark_code")


@entity("gold.security_dim")
def team_security_dim(lake) -> DataFrame:
    s = lake.get("silver.security_dim").join(lake.get("gold.team_securities"), "security_sk", "inner")
    return s.select("team_code", "security_sk", "enterprise_key", "effective_start_date", "effective_end_date",
                    "is_current", "security_name", "asset_class", "sub_asset_class", "issue_date", "maturity_date",
                    "coupon_rate", "currency_code")


@entity("gold.security_master_fact")
def team_security_master(lake) -> DataFrame:
    m = lake.get("silver.security_master_fact").join(
        lake.get("gold.security_dim").select("team_code", "security_sk"), "security_sk", "inner")
    return m.select("team_code", "security_master_sk", "snapshot_date", "security_sk", "enterprise_key",
                    "security_name", "asset_class", "latest_close_price_usd", "days_to_maturity", "is_matured")


@entity("gold.security_price_fact")
def team_security_price(lake) -> DataFrame:
    p = lake.get("silver.security_price_fact").join(
        lake.get("gold.security_dim").select("team_code", "security_sk"), "security_sk", "inner")
    return p.select("team_code", "security_price_sk", "enterprise_key", "price_date", "security_sk",
                    "close_price_usd", "currency_code", "price_type")


@entity("gold.security_rating_dim")
def team_rating(lake) -> DataFrame:
    keys = lake.get("gold.security_dim").select("team_code", F.col("enterprise_key").alias("rated_enterprise_key")) \
        .distinct()
    r = lake.get("silver.rating_dim").join(keys, "rated_enterprise_key", "inner")
    return r.select("team_code", "security_rating_sk", "enterprise_key", "effective_start_date", "effective_end_date",
                    "is_current", "rated_enterprise_key", "rating_agency", "rating_value", "rating_outlook",
                    "rating_numeric_score")


@entity("gold.collateral_exposure_fact")
def team_collateral_exposure(lake) -> DataFrame:
    e = lake.get("silver.collateral_exposure_fact").join(_team_contracts(lake), "contract_sk", "inner")
    return e.select("team_code", "collateral_exposure_sk", "enterprise_key", "exposure_date", "contract_sk",
                    "exposure_amount_usd", "collateral_value_usd", "collateral_type", "ltv_pct")


@entity("gold.collateral_positions_fact")
def team_collateral_positions(lake) -> DataFrame:
    c = lake.get("silver.collateral_positions_fact").join(_team_contracts(lake), "contract_sk", "inner")
    return c.select("team_code", "collateral_position_sk", "enterprise_key", "position_date", "contract_sk",
                    "security_sk", "position_value_usd", "collateral_role")


def _pd_teams(lake) -> DataFrame:
    return _teams(lake).filter(F.col("is_pd_strategy")).select("team_code")


@entity("gold.consolidated_position_book", cluster=("position_date",), dated="position_date", sk="pd_position_book_sk")
def consolidated_positions(lake) -> DataFrame:
    p = lake.get("gold.position_analytics_fact", ids=False).join(F.broadcast(_pd_teams(lake)), "team_code", "left_semi")
    p = lake.number(p, ["position_date", "team_code", "enterprise_key"], "pd_position_book_sk", of=p)
    return p.select("pd_position_book_sk", "team_code", "enterprise_key", "position_date", "portfolio_sk",
                    "security_sk", "business_unit_sk", "market_value_usd", "book_value_usd", "cost_basis_usd",
                    "unrealized_gl_usd", "concentration_pct", "portfolio_rank", "currency_code")


@entity("gold.consolidated_contract_book", cluster=("summary_date",), dated="summary_date", sk="pd_contract_book_sk")
def consolidated_contracts(lake) -> DataFrame:
    s = lake.get("gold.contract_summary_fact", ids=False).join(F.broadcast(_pd_teams(lake)), "team_code", "left_semi")
    d = lake.get("gold.contract_details_fact", ids=False).select(
        F.col("team_code").alias("__t"), F.col("contract_sk").alias("__c"), F.col("detail_date").alias("__d"),
        "has_active_breach")
    if lake.makes("gold.contract_details_fact"):
        d = cut_lineage(d)
    j = s.join(d, (s.team_code == d.__t) & (s.contract_sk == d.__c) & (s.summary_date == d.__d), "left")
    j = j.withColumn("has_active_breach", F.coalesce(F.col("has_active_breach"), F.lit(False)))
    j = lake.number_rows(j, ["summary_date", "team_code", "enterprise_key"], "pd_contract_book_sk")
    return j.select("pd_contract_book_sk", "team_code", "enterprise_key", "summary_date", "contract_sk",
                    "outstanding_principal_usd", "accrued_interest_usd", "paid_to_date_usd", "performance_status",
                    "has_active_breach")


@entity("gold.consolidated_transaction_book", cluster=("transaction_date",), dated="transaction_date", sk="pd_transaction_book_sk")
def consolidated_transactions(lake) -> DataFrame:
    pf = lake.get("silver.portfolio_dim").filter(F.col("is_current")).select(
        "portfolio_sk", F.col("business_unit_enterprise_key").alias("bu_enterprise_key"))
    teams = _teams(lake).filter(F.col("is_pd_strategy")).select("bu_enterprise_key", "team_code")
    pp = pf.join(F.broadcast(teams), "bu_enterprise_key", "inner").select("portfolio_sk", "team_code")
    t = lake.get("silver.transaction_fact", ids=False).join(pp, "portfolio_sk", "inner")
    t = lake.number(t, ["transaction_date", "team_code", "enterprise_key"], "pd_transaction_book_sk", of=t)
    return t.select("pd_transaction_book_sk", "team_code", "enterprise_key", "transaction_date", "settlement_date",
                    "portfolio_sk", "security_sk", "transaction_type", "gross_amount_usd", "net_amount_usd",
                    "fees_usd", "currency_code")
