"""Silver layer: SCD2 dimensions, FX, dated facts, month-end, cancels, income."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.functions.scalar import hash_int, rating_score, safe_div
from lakeworks.operators.dedup import latest_wins
from lakeworks.operators.fx import normalize_currency
from lakeworks.operators.keys import mappings_of
from lakeworks.operators.rowid import dense_row_id
from lakeworks.operators.scd2 import scd1_as_scd2, scd2_chain
from lakeworks.operators.snapshot import month_end_snapshot
from lakeworks.operators.temporal import overlapping, temporal_join
from lakeworks.plans.bronze import as_transaction, newest_positions, newest_trades, resolve
from lakeworks.plans.registry import entity, live_step
from lakeworks.session import cut_lineage

SCD = ["effective_start_date", "effective_end_date", "is_current", "preceding_record_sk", "succeeding_record_sk"]


def _fx(lake) -> DataFrame:
    """The rates, made once from the days of all sources: their files tell whether joins may broadcast them."""
    label = f"#versions:rates:{lake.fully_live}"
    if label not in lake._memo:
        lake._memo[label] = cut_lineage(lake.get("silver.fx_rate_dim").select("from_currency", "to_currency", "rate_date", "fx_rate"))
    return lake._memo[label]


def _usd(lake, df, amounts, ccy, date, scale=2):
    return normalize_currency(df, _fx(lake), amounts, ccy, date, scale=scale, missing=lake.cfg.fx_missing)


def _dim(lake, name, sk, key="enterprise_key", current=False, prefix="d_", more=()):
    """Dimension columns renamed for a temporal / current join; ``more`` of them as they are."""
    d = lake.get(name)
    if current:
        d = d.filter(F.col("is_current"))
    return d.select(F.col(key).alias(f"{prefix}key"), F.col(sk), *more,
                    F.col("effective_start_date").alias(f"{prefix}start"),
                    F.col("effective_end_date").alias(f"{prefix}end"))


def _tjoin(lake, fact, name, sk, fact_key, date_col, prefix, more=()):
    """``more``: columns of the version found, which a second join by its key would
    look up for every row, those without a version all in one task."""
    d = _dim(lake, name, sk, prefix=prefix, more=more)
    out = temporal_join(fact, d, fact_key, f"{prefix}key", date_col, f"{prefix}start", f"{prefix}end", how="left")
    return out.drop(f"{prefix}key", f"{prefix}start", f"{prefix}end")


def keyed_versions(lake, name, sk, system, domain, prefix, more=()):
    """Versions under the source keys of their enterprise keys, so that a fact is dealt once,
    not for its key and then for the version."""
    label = f"#versions:{system}:{name}:{','.join(more)}:{lake.fully_live}"
    if label not in lake._memo:
        m = mappings_of(lake.part("bronze.crosswalk_lookup", system, domain), system, domain, f"{prefix}vk", f"{prefix}vek")
        d = _dim(lake, name, sk, prefix=prefix, more=more)
        found = m.join(d, F.col(f"{prefix}vek") == F.col(f"{prefix}key"), "inner").drop(f"{prefix}vek", f"{prefix}key")
        lake._memo[label] = cut_lineage(found)   # its files tell whether joins may broadcast it
    return lake._memo[label]


def _version_of(fact, versions, source_key, date_col, prefix):
    """As :func:`_tjoin`, by a fact's source key (a column's expression) and the versions of :func:`keyed_versions`."""
    out = temporal_join(fact.withColumn("__fk", source_key), versions, "__fk", f"{prefix}vk", date_col,
                        f"{prefix}start", f"{prefix}end", how="left")
    return out.drop("__fk", f"{prefix}vk", f"{prefix}start", f"{prefix}end")


def _versioned(lake, rows, keys, date_col, sk):
    """Rows with the versions of their portfolio and security and, as ``sk``, their number by
    enterprise key. Where no versions of a key overlap a row stays one row, so it is numbered
    before the joins: what is checkpointed are the source's numbers, and a reader's dates are
    looked up in those files. Else ``sk`` is left out: numbers go to the joined rows."""
    portfolios = keyed_versions(lake, "silver.portfolio_dim", "portfolio_sk", "state_street", "portfolio", "pd_", ["business_unit_enterprise_key"])
    securities = keyed_versions(lake, "silver.security_dim", "security_sk", "state_street", "security", "sd_")
    if not lake.ids or _one_match_each(lake, portfolios, securities):
        rows = rows.withColumn("__key", keys.get("in_order", keys["enterprise_key"]))
        rows = lake.number(rows, ["__key"], sk, of=rows).drop("__key")
    rows = _unit(lake, _version_of(rows, portfolios, keys["portfolio_source_key"], date_col, "pd_"))
    return _version_of(rows, securities, keys["security_source_key"], date_col, "sd_")


# what a live position is made from where only its amounts and the versions it names are read
_AMOUNTS = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "market_value_local", "l_discount", "l_tax", "position_date")


def position_star(lake, contracts: DataFrame, portfolio: DataFrame, security: DataFrame) -> DataFrame | None:
    """Live positions with what their versions bring along: ``contracts`` by ``__ck`` from
    ``__ed_s`` to ``__ed_e``, ``portfolio`` by portfolio_sk and ``security`` by security_sk, all
    inner. These meet the versions first, so a position is dealt once for each of its keys. None
    if positions can't be numbered before the joins, as numbers are asked for and versions overlap."""
    units = _dim(lake, "silver.business_unit_dim", "business_unit_sk", current=True, prefix="bu_").select("bu_key")
    portfolios = keyed_versions(lake, "silver.portfolio_dim", "portfolio_sk", "state_street", "portfolio", "pd_", ["business_unit_enterprise_key"])
    securities = keyed_versions(lake, "silver.security_dim", "security_sk", "state_street", "security", "sd_")
    rows, keys = newest_positions(lake), lake.roles.position_keys()
    if lake.ids:
        if not _one_match_each(lake, portfolios, securities):
            return None
        rows = rows.select(*_AMOUNTS, keys["in_order"].alias("__key"))
        rows = lake.number(rows, ["__key"], "position_sk", of=rows).drop("__key")
    else:
        rows = rows.select(*_AMOUNTS).withColumn("position_sk", F.lit(None).cast("bigint"))
    portfolios = portfolios.join(F.broadcast(units), F.col("business_unit_enterprise_key") == F.col("bu_key"), "left") \
        .drop("business_unit_enterprise_key", "bu_key").join(portfolio, "portfolio_sk", "inner")
    securities = cut_lineage(securities.join(security, "security_sk", "inner"))
    rows = temporal_join(rows.withColumn("__fp", keys["portfolio_source_key"]), cut_lineage(portfolios),
                         "__fp", "pd_vk", "position_date", "pd_start", "pd_end", how="inner").drop("__fp", "pd_vk", "pd_start", "pd_end")
    contract = F.concat(F.lit("ORD_"), F.col("l_orderkey").cast("string"))
    rows = temporal_join(rows.withColumn("__fc", contract), contracts, "__fc", "__ck", "position_date", "__ed_s", "__ed_e",
                         how="inner").drop("__fc", "__ck", "__ed_s", "__ed_e")
    rows = temporal_join(rows.withColumn("__fs", keys["security_source_key"]), securities,
                         "__fs", "sd_vk", "position_date", "sd_start", "sd_end", how="inner").drop("__fs", "sd_vk", "sd_start", "sd_end")
    more = [c for c in rows.columns if c not in _AMOUNTS]
    for name, kind in (("l_linenumber", "int"), ("l_returnflag", "string"), ("l_linestatus", "string"), ("remapped", "boolean")):
        rows = rows.withColumn(name, F.lit(None).cast(kind))       # of no use to an amount
    return _usd(lake, lake.roles.as_position(rows, *more),
                {"market_value_usd": "market_value_local", "book_value_usd": "book_value_local", "cost_basis_usd": "cost_basis_local",
                 "unrealized_gl_usd": "unrealized_gl_local"}, "currency_code", "position_date")


@live_step("positions' versions")
def position_versions(lake) -> DataFrame | None:
    """The business unit and security of each live position, for readers of those alone."""
    if not (lake.makes("silver.position_analytics_fact") and lake.makes("bronze.position")):
        return None
    portfolios = keyed_versions(lake, "silver.portfolio_dim", "portfolio_sk", "state_street", "portfolio", "pd_", ["business_unit_enterprise_key"])
    securities = keyed_versions(lake, "silver.security_dim", "security_sk", "state_street", "security", "sd_")
    keys, rows = lake.roles.position_keys(), newest_positions(lake, named=True)
    rows = _unit(lake, _version_of(rows, portfolios, keys["portfolio_source_key"], "position_date", "pd_"))
    return _version_of(rows, securities, keys["security_source_key"], "position_date", "sd_").select("business_unit_sk", "security_sk")


def _one_match_each(lake, portfolios, securities) -> bool:
    units = _dim(lake, "silver.business_unit_dim", "business_unit_sk", current=True, prefix="bu_")
    repeated = units.groupBy("bu_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return all(bad.isEmpty() for bad in (repeated, overlapping(portfolios, ["pd_vk"], "pd_start", "pd_end"),
                                         overlapping(securities, ["sd_vk"], "sd_start", "sd_end")))


def _cjoin(lake, fact, name, sk, fact_key, prefix, key="enterprise_key", how="left"):
    d = _dim(lake, name, sk, key=key, current=True, prefix=prefix)
    out = fact.join(d, fact[fact_key] == d[f"{prefix}key"], how)
    return out.drop(f"{prefix}key", f"{prefix}start", f"{prefix}end")


def _unit(lake, fact):
    """The portfolio's business unit: one of a handful, so every task has them all."""
    d = _dim(lake, "silver.business_unit_dim", "business_unit_sk", current=True, prefix="bu_")
    out = fact.join(F.broadcast(d), F.col("business_unit_enterprise_key") == d["bu_key"], "left")
    return out.drop("business_unit_enterprise_key", "bu_key", "bu_start", "bu_end")


# ----------------------------------------------------------------- dimensions
@entity("silver.security_dim")
def security_dim(lake) -> DataFrame:
    s = lake.roles.security
    s = resolve(lake, s, "aspen", "issuer_source_key", "issuer_enterprise_key")
    ch = scd2_chain(s, "enterprise_key", [F.col("issue_date").asc_nulls_last(), F.col("version_no")],
                    "issue_date", "security_sk")
    return ch.select("security_sk", "enterprise_key", *SCD, "source_key", "security_name", "security_type",
                     "asset_class", "sub_asset_class", "issue_date", "maturity_date", "coupon_rate", "currency_code",
                     "issuer_enterprise_key", "brand")


@entity("silver.rating_dim")
def rating_dim(lake) -> DataFrame:
    r = lake.get("bronze.rating").filter(F.col("rated_enterprise_key").isNotNull())
    ch = scd2_chain(r, "rated_enterprise_key", [F.col("rating_date"), F.col("source_key")], "rating_date",
                    "security_rating_sk")
    return ch.select("security_rating_sk", F.col("source_key").alias("enterprise_key"), *SCD,
                     "rated_enterprise_key", "rated_object_type", "rating_agency", "rating_value", "rating_outlook",
                     rating_score("rating_value").alias("rating_numeric_score"))


@entity("silver.contract_dim")
def contract_dim(lake) -> DataFrame:
    ch = scd2_chain(lake.roles.contract, "enterprise_key", [F.col("signing_date"), F.col("version_no")],
                    "signing_date", "contract_sk")
    return ch.select("contract_sk", "enterprise_key", *SCD, "source_key", "contract_name", "entity_source_key",
                     "contract_type", "signing_date", "maturity_date", "principal_local", "currency_code",
                     "coupon_rate", "spread_over_benchmark", "status")


@entity("silver.portfolio_dim")
def portfolio_dim(lake) -> DataFrame:
    p = lake.get("bronze.portfolio")
    p = resolve(lake, p, "internal_admin", "bu_source_key", "business_unit_enterprise_key")
    d = scd1_as_scd2(p, ["enterprise_key"], "portfolio_sk")
    return d.select("portfolio_sk", "enterprise_key", *SCD, "portfolio_name", "base_currency", "custodian_currency",
                    "business_unit_enterprise_key")


@entity("silver.entity_dim")
def entity_dim(lake) -> DataFrame:
    ch = scd2_chain(lake.roles.entity, "enterprise_key", [F.col("formation_date"), F.col("version_no")],
                    "formation_date", "entity_sk")
    flags = lake.get("bronze.entity").select(F.col("enterprise_key").alias("__ek"), "has_contracts")
    ch = ch.join(flags, ch.enterprise_key == flags.__ek, "left")
    return ch.select("entity_sk", "enterprise_key", *SCD, "source_key", "entity_name", "entity_type",
                     "jurisdiction", "formation_date", "country",
                     F.coalesce(F.col("has_contracts"), F.lit(False)).alias("has_contracts"))


@entity("silver.industry_dim")
def industry_dim(lake) -> DataFrame:
    d = scd1_as_scd2(lake.roles.industry, ["classification_code"], "industry_sk")
    return d.select("industry_sk", F.col("classification_code").alias("enterprise_key"), *SCD,
                    "classification_name", "parent_code", "classification_level", "classification_system")


@entity("silver.reporting_group_dim")
def reporting_group_dim(lake) -> DataFrame:
    d = scd1_as_scd2(lake.roles.reporting_group, ["group_code"], "reporting_group_sk", bounded=True)
    return d.select("reporting_group_sk", F.col("group_code").alias("enterprise_key"), *SCD,
                    "group_name", "parent_group_code", "group_level", "group_type")


@entity("silver.business_unit_dim")
def business_unit_dim(lake) -> DataFrame:
    bu = lake.get("bronze.business_unit")
    one = lake.roles.compliance.agg(F.count(F.lit(1)).cast("bigint").alias("risk_team_code_count"))
    bu = bu.crossJoin(F.broadcast(one))
    d = scd1_as_scd2(bu, ["enterprise_key"], "business_unit_sk", bounded=True)
    return d.select("business_unit_sk", "enterprise_key", *SCD, "bu_code", "bu_name", "bu_type", "strategy_name",
                    F.expr("strategy_name LIKE 'PD\\\\_%' ESCAPE '\\\\'").alias("is_pd_strategy"),
                    "associated_risk_team_codes", "risk_team_code_count")


@entity("silver.fx_rate_dim")
def fx_rate_dim(lake) -> DataFrame:
    fx = lake.get("bronze.fx_rate")
    # one row per currency pair and calendar day: bounded by the calendar
    d = dense_row_id(fx, ["from_currency", "to_currency", "rate_date"], "fx_rate_sk", bounded=True)
    return d.select("fx_rate_sk", "from_currency", "to_currency", "rate_date", "fx_rate", "rate_type")


# ---------------------------------------------------------------------- facts
@entity("silver.position_analytics_fact", cluster=("position_date",), dated="position_date", sk="position_sk")
def position_fact(lake) -> DataFrame:
    if lake.makes("bronze.position"):
        p = _versioned_positions(lake)
    else:
        p = lake.get("bronze.position")
        p = _unit(lake, _tjoin(lake, p, "silver.portfolio_dim", "portfolio_sk", "portfolio_enterprise_key", "position_date", "pd_",
                               ["business_unit_enterprise_key"]))
        p = _tjoin(lake, p, "silver.security_dim", "security_sk", "security_enterprise_key", "position_date", "sd_")
    p = _usd(lake, p, {"market_value_usd": "market_value_local", "book_value_usd": "book_value_local",
                       "cost_basis_usd": "cost_basis_local", "unrealized_gl_usd": "unrealized_gl_local"},
             "currency_code", "position_date")
    if "position_sk" not in p.columns:
        p = lake.number(p, ["enterprise_key"], "position_sk", of=lake.get("bronze.position"))
    return p.select("position_sk", "enterprise_key", "position_date", "portfolio_sk", "security_sk",
                    "business_unit_sk", "quantity", "market_value_local", "market_value_usd", "book_value_local",
                    "book_value_usd", "cost_basis_local", "cost_basis_usd", "unrealized_gl_local",
                    "unrealized_gl_usd", "currency_code", "fx_rate_to_usd", "settlement_status",
                    "contract_source_key", "return_flag")


def _versioned_positions(lake) -> DataFrame:
    """Live positions with the versions of their portfolio and security: the source's numbers are
    deduplicated, numbered and joined, texts and amounts are made last."""
    p = _versioned(lake, newest_positions(lake), lake.roles.position_keys(), "position_date", "position_sk")
    return lake.roles.as_position(p, *[c for c in p.columns if c.endswith("_sk")])


@entity("silver.position_monthend_fact")
def position_monthend(lake) -> DataFrame:
    p = lake.get("silver.position_analytics_fact", ids=False)
    me = month_end_snapshot(
        p, "position_date", ["portfolio_sk", "security_sk", "business_unit_sk", "currency_code"],
        [F.sum("quantity").alias("quantity"), F.sum("market_value_local").alias("market_value_local"),
         F.sum("market_value_usd").alias("market_value_usd"), F.sum("book_value_local").alias("book_value_local"),
         F.sum("cost_basis_usd").alias("cost_basis_usd"), F.sum("unrealized_gl_usd").alias("unrealized_gl_usd"),
         F.count(F.lit(1)).alias("position_count")])
    me = dense_row_id(me, [F.col("monthend_date"), F.col("portfolio_sk").asc_nulls_last(),
                           F.col("security_sk").asc_nulls_last(), F.col("business_unit_sk").asc_nulls_last(),
                           F.col("currency_code")], "position_monthend_sk")
    return me


@entity("silver.security_master_fact")
def security_master(lake) -> DataFrame:
    as_of = F.lit(lake.cfg.as_of)
    cur = lake.get("silver.security_dim").filter(F.col("is_current"))
    price = lake.get("bronze.security").select(F.col("enterprise_key").alias("__ek"), "latest_close_price",
                                               "latest_close_price_currency", "latest_price_date")
    m = cur.join(price, cur.enterprise_key == price.__ek, "left").drop("__ek")
    m = _usd(lake, m, {"latest_close_price_usd": "latest_close_price"}, "latest_close_price_currency",
             "latest_price_date", scale=6)
    m = m.withColumn("snapshot_date", as_of) \
        .withColumn("days_to_maturity", F.datediff(F.col("maturity_date"), as_of).cast("bigint")) \
        .withColumn("is_matured", F.col("maturity_date") < as_of)
    m = dense_row_id(m, ["security_sk"], "security_master_sk")
    return m.select("security_master_sk", "snapshot_date", "security_sk", "enterprise_key", "security_name",
                    "asset_class", "latest_close_price", "latest_close_price_usd", "latest_price_date",
                    "days_to_maturity", "is_matured")


@entity("silver.security_price_fact", cluster=("price_date",), dated="price_date")
def security_price_fact(lake) -> DataFrame:
    p = lake.get("bronze.security_price")
    p = _tjoin(lake, p, "silver.security_dim", "security_sk", "security_enterprise_key", "price_date", "sd_")
    p = _usd(lake, p, {"close_price_usd": "close_price_local"}, "currency_code", "price_date", scale=6)
    p = dense_row_id(p, [F.col("security_enterprise_key"), F.col("price_date")], "security_price_sk")
    return p.select("security_price_sk", F.col("security_enterprise_key").alias("enterprise_key"), "price_date",
                    "security_sk", "close_price_local", "close_price_usd", "currency_code", "price_type",
                    "fx_rate_to_usd")


def _breach_as_of(lake) -> DataFrame:
    """Latest covenant day on or before as_of per contract, breached when any
    covenant tripped that day (A5)."""
    cov = lake.roles.covenant.filter(F.col("covenant_date") <= F.lit(lake.cfg.as_of))
    # the greatest (day, tripped) is the latest day, tripped if any row of that day is
    tripped = F.when(F.col("covenant_status") == "TRIPPED", 1).otherwise(0).alias("tripped")
    last = cov.groupBy("contract_source_key").agg(F.max(F.struct("covenant_date", tripped)).alias("last"))
    return last.select("contract_source_key", F.col("last.covenant_date").alias("covenant_date"),
                       (F.col("last.tripped") > 0).alias("has_active_breach"))


@entity("silver.contract_details_fact", sk="contract_details_sk")
def contract_details(lake) -> DataFrame:
    as_of = F.lit(lake.cfg.as_of)
    c = lake.get("bronze.contract").withColumn("detail_date", as_of)
    c = _cjoin(lake, c, "silver.contract_dim", "contract_sk", "enterprise_key", "cd_")
    c = _cjoin(lake, c, "silver.entity_dim", "entity_sk", "entity_enterprise_key", "ed_")
    c = _usd(lake, c, {"principal_usd": "principal_local"}, "currency_code", "detail_date")
    key_map = lake.roles.contract.filter(F.expr("source_key NOT LIKE '%\\\\_v2' ESCAPE '\\\\'")) \
        .select(F.col("enterprise_key").alias("__ek"), F.col("source_key").alias("__csk")).distinct()
    c = c.join(key_map, c.enterprise_key == key_map.__ek, "left")
    br = _breach_as_of(lake)
    c = c.join(br, c.__csk == br.contract_source_key, "left")
    c = c.withColumn("days_to_maturity", F.datediff(F.col("maturity_date"), as_of).cast("bigint")) \
        .withColumn("has_active_breach", F.coalesce(F.col("has_active_breach"), F.lit(False)))
    c = lake.number(c, ["enterprise_key"], "contract_details_sk", of=lake.get("bronze.contract"))
    return c.select("contract_details_sk", "enterprise_key", "detail_date", "contract_sk", "entity_sk",
                    "contract_type", "principal_local", "principal_usd", "coupon_rate", "spread_over_benchmark",
                    "days_to_maturity", "status", "has_active_breach", "currency_code", "fx_rate_to_usd")


@entity("silver.contract_summary_fact", cluster=("summary_date",), dated="summary_date", sk="contract_summary_sk")
def contract_summary(lake) -> DataFrame:
    # the frame, its mappings and its versions meet by the source key: the rows are dealt once
    s = resolve(lake, lake.roles.contract_summary, "efront", "contract_source_key", "enterprise_key")
    s = _version_of(s, keyed_versions(lake, "silver.contract_dim", "contract_sk", "efront", "contract", "cd_"),
                    F.col("contract_source_key"), "summary_date", "cd_")
    # numbered before the amounts are made: there is one rate at most for a row
    s = lake.number_rows(s.drop("contract_source_key", "order_key"), [F.col("enterprise_key"), F.col("summary_date")], "contract_summary_sk")
    s = _usd(lake, s, {"outstanding_principal_usd": "outstanding_principal_local",
                       "accrued_interest_usd": "accrued_interest_local", "paid_to_date_usd": "paid_to_date_local"},
             "currency_code", "summary_date")
    return s.select("contract_summary_sk", "enterprise_key", "summary_date", "contract_sk",
                    "outstanding_principal_local", "outstanding_principal_usd", "accrued_interest_local",
                    "accrued_interest_usd", "paid_to_date_local", "paid_to_date_usd", "currency_code",
                    "fx_rate_to_usd", "performance_status")


@entity("silver.portfolio_analytics_fact")
def portfolio_analytics(lake) -> DataFrame:
    risk = lake.get("bronze.portfolio_risk")
    perf = lake.get("bronze.portfolio_performance").select(
        F.col("portfolio_source_key").alias("__pk"), F.col("performance_date").alias("__pdate"),
        "period_return_pct", "return_sum", "return_count", "benchmark_code")
    a = risk.join(perf, (risk.portfolio_source_key == perf.__pk) & (risk.risk_date == perf.__pdate), "left") \
        .drop("__pk", "__pdate").withColumnRenamed("risk_date", "analytics_date")
    w = Window.partitionBy("portfolio_enterprise_key", F.year("analytics_date")).orderBy("analytics_date") \
        .rowsBetween(Window.unboundedPreceding, 0)
    a = a.withColumn("ytd_return_pct",
                     F.sum("return_sum").over(w).cast("double") / F.sum("return_count").over(w).cast("double"))
    a = _unit(lake, _tjoin(lake, a, "silver.portfolio_dim", "portfolio_sk", "portfolio_enterprise_key", "analytics_date", "pd_",
                           ["business_unit_enterprise_key"]))
    a = dense_row_id(a, [F.col("portfolio_enterprise_key"), F.col("analytics_date")], "portfolio_analytics_sk")
    return a.select("portfolio_analytics_sk", "analytics_date", "portfolio_sk", "business_unit_sk", "var_95",
                    "var_99", "expected_shortfall", "period_return_pct", "return_sum", "return_count",
                    "ytd_return_pct", F.lit(0.01).alias("benchmark_return_pct"), "benchmark_code")


@entity("silver.portfolio_analytics_monthend_fact")
def analytics_monthend(lake) -> DataFrame:
    a = lake.get("silver.portfolio_analytics_fact")
    me = month_end_snapshot(a, "analytics_date", ["portfolio_sk", "business_unit_sk"], [
        F.max("var_95").alias("var_95"), F.max("var_99").alias("var_99"),
        (F.sum("return_sum").cast("double") / F.sum("return_count").cast("double")).alias("avg_period_return_pct"),
        F.max("ytd_return_pct").alias("ytd_return_pct")])
    return dense_row_id(me, [F.col("monthend_date"), F.col("portfolio_sk").asc_nulls_last(),
                             F.col("business_unit_sk").asc_nulls_last()], "analytics_monthend_sk")


@entity("silver.collateral_exposure_fact")
def collateral_exposure(lake) -> DataFrame:
    e = resolve(lake, lake.roles.collateral_exposure, "efront", "contract_source_key", "enterprise_key")
    e = _version_of(e, keyed_versions(lake, "silver.contract_dim", "contract_sk", "efront", "contract", "cd_"),
                    F.col("contract_source_key"), "exposure_date", "cd_")
    e = dense_row_id(e.drop("contract_source_key", "order_key"), [F.col("enterprise_key"), F.col("exposure_date")], "collateral_exposure_sk")
    e = _usd(lake, e, {"exposure_amount_usd": "exposure_amount_local", "collateral_value_usd": "collateral_value_local"},
             "currency_code", "exposure_date")
    e = e.withColumn("ltv_pct", safe_div("exposure_amount_usd", "collateral_value_usd"))
    return e.select("collateral_exposure_sk", "enterprise_key", "exposure_date", "contract_sk",
                    "exposure_amount_local", "exposure_amount_usd", "collateral_value_local", "collateral_value_usd",
                    "collateral_type", "ltv_pct")


@entity("silver.collateral_positions_fact", sk="collateral_position_sk")
def collateral_positions(lake) -> DataFrame:
    c = lake.get("bronze.collateral")
    if lake.makes("bronze.collateral"):
        # each mapping and its versions meet the rows by the same source key: dealt once for both
        c = _version_of(c, keyed_versions(lake, "silver.contract_dim", "contract_sk", "efront", "contract", "cd_", ["currency_code"]),
                        F.col("contract_source_key"), "position_date", "cd_").drop("contract_source_key", "order_key")
        c = resolve(lake, c, "state_street", "security_source_key", "security_enterprise_key")
        c = _version_of(c, keyed_versions(lake, "silver.security_dim", "security_sk", "state_street", "security", "sd_"),
                        F.col("security_source_key"), "position_date", "sd_").drop("security_source_key")
    else:
        c = resolve(lake, c, "state_street", "security_source_key", "security_enterprise_key")
        c = _tjoin(lake, c, "silver.contract_dim", "contract_sk", "contract_enterprise_key", "position_date", "cd_", ["currency_code"])
        c = _tjoin(lake, c, "silver.security_dim", "security_sk", "security_enterprise_key", "position_date", "sd_")
    c = c.select("contract_enterprise_key", "security_enterprise_key", "position_date", "l_linenumber", "position_value_local",
                 "collateral_role", "contract_sk", "security_sk", "currency_code")
    # numbered before the amount is made: there is one rate at most for a row
    c = lake.number_rows(c, [F.col("contract_enterprise_key"), F.col("security_enterprise_key"), F.col("position_date"),
                             F.col("l_linenumber"), F.col("position_value_local"), F.col("collateral_role")],
                         "collateral_position_sk")
    c = _usd(lake, c, {"position_value_usd": "position_value_local"}, "currency_code", "position_date")
    return c.select("collateral_position_sk", F.col("contract_enterprise_key").alias("enterprise_key"),
                    "position_date", "contract_sk", "security_sk", "position_value_local", "position_value_usd",
                    "currency_code", "collateral_role")


@entity("silver.transaction_fact", cluster=("transaction_date",), dated="transaction_date", sk="transaction_sk")
def transaction_fact(lake) -> DataFrame:
    if lake.makes("bronze.transaction"):
        t = newest = _versioned_trades(lake)
    else:
        t = newest = latest_wins(lake.get("bronze.transaction"), ["enterprise_key"],
                                 [F.col("transaction_date").desc(), F.col("transaction_status")])
        t = _unit(lake, _tjoin(lake, t, "silver.portfolio_dim", "portfolio_sk", "portfolio_enterprise_key", "transaction_date", "pd_",
                               ["business_unit_enterprise_key"]))
        t = _tjoin(lake, t, "silver.security_dim", "security_sk", "security_enterprise_key", "transaction_date", "sd_")
    t = _usd(lake, t, {"gross_amount_usd": "gross_amount_local", "fees_usd": "fees_local",
                       "net_amount_usd": "net_amount_local"}, "currency_code", "transaction_date")
    if "transaction_sk" not in t.columns:
        t = lake.number(t, ["enterprise_key"], "transaction_sk", of=newest)
    return t.select("transaction_sk", "enterprise_key", "transaction_date", "settlement_date", "portfolio_sk",
                    "security_sk", "business_unit_sk", "transaction_type", "transaction_status", "quantity",
                    "gross_amount_local", "gross_amount_usd", "fees_usd", "net_amount_usd", "currency_code",
                    "fx_rate_to_usd", "_source_pref")


def _versioned_trades(lake) -> DataFrame:
    """As :func:`_versioned_positions`: an order's newest row is found where the order met its lines."""
    t = latest_wins(newest_trades(lake), ["order_key"], [F.col("transaction_date").desc(), F.col("transaction_status")], hashed=False)
    t = _versioned(lake, t, lake.roles.trade_keys(), "transaction_date", "transaction_sk")
    return as_transaction(lake, t, *[c for c in t.columns if c.endswith("_sk")])


# ---------------------------------------------------------- history (cancels)
@entity("silver.contract_details_cancels_fact")
def cancels_amendment(lake) -> DataFrame:
    raw = lake.roles.contract
    c2 = raw.filter(F.expr("source_key LIKE '%\\\\_v2' ESCAPE '\\\\'")).select(
        F.regexp_replace("source_key", "_v2$", "").alias("original_source_key"),
        F.col("signing_date").alias("amendment_date"))
    c1 = raw.select(F.col("source_key").alias("__k1"), F.col("principal_local").alias("original_principal_local"),
                    F.col("currency_code").alias("original_currency_code"))
    a = c2.join(c1, c2.original_source_key == c1.__k1, "inner").drop("__k1")
    a = resolve(lake, a, "efront", "original_source_key", "original_enterprise_key")
    old = lake.get("silver.contract_dim").filter(~F.col("is_current")).select(
        F.col("enterprise_key").alias("__ek"), "contract_sk")
    a = a.join(old, a.original_enterprise_key == old.__ek, "left").drop("__ek")
    a = _usd(lake, a, {"cancelled_principal_usd": "original_principal_local"}, "original_currency_code",
             "amendment_date")
    a = dense_row_id(a, [F.col("amendment_date"), F.col("original_source_key")], "cancel_sk")
    return a.select("cancel_sk", F.col("contract_sk").alias("cancelled_contract_details_sk"), "contract_sk",
                    F.col("amendment_date").alias("cancel_event_date"),
                    F.lit(None).cast("date").alias("original_detail_date"), F.lit("AMENDMENT").alias("cancel_reason"),
                    "cancelled_principal_usd", "original_source_key")


@entity("silver.position_cancels_fact")
def cancels_remap(lake) -> DataFrame:
    p = lake.roles.position.filter(F.expr("enterprise_key LIKE 'REMAPPED\\\\_%' ESCAPE '\\\\'"))
    p = resolve(lake, p, "state_street", "portfolio_source_key", "portfolio_enterprise_key")
    p = resolve(lake, p, "aspen", "security_source_key", "security_enterprise_key")
    p = _cjoin(lake, p, "silver.portfolio_dim", "portfolio_sk", "portfolio_enterprise_key", "pd_")
    p = _tjoin(lake, p, "silver.security_dim", "security_sk", "security_enterprise_key", "position_date", "sd_")
    p = _usd(lake, p, {"cancelled_market_value_usd": "market_value_local"}, "currency_code", "position_date")
    p = dense_row_id(p, [F.col("position_date"), F.col("source_key"), F.col("market_value_local")], "cancel_sk")
    position = hash_int("cancelled_position", ["source_key"], 12, 1 << 48)
    return p.select("cancel_sk", position.alias("cancelled_position_sk"), "portfolio_sk", "security_sk",
                    F.col("position_date").alias("cancel_event_date"),
                    F.col("position_date").alias("original_position_date"),
                    F.lit("CROSSWALK_REMAP").alias("cancel_reason"), "cancelled_market_value_usd")


@entity("silver.security_price_cancels_fact")
def price_cancels(lake) -> DataFrame:
    """Structurally present, no price corrections modelled: empty typed frame."""
    schema = ("cancel_sk bigint, cancelled_security_price_sk bigint, security_sk bigint, cancel_event_date date, "
              "original_price_date date, cancel_reason string, cancelled_close_price_usd decimal(18,6)")
    return lake.spark.createDataFrame([], schema)


@entity("silver.income_bridge")
def income_bridge(lake) -> DataFrame:
    cf = lake.roles.cash_flow.filter(F.col("cash_flow_type") == "INCOME")
    cf = resolve(lake, cf, "state_street", "portfolio_source_key", "portfolio_enterprise_key")
    cf = _cjoin(lake, cf, "silver.portfolio_dim", "portfolio_sk", "portfolio_enterprise_key", "pd_", how="inner")
    cf = _usd(lake, cf, {"income_amount_usd": "amount_local"}, "currency_code", "cash_flow_date")
    cf = dense_row_id(cf, [F.col("cash_flow_date"), F.col("portfolio_source_key"), F.col("event_id")],
                      "income_bridge_sk")
    return cf.select("income_bridge_sk", "portfolio_sk", F.lit(None).cast("bigint").alias("security_sk"),
                     F.lit(None).cast("bigint").alias("contract_sk"), F.col("cash_flow_date").alias("income_date"),
                     F.lit("COUPON").alias("income_type"), F.col("amount_local").alias("income_amount_local"),
                     "income_amount_usd", "currency_code")
