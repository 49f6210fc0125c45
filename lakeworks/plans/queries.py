"""Registered report queries: key -> builder(lake) -> DataFrame.

report frame; ``run_query`` applies the shared output shaping.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.operators.temporal import valid_at
from lakeworks.plans.mart import settled_books
from lakeworks.plans.output import finalize
from lakeworks.session import cut_lineage, passing_cuts

QUERIES: dict[str, Callable] = {}


def query(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


def entity_query(key: str, name: str, drop=()):
    QUERIES[key] = lambda lake: lake.get(name).drop(*drop)


# --- bronze ------------------------------------------------------------------
for _e in ["security", "entity", "asset", "portfolio", "contract", "business_unit", "position", "transaction",
           "security_price", "portfolio_risk", "portfolio_performance", "rating", "collateral", "fx_rate"]:
    entity_query(f"bronze_{_e}", f"bronze.{_e}")
entity_query("lineage_audit", "bronze.lineage_audit")
entity_query("conflict_detection", "bronze.conflicts")
entity_query("crosswalk_build", "bronze.crosswalk")


@query("resolve_current")
def resolve_current(lake) -> DataFrame:
    """Every distinct (system, key) the positions reference, resolved to
    its current enterprise key (NULL when unmapped)."""
    from lakeworks.operators.keys import resolve_keys
    r = lake.roles
    keys = (r.position.select(F.lit("state_street").alias("source_system"), F.col("portfolio_source_key").alias("source_key"))
            .unionByName(r.position.select(F.lit("state_street").alias("source_system"), F.col("security_source_key").alias("source_key")))
            .unionByName(r.contract.select(F.lit("efront").alias("source_system"), F.col("entity_source_key").alias("source_key")))
            .unionByName(r.cash_flow.select(F.lit("aladdin").alias("source_system"), F.col("portfolio_source_key").alias("source_key")))
            .distinct())
    return resolve_keys(keys, lake.get("bronze.crosswalk_active"), F.col("source_system"), "source_key", "enterprise_key")


@query("resolve_source_keys")
def resolve_source_keys(lake) -> DataFrame:
    """Enterprise key -> its source keys in pages, flattened for comparison."""
    from lakeworks.operators.keys import source_keys_of
    s = source_keys_of(lake.get("bronze.crosswalk"))
    return s.select("enterprise_key", "page", F.size("source_keys").cast("bigint").alias("n_source_keys"),
                    F.concat_ws(",", F.transform("source_keys", lambda x: F.concat_ws(":", x["source_system"], x["source_key"])))
                    .alias("source_keys"))


@query("crosswalk_merge")
def crosswalk_merge(lake) -> DataFrame:
    """Merge-insert of the full build into a crosswalk seeded with the
    master-data arms only; re-running inserts nothing (idempotent)."""
    from lakeworks.operators.keys import merge_insert
    xw = lake.get("bronze.crosswalk_current").select("source_system", "source_key", "enterprise_key")
    seed = xw.filter(F.col("source_system").isin("aspen", "internal_admin"))
    once = merge_insert(xw, seed, ["source_system", "source_key"])
    twice = merge_insert(xw, once, ["source_system", "source_key"])
    return twice.groupBy("source_system").agg(F.count(F.lit(1)).alias("mapping_count"))


# --- silver ------------------------------------------------------------------
for _k, _n in {
    "security_dim": "security_dim", "rating_dim": "rating_dim", "contract_dim": "contract_dim",
    "portfolio_dim": "portfolio_dim", "entity_dim": "entity_dim", "industry_dim": "industry_dim",
    "reporting_group_dim": "reporting_group_dim", "business_unit_dim": "business_unit_dim",
    "fx_rates": "fx_rate_dim", "silver_position": "position_analytics_fact",
    "position_monthend": "position_monthend_fact", "security_master": "security_master_fact",
    "silver_security_price": "security_price_fact", "contract_details": "contract_details_fact",
    "silver_contract_summary": "contract_summary_fact", "portfolio_analytics": "portfolio_analytics_fact",
    "analytics_monthend": "portfolio_analytics_monthend_fact", "collateral_exposure": "collateral_exposure_fact",
    "collateral_positions": "collateral_positions_fact", "silver_transaction": "transaction_fact",
    "cancels_amendment": "contract_details_cancels_fact", "cancels_remap": "position_cancels_fact",
    "price_cancels": "security_price_cancels_fact", "income_bridge": "income_bridge",
}.items():
    entity_query(_k, f"silver.{_n}")


@query("covenant_breach")
def covenant_breach(lake) -> DataFrame:
    """A5: boolean-any per contract and covenant day."""
    cov = lake.roles.covenant
    return cov.groupBy("contract_source_key", "covenant_date").agg(
        (F.max(F.when(F.col("covenant_status") == "TRIPPED", 1).otherwise(0)) > 0).alias("has_active_breach"),
        F.count(F.lit(1)).alias("covenant_rows"))


@query("surrogate_keys")
def surrogate_keys(lake) -> DataFrame:
    """Global row ids over the deduplicated positions without a
    single-partition window."""
    from lakeworks.operators.rowid import dense_row_id
    p = lake.get("bronze.position").select("enterprise_key", "position_date")
    return dense_row_id(p, [F.col("position_date"), F.col("enterprise_key")], "row_id")


# --- gold --------------------------------------------------------------------
for _k, _n in {
    "team_position": "position_analytics_fact", "team_contract_details": "contract_details_fact",
    "team_contract_summary": "contract_summary_fact", "team_portfolio_analytics": "portfolio_analytics_fact",
    "team_security_dim": "security_dim", "team_security_master": "security_master_fact",
    "team_security_price": "security_price_fact", "team_rating": "security_rating_dim",
    "team_collateral_exposure": "collateral_exposure_fact", "team_collateral_positions": "collateral_positions_fact",
    "consolidated_positions": "consolidated_position_book", "consolidated_contracts": "consolidated_contract_book",
    "consolidated_transactions": "consolidated_transaction_book",
}.items():
    entity_query(_k, f"gold.{_n}")


# --- star mart views ------------------------------------------------------------
for _k, _n in {
    "aum_daily": "aum_daily_by_portfolio", "position_enriched": "position_enriched", "portfolio_kpi": "portfolio_kpi_daily",
    "position_external_keys": "position_with_external_keys", "portfolio_book": "portfolio_book",
    "security_book": "security_book", "transaction_book": "transaction_book", "transaction_detail": "transaction_detail",
}.items():
    entity_query(_k, f"mart.{_n}")


@query("current_entity")
def current_entity(lake) -> DataFrame:
    """Q1: current entities with their group, the portfolio that owns most of them,
    and external ids pivoted to columns (A11)."""
    e = lake.get("mart.dim_entity").filter(F.col("is_current"))
    g = lake.get("mart.dim_portfolio_group").select("portfolio_group_sk", "group_name")
    xw = lake.get("mart.key_crosswalk").filter(
        F.col("is_current") & (F.col("domain_code") == "ENTITY") & (F.col("relationship_type") == "ONE_TO_ONE"))
    ids = xw.groupBy(F.col("target_key").alias("enterprise_entity_id")).agg(
        F.max(F.when(F.col("source_system") == "STATE_STREET", F.col("source_key"))).alias("state_street_id"),
        F.max(F.when(F.col("source_system") == "BLOOMBERG", F.col("source_key"))).alias("bloomberg_id"),
        F.max(F.when(F.col("source_system") == "EFRONT", F.col("source_key"))).alias("efront_id"))
    # of several owners the one with the greatest share, then the smallest key
    owner = lake.get("mart.portfolio_entity_alloc").groupBy("entity_sk").agg(
        F.max_by("portfolio_sk", F.struct("ownership_percentage", -F.col("portfolio_sk"))).alias("portfolio_sk"))
    p = lake.get("mart.dim_portfolio").filter(F.col("is_current")).select("portfolio_sk", "enterprise_portfolio_id", "portfolio_name")
    return (e.join(F.broadcast(g), "portfolio_group_sk", "left").join(ids, "enterprise_entity_id", "left")
            .join(owner, "entity_sk", "left").join(p, "portfolio_sk", "left").select(
        "entity_sk", "enterprise_entity_id", "entity_name", "entity_type", "jurisdiction", "group_name",
        "enterprise_portfolio_id", "portfolio_name", "state_street_id", "bloomberg_id", "efront_id"))


@query("portfolio_hierarchy")
def portfolio_hierarchy(lake) -> DataFrame:
    p = lake.get("mart.dim_portfolio").filter(F.col("is_current"))
    g = lake.get("mart.dim_portfolio_group").filter(F.col("is_current"))
    return p.join(F.broadcast(g), "portfolio_group_sk", "left").select(
        "portfolio_sk", "enterprise_portfolio_id", "portfolio_name", "portfolio_type", "portfolio_group_sk",
        "group_name", "group_type")


@query("security_with_asset")
def security_with_asset(lake) -> DataFrame:
    s = lake.get("mart.dim_security").filter(F.col("is_current"))
    a = lake.get("mart.dim_asset").select("asset_sk", "asset_name", "asset_type", "country_code", "managing_group_id")
    t = lake.roles.team.select(F.col("region_key").alias("managing_group_id"), F.col("bu_code").alias("team_code"))
    return s.join(a, "asset_sk", "left").join(F.broadcast(t), "managing_group_id", "left").select(
        "security_sk", "enterprise_security_id", "security_name", "security_type", "asset_sk", "asset_name",
        "asset_type", "country_code", "team_code")


# --- headline / demo queries (X1-X21) --------------------------------------------
def _between(lake, name, lo, hi):
    return lake.between(name, dt.date.fromisoformat(lo), dt.date.fromisoformat(hi))


@query("demo_aum_window")
def demo_aum_window(lake) -> DataFrame:
    a = _between(lake, "mart.aum_daily_by_portfolio", "2000-01-01", "2000-12-31")
    return a.orderBy(F.col("position_date").desc(), F.col("aum").desc(), F.col("portfolio_sk")).limit(100) \
        .select("position_date", "portfolio_name", "portfolio_type", "aum", "position_count")


@query("demo_position_window")
def demo_position_window(lake) -> DataFrame:
    e = _between(lake, "mart.position_enriched", "2000-10-01", "2000-12-31").filter(F.col("portfolio_type") == "FUND")
    return e.select("position_id", "position_date", "portfolio_name", "entity_name", "asset_name", "asset_city",
                    "security_name", "security_type", "market_value", "unrealized_gain_loss")


@query("demo_point_lookup")
def demo_point_lookup(lake) -> DataFrame:
    first = lake.get("mart.dim_security").filter(F.col("is_current")).agg(F.min("security_sk").alias("security_sk"))
    p = _between(lake, "mart.fact_position", "2000-06-01", "2000-06-30")
    return p.join(F.broadcast(first), "security_sk", "inner").select(
        "position_id", "position_date", "security_sk", "market_value", "quantity")


@query("kpi_top_yoy")
def kpi_top_yoy(lake) -> DataFrame:
    k = lake.latest("mart.portfolio_kpi_daily")
    ago = F.col("aum_year_ago")
    yoy = F.when(ago.isNull() | (ago == 0), F.lit(None).cast("double")).otherwise(
        (F.col("aum") - ago).cast("double") / ago.cast("double") * 100)
    return k.orderBy(F.col("aum").desc(), F.col("portfolio_name")).limit(20).select(
        "portfolio_name", "portfolio_type", "aum", "aum_year_ago", yoy.alias("yoy_pct_change"), "aum_7day_ma",
        "aum_30day_ma", "aum_rank_on_date")


@query("kpi_timeline")
def kpi_timeline(lake, portfolio_sk: int = 1) -> DataFrame:
    return lake.get("mart.portfolio_kpi_daily").filter(F.col("portfolio_sk") == portfolio_sk).select(
        "position_date", "aum", "aum_7day_ma", "aum_30day_ma", "aum_year_ago", "aum_rank_on_date",
        "active_entity_count")


@query("recon_month")
def recon_month(lake) -> DataFrame:
    return _between(lake, "mart.position_with_external_keys", "2000-01-01", "2000-01-31").select(
        "position_id", "position_date", "portfolio_name", "entity_name", "security_name", "state_street_entity_id",
        "bloomberg_security_id", "market_value")


@query("external_by_country")
def external_by_country(lake) -> DataFrame:
    x = lake.get("mart.position_with_external_keys", ids=False)
    return x.groupBy("country_code").agg(
        F.countDistinct("state_street_entity_id").alias("distinct_ss_entities"),
        F.countDistinct("bloomberg_security_id").alias("distinct_bbg_securities"),
        F.sum("market_value").alias("total_market_value"), F.count(F.lit(1)).alias("row_count"))


@query("book_x_security")
def book_x_security(lake) -> DataFrame:
    with settled_books(lake):
        pb, sb = lake.get("mart.portfolio_book"), lake.get("mart.security_book")
    sb = sb.select("portfolio_name", "position_date", "security_name", "entity_name", "asset_name", "market_value",
                   "pct_of_portfolio_aum")
    return pb.join(sb, ["portfolio_name", "position_date"]).select(
        "portfolio_name", "position_date", "aum", "aum_rank_on_date", "top_3_concentration_pct", "entity_count",
        "security_name", "entity_name", "asset_name", "market_value", "pct_of_portfolio_aum")


@query("peak_concentration")
def peak_concentration(lake) -> DataFrame:
    from pyspark.sql import Window
    with settled_books(lake):
        pb, sb = lake.get("mart.portfolio_book"), lake.get("mart.security_book")
    pb = pb.withColumn("yr", F.year("position_date").cast("bigint"))
    w = Window.partitionBy("portfolio_name", "yr").orderBy(F.col("top_3_concentration_pct").desc(), "position_date")
    r = pb.withColumn("rank_in_year", F.row_number().over(w).cast("bigint"))
    sb = sb.select("portfolio_name", "position_date", "security_name", "entity_name", "country_code", "market_value",
                   "pct_of_portfolio_aum")
    return r.join(sb, ["portfolio_name", "position_date"]).select(
        "portfolio_name", "yr", F.col("position_date").alias("peak_date"),
        F.col("top_3_concentration_pct").alias("peak_concentration"), F.col("aum").alias("aum_on_peak_date"),
        "entity_count", "rank_in_year", "security_name", "entity_name", "country_code", "market_value",
        "pct_of_portfolio_aum")


@query("turnover_ratio")
def turnover_ratio(lake) -> DataFrame:
    tb = lake.get("mart.transaction_book")
    pb = lake.get("mart.portfolio_book").select(
        "portfolio_name", F.col("position_date").alias("transaction_date"), "aum", "aum_rank_on_date",
        "top_3_concentration_pct", "entity_count")
    j = tb.join(pb, ["portfolio_name", "transaction_date"])
    return j.select("portfolio_name", "portfolio_type", "transaction_date", "transaction_count",
                    "distinct_securities_traded", "turnover_gross", "net_gross_flow", "total_fees", "buy_count",
                    "sell_count", "turnover_rank_on_date", "aum", "aum_rank_on_date", "top_3_concentration_pct",
                    "entity_count", safe_div_col("turnover_gross", "aum").alias("turnover_ratio"))


@query("txn_three_way")
def txn_three_way(lake) -> DataFrame:
    td = lake.get("mart.transaction_detail")
    sb = lake.get("mart.security_book").select(
        "portfolio_name", "security_name", F.col("position_date").alias("transaction_date"),
        F.col("market_value").alias("position_market_value"), "pct_of_portfolio_aum")
    tb = lake.get("mart.transaction_book").select(
        "portfolio_name", "transaction_date", F.col("turnover_gross").alias("portfolio_day_turnover"),
        F.col("transaction_count").alias("portfolio_day_txn_count"), "turnover_rank_on_date")
    j = td.join(sb, ["portfolio_name", "security_name", "transaction_date"]).join(tb, ["portfolio_name", "transaction_date"])
    return j.select("transaction_id", "transaction_date", "portfolio_name", "security_name", "entity_name",
                    "country_code", "transaction_type", F.col("quantity").alias("txn_quantity"),
                    F.col("gross_amount").alias("txn_gross"), "counterparty", "pct_of_daily_turnover",
                    "position_market_value", "pct_of_portfolio_aum", "portfolio_day_turnover",
                    "portfolio_day_txn_count", "turnover_rank_on_date",
                    safe_div_col(F.abs("gross_amount"), "portfolio_day_turnover").alias("txn_share_of_portfolio_day"))


@query("allocation_summary")
def allocation_summary(lake) -> DataFrame:
    g = lake.get("mart.dim_portfolio_group").filter(F.col("is_current"))
    a = lake.get("mart.investor_portfolio_group_alloc").filter(F.col("is_current"))
    j = g.join(a, "portfolio_group_sk", "left")
    return j.groupBy("group_name").agg(F.countDistinct("investor_sk").alias("investors_in_group"),
                                       F.round(F.sum("ownership_percentage"), 2).alias("total_pct_committed"))


@query("ownership_distribution")
def ownership_distribution(lake) -> DataFrame:
    """X12, second half: entities per ownership percentage."""
    a = lake.get("mart.portfolio_entity_alloc").filter(F.col("is_current"))
    return a.groupBy(F.col("ownership_percentage").cast("double").alias("ownership_percentage")).agg(
        F.count(F.lit(1)).alias("entity_count"))


@query("dimension_counts")
def dimension_counts(lake) -> DataFrame:
    def c(name, df):
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("entity_type"), "row_count")
    cur = F.col("is_current")
    parts = [
        c("investors", lake.roles.t.customer),
        c("portfolio_groups", lake.get("mart.dim_portfolio_group").filter(cur)),
        c("portfolios", lake.get("mart.dim_portfolio").filter(cur)),
        c("entities", lake.get("mart.dim_entity").filter(cur)),
        c("assets", lake.get("mart.dim_asset").filter(cur)),
        c("securities", lake.get("mart.dim_security").filter(cur)),
        c("crosswalk_mappings", lake.get("mart.key_crosswalk").filter(cur)),
        c("positions", lake.get("mart.fact_position", ids=False)),
        c("investor_pg_alloc", lake.get("mart.investor_portfolio_group_alloc")),
        c("pg_portfolio_alloc", lake.get("mart.pg_portfolio_alloc")),
        c("portfolio_entity_alloc", lake.get("mart.portfolio_entity_alloc")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("position_summary")
def position_summary(lake) -> DataFrame:
    p = lake.get("mart.fact_position", ids=False)
    return p.agg(F.min("position_date").alias("earliest_date"), F.max("position_date").alias("latest_date"),
                 F.countDistinct("position_date").alias("distinct_dates"), F.count(F.lit(1)).alias("total_rows"),
                 F.round(F.sum("market_value"), 2).alias("total_market_value"),
                 (F.sum("market_value").cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_market_value"))


@query("adhoc_top_positions")
def adhoc_top_positions(lake) -> DataFrame:
    b = lake.get("gold.consolidated_position_book", ids=False)
    return b.orderBy(F.col("market_value_usd").desc(), F.col("enterprise_key"), F.col("team_code")).limit(10).select(
        "team_code", "enterprise_key", "security_sk", "position_date", "market_value_usd", "concentration_pct",
        "portfolio_rank")


@query("adhoc_team_aum")
def adhoc_team_aum(lake) -> DataFrame:
    b = lake.latest("gold.consolidated_position_book", ids=False)
    return b.groupBy("team_code").agg(
        F.countDistinct("enterprise_key").alias("unique_positions"), F.sum("market_value_usd").alias("total_aum_usd"),
        F.round(F.avg("concentration_pct"), 9).alias("avg_concentration_pct"),
        F.max("portfolio_rank").alias("deepest_rank"))


@query("adhoc_contract_concentration")
def adhoc_contract_concentration(lake) -> DataFrame:
    b = lake.latest("gold.consolidated_contract_book", ids=False)
    return b.orderBy(F.col("outstanding_principal_usd").desc(), F.col("team_code"), F.col("enterprise_key")).limit(20) \
        .select("team_code", "contract_sk", "summary_date", "outstanding_principal_usd", "accrued_interest_usd",
                "performance_status", "has_active_breach")


@query("txn_by_quarter")
def txn_by_quarter(lake) -> DataFrame:
    t = lake.get("gold.consolidated_transaction_book", ids=False)
    return t.groupBy("team_code", F.date_trunc("quarter", F.col("transaction_date")).cast("date").alias("quarter")).agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("gross_amount_usd").alias("gross_volume_usd"),
        F.sum("fees_usd").alias("total_fees_usd"))


@query("scd2_version_counts")
def scd2_version_counts(lake) -> DataFrame:
    out = None
    for name in ("contract_dim", "security_dim", "entity_dim"):
        d = lake.get(f"silver.{name}").agg(
            F.count(F.lit(1)).alias("total_versions"), F.countDistinct("enterprise_key").alias("unique_keys"))
        d = d.select(F.lit(name).alias("dimension"), "total_versions", "unique_keys",
                     (F.col("total_versions") - F.col("unique_keys")).alias("amendments"))
        out = d if out is None else out.unionByName(d)
    return out


@query("provenance_share")
def provenance_share(lake) -> DataFrame:
    from pyspark.sql import Window
    s = lake.get("bronze.security").groupBy("_source_pref").agg(F.count(F.lit(1)).alias("rows_won_by_source"))
    tot = F.sum("rows_won_by_source").over(Window.partitionBy())
    return s.withColumn("pct_of_total", F.col("rows_won_by_source").cast("double") / tot.cast("double"))


@query("fx_latest")
def fx_latest(lake) -> DataFrame:
    fx = lake.get("silver.fx_rate_dim")
    last = fx.agg(F.max("rate_date").alias("rate_date"))
    return fx.join(F.broadcast(last), "rate_date", "inner").select("from_currency", "to_currency", "rate_date", "fx_rate")


# --- key mapping, SCD2 maintenance, deltas, anchors, JSON -----------------------
def _maint(name):
    def run(lake):
        from lakeworks.plans import maintenance
        return getattr(maintenance, name)(lake)
    return run


for _k in ["mapping_add", "mapping_supersede", "resolve_as_of", "resolve_all_targets", "resolve_all_sources",
           "scd2_close_chain", "scd2_apply", "scd2_soft_delete", "hash_delta", "watermark_delta", "anchor_chain",
           "json_techniques"]:
    QUERIES[_k] = _maint(f"{_k}_report")


# --- gates, parity, incremental, streaming, synthetic ----------------------------
def _gate(name):
    def run(lake):
        from lakeworks.plans import gates
        return getattr(gates, name)(lake)
    return run


for _k in ["gate_fk_orphans", "gate_duplicates", "gate_team_nonempty", "gate_consolidated_sum", "gate_scd2_current",
           "gate_scd2_overlap", "gate_scd2_dates", "gate_scd2_links", "gate_nonempty", "gate_conflict_density", "gate_missing_fx",
           "triplet_coverage", "gate_parity", "gate_set_difference", "parity_pivot"]:
    QUERIES[_k] = _gate(_k)


@query("incremental_aum")
def incremental_aum(lake) -> DataFrame:
    from lakeworks.plans.incremental import incremental_aum as build
    return build(lake)


@query("predicate_delete")
def predicate_delete(lake) -> DataFrame:
    """Delete the sells of 1998 from a stored fact and put the fees of 1999 to
    0, rewriting only files that hold such rows; rows and sums by year after it."""
    from lakeworks.plans.store import SnapshotStore
    store = SnapshotStore(lake.spark)
    fact = lake.get("mart.fact_transaction").withColumn("year", F.year("transaction_date"))
    store.write("t", fact.repartitionByRange(F.col("year")))
    store.delete_where("t", (F.col("year") == 1998) & (F.col("transaction_type") == "SELL"))
    store.update_where("t", F.col("year") == 1999, {"fees": F.lit(0)})
    return store.read("t").groupBy("year").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("gross_amount").alias("gross_amount"), F.sum("fees").alias("fees"))


@query("clone_shape")
def clone_shape(lake) -> DataFrame:
    """An empty table of another one's shape, and what both hold then."""
    from lakeworks.plans.store import SnapshotStore
    store = SnapshotStore(lake.spark)
    store.write("t", lake.get("bronze.asset"))
    store.clone_shape("t", "t_like")
    out = []
    for name in ("t", "t_like"):
        df = store.read(name)
        out.append(df.agg(F.count(F.lit(1)).alias("rows"), F.count("asset_name").alias("named"), F.max("vintage_year").alias("newest"))
                   .select(F.lit(name).alias("table_name"), "rows", "named", "newest"))
    return out[0].unionByName(out[1])


@query("incremental_refresh")
def incremental_refresh(lake) -> DataFrame:
    """Daily AUM refreshed from the changes between two stored versions of the
    fact (R10m): the earlier one ends in mid-2001 and holds other values for some
    portfolios. Returns the refreshed rows and how the log says they were made."""
    from lakeworks.plans.registry import Lake, Placement
    from lakeworks.plans.store import SnapshotStore
    # the aggregate reads no position number; both versions are made from one set of rows
    name, rows, portfolios = "mart.aum_daily_by_portfolio", lake.get("mart.fact_position", ids=False), lake.get("mart.dim_portfolio")
    own = Lake(lake.spark, lake.sf_dir, lake.cfg, Placement(mart=True), SnapshotStore(lake.spark))
    value = F.when(F.col("portfolio_sk") % 5 == 0, F.col("market_value") + 1).otherwise(F.col("market_value"))
    with passing_cuts(lake.spark):       # the rows are kept until both versions are written
        fact = cut_lineage(rows)
        earlier = fact.filter(F.col("position_date") < F.lit(dt.date(2001, 6, 1)))
        own.store.write("mart.fact_position", earlier.withColumn("market_value", value.cast(fact.schema["market_value"].dataType)))
        own.store.write("mart.dim_portfolio", portfolios)
        own.refresh(name)
        own.store.write("mart.fact_position", fact)
    version = own.refresh(name)
    log = own.store.refresh_log().filter(F.col("version") == version).select("strategy")
    return own.store.read(name, version).join(F.broadcast(log))  # one line


VALID_ON = dt.date(1998, 7, 1)
# the key of each versioned dimension
VERSIONED = {"security_dim": "enterprise_key", "contract_dim": "enterprise_key", "portfolio_dim": "enterprise_key",
             "entity_dim": "enterprise_key", "business_unit_dim": "enterprise_key", "industry_dim": "enterprise_key",
             "reporting_group_dim": "enterprise_key", "rating_dim": "rated_enterprise_key"}


@query("valid_at")
def valid_at_dims(lake) -> DataFrame:
    """The time slice of all eight versioned dimensions on one day: which version of
    each key was valid then."""
    out = None
    for name, key in VERSIONED.items():
        d = lake.get(f"silver.{name}").select(F.col(key).alias("key"), "effective_start_date", "effective_end_date")
        d = valid_at(d, ["key"], VALID_ON).select(F.lit(name).alias("dimension"), "key", "effective_start_date")
        out = d if out is None else out.unionByName(d)
    return out


@query("streaming_refresh")
def streaming_refresh(lake) -> DataFrame:
    """Structured Streaming over the events parquet, folded into keyed state per micro-batch."""
    from lakeworks.sources.tables import table_path
    from lakeworks.streaming.refresh import streaming_refresh as run
    path = table_path(lake.sf_dir, "events")
    schema = lake.spark.read.parquet(path).schema
    state = run(lake.spark, path, schema)
    return state.select("portfolio_source_key", "cash_flow_date", "cash_flow_type",
                        F.col("sum_amount_local").alias("amount_local"), F.col("row_count").alias("flow_count"))


@query("hash_attributes")
def hash_attributes(lake) -> DataFrame:
    from lakeworks.functions.synthetic import hash_attributes as build
    return build(lake.roles.t.part, "p_partkey")


def safe_div_col(num, den):
    n = F.col(num) if isinstance(num, str) else num
    d = (F.col(den) if isinstance(den, str) else den).cast("double")
    return n.cast("double") / F.when(d != 0, d)


def run_query(lake, key: str) -> DataFrame:
    return finalize(QUERIES[key](lake))
