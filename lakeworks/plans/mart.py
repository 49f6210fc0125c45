"""Kimball star (dims, facts, bridges, SCD2 key crosswalk) and the mart views (Q1-Q11).

Dimensions reuse the silver SCD2 chains; facts carry the dimension version
valid on the event date (anchor chain: contract -> owner -> entity version on
the day). Mart aggregates whose groups are bounded by a dimension (portfolio
x day, entity x portfolio x day) use windows; shares over raw fact rows use
the skew-safe grouped-sum join.
"""

from __future__ import annotations

import datetime as dt
from contextlib import nullcontext
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.functions.scalar import pick, safe_div
from lakeworks.operators.changes import CHANGE, COUNT, measure
from lakeworks.operators.rowid import dense_row_id
from lakeworks.operators.segments import segmented_window
from lakeworks.operators.temporal import temporal_join
from lakeworks.operators.windows import share_of_total
from lakeworks.plans.bronze import resolve
from lakeworks.plans.registry import Additive, additive, entity, live_step
from lakeworks.plans.silver import position_star
from lakeworks.session import cut_lineage

# Fixed values of the star seed
PORTFOLIO_TYPES = ["FUND", "SMA", "CO_INVEST"]
SOURCE_REGISTRY = [("STATE_STREET", "State Street custody"), ("BLOOMBERG", "Bloomberg"),
                   ("EFRONT", "eFront"), ("ENTERPRISE", "Enterprise master")]
KEY_DOMAINS = [("ENTITY", "Entity"), ("SECURITY", "Security"), ("PORTFOLIO", "Portfolio")]
REMAP_DATE = dt.date(1998, 7, 1)
BASE_DATE = dt.date(1990, 1, 1)


def _entity_of_contract(lake, df: DataFrame, contract_key: str, date_col: str) -> DataFrame:
    """Anchor chain: contract source key -> owner entity key -> entity version valid on the date (inner)."""
    out = temporal_join(df, _owner_versions(lake), contract_key, "__ck", date_col, "__ed_s", "__ed_e", how="inner")
    return out.drop("__ck", "__ed_s", "__ed_e")


def _owner_versions(lake) -> DataFrame:
    """Contracts meet the versions of their owners first, so facts are dealt by contract once."""
    owners = lake.roles.contract.filter(F.col("version_no") == 1).select(
        F.col("source_key").alias("__ck"), F.col("entity_source_key").alias("__esk"))
    owners = resolve(lake, owners, "efront", "__esk", "__eek", domain="entity").drop("__esk")
    ed = lake.get("silver.entity_dim").select(
        F.col("enterprise_key").alias("__ed_key"), "entity_sk",
        F.col("effective_start_date").alias("__ed_s"), F.col("effective_end_date").alias("__ed_e"))
    return owners.join(ed, F.col("__eek") == F.col("__ed_key"), "inner").drop("__eek", "__ed_key")


# ---------------------------------------------------------------- dimensions
@entity("mart.dim_portfolio_group")
def dim_portfolio_group(lake) -> DataFrame:
    r = lake.roles.t.region
    return r.select(F.col("r_regionkey").cast("bigint").alias("portfolio_group_sk"),
                    F.concat(F.lit("EK_PG_"), F.col("r_regionkey").cast("string")).alias("enterprise_portfolio_group_id"),
                    F.col("r_name").alias("group_name"), F.lit("REGION").alias("group_type"),
                    F.lit(True).alias("is_current"))


@entity("mart.dim_portfolio")
def dim_portfolio(lake) -> DataFrame:
    pd = lake.get("silver.portfolio_dim")
    rp = lake.roles.portfolio.select(F.col("enterprise_key").alias("__ek"), "portfolio_name", "currency_code",
                                     "bu_source_key", "supplier_key")
    j = pd.drop("portfolio_name").join(rp, pd.enterprise_key == rp.__ek, "left")
    # its size in files tells whether joins may broadcast it; that of the join below is a guess
    return cut_lineage(j).select("portfolio_sk", F.col("enterprise_key").alias("enterprise_portfolio_id"),
                    F.substring("bu_source_key", 4, 10).cast("bigint").alias("portfolio_group_sk"),
                    "portfolio_name", pick(PORTFOLIO_TYPES, "supplier_key").alias("portfolio_type"),
                    "currency_code", "is_current", "effective_start_date", "effective_end_date")


@entity("mart.dim_entity")
def dim_entity(lake) -> DataFrame:
    e = lake.get("silver.entity_dim")
    reg = lake.roles.entity.select(F.col("source_key").alias("__sk"), "region_key")
    e = e.join(reg, e.source_key == reg.__sk, "left")
    return e.select("entity_sk", F.col("enterprise_key").alias("enterprise_entity_id"), "entity_name", "entity_type",
                    "jurisdiction", F.col("region_key").alias("portfolio_group_sk"), "is_current",
                    "effective_start_date", "effective_end_date")


@entity("mart.dim_security")
def dim_security(lake) -> DataFrame:
    s = lake.get("silver.security_dim")
    return s.select("security_sk", F.col("enterprise_key").alias("enterprise_security_id"),
                    F.substring("brand", 7, 4).cast("bigint").alias("asset_sk"), "security_name", "security_type",
                    F.col("source_key").alias("cusip"), "is_current", "effective_start_date", "effective_end_date")


@entity("mart.dim_asset")
def dim_asset(lake) -> DataFrame:
    a = lake.roles.asset
    return a.select(F.col("brand_no").alias("asset_sk"), F.col("enterprise_key").alias("enterprise_asset_id"),
                    "asset_name", "asset_type", F.concat(F.lit("CITY_"), (F.col("brand_no") % 5).cast("string")).alias("city"),
                    "country_code", (F.col("brand_no") % 5).alias("managing_group_id"), F.lit(True).alias("is_current"))


# --------------------------------------------------------------------- facts
@entity("mart.fact_position", cluster=("position_date",), dated="position_date", sk="position_id")
def fact_position(lake) -> DataFrame:
    star = lake.asked_star()
    if star is not None:
        return lake.live("fact with its star", *star)
    p = lake.get("silver.position_analytics_fact", ids=lake.ids)
    p = _entity_of_contract(lake, p, "contract_source_key", "position_date")
    return p.select("position_date", "portfolio_sk", "entity_sk", "security_sk", "quantity", *_fact_columns()).select(
        "position_id", "position_date", "portfolio_sk", "entity_sk", "security_sk", "quantity", "market_value", "book_value",
        "cost_basis", "unrealized_gain_loss", "local_currency_code", "reporting_currency_code", "fx_rate", "record_source")


def _fact_columns() -> list[Column]:
    """A position's columns under the names of the fact."""
    named = {"position_sk": "position_id", "market_value_usd": "market_value", "book_value_usd": "book_value",
             "cost_basis_usd": "cost_basis", "unrealized_gl_usd": "unrealized_gain_loss", "currency_code": "local_currency_code",
             "fx_rate_to_usd": "fx_rate"}
    return [*[F.col(c).alias(a) for c, a in named.items()], F.lit("USD").alias("reporting_currency_code"),
            F.lit("state_street").alias("record_source")]


@entity("mart.fact_transaction", cluster=("transaction_date",), dated="transaction_date", sk="transaction_id")
def fact_transaction(lake) -> DataFrame:
    t = lake.get("silver.transaction_fact", ids=lake.ids).filter(F.col("transaction_status") == "SETTLED")
    t = t.withColumn("__txn_ck", F.concat(F.lit("ORD_"), F.substring("enterprise_key", 8, 20)))
    t = _entity_of_contract(lake, t, "__txn_ck", "transaction_date")
    sign = F.when(F.col("transaction_type") == "SELL", F.lit(-1)).otherwise(F.lit(1))
    gross = (F.col("gross_amount_usd") * sign).cast("decimal(18,2)")
    return t.select(F.col("transaction_sk").alias("transaction_id"), "transaction_date", "settlement_date",
                    "portfolio_sk", "entity_sk", "security_sk", "transaction_type",
                    (F.col("quantity") * sign).cast("decimal(18,4)").alias("quantity"),
                    gross.alias("gross_amount"), F.col("fees_usd").alias("fees"),
                    (gross - F.col("fees_usd")).cast("decimal(18,2)").alias("net_amount"),
                    F.concat(F.lit("CPTY_"), (F.col("transaction_sk") % 7).cast("string")).alias("counterparty"),
                    F.col("fx_rate_to_usd").alias("fx_rate"), F.lit("state_street").alias("record_source"))


# ------------------------------------------------------------------- bridges
@entity("mart.key_crosswalk")
def key_crosswalk(lake) -> DataFrame:
    """SCD2 crosswalk with ONE_TO_ONE, MANY_TO_ONE and ONE_TO_MANY mappings,
    remaps of every 25th entity from 1998-07-01, and Bloomberg security ids."""
    c = lake.roles.t.customer.select(F.col("c_custkey").cast("bigint").alias("c"))
    p = lake.roles.t.part.select(F.col("p_partkey").cast("bigint").alias("p"))
    cs = F.col("c").cast("string")

    def rows(df, domain, system, key, target, rel, split, start, end, current):
        return df.select(F.lit(domain).alias("domain_code"), F.lit(system).alias("source_system"),
                         key.alias("source_key"), F.lit("ENTERPRISE").alias("target_system"),
                         target.alias("target_key"), F.lit(rel).alias("relationship_type"),
                         (split if isinstance(split, Column) else F.lit(split)).cast("int").alias("split_sequence"),
                         F.lit(start).alias("effective_start_date"),
                         (end if end is not None else F.lit(None).cast("date")).alias("effective_end_date"),
                         current.alias("is_current"))

    remapped = (F.col("c") % 25 == 0)
    arms = [
        rows(c, "ENTITY", "STATE_STREET", F.concat(F.lit("SS_ENT_"), cs), F.concat(F.lit("EK_CUS_"), cs),
             "ONE_TO_ONE", 1, BASE_DATE, F.when(remapped, F.lit(REMAP_DATE - dt.timedelta(days=1))), ~remapped),
        rows(c.filter(remapped), "ENTITY", "STATE_STREET", F.concat(F.lit("SS_ENT_"), cs),
             F.concat(F.lit("REMAPPED_EK_CUS_"), cs), "ONE_TO_ONE", 1, REMAP_DATE, None, F.lit(True)),
        rows(c, "ENTITY", "EFRONT", F.concat(F.lit("EF_ENT_"), cs), F.concat(F.lit("EK_CUS_"), cs),
             "ONE_TO_ONE", 1, BASE_DATE, None, F.lit(True)),
        rows(c.filter(F.col("c") < 10).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3)))),
             "ENTITY", "STATE_STREET", F.concat(F.lit("SS_ENT_"), cs, F.lit("_"), F.col("k").cast("string")),
             F.concat(F.lit("EK_CUS_"), cs), "MANY_TO_ONE", F.col("k"), BASE_DATE, None, F.lit(True)),
        rows(c.filter((F.col("c") >= 10) & (F.col("c") < 30)).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(2)))),
             "ENTITY", "STATE_STREET", F.concat(F.lit("SS_GRP_"), cs),
             F.concat(F.lit("EK_CUS_"), (F.col("c") + F.col("k") - 1).cast("string")), "ONE_TO_MANY", F.col("k"),
             BASE_DATE, None, F.lit(True)),
        rows(p, "SECURITY", "BLOOMBERG", F.concat(F.lit("BBG_"), F.col("p").cast("string")),
             F.concat(F.lit("EK_PRT_"), F.col("p").cast("string")), "ONE_TO_ONE", 1, BASE_DATE, None, F.lit(True)),
        rows(c.filter(F.col("c") % 2 == 0), "ENTITY", "BLOOMBERG", F.concat(F.lit("BBG_ENT_"), cs),
             F.concat(F.lit("EK_CUS_"), cs), "ONE_TO_ONE", 1, BASE_DATE, None, F.lit(True)),
    ]
    xw = arms[0]
    for a in arms[1:]:
        xw = xw.unionByName(a)
    xw = dense_row_id(xw, ["domain_code", "source_system", "source_key", "effective_start_date", "target_key"],
                      "crosswalk_sk")
    # links between a closed mapping and the one that replaced it (same source key, next day)
    nxt = xw.select(F.col("domain_code").alias("__d"), F.col("source_system").alias("__s"),
                    F.col("source_key").alias("__k"), F.col("effective_start_date").alias("__start"),
                    F.col("crosswalk_sk").alias("succeeding_record_sk"))
    xw = xw.join(nxt, (xw.domain_code == nxt.__d) & (xw.source_system == nxt.__s) & (xw.source_key == nxt.__k)
                 & (F.date_add(xw.effective_end_date, 1) == nxt.__start), "left").drop("__d", "__s", "__k", "__start")
    prv = xw.select(F.col("domain_code").alias("__d"), F.col("source_system").alias("__s"),
                    F.col("source_key").alias("__k"), F.col("effective_end_date").alias("__end"),
                    F.col("crosswalk_sk").alias("preceding_record_sk"))
    xw = xw.join(prv, (xw.domain_code == prv.__d) & (xw.source_system == prv.__s) & (xw.source_key == prv.__k)
                 & (F.date_sub(xw.effective_start_date, 1) == prv.__end), "left").drop("__d", "__s", "__k", "__end")
    return xw


@entity("mart.investor_portfolio_group_alloc")
def investor_pg_alloc(lake) -> DataFrame:
    c = lake.roles.t.customer.select(F.col("c_custkey").cast("bigint").alias("investor_sk"))
    r = lake.roles.t.region.select(F.col("r_regionkey").cast("bigint").alias("portfolio_group_sk"))
    # (7 * investor + group) divisible by 5, solved for the group
    pairs = c.join(F.broadcast(r), F.pmod(F.col("portfolio_group_sk"), F.lit(5))
                   == F.pmod(F.col("investor_sk") * -7, F.lit(5)))
    pct = (F.lit(Decimal("0.5")) + F.lit(Decimal("0.1")) * ((F.col("investor_sk") * 3 + F.col("portfolio_group_sk")) % 245))
    return pairs.select("investor_sk", "portfolio_group_sk", pct.cast("decimal(8,5)").alias("ownership_percentage"),
                        F.lit(True).alias("is_current"))


@entity("mart.portfolio_entity_alloc")
def portfolio_entity_alloc(lake) -> DataFrame:
    f = lake.get("mart.fact_position", ids=False).select("portfolio_sk", "entity_sk").distinct()
    pct = ((F.col("portfolio_sk") + F.col("entity_sk")) % 20 + 1) * 5
    return f.select("portfolio_sk", "entity_sk", pct.cast("decimal(8,5)").alias("ownership_percentage"),
                    F.lit(True).alias("is_current"))


@entity("mart.pg_portfolio_alloc")
def pg_portfolio_alloc(lake) -> DataFrame:
    p = lake.get("mart.dim_portfolio")
    return p.select("portfolio_group_sk", "portfolio_sk", F.lit(Decimal("100")).cast("decimal(8,5)").alias("ownership_percentage"),
                    F.lit(True).alias("is_current"))


# ---------------------------------------------------------------- mart views
# what each dimension brings to a fact
STAR = {"mart.dim_portfolio": ("portfolio_sk", "portfolio_name", "portfolio_type"),
        "mart.dim_entity": ("entity_sk", "enterprise_entity_id", "entity_name", "entity_type", "jurisdiction"),
        "mart.dim_security": ("security_sk", "asset_sk", "security_name", "security_type", "cusip", "enterprise_security_id"),
        "mart.dim_asset": ("asset_sk", "asset_name", "asset_type", "asset_city", "country_code")}


def _enriched_base(lake, fact: DataFrame) -> DataFrame:
    pf, e, s, a = (_star_dim(lake, n) for n in STAR)
    return fact.join(pf, "portfolio_sk").join(e, "entity_sk").join(s, "security_sk").join(a, "asset_sk")


def _star_dim(lake, name: str) -> DataFrame:
    d = lake.get(name)
    return (d.withColumnRenamed("city", "asset_city") if name == "mart.dim_asset" else d).select(*STAR[name])


def _enriched_positions(lake, ids: bool = True, external: bool = False) -> DataFrame:
    """Positions with their dimensions and, where ``external``, the keys that other systems know
    the entity and the security by on the day."""
    b = lake.live("positions' star", ids, external)
    if b is not None:
        return b
    b = _enriched_base(lake, lake.get("mart.fact_position", ids=ids))
    for args in EXTERNAL if external else ():
        domain, system, out, key = args
        xw = _external_xw(lake, domain, system, out, "__x_t", "__x_")
        b = temporal_join(b, xw, key, "__x_t", "position_date", "__x_s", "__x_e", open_end=True).drop("__x_t", "__x_s", "__x_e")
    return b


@live_step("positions' star")
def _live_star(lake, ids: bool, external: bool) -> DataFrame | None:
    """As above, where the fact and what it is made from are made here: by the fact's builder."""
    if not all(lake.makes(n) for n in ("mart.fact_position", *STAR, "silver.position_analytics_fact", "silver.entity_dim", "bronze.position")):
        return None
    return lake.starred("mart.fact_position", ids, external)


@live_step("fact with its star")
def _star_of_fact(lake, external: bool) -> DataFrame | None:
    """Dimensions meet the versions before the positions do."""
    pf, e, s, a = (_star_dim(lake, n) for n in STAR)
    if external:
        e, s = (_with_mappings(lake, d, *args) for d, args in zip((e, s), EXTERNAL))
    b = position_star(lake, _owner_versions(lake).join(e, "entity_sk", "inner"), pf, s)
    if b is None:
        return None
    for _, _, out, _ in EXTERNAL if external else ():
        # none valid on the day: a row without a key, as a left join gives
        valid = F.filter(out, lambda x: (x["s"] <= F.col("position_date")) & (x["e"].isNull() | (x["e"] >= F.col("position_date"))))
        b = b.withColumn("__x", F.explode_outer(valid)).withColumn(out, F.col("__x.key")).drop("__x")
    return b.join(a, "asset_sk").select("*", *_fact_columns())


# domain and system of the external keys, the column they go to, and the dimension's column they are mappings of
EXTERNAL = (("ENTITY", "STATE_STREET", "state_street_entity_id", "enterprise_entity_id"),
            ("SECURITY", "BLOOMBERG", "bloomberg_security_id", "enterprise_security_id"))


def _with_mappings(lake, dim: DataFrame, domain: str, system: str, out: str, key: str) -> DataFrame:
    """A dimension with its keys' mappings, a handful each, as an array."""
    xw = _external_xw(lake, domain, system, "key", "__x_t", "").groupBy("__x_t").agg(
        F.collect_list(F.struct("s", "e", "key")).alias(out))
    return dim.join(xw, F.col(key) == F.col("__x_t"), "left").drop("__x_t")


# -- aggregates that are kept up to date from the changes of the fact ------------
MONEY_SUM = "decimal(28,2)"  # of DECIMAL(18,2) values


def _carried(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols, *[c for c in (CHANGE,) if c in df.columns])


def _aum_finish(lake, state: DataFrame) -> DataFrame:
    pf = lake.get("mart.dim_portfolio").select("portfolio_sk", "portfolio_name", "portfolio_type")
    return state.join(pf, "portfolio_sk").select(
        "position_date", "portfolio_sk", "portfolio_name", "portfolio_type", measure("market_value", MONEY_SUM).alias("aum"),
        measure("book_value", MONEY_SUM), measure("unrealized_gain_loss", MONEY_SUM).alias("unrealized_pnl"),
        F.col(COUNT).alias("position_count"))


additive("mart.aum_daily_by_portfolio", Additive(
    inputs={"mart.fact_position": (("position_date", "portfolio_sk", "market_value", "book_value", "unrealized_gain_loss"),
                                   ("position_date",))},
    rows=lambda f: f["mart.fact_position"], keys=("position_date", "portfolio_sk"),
    measures=("market_value", "book_value", "unrealized_gain_loss"), finish=_aum_finish), cluster=("position_date",), dated="position_date")


@entity("mart.position_enriched", cluster=("position_date",), dated="position_date")
def position_enriched(lake) -> DataFrame:
    b = _enriched_positions(lake)
    return b.select("position_id", "position_date", "portfolio_sk", "portfolio_name", "portfolio_type", "entity_sk",
                    "entity_name", "entity_type", "jurisdiction", "asset_sk", "asset_name", "asset_type", "asset_city",
                    F.col("country_code").alias("asset_country"), "security_sk", "security_name", "security_type",
                    "cusip", "quantity", "market_value", "book_value", "cost_basis", "unrealized_gain_loss",
                    "local_currency_code", "reporting_currency_code", "fx_rate", "record_source")


def _kpi_finish(lake, state: DataFrame) -> DataFrame:
    da = state.select("*", measure("market_value", MONEY_SUM), measure("unrealized_gain_loss", MONEY_SUM)).groupBy(
        "position_date", "portfolio_sk").agg(
        F.sum("market_value").cast(MONEY_SUM).alias("aum"), F.sum("unrealized_gain_loss").cast(MONEY_SUM).alias("unrealized_pnl"),
        F.count("entity_sk").alias("active_entity_count"), F.sum(COUNT).alias("position_count"))
    da = cut_lineage(da)                 # counted and placed below, each from the whole of it
    wd = Window.partitionBy("position_date").orderBy(F.col("aum").desc())

    def mean(rows: int):
        return lambda w: (F.sum("aum").over(w.rowsBetween(1 - rows, 0)).cast("double")
                          / F.count(F.lit(1)).over(w.rowsBetween(1 - rows, 0)).cast("double"))

    k = segmented_window(da, ["portfolio_sk"], ["position_date"], F.year("position_date"), 365, {
        "aum_7day_ma": mean(7), "aum_30day_ma": mean(30), "aum_year_ago": lambda w: F.lag("aum", 365).over(w)})
    k = k.withColumn("aum_rank_on_date", F.dense_rank().over(wd).cast("bigint"))
    pf = lake.get("mart.dim_portfolio").select("portfolio_sk", "portfolio_name", "portfolio_type")
    return k.join(pf, "portfolio_sk").select("position_date", "portfolio_sk", "portfolio_name", "portfolio_type",
                                             "aum", "unrealized_pnl", "active_entity_count", "position_count",
                                             "aum_7day_ma", "aum_30day_ma", "aum_year_ago", "aum_rank_on_date")


# a state row per entity, so that entities are counted without a distinct
additive("mart.portfolio_kpi_daily", Additive(
    inputs={"mart.fact_position": (("position_date", "portfolio_sk", "entity_sk", "market_value", "unrealized_gain_loss"),
                                   ("position_date",))},
    rows=lambda f: f["mart.fact_position"].repartition("position_date", "portfolio_sk"),     # for both sums, by entity and without
    keys=("position_date", "portfolio_sk", "entity_sk"),
    measures=("market_value", "unrealized_gain_loss"), finish=_kpi_finish), cluster=("position_date",), dated="position_date")


def _external_xw(lake, domain: str, system: str, key_alias: str, target_alias: str, prefix: str) -> DataFrame:
    xw = lake.get("mart.key_crosswalk").filter(
        (F.col("relationship_type") == "ONE_TO_ONE") & (F.col("domain_code") == domain) & (F.col("source_system") == system))
    return xw.select(F.col("target_key").alias(target_alias), F.col("source_key").alias(key_alias),
                     F.col("effective_start_date").alias(f"{prefix}s"), F.col("effective_end_date").alias(f"{prefix}e"))


@entity("mart.position_with_external_keys", cluster=("position_date",), dated="position_date", sk="position_id")
def position_external_keys(lake) -> DataFrame:
    j = _enriched_positions(lake, ids=lake.ids, external=True)
    return j.select("position_id", "position_date", "portfolio_name", "entity_name", "security_name", "asset_name",
                    "country_code", "quantity", "market_value", "state_street_entity_id", "bloomberg_security_id")


def _book_rows(f: dict[str, DataFrame]) -> DataFrame:
    star = (f["mart.fact_position"].join(f["mart.dim_portfolio"], "portfolio_sk").join(f["mart.dim_entity"], "entity_sk")
            .join(f["mart.dim_security"], "security_sk").join(f["mart.dim_asset"], "asset_sk"))
    return _carried(star, *BOOK_KEYS, "market_value")


BOOK_KEYS = ("position_date", "portfolio_name", "portfolio_type", "enterprise_entity_id", "country_code")


def _book_finish(lake, state: DataFrame) -> DataFrame:
    by_entity = state.select(*BOOK_KEYS, measure("market_value", MONEY_SUM).alias("entity_mv"))
    # in two stages: each of 32 parts of a portfolio-day (an entity's rows are in one part) sums up
    # its rows and gives its own 3 greatest and its countries; then the parts are put together
    day, key = ["position_date", "portfolio_name"], ["position_date", "portfolio_name", "portfolio_type"]
    rank = F.struct(F.col("entity_mv").isNull().alias("none"), (-F.col("entity_mv")).alias("less"), "enterprise_entity_id",
                    "country_code", "portfolio_type")
    dealt = by_entity.withColumn("__part", F.pmod(F.xxhash64("enterprise_entity_id"), F.lit(32))).repartition(*day, "__part")
    first = F.row_number().over(Window.partitionBy(*day, "__part").orderBy(rank))
    entities = dealt.withColumn("__top", F.when(first <= 3, rank)).groupBy(*key, "__part", "enterprise_entity_id").agg(
        F.sum("entity_mv").alias("mv"), F.collect_set("country_code").alias("countries"), F.collect_list("__top").alias("tops"))
    parts = entities.groupBy(*key, "__part").agg(
        F.sum("mv").alias("mv"), F.count("enterprise_entity_id").alias("n"),
        F.array_distinct(F.flatten(F.collect_list("countries"))).alias("countries"), F.flatten(F.collect_list("tops")).alias("tops"))
    whole = parts.repartition(*day).groupBy(*key).agg(
        F.sum("mv").cast("decimal(38,2)").alias("aum"), F.sum("n").alias("entity_count"),
        F.size(F.array_distinct(F.flatten(F.collect_list("countries")))).cast("bigint").alias("country_count"),
        F.flatten(F.collect_list("tops")).alias("tops"))
    # a row for each type of a portfolio's day, with at most 3 entities from each part
    top3 = F.slice(F.sort_array(F.flatten(F.collect_list("tops").over(Window.partitionBy(*day)))), 1, 3)
    own = F.filter("__top3", lambda x: x["portfolio_type"].eqNullSafe(F.col("portfolio_type")) & ~x["none"])
    book = whole.withColumn("__top3", top3).withColumn("__top3", F.aggregate(
        own, F.lit(0).cast("decimal(38,2)"), lambda total, x: (total - x["less"]).cast("decimal(38,2)")))
    wd = Window.partitionBy("position_date").orderBy(F.col("aum").desc())
    return book.select("position_date", "portfolio_name", "portfolio_type", "aum",
                       safe_div("__top3", "aum").alias("top_3_concentration_pct"),
                       "entity_count", "country_count",
                       F.dense_rank().over(wd).cast("bigint").alias("aum_rank_on_date"))


# what the portfolio and security books read of the positions and their dimensions
BOOKED = ("position_date", "portfolio_name", "portfolio_type", "enterprise_entity_id", "entity_name", "asset_name", "country_code",
          "security_name", "security_type", "market_value", "unrealized_gain_loss")


@live_step("books' positions")
def _booked(lake) -> DataFrame | None:
    """The positions of the books, where they are made here."""
    if "#booked" in lake._given:
        return lake._given["#booked"]
    b = lake.live("positions' star", False, False)
    return None if b is None else b.select(*BOOKED)


def _booked_by_entity(lake) -> DataFrame | None:
    """Those of the portfolio book, written: the shuffles before and after don't lie on the disk together."""
    b = _booked(lake)
    return b if b is None or "#booked" in lake._given else cut_lineage(b.select(*BOOK_KEYS, "market_value"))


def settled_books(lake):
    """For a report of both books: what they read is written once (:meth:`Lake.reading`)."""
    b = _booked(lake)
    return nullcontext(lake) if b is None else lake.reading({"#booked": cut_lineage(b)})


# the star joins lie under the aggregate: a change of a dimension passes through them too
additive("mart.portfolio_book", Additive(
    inputs={"mart.fact_position": (("position_date", "portfolio_sk", "entity_sk", "security_sk", "market_value"), ("position_date",)),
            "mart.dim_portfolio": (("portfolio_sk", "portfolio_name", "portfolio_type"), ()),
            "mart.dim_entity": (("entity_sk", "enterprise_entity_id"), ()),
            "mart.dim_security": (("security_sk", "asset_sk"), ()),
            "mart.dim_asset": (("asset_sk", "country_code"), ())},
    rows=_book_rows, keys=BOOK_KEYS, measures=("market_value",), finish=_book_finish, live=_booked_by_entity))


@entity("mart.security_book")
def security_book(lake) -> DataFrame:
    b = lake.live("books' positions")
    b = _enriched_base(lake, lake.get("mart.fact_position", ids=False)) if b is None else b
    ps = b.groupBy("position_date", "portfolio_name", "portfolio_type", "entity_name", "asset_name", "country_code",
                   "security_name", "security_type").agg(
        F.sum("market_value").alias("market_value"), F.sum("unrealized_gain_loss").alias("unrealized_pnl"))
    ps = cut_lineage(ps)                 # read twice below
    return share_of_total(ps, ["position_date", "portfolio_name"], "market_value", "pct_of_portfolio_aum")


@entity("mart.transaction_book")
def transaction_book(lake) -> DataFrame:
    t = lake.get("mart.fact_transaction", ids=False)
    pf = lake.get("mart.dim_portfolio").select("portfolio_sk", "portfolio_name", "portfolio_type")
    j = t.join(pf, "portfolio_sk")

    def cnt(kind):
        return F.sum(F.when(F.col("transaction_type") == kind, 1).otherwise(0)).cast("bigint")

    book = j.groupBy("portfolio_name", "portfolio_type", "transaction_date").agg(
        F.sum("gross_amount").alias("net_gross_flow"), F.sum(F.abs("gross_amount")).alias("turnover_gross"),
        F.sum("net_amount").alias("net_cash_flow"), F.sum("fees").alias("total_fees"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.countDistinct("security_sk").alias("distinct_securities_traded"),
        cnt("BUY").alias("buy_count"), cnt("SELL").alias("sell_count"),
        cnt("ACQUISITION").alias("acquisition_count"), cnt("DISPOSAL").alias("disposal_count"))
    wd = Window.partitionBy("transaction_date").orderBy(F.col("turnover_gross").desc())
    return book.withColumn("turnover_rank_on_date", F.dense_rank().over(wd).cast("bigint"))


@entity("mart.transaction_detail")
def transaction_detail(lake) -> DataFrame:
    b = _enriched_base(lake, lake.get("mart.fact_transaction")).withColumn("__abs", F.abs("gross_amount"))
    b = share_of_total(b, ["portfolio_name", "transaction_date"], "__abs", "pct_of_daily_turnover")
    return b.select("transaction_id", "transaction_date", "settlement_date", "portfolio_name", "portfolio_type",
                    "entity_name", "asset_name", "country_code", "security_name", "security_type", "transaction_type",
                    "quantity", "gross_amount", "fees", "net_amount", "counterparty", "record_source",
                    "pct_of_daily_turnover")
