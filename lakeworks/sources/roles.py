"""Raw landing frames of the investment lake, derived from the driver tables.

Each property is one raw source table of the reference's domain (positions,
prices, contracts, ratings, ...) expressed as a lazy DataFrame over the driver
parquet. The exact definitions are shared with the SQL oracles
(``oracle/prelude.py``); integer and decimal arithmetic is used wherever a
value must be reproduced exactly by another engine.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
import functools
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.config import CURRENCIES, FX_BASE_E4, FX_EPOCH, FX_GAP_EVERY, LakeConfig
from lakeworks.functions.scalar import currency_of, day, money, pick
from lakeworks.sources.tables import Tables

# Rating letters by order priority digit, agencies, outlooks.
RATING_BY_PRIORITY = ["AAA", "AA", "A", "BBB", "BB"]
AGENCIES = ["MOODY", "SP", "FITCH"]
OUTLOOK_BY_STATUS = {"F": "STABLE", "O": "POSITIVE", "P": "NEGATIVE"}
TXN_STATUS_BY_ORDER_STATUS = {"F": "SETTLED", "O": "PENDING", "P": "EXECUTED"}
ASSET_COUNTRIES = ["US", "GB", "DE", "FR", "JP", "CA", "AU"]
SECURITY_RATINGS = ["AAA", "AA", "A", "BBB", "BB", "B", "CCC"]


# The source system that each raw frame comes from.
FRAME_SOURCES = {
    "position": "state_street", "position_rows": "state_street", "settled_transaction": "state_street", "security_price": "state_street",
    "cash_flow": "state_street", "portfolio": "state_street",
    "portfolio_risk": "aladdin", "portfolio_performance": "aladdin", "compliance": "aladdin", "trade_blotter": "aladdin",
    "security": "aspen", "entity": "aspen", "asset": "aspen", "rating": "aspen", "security_rating": "aspen",
    "industry": "aspen", "reporting_group": "aspen",
    "contract": "efront", "contract_summary": "efront", "covenant": "efront", "capital_activity": "efront",
    "collateral_exposure": "efront", "collateral_position": "efront",
    "team": "internal_admin", "fx_rate": "bloomberg",
}


class Roles:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: LakeConfig | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cfg = cfg or LakeConfig()
        self.t = Tables(spark, sf_dir)

    # ------------------------------------------------------------------ teams
    @cached_property
    def team(self) -> DataFrame:
        """Business units (internal_admin): one team per region."""
        r = self.t.region
        name = F.upper(F.regexp_replace(F.col("r_name"), " ", "_"))
        df = r.select(
            F.concat(F.lit("BU_"), F.col("r_regionkey").cast("string")).alias("source_key"),
            F.concat(F.lit("EK_BU_"), F.col("r_regionkey").cast("string")).alias("enterprise_key"),
            F.concat(F.lit("team_"), F.lower(F.regexp_replace(F.col("r_name"), " ", "_"))).alias("bu_code"),
            F.col("r_name").alias("bu_name"),
            F.lit("TEAM").alias("bu_type"),
            F.concat(F.when(F.col("r_regionkey") % 2 == 0, F.lit("PD_")).otherwise(F.lit("PM_")), name).alias("strategy_name"),
            F.make_date(F.lit(1990), (F.col("r_regionkey") + 1).cast("int"), F.lit(1)).alias("established_date"),
            F.col("r_regionkey").cast("bigint").alias("region_key"),
        )
        if self.cfg.skip_teams:
            df = df.filter(~F.col("bu_code").isin(list(self.cfg.skip_teams)))
        return df

    @cached_property
    def compliance(self) -> DataFrame:
        """Compliance checks (aladdin): risk team code per order priority."""
        o = self.t.orders
        return o.select(F.concat(F.lit("RISK_"), F.substring("o_orderpriority", 1, 1)).alias("risk_team_code")).distinct()

    # ------------------------------------------------------------- portfolios
    @cached_property
    def portfolio(self) -> DataFrame:
        s, n = self.t.supplier, self.t.nation
        return s.join(n, s.s_nationkey == n.n_nationkey, "inner").select(
            F.concat(F.lit("SUP_"), F.col("s_suppkey").cast("string")).alias("source_key"),
            F.concat(F.lit("EK_SUP_"), F.col("s_suppkey").cast("string")).alias("enterprise_key"),
            F.col("s_name").alias("portfolio_name"),
            F.concat(F.lit("STRAT_"), F.col("n_name")).alias("strategy_name"),
            currency_of("n_nationkey").alias("currency_code"),
            F.concat(F.lit("BU_"), F.col("n_regionkey").cast("string")).alias("bu_source_key"),
            F.col("n_name").alias("nation_name"),
            F.col("s_suppkey").cast("bigint").alias("supplier_key"),
        )

    # -------------------------------------------------------------- securities
    @cached_property
    def security(self) -> DataFrame:
        """Security master versions (aspen): one per part, a `_v2` reissue for p_partkey % 20 = 0."""
        p = self.t.part
        base = p.select(
            "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice",
            F.date_add(F.lit(dt.date(1994, 1, 1)), (F.col("p_partkey") % 365).cast("int")).alias("issue_date"))
        v1 = base.select(
            F.concat(F.lit("PRT_"), F.col("p_partkey").cast("string")).alias("source_key"),
            F.col("p_name").alias("security_name"), "issue_date", F.lit(1).alias("version_no"),
            "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
        v2 = base.filter(F.col("p_partkey") % 20 == 0).select(
            F.concat(F.lit("PRT_"), F.col("p_partkey").cast("string"), F.lit("_v2")).alias("source_key"),
            F.concat(F.col("p_name"), F.lit(" (Reissued)")).alias("security_name"),
            F.date_add(F.col("issue_date"), 1460).alias("issue_date"), F.lit(2).alias("version_no"),
            "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
        out = v1.unionByName(v2).select(
            "source_key",
            F.concat(F.lit("EK_PRT_"), F.col("p_partkey").cast("string")).alias("enterprise_key"),
            "security_name",
            F.col("p_type").alias("security_type"),
            F.col("p_type").alias("asset_class"),
            F.concat(F.lit("SIZE_"), (F.col("p_size") % 5).cast("string")).alias("sub_asset_class"),
            "issue_date",
            F.date_add(F.col("issue_date"), 3650).alias("maturity_date"),
            F.round((F.col("p_size") % 10) / F.lit(100.0), 4).alias("coupon_rate"),
            F.lit("USD").alias("currency_code"),
            F.concat(F.lit("BRD_"), F.substring("p_brand", 7, 4)).alias("issuer_source_key"),
            F.col("p_retailprice").cast("decimal(18,2)").alias("par_value"),
            F.col("version_no").cast("int").alias("version_no"),
            F.col("p_partkey").cast("bigint").alias("part_key"),
            F.col("p_brand").alias("brand"),
        )
        return out

    # ---------------------------------------------------------------- entities
    @cached_property
    def entity(self) -> DataFrame:
        """Entity master versions (aspen): customers; `_v2` restructuring for c_custkey % 10 = 0."""
        c, n = self.t.customer, self.t.nation
        base = c.join(n, c.c_nationkey == n.n_nationkey, "inner").select(
            "c_custkey", "c_name", "c_mktsegment", "n_name", "n_regionkey")
        v1 = base.select(
            F.concat(F.lit("CUS_"), F.col("c_custkey").cast("string")).alias("source_key"),
            F.col("c_name").alias("entity_name"),
            F.date_add(F.lit(dt.date(1990, 1, 1)), (F.col("c_custkey") % 1000).cast("int")).alias("formation_date"),
            F.lit(1).alias("version_no"), "c_custkey", "c_mktsegment", "n_name", "n_regionkey")
        v2 = base.filter(F.col("c_custkey") % 10 == 0).select(
            F.concat(F.lit("CUS_"), F.col("c_custkey").cast("string"), F.lit("_v2")).alias("source_key"),
            F.concat(F.col("c_name"), F.lit(" (Restructured)")).alias("entity_name"),
            F.date_add(F.lit(dt.date(1998, 1, 1)), (F.col("c_custkey") % 365).cast("int")).alias("formation_date"),
            F.lit(2).alias("version_no"), "c_custkey", "c_mktsegment", "n_name", "n_regionkey")
        out = v1.unionByName(v2).select(
            "source_key",
            F.concat(F.lit("EK_CUS_"), F.col("c_custkey").cast("string")).alias("enterprise_key"),
            "entity_name",
            F.col("c_mktsegment").alias("entity_type"),
            F.col("n_name").alias("jurisdiction"),
            "formation_date",
            F.col("n_name").alias("country"),
            F.col("version_no").cast("int").alias("version_no"),
            F.col("c_custkey").cast("bigint").alias("customer_key"),
            F.col("n_regionkey").cast("bigint").alias("region_key"),
        )
        return out

    # --------------------------------------------------------------- contracts
    @cached_property
    def contract(self) -> DataFrame:
        """Contracts (efront): orders; `_v2` amendment for o_orderkey % 20 = 0."""
        o = self.t.orders
        base = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                        money("o_totalprice").alias("principal"), day("o_orderdate").alias("signing"))
        v1 = base.select(
            F.concat(F.lit("ORD_"), F.col("o_orderkey").cast("string")).alias("source_key"),
            F.col("signing").alias("signing_date"), F.col("principal").alias("principal_local"),
            F.lit(1).alias("version_no"), "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        v2 = base.filter(F.col("o_orderkey") % 20 == 0).select(
            F.concat(F.lit("ORD_"), F.col("o_orderkey").cast("string"), F.lit("_v2")).alias("source_key"),
            F.date_add(F.col("signing"), 365).alias("signing_date"),
            (F.col("principal") * F.lit(Decimal("1.5"))).cast("decimal(18,2)").alias("principal_local"),
            F.lit(2).alias("version_no"), "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        out = v1.unionByName(v2).select(
            "source_key",
            F.concat(F.lit("EK_ORD_"), F.col("o_orderkey").cast("string")).alias("enterprise_key"),
            F.concat(F.lit("Contract "), F.col("o_orderkey").cast("string")).alias("contract_name"),
            F.concat(F.lit("CUS_"), F.col("o_custkey").cast("string")).alias("entity_source_key"),
            F.substring("o_orderpriority", 3, 20).alias("contract_type"),
            "signing_date",
            F.date_add(F.col("signing_date"), 1825).alias("maturity_date"),
            "principal_local",
            currency_of("o_custkey").alias("currency_code"),
            F.round((F.col("o_orderkey") % 7) / F.lit(100.0), 4).alias("coupon_rate"),
            F.round((F.col("o_orderkey") % 5) / F.lit(1000.0), 4).alias("spread_over_benchmark"),
            F.when(F.col("o_orderstatus") == "P", F.lit("RESTRUCTURED")).otherwise(F.lit("ACTIVE")).alias("status"),
            F.col("version_no").cast("int").alias("version_no"),
            F.col("o_orderkey").cast("bigint").alias("order_key"),
        )
        return out

    # ----------------------------------------------------------------- ratings
    @cached_property
    def rating(self) -> DataFrame:
        """Entity ratings (aspen): one per (customer, order day), highest order key wins."""
        o = self.t.orders
        from lakeworks.operators.dedup import latest_wins
        per_day = latest_wins(
            o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", day("o_orderdate").alias("rating_date")),
            ["o_custkey", "rating_date"], [F.col("o_orderkey").desc()])
        digit = F.substring("o_orderpriority", 1, 1).cast("int")
        outlook = F.when(F.col("o_orderstatus") == "F", "STABLE").when(F.col("o_orderstatus") == "O", "POSITIVE").otherwise("NEGATIVE")
        return per_day.select(
            F.concat(F.lit("RAT_"), F.col("o_orderkey").cast("string")).alias("source_key"),
            F.concat(F.lit("CUS_"), F.col("o_custkey").cast("string")).alias("entity_source_key"),
            F.concat(F.lit("EK_CUS_"), F.col("o_custkey").cast("string")).alias("rated_enterprise_key"),
            "rating_date",
            pick(AGENCIES, "o_custkey").alias("rating_agency"),
            F.element_at(F.array(*[F.lit(v) for v in RATING_BY_PRIORITY]), digit).alias("rating_value"),
            outlook.alias("rating_outlook"),
            F.lit("AFFIRM").alias("rating_action_type"),
            F.col("o_orderkey").cast("bigint").alias("order_key"),
        )

    # --------------------------------------------------------------- positions
    @cached_property
    def position(self) -> DataFrame:
        """Custodian positions (state_street): lineitem rows, several per source key
        (corrections), plus `REMAPPED_` re-emissions for l_orderkey % 500 = 0."""
        return self.as_position(self.position_rows)

    @cached_property
    def position_rows(self) -> DataFrame:
        """Lineitem rows behind the positions, and the remapped ones once more."""
        li = self.t.lineitem.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", day("l_shipdate").alias("position_date"))
        again = li.filter(F.col("l_orderkey") % 500 == 0).withColumn("position_date", F.date_add("position_date", 1))
        return li.withColumn("remapped", F.lit(False)).unionByName(again.withColumn("remapped", F.lit(True)))

    @staticmethod
    def position_keys() -> dict[str, Column]:
        """Texts that positions are known by and name others by, of ``position_rows``."""
        key = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
        return {"source_key": key,
                "portfolio_source_key": F.concat(F.lit("SUP_"), F.col("l_suppkey").cast("string")),
                "security_source_key": F.concat(F.lit("PRT_"), F.col("l_partkey").cast("string")),
                "enterprise_key": F.concat(F.when(F.col("remapped"), "REMAPPED_EK_POS_").otherwise("EK_POS_"), key),
                # sorts as the enterprise key does, which the first letter of its prefix decides
                "in_order": F.concat(F.when(F.col("remapped"), "R").otherwise("E"), key)}

    # the kinds that as_position takes a position's numbers as, and the price under the name it gives it
    POSITION_AMOUNTS = {"l_quantity": ("decimal(18,4)", "l_quantity"), "l_extendedprice": ("decimal(18,2)", "market_value_local"),
                        "l_discount": ("decimal(4,2)", "l_discount"), "l_tax": ("decimal(4,2)", "l_tax")}

    @staticmethod
    def as_position(rows: DataFrame, *more: str) -> DataFrame:
        """Positions of (some of) the ``position_rows``; ``more`` columns as they are. The newest
        positions have their market value already."""
        keys = Roles.position_keys()
        valued = "market_value_local" in rows.columns
        mv = F.col("market_value_local") if valued else money("l_extendedprice")
        base = rows.select(
            *more, *[keys[k].alias(k) for k in ("source_key", "portfolio_source_key", "security_source_key")],
            F.concat(F.lit("ORD_"), F.col("l_orderkey").cast("string")).alias("contract_source_key"),
            "position_date",
            F.col("l_quantity").cast("decimal(18,4)").alias("quantity"),
            mv.alias("market_value_local"),
            (mv * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,2)").alias("book_value_local"),
            (mv * (F.lit(1) + F.col("l_tax").cast("decimal(4,2)"))).cast("decimal(18,2)").alias("cost_basis_local"),
            F.when(F.col("l_linestatus") == "F", "SETTLED").otherwise("PENDING").alias("settlement_status"),
            F.col("l_returnflag").alias("return_flag"),
            currency_of("l_suppkey").alias("currency_code"),
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", *([] if valued else ["l_extendedprice"]),
            "l_discount", "l_tax", "l_returnflag", "l_linestatus",
            keys["enterprise_key"].alias("enterprise_key"),
        )
        return base.withColumn("unrealized_gl_local", (F.col("market_value_local") - F.col("cost_basis_local")).cast("decimal(18,2)"))

    @staticmethod
    def position_version_order():
        """Total order of the position versions of one key (newest first)."""
        return [F.col("position_date").desc(), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity"),
                F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax"), F.col("l_returnflag"),
                F.col("l_linestatus")]

    # ------------------------------------------------------------ transactions
    @cached_property
    def order_lines(self) -> DataFrame:
        """Per order line totals (one shuffle of lineitem by order key)."""
        li = self.t.lineitem
        return li.groupBy("l_orderkey").agg(
            F.min("l_suppkey").alias("first_suppkey"), F.min("l_partkey").alias("first_partkey"),
            F.sum(F.col("l_quantity").cast("decimal(18,4)")).alias("line_quantity"),
            F.sum(money("l_extendedprice")).alias("line_amount"))

    @cached_property
    def trade_rows(self) -> DataFrame:
        """Orders with the totals of their lines, behind the settled trades and the blotter."""
        o = self.t.orders
        return o.join(self.order_lines, o.o_orderkey == F.col("l_orderkey"), "inner").select(
            F.col("o_orderkey").cast("bigint").alias("order_key"), "o_custkey", "first_suppkey", "first_partkey",
            day("o_orderdate").alias("transaction_date"),
            F.col("line_quantity").cast("decimal(18,4)").alias("quantity"),
            F.col("line_amount").cast("decimal(18,2)").alias("gross_amount_local"),
            F.col("o_orderstatus").alias("order_status"))

    @staticmethod
    def trade_keys() -> dict[str, Column]:
        """Texts that trades are known by and name others by, of ``trade_rows``."""
        return {name: F.concat(F.lit(prefix), F.col(c).cast("string")) for name, prefix, c in (
            ("source_key", "TXN_", "order_key"), ("enterprise_key", "EK_TXN_", "order_key"),
            ("portfolio_source_key", "SUP_", "first_suppkey"), ("security_source_key", "PRT_", "first_partkey"))}

    @staticmethod
    def as_trade(rows: DataFrame, *more: str) -> DataFrame:
        """Trades of (some of) the ``trade_rows``; ``more`` columns as they are."""
        return rows.select(
            *more, *[key.alias(name) for name, key in Roles.trade_keys().items()], "transaction_date",
            F.when(F.col("order_key") % 3 == 0, "SELL").otherwise("BUY").alias("transaction_type"),
            "quantity", "gross_amount_local", currency_of("o_custkey").alias("currency_code"), "order_status", "order_key")

    @cached_property
    def settled_transaction(self) -> DataFrame:
        """Settled trades (state_street): finished orders, with fees and settlement."""
        b = self.as_trade(self.trade_rows).filter(F.col("order_status") == "F")
        fees = self.trade_fees()
        return b.select(
            "source_key", "enterprise_key", "portfolio_source_key", "security_source_key", "transaction_date",
            F.date_add(F.col("transaction_date"), 3).alias("settlement_date"), "transaction_type", "quantity",
            "gross_amount_local", fees.alias("fees_local"),
            (F.col("gross_amount_local") - fees).cast("decimal(18,2)").alias("net_amount_local"),
            "currency_code", "order_key")

    @staticmethod
    def trade_fees() -> Column:
        return (F.col("gross_amount_local") * F.lit(Decimal("0.0015"))).cast("decimal(18,2)")

    @staticmethod
    def trade_status() -> Column:
        return (F.when(F.col("order_status") == "F", "SETTLED").when(F.col("order_status") == "O", "PENDING")
                .otherwise("EXECUTED"))

    @cached_property
    def trade_blotter(self) -> DataFrame:
        """In-flight blotter (aladdin): every order with its trade status."""
        b = self.as_trade(self.trade_rows)
        status = self.trade_status()
        return b.select("source_key", "enterprise_key", "portfolio_source_key", "security_source_key",
                        "transaction_date", status.alias("trade_status"), "quantity",
                        F.when(F.col("transaction_type") == "SELL", "S").otherwise("B").alias("side"),
                        "currency_code", "order_key")

    # -------------------------------------------------------------- collateral
    @cached_property
    def collateral_position(self) -> DataFrame:
        li = self.t.lineitem
        return li.select(
            F.concat(F.lit("ORD_"), F.col("l_orderkey").cast("string")).alias("contract_source_key"),
            F.concat(F.lit("PRT_"), F.col("l_partkey").cast("string")).alias("security_source_key"),
            day("l_shipdate").alias("position_date"),
            money("l_extendedprice").alias("position_value_local"),
            F.when(F.col("l_linenumber") == 1, "PRIMARY").otherwise("SECONDARY").alias("collateral_role"),
            F.col("l_orderkey").cast("bigint").alias("order_key"), "l_linenumber")

    @cached_property
    def collateral_exposure(self) -> DataFrame:
        o = self.t.orders
        val = self.t.lineitem.groupBy("l_orderkey").agg(F.sum(money("l_extendedprice")).alias("collateral_value_local"))
        exp = (money("o_totalprice") * F.lit(Decimal("0.85"))).cast("decimal(18,2)")
        return o.join(val, o.o_orderkey == val.l_orderkey, "inner").select(
            F.concat(F.lit("ORD_"), F.col("o_orderkey").cast("string")).alias("contract_source_key"),
            day("o_orderdate").alias("exposure_date"),
            exp.alias("exposure_amount_local"),
            currency_of("o_custkey").alias("currency_code"),
            F.when(F.col("o_orderpriority").startswith("1"), "CASH").otherwise("SECURITIES").alias("collateral_type"),
            F.col("collateral_value_local").cast("decimal(18,2)").alias("collateral_value_local"),
            F.col("o_orderkey").cast("bigint").alias("order_key"))

    # ------------------------------------------------------- contract activity
    @cached_property
    def contract_summary(self) -> DataFrame:
        """Per order x month of ship date: outstanding principal after the
        shipped amount so far, and a status from the returned share."""
        li = self.t.lineitem
        o = self.t.orders

        def key(c):
            return F.concat(F.lit("ORD_"), F.col(c).cast("string"))
        # by the text that names the contract from the start: readers look it up without dealing the rows again
        monthly = li.groupBy(key("l_orderkey").alias("contract_source_key"), F.last_day(day("l_shipdate")).alias("summary_date")).agg(
            F.sum(money("l_extendedprice")).alias("shipped"),
            F.sum(F.when(F.col("l_returnflag") == "R", money("l_extendedprice")).otherwise(F.lit(0))).alias("returned"))
        from pyspark.sql import Window
        w = Window.partitionBy("contract_source_key").orderBy("summary_date").rowsBetween(Window.unboundedPreceding, 0)
        cum = monthly.withColumn("shipped_to_date", F.sum("shipped").over(w)).withColumn("returned_to_date", F.sum("returned").over(w))
        j = cum.join(o.select(key("o_orderkey").alias("__ck"), "o_orderkey", "o_custkey", money("o_totalprice").alias("principal")),
                     F.col("contract_source_key") == F.col("__ck"), "inner")
        outstanding = F.greatest(F.col("principal") - F.col("shipped_to_date"), F.lit(0)).cast("decimal(18,2)")
        share = F.col("returned_to_date") * 100 / F.when(F.col("shipped_to_date") != 0, F.col("shipped_to_date"))
        status = F.when(F.col("returned_to_date") * 2 > F.col("shipped_to_date"), "IMPAIRED") \
            .when(F.col("returned_to_date") > 0, "WATCH").otherwise("CURRENT")
        del share
        return j.select(
            "contract_source_key",
            "summary_date",
            outstanding.alias("outstanding_principal_local"),
            (F.col("shipped") * F.lit(Decimal("0.01"))).cast("decimal(18,2)").alias("accrued_interest_local"),
            F.col("shipped_to_date").cast("decimal(18,2)").alias("paid_to_date_local"),
            currency_of("o_custkey").alias("currency_code"),
            status.alias("performance_status"),
            F.col("o_orderkey").cast("bigint").alias("order_key"))

    @cached_property
    def covenant(self) -> DataFrame:
        li = self.t.lineitem
        return li.select(
            F.concat(F.lit("ORD_"), F.col("l_orderkey").cast("string")).alias("contract_source_key"),
            day("l_shipdate").alias("covenant_date"),
            F.lit("LTV").alias("covenant_type"),
            F.when(F.col("l_returnflag") == "R", "TRIPPED").otherwise("PASS").alias("covenant_status"))

    # ------------------------------------------------------ risk / performance
    @cached_property
    def portfolio_month(self) -> DataFrame:
        li = self.t.lineitem
        diff = (F.col("l_tax").cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))
        return li.groupBy("l_suppkey", F.last_day(day("l_shipdate")).alias("risk_date")).agg(
            F.max(F.col("l_discount").cast("decimal(18,6)")).alias("var_95"),
            F.max(F.col("l_tax").cast("decimal(18,6)")).alias("var_99"),
            F.sum(diff).alias("__ret_sum"), F.count(F.lit(1)).alias("__ret_n"),
            F.sum(money("l_extendedprice")).alias("__exposure"))

    @cached_property
    def portfolio_risk(self) -> DataFrame:
        pm = self.portfolio_month
        return pm.select(
            F.concat(F.lit("SUP_"), F.col("l_suppkey").cast("string")).alias("portfolio_source_key"),
            "risk_date", "var_95", "var_99",
            (F.col("var_95") + F.col("var_99")).cast("decimal(18,6)").alias("expected_shortfall"),
            F.lit("USD").alias("risk_currency"),
            F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("portfolio_name"),
            F.col("l_suppkey").cast("bigint").alias("supplier_key"))

    @cached_property
    def portfolio_performance(self) -> DataFrame:
        pm = self.portfolio_month
        ret = F.col("__ret_sum").cast("double") / F.col("__ret_n").cast("double")
        return pm.select(
            F.concat(F.lit("SUP_"), F.col("l_suppkey").cast("string")).alias("portfolio_source_key"),
            F.col("risk_date").alias("performance_date"),
            ret.alias("period_return_pct"),
            F.col("__ret_sum").alias("return_sum"), F.col("__ret_n").cast("bigint").alias("return_count"),
            F.lit("BM_GLOBAL").alias("benchmark_code"),
            F.col("l_suppkey").cast("bigint").alias("supplier_key"))

    @cached_property
    def capital_activity(self) -> DataFrame:
        o = self.t.orders.filter(F.col("o_orderstatus").isin("O", "F"))
        return o.join(self.order_lines, o.o_orderkey == F.col("l_orderkey"), "inner").select(
            F.concat(F.lit("SUP_"), F.col("first_suppkey").cast("string")).alias("portfolio_source_key"),
            day("o_orderdate").alias("activity_date"),
            F.when(F.col("o_orderstatus") == "O", "CAPITAL_CALL").otherwise("DISTRIBUTION").alias("activity_type"),
            F.col("line_amount").cast("decimal(18,2)").alias("amount_local"),
            F.col("o_orderkey").cast("bigint").alias("order_key"))

    # ------------------------------------------------------------------ prices
    @cached_property
    def security_price(self) -> DataFrame:
        li = self.t.lineitem
        return li.groupBy("l_partkey", day("l_shipdate").alias("price_date")).agg(
            F.max(F.col("l_extendedprice").cast("decimal(18,6)")).alias("close_price_local")).select(
            F.concat(F.lit("PRT_"), F.col("l_partkey").cast("string")).alias("security_source_key"),
            "price_date", "close_price_local", F.lit("USD").alias("currency_code"),
            F.lit("CLOSE").alias("price_type"))

    # -------------------------------------------------------------- cash flows
    @cached_property
    def cash_flow(self) -> DataFrame:
        e = self.t.events
        kind = (F.when(F.col("event_type") == "purchase", "INCOME").when(F.col("event_type") == "signup", "CONTRIBUTION")
                .when(F.col("event_type") == "error", "FEE").when(F.col("event_type") == "click", "EXPENSE")
                .otherwise("DISTRIBUTION"))
        return e.select(
            F.col("event_id").cast("bigint").alias("event_id"),
            F.concat(F.lit("SUP_"), (F.col("user_id") % 10).cast("string")).alias("portfolio_source_key"),
            day("ts").alias("cash_flow_date"), kind.alias("cash_flow_type"),
            money("value").alias("amount_local"), F.lit("USD").alias("currency_code"))

    @cached_property
    def asset(self) -> DataFrame:
        """Asset master (aspen): one asset per part brand."""
        p = self.t.part
        brand_no = F.substring("p_brand", 7, 4).cast("bigint")
        agg = p.groupBy(brand_no.alias("brand_no"), "p_brand").agg(
            F.min("p_type").alias("asset_class"),
            F.sum(F.col("p_retailprice").cast("decimal(18,2)")).alias("total_size_local"))
        return agg.select(
            F.concat(F.lit("AST_"), F.col("brand_no").cast("string")).alias("source_key"),
            F.concat(F.lit("EK_AST_"), F.col("brand_no").cast("string")).alias("enterprise_key"),
            F.col("p_brand").alias("asset_name"), F.lit("BRAND").alias("asset_type"), "asset_class",
            pick(ASSET_COUNTRIES, "brand_no").alias("country_code"),
            (F.lit(1990) + F.col("brand_no") % 10).cast("int").alias("vintage_year"),
            F.col("total_size_local").cast("decimal(18,2)").alias("total_size_local"),
            F.lit("USD").alias("currency_code"), F.col("brand_no"))

    @cached_property
    def security_rating(self) -> DataFrame:
        """Security ratings (aspen): one rating per security at issue."""
        p = self.t.part
        return p.select(
            F.concat(F.lit("SRAT_"), F.col("p_partkey").cast("string")).alias("source_key"),
            F.concat(F.lit("PRT_"), F.col("p_partkey").cast("string")).alias("security_source_key"),
            F.date_add(F.lit(dt.date(1994, 1, 1)), (F.col("p_partkey") % 365).cast("int")).alias("rating_date"),
            pick(AGENCIES, "p_partkey").alias("rating_agency"),
            pick(SECURITY_RATINGS, "p_size").alias("rating_value"),
            F.lit("STABLE").alias("rating_outlook"), F.lit("NEW").alias("rating_action_type"))

    # ------------------------------------------------------------- hierarchies
    @cached_property
    def industry(self) -> DataFrame:
        p = self.t.part
        return p.select("p_brand").distinct().select(
            F.concat(F.lit("IND_"), F.substring("p_brand", 7, 4)).alias("classification_code"),
            F.col("p_brand").alias("classification_name"),
            F.lit("IND_ROOT").alias("parent_code"), F.lit(2).alias("classification_level"),
            F.lit("BRAND").alias("classification_system"))

    @cached_property
    def reporting_group(self) -> DataFrame:
        c = self.t.customer
        r = self.t.region
        seg = c.select("c_mktsegment").distinct().select(
            F.concat(F.lit("SEG_"), F.col("c_mktsegment")).alias("group_code"), F.col("c_mktsegment").alias("group_name"),
            F.lit("RG_ROOT").alias("parent_group_code"), F.lit(2).alias("group_level"), F.lit("SEGMENT").alias("group_type"))
        reg = r.select(
            F.concat(F.lit("REG_"), F.col("r_regionkey").cast("string")).alias("group_code"), F.col("r_name").alias("group_name"),
            F.lit("RG_ROOT").alias("parent_group_code"), F.lit(2).alias("group_level"), F.lit("REGION").alias("group_type"))
        return seg.unionByName(reg)

    # --------------------------------------------------------------------- fx
    @cached_property
    def fx_rate(self) -> DataFrame:
        """Daily X->USD rates for every day of the span the data covers.

        One row per (currency, day); a date that is far off makes the calendar
        longer, at most to the years 1 to 9999 that a date can name.
        Days with day_index % 97 = 0 are missing on purpose (default path).
        """
        li, o, e = self.t.lineitem, self.t.orders, self.t.events
        spans = (li.select(day("l_shipdate").alias("d"))
                 .unionByName(o.select(day("o_orderdate").alias("d")))
                 .unionByName(e.select(day("ts").alias("d")))
                 .agg(F.min("d").alias("lo"), F.max("d").alias("hi")))
        last = F.date_add(F.least(F.col("hi"), F.date_sub(F.lit(dt.date(9999, 12, 31)), 730)), 730)
        days = spans.select(F.explode(F.sequence(F.col("lo"), F.greatest(last, F.col("hi")))).alias("rate_date"))
        idx = F.datediff(F.col("rate_date"), F.lit(FX_EPOCH))
        days = days.withColumn("__day", idx).filter(F.col("__day") % FX_GAP_EVERY != 0)
        pairs = self.spark.createDataFrame(
            [(ccy, i, FX_BASE_E4[ccy]) for i, ccy in enumerate(CURRENCIES) if ccy != "USD"],
            "from_currency string, pair int, base_e4 int")
        e7 = (F.col("base_e4").cast("bigint") * (F.lit(980) + (F.col("__day") * 7 + F.col("pair") * 13) % 41))
        rate = (e7.cast("decimal(18,0)") * F.lit(Decimal("0.0000001"))).cast("decimal(18,8)")
        return days.crossJoin(F.broadcast(pairs)).select(
            "from_currency", F.lit("USD").alias("to_currency"), "rate_date", rate.alias("fx_rate"),
            F.lit("SPOT").alias("rate_type"))


def _toggled(name: str, source: str) -> cached_property:
    """The frame, or where its source is switched off (``skip_sources``) no rows of
    the same schema, so that everything above still plans; what unifies several
    sources falls back on the others."""
    build = vars(Roles)[name].func

    @functools.wraps(build)
    def frame(self) -> DataFrame:
        df = build(self)
        return df.where(F.lit(False)) if source in self.cfg.skip_sources else df

    made = cached_property(frame)
    made.__set_name__(Roles, name)
    return made


for _name, _source in FRAME_SOURCES.items():
    setattr(Roles, _name, _toggled(_name, _source))
