"""Steps that many reports share: what they read, write and do once."""

import datetime as dt
import os

from pyspark.sql import functions as F

from lake_helpers import SF_SMALL, rows
from lakeworks.operators.dedup import latest_wins
from lakeworks.operators.keys import lookup_of
from lakeworks.operators.rowid import dense_row_id
from lakeworks.plans import bronze, gates
from lakeworks.plans.mart import _book_finish
from lakeworks.plans.registry import Lake, REGISTRY
from lakeworks.sources.roles import Roles


def test_a_lookup_is_built_from_the_frames_that_name_its_domain(spark):
    lake = Lake(spark, SF_SMALL)
    lake.get("silver.security_dim")
    assert not lake.store.exists("bronze.crosswalk_keys") and not lake.store.exists("bronze.crosswalk_lookup")
    whole = lookup_of(bronze._keys_of(lake, bronze.KEY_COLUMNS).distinct())
    for system, domain in (("aspen", "issuer"), ("aspen", "security"), ("efront", "entity"), ("efront", "contract"),
                           ("internal_admin", "team"), ("state_street", "portfolio"), ("state_street", "security"),
                           ("aladdin", "portfolio"), ("efront", "security")):
        own = lake.part("bronze.crosswalk_lookup", system, domain)
        same = whole.filter((F.col("source_system") == system) & (F.col("domain") == domain))
        cols = ("source_key", "enterprise_key")
        assert rows(own, *cols) == rows(same, *cols) != [], (system, domain)


def test_numbered_rows_are_columns_in_files_and_need_no_join(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), F.lit("a text that is long and the same").alias("t"))
    out = dense_row_id(df, ["k"], "n")
    assert rows(out, "k", "n") == [(i, i + 1) for i in range(1000)]
    files = out.inputFiles()
    assert files and all(f.endswith(".parquet") for f in files)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    assert dense_row_id(df.limit(0), ["k"], "n").collect() == []


def test_newest_positions_by_their_numbers_are_those_by_their_text(spark, tmp_path):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    none = li.limit(3).withColumn("l_orderkey", F.lit(None).cast("bigint")).unionByName(
        li.limit(4).withColumn("l_linenumber", F.lit(None).cast(li.schema["l_linenumber"].dataType)))
    for t in os.listdir(SF_SMALL):
        if not t.startswith("lineitem"):
            os.symlink(f"{SF_SMALL}/{t}", tmp_path / t)
    li.unionByName(li.limit(50)).unionByName(none).write.parquet(str(tmp_path / "lineitem.parquet"))
    r = Roles(spark, str(tmp_path))
    cols = ["enterprise_key", "source_key", "position_date", "contract_source_key", "market_value_local"]
    by_text = latest_wins(r.position, ["enterprise_key"], r.position_version_order()).select(*cols)
    by_number = Lake(spark, str(tmp_path)).get("bronze.position").select(*cols)
    assert by_text.filter("enterprise_key is null").count() == 1
    cols.remove("contract_source_key")                      # of the row without a key any may be taken on a tie
    assert by_text.select(*cols).exceptAll(by_number.select(*cols)).isEmpty() and by_text.count() == by_number.count()
    plan = Lake(spark, str(tmp_path)).get("bronze.position")._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(enterprise_key" not in plan


def test_sk_lookups_are_not_joined_again_by_number(spark):
    for name in ("silver.collateral_positions_fact", "silver.position_analytics_fact", "silver.transaction_fact"):
        plan = Lake(spark, SF_SMALL).get(name, ids=False)._jdf.queryExecution().analyzed().toString()
        assert "__csk" not in plan and "__psk" not in plan, name


def test_reports_of_two_books_make_the_fact_once(spark, monkeypatch):
    from lakeworks.plans.queries import QUERIES
    made = []
    fact = REGISTRY["mart.fact_position"].build
    monkeypatch.setattr(REGISTRY["mart.fact_position"], "build", lambda lake: made.append(1) or fact(lake))
    lake = Lake(spark, SF_SMALL)
    out = QUERIES["book_x_security"](lake)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(made) == 1 and "l_extendedprice" not in plan       # all that is left starts from files
    assert "market_value" in plan and out.count() > 0


def test_top_three_of_a_day_over_the_types_of_a_portfolio(spark):
    lake = Lake(spark, SF_SMALL)
    day = dt.date(2000, 1, 1)
    state = spark.createDataFrame(
        [(day, "P", "FUND", f"E{i}", c, float(v)) for i, c, v in ((1, "US", 50), (1, "GB", 40), (2, "US", 30), (3, "DE", 7))]
        + [(day, "P", "SMA", "E9", "US", 45.0), (day, "P", "SMA", None, None, 1.0), (day, None, "SMA", "E1", "US", None)],
        "position_date date, portfolio_name string, portfolio_type string, enterprise_entity_id string, country_code string, v double")
    state = state.select("position_date", "portfolio_name", "portfolio_type", "enterprise_entity_id", "country_code",
                         F.col("v").cast("decimal(28,2)").alias("s_market_value"))
    from lakeworks.operators.changes import COUNT, state_of
    own = state_of(state.withColumnRenamed("s_market_value", "market_value"),
                   ("position_date", "portfolio_name", "portfolio_type", "enterprise_entity_id", "country_code"), ("market_value",))
    assert COUNT in own.columns
    got = {(r.portfolio_name, r.portfolio_type): r for r in _book_finish(lake, own).collect()}
    fund, sma, none = got["P", "FUND"], got["P", "SMA"], got[None, "SMA"]
    assert (float(fund.aum), fund.entity_count, fund.country_count) == (127.0, 3, 3)
    assert abs(fund.top_3_concentration_pct - 90 / 127) < 1e-12 and abs(sma.top_3_concentration_pct - 45 / 46) < 1e-12
    assert (sma.entity_count, sma.country_count) == (1, 1) and none.aum is None and none.top_3_concentration_pct is None


def test_both_differences_of_bags_come_from_one_pass(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None), (4, "z")], "k int, v string")
    got = gates._both_ways(a, b, "ab", "ba")
    assert rows(got) == [(a.exceptAll(b).count(), b.exceptAll(a).count())] == [(2, 2)]
    assert rows(gates._both_ways(a.limit(0), b.limit(0), "ab", "ba")) == [(0, 0)]
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
