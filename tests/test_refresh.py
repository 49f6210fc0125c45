"""Incremental refresh and staleness over a lake whose sources change."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from lake_helpers import SF_SMALL, rows
from lakeworks.plans.registry import Lake, Placement, dependencies, source_tables
from lakeworks.plans.store import SnapshotStore

AUM, KPI, BOOK, FACT = (f"mart.{n}" for n in ("aum_daily_by_portfolio", "portfolio_kpi_daily", "portfolio_book", "fact_position"))


@pytest.fixture
def sources(tmp_path):
    target = str(tmp_path / "sf")
    shutil.copytree(SF_SMALL, target)
    os.chmod(target, 0o755)  # the folder too: it is copied as it is, read-only
    for root, dirs, files in os.walk(target):
        for n in dirs + files:
            os.chmod(os.path.join(root, n), 0o755)
    return target


def change(spark, sf, table, make):
    """Replace a source table."""
    os.remove(f"{sf}/{table}.parquet")
    make(spark.read.parquet(f"{SF_SMALL}/{table}.parquet")).write.parquet(f"{sf}/{table}.parquet")


def same(a, b):
    return a.exceptAll(b.select(a.columns)).count() == 0 and b.select(a.columns).exceptAll(a).count() == 0


def test_aggregates_are_refreshed_from_changes(spark, sources, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    lake = Lake(spark, sources, placement=Placement(mart=True), store=store, auto_refresh=True)
    wanted = {AUM, KPI, BOOK}
    for n in sorted(wanted):
        lake.refresh(n)
    kind = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").schema["l_extendedprice"].dataType
    price = F.when(F.col("l_orderkey") % 100 == 0, F.col("l_extendedprice") + 5).otherwise(F.col("l_extendedprice")).cast(kind)
    change(spark, sources, "lineitem", lambda df: df.withColumn("l_extendedprice", price).filter("l_orderkey % 97 <> 3"))
    # names of portfolios change too: a dimension's change passes the star join
    change(spark, sources, "supplier", lambda df: df.withColumn("s_name", F.when(F.col("s_suppkey") == 2, F.lit("Renamed"))
                                                                 .otherwise(F.col("s_name"))))
    done = {r.entity: r for r in lake.refresh_stale(wanted | {FACT, "mart.dim_portfolio"}, workers=3).collect()}
    assert {done[n].action for n in wanted} == {"refreshed"}
    live = Lake(spark, sources)
    for n in sorted(wanted):
        assert same(live.get(n), store.read(n)), n
    log = store.refresh_log().filter(F.col("version") == 2)
    assert rows(log.filter(F.col("entity").isin(*wanted)), "strategy") == [("incremental",)] * 3
    assert "Renamed" in {r.portfolio_name for r in store.read(BOOK).collect()}
    # again in full, and with nothing changed
    lake.refresh(AUM, full=True)
    assert same(live.get(AUM), store.read(AUM))
    assert {r.action for r in lake.refresh_stale(wanted).collect()} == {"fresh"}


def test_only_dependants_of_a_change_are_rebuilt(spark, sources, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    lake = Lake(spark, sources, placement=Placement(silver=True), store=store)
    names = {"silver.industry_dim", "silver.reporting_group_dim", "silver.fx_rate_dim"}
    assert {r.state for r in lake.freshness().collect() if r.entity in names} == {"missing"}
    assert {r.action for r in lake.refresh_stale(names, workers=4).collect()} == {"refreshed"}
    assert {r.action for r in lake.refresh_stale(names).collect()} == {"fresh"}
    change(spark, sources, "part", lambda df: df.withColumn("p_brand", F.concat(F.col("p_brand"), F.lit("9"))))
    lake = Lake(spark, sources, placement=Placement(silver=True), store=store)
    state = {r.entity: (r.state, r.reasons) for r in lake.freshness().collect() if r.entity in names}
    assert state.pop("silver.industry_dim") == ("stale", "source:part")
    assert {s for s, _ in state.values()} == {"fresh"}
    done = {r.entity: r.action for r in lake.refresh_stale(names).collect()}
    assert done.pop("silver.industry_dim") == "refreshed" and set(done.values()) == {"fresh"}
    assert store.current_version("silver.industry_dim") == 2 and store.current_version("silver.fx_rate_dim") == 1


def test_rebuilt_input_with_the_same_content_leaves_the_rest_fresh(spark, sources, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    lake = Lake(spark, sources, placement=Placement(silver=True), store=store)
    # the crosswalk lies between the sources and this dimension
    assert "bronze.crosswalk_keys" in {d for n in dependencies("silver.entity_dim") for d in dependencies(n) | {n}} | dependencies(
        "bronze.crosswalk_lookup")
    first = {r.entity: r.action for r in lake.refresh_stale({"silver.entity_dim"}).collect()}
    assert set(first.values()) == {"refreshed"} and "bronze.crosswalk_keys" in first
    # names of suppliers are no keys: the crosswalk is built again, with the same content
    change(spark, sources, "supplier", lambda df: df.withColumn("s_name", F.upper("s_name")))
    done = {r.entity: r.action for r in lake.refresh_stale({"silver.entity_dim"}).collect()}
    assert done.pop("silver.entity_dim") == "fresh" and done["bronze.crosswalk_keys"] == "refreshed"
    assert store.content("bronze.crosswalk_keys", 1) == store.content("bronze.crosswalk_keys", 2)
    store.write("silver.entity_dim", store.read("silver.entity_dim"))          # by another hand: no note of its inputs
    assert lake.stale("silver.entity_dim") == ["missing"]


def test_a_failure_is_kept_to_its_dependants(spark, tmp_path, monkeypatch):
    from lakeworks.plans import registry
    store = SnapshotStore(spark, str(tmp_path / "store"))
    lake = Lake(spark, SF_SMALL, placement=Placement(silver=True, gold=True), store=store)
    bad = registry.REGISTRY["silver.rating_dim"]
    monkeypatch.setattr(bad, "build", lambda lake: 1 / 0)
    names = {"silver.rating_dim", "gold.security_rating_dim", "silver.industry_dim"}
    done = {r.entity: r.action for r in lake.refresh_stale(names, workers=2).collect() if r.entity in names}
    assert done == {"silver.rating_dim": "failed", "gold.security_rating_dim": "blocked", "silver.industry_dim": "refreshed"}


def test_sources_are_read_from_the_code():
    assert source_tables("bronze.asset") == {"part"}
    assert {"lineitem", "events", "customer"} <= source_tables("bronze.crosswalk_keys")
    assert source_tables("mart.aum_daily_by_portfolio") == set()
