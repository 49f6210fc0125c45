"""What reports leave on the disk: shuffles and cuts go when their rows are written, and rows are dealt once where they can be."""

import os

import pytest
from pyspark.sql import functions as F

from lake_helpers import SF_SMALL, rows
from lakeworks.operators import keys
from lakeworks.operators.keys import source_keys_of
from lakeworks.operators.windows import dense_rank_within, share_of_total
from lakeworks.plans import gates
from lakeworks.plans.bronze import newest_positions
from lakeworks.plans.queries import QUERIES
from lakeworks.plans.registry import Lake, Placement
from lakeworks.plans.silver import _breach_as_of
from lakeworks.plans.store import SnapshotStore
from lakeworks.session import cut_lineage, passing_cuts, shuffles_freed

FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_shuffles_go_when_rows_are_written(spark, tmp_path):
    seen = []
    before = spark.conf.get(FREE)
    with shuffles_freed(spark):
        seen.append(spark.conf.get(FREE))
    with pytest.raises(ValueError), shuffles_freed(spark):
        raise ValueError
    assert seen == ["true"] and spark.conf.get(FREE) == before
    # the shuffles of a written frame can be made again by a frame of the same rows
    df = spark.range(100).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    cut = cut_lineage(df)
    assert rows(cut) == rows(df) == rows(df)
    store = SnapshotStore(spark, str(tmp_path / "s"))
    assert rows(store.read("t", store.write("t", df))) == rows(df)


def test_cuts_on_the_way_are_deleted(spark):
    outer = cut_lineage(spark.range(5).toDF("k"))
    with passing_cuts(spark):
        with passing_cuts(spark):
            inner = cut_lineage(outer.withColumn("v", F.lit(1)))
            files = inner.inputFiles()
            assert inner.count() == 5
        path = files[0].removeprefix("file://")
        assert not os.path.exists(path)
        again = cut_lineage(outer)
        assert again.count() == 5
    assert not os.path.exists(again.inputFiles()[0].removeprefix("file://")) and outer.count() == 5


def test_a_refresh_leaves_no_cuts_and_live_frames_still_read(spark, tmp_path):
    lake = Lake(spark, SF_SMALL, placement=Placement(gold=True), store=SnapshotStore(spark, str(tmp_path / "s")))
    before = lake.get("silver.security_dim")
    top = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    def cuts():
        return {f for f in os.listdir(top) if f.startswith("cut-")}
    kept = cuts()
    lake.refresh("gold.position_analytics_fact")
    assert cuts() <= kept and before.count() > 0
    live = Lake(spark, SF_SMALL).get("gold.position_analytics_fact")
    cols = ["team_code", "enterprise_key", "position_sk", "concentration_pct", "portfolio_rank"]
    assert rows(lake.get("gold.position_analytics_fact"), *cols) == rows(live, *cols)
    assert lake.get("silver.security_dim").count() == before.count()


def test_source_keys_of_short_and_long_lists(spark, monkeypatch):
    xw = spark.createDataFrame([("s", f"K{i:03d}", "EK_LONG") for i in range(25)] + [("s", "A", "EK_1"), ("r", "B", "EK_1"), ("s", "C", None)],
                               "source_system string, source_key string, enterprise_key string")
    got = {(r.enterprise_key, r.page): [tuple(x) for x in r.source_keys] for r in source_keys_of(xw, page=10).collect()}
    assert got[("EK_1", 0)] == [("r", "B"), ("s", "A")] and got[(None, 0)] == [("s", "C")]
    assert [len(got["EK_LONG", p]) for p in range(3)] == [10, 10, 5] and len(got) == 5
    assert got["EK_LONG", 0] + got["EK_LONG", 1] + got["EK_LONG", 2] == [("s", f"K{i:03d}") for i in range(25)]
    whole = {(r.enterprise_key, r.page): [tuple(x) for x in r.source_keys] for r in source_keys_of(xw, page=100).collect()}
    assert whole["EK_LONG", 0] == got["EK_LONG", 0] + got["EK_LONG", 1] + got["EK_LONG", 2]
    # only lists over a page are placed
    placed = []
    monkeypatch.setattr(keys, "positions", lambda df, *a: placed.append(df.count()) or df.withColumn("__at", F.lit(0)))
    source_keys_of(xw, page=10)
    assert placed == [25]


def test_rank_and_share_come_from_one_join(spark):
    df = spark.createDataFrame([("a", 1.5, 1), ("a", 1.5, 2), ("a", -3.0, 3), ("a", None, 4), ("b", 0.0, 5), (None, 2.0, 6)], "g string, x double, id int")
    df = df.select("g", F.col("x").cast("decimal(18,2)").alias("v"), "id")
    two = dense_rank_within(share_of_total(df, ["g"], "v", "s"), ["g"], "v", "r")
    one = dense_rank_within(df, ["g"], "v", "r", share="s")
    assert rows(one, "id", "s", "r") == rows(two, "id", "s", "r")
    assert exchanges(one) < exchanges(two) or "BroadcastHashJoin" in one._jdf.queryExecution().executedPlan().toString()


def test_latest_covenant_day_is_breached_if_any_row_of_it_is(spark):
    lake = Lake(spark, SF_SMALL)
    d = "c string, day string, status string"
    cov = spark.createDataFrame([("A", "1998-01-01", "TRIPPED"), ("A", "1998-02-01", "PASS"), ("B", "1998-02-01", "PASS"),
                                 ("B", "1998-02-01", "TRIPPED"), ("C", "1998-01-01", None)], d)
    lake.roles.__dict__["covenant"] = cov.select(F.col("c").alias("contract_source_key"), F.col("day").cast("date").alias("covenant_date"),
                                                 F.col("status").alias("covenant_status"))
    assert rows(_breach_as_of(lake), "contract_source_key", "has_active_breach") == [("A", False), ("B", True), ("C", False)]


def test_positions_meet_each_dimension_once(spark):
    lake = Lake(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = lake.get("mart.position_enriched")
        plan = star._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # versions bring the columns of portfolio and security; the dimensions themselves aren't joined to the rows
    assert plan.count("portfolio_sk#") and "Join Inner, (portfolio_sk" not in plan and "Join Inner, (security_sk" not in plan
    old = Lake(spark, SF_SMALL)
    from lakeworks.plans.mart import _enriched_base
    b = _enriched_base(old, old.get("mart.fact_position"))
    cols = ["position_id", "position_date", "portfolio_name", "entity_name", "security_name", "asset_name", "market_value", "cost_basis", "fx_rate"]
    assert rows(star, *cols) == rows(b, *cols)


def test_keys_of_newest_positions_need_no_amounts(spark):
    lake = Lake(spark, SF_SMALL)
    cols = ["l_orderkey", "l_linenumber", "remapped", "position_date", "l_partkey", "l_suppkey"]
    narrow = newest_positions(lake, named=True)
    assert rows(narrow, *cols) == rows(newest_positions(lake), *cols) and "l_extendedprice" not in narrow.columns


def test_team_contracts_made_here_are_those_of_the_details(spark, tmp_path):
    live = Lake(spark, SF_SMALL)
    got = live.live("teams' contracts") if live._stack else QUERIES["team_contract_summary"](live).select("team_code", "contract_sk").distinct()
    pairs = set(rows(QUERIES["team_contract_details"](Lake(spark, SF_SMALL)).select("team_code", "contract_sk").distinct()))
    assert set(rows(got)) and set(rows(got)) <= pairs
    # from stored collateral, by way of the entities
    stored = Lake(spark, SF_SMALL, placement=Placement(silver=True), store=SnapshotStore(spark, str(tmp_path / "s")), auto_refresh=True)
    assert rows(stored.get("gold.team_contracts"), "team_code", "contract_sk") == rows(live.get("gold.team_contracts"), "team_code", "contract_sk")


def test_differences_of_all_snapshots_come_from_one_pass(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (3, "z")], "k int, v string")
    counts = gates._counts(["k", "v"], [(a, {"a": F.lit(1)}), (b, {"b": F.lit(1), "c": F.when(F.col("k") == 3, 0).otherwise(1)})])
    got = counts.agg(*[gates._surplus(x, y).alias(f"{x}{y}") for x, y in ("ab", "ba", "ac", "ca")])
    assert rows(got) == [(2, 1, 2, 0)]
