"""Source switches and the folding of stream batches."""

import os

import pytest
from pyspark.sql import functions as F

from lake_helpers import SF_SMALL, rows
from lakeworks.config import SOURCES, LakeConfig
from lakeworks.plans.registry import Lake
from lakeworks.sources.roles import FRAME_SOURCES, Roles


@pytest.mark.parametrize("source", SOURCES)
def test_each_source_can_be_switched_off(spark, source):
    on, off = Roles(spark, SF_SMALL), Roles(spark, SF_SMALL, LakeConfig(skip_sources=frozenset([source])))
    own = [n for n, s in FRAME_SOURCES.items() if s == source]
    assert own
    for name in own:
        assert getattr(off, name).schema == getattr(on, name).schema and getattr(off, name).isEmpty()
    other = next(n for n, s in FRAME_SOURCES.items() if s not in (source, "state_street", "efront"))
    assert not getattr(off, other).isEmpty()


def test_provenance_falls_back_on_the_other_sources(spark):
    def lake(*sources):
        return Lake(spark, SF_SMALL, LakeConfig(skip_sources=frozenset(sources)))
    full = lake().get("bronze.security")
    assert {r[0] for r in full.select("_source_pref").distinct().collect()} >= {"aspen+state_street"}
    alone = lake("state_street").get("bronze.security")
    assert rows(alone.select("_source_pref").distinct()) == [("aspen",)]
    assert alone.count() == full.count() and alone.filter("latest_close_price is not null").isEmpty()
    assert lake("aspen").get("bronze.security").isEmpty()
    assert lake("efront").get("bronze.entity").filter("has_contracts").isEmpty()
    rates = lake("bloomberg").get("silver.position_analytics_fact")
    assert rates.filter("fx_rate_to_usd is not null").isEmpty() and not rates.isEmpty()


def test_batches_are_folded_and_replays_count_once(spark, tmp_path):
    from lakeworks.streaming.refresh import _folders, cash_flow_rows, partials, write_batch
    root = str(tmp_path / "root")
    ev = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))
    most = 0
    for k in range(50):
        write_batch(root, ev.filter(F.col("event_id") % 50 == k).coalesce(1), k, keep=8)
        most = max(most, len(_folders(spark, root)))
    assert most <= 8
    lying = [d for kind in ("batch", "upto") for d in os.listdir(f"{root}/{kind}") if "=" in d]
    assert len(lying) <= 8
    for k in (0, 30, 49):  # long folded, and the newest
        write_batch(root, ev.filter(F.col("event_id") % 50 == k).coalesce(1), k, keep=8)
    want = cash_flow_rows(ev).groupBy("portfolio_source_key", "cash_flow_date", "cash_flow_type").agg(
        F.sum("amount_local").alias("s"), F.count(F.lit(1)).alias("n"))
    assert rows(partials(spark, root), "portfolio_source_key", "cash_flow_date", "cash_flow_type", "sum_amount_local", "row_count") == \
        rows(want, "portfolio_source_key", "cash_flow_date", "cash_flow_type", "s", "n")
