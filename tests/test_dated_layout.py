"""Dated facts lie in month folders, and reports that name their dates open only
the files of their months: every other file is made unreadable first."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from lake_helpers import SF_SMALL, rows
from lakeworks.plans import registry
from lakeworks.plans.queries import QUERIES
from lakeworks.plans.registry import Lake, Placement
from lakeworks.plans.store import SnapshotStore

JAN, APR = dt.date(2000, 1, 1), dt.date(2000, 4, 1)


def days(spark):
    """120 days from January 1st of 2000, ten rows a day, and five rows without a day."""
    dated = spark.range(1200).select("id", F.date_add(F.lit(JAN), (F.col("id") % 120).cast("int")).alias("day"))
    return dated.unionByName(spark.range(5).select((F.col("id") + 5000).alias("id"), F.lit(None).cast("date").alias("day")))


def spoil(folder, keep):
    """Overwrite all files but those in the folders of the months in ``keep``."""
    n = 0
    for f in glob.glob(f"{folder}/in_month=*/*.parquet"):
        if not any(f"in_month={m}/" in f for m in keep):
            with open(f, "wb") as out:
                out.write(b"not parquet")
            n += 1
    return n


def test_only_the_months_asked_for_are_opened(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    df = days(spark)
    store.write("t", df, dated="day", cluster=("day",))
    folders = {os.path.basename(f) for f in glob.glob(f"{tmp_path}/t/v=000001/in_month=*")}
    assert folders == {f"in_month={m}" for m in ("200001", "200002", "200003", "200004", "__HIVE_DEFAULT_PARTITION__")}
    assert store.read("t").columns == ["id", "day"] and rows(store.read("t").fillna({"day": "1900-01-01"})) == rows(
        df.fillna({"day": "1900-01-01"}))
    assert store.newest_month("t") == (APR, dt.date(2000, 4, 30))
    assert spoil(f"{tmp_path}/t/v=000001", ["200002", "200003"]) >= 3
    lo, hi = dt.date(2000, 2, 10), dt.date(2000, 3, 5)
    got = store.read("t", dates=(lo, hi)).where(F.col("day").between(lo, hi))
    assert rows(got) == rows(df.where(F.col("day").between(lo, hi)))
    with pytest.raises(Exception, match="(?i)parquet"):
        store.read("t").where(F.col("day") == F.lit(JAN)).collect()


def test_newest_month_at_the_end_of_a_year_and_without_dates(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.write("y", spark.sql("select date'1999-12-31' as day"), dated="day")
    assert store.newest_month("y") == (dt.date(1999, 12, 1), dt.date(1999, 12, 31))
    store.write("n", spark.sql("select cast(null as date) as day, 1 as x"), dated="day")
    assert store.newest_month("n") is None and rows(store.read("n"), "x") == [(1,)]
    store.write("e", spark.sql("select date'1999-12-31' as day, 1 as x").where("x > 1"), dated="day")
    assert store.newest_month("e") is None and store.read("e").count() == 0 and store.read("e").columns == ["day", "x"]
    store.write("u", spark.range(3))
    assert store.newest_month("u") is None and store.newest_month("missing") is None


def test_changes_by_predicate_keep_the_folders(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.write("t", days(spark), dated="day")
    february = F.col("day").between(dt.date(2000, 2, 1), dt.date(2000, 2, 29))
    assert store.delete_where("t", february & (F.col("id") % 2 == 0))[0] == 2
    assert {os.path.basename(os.path.dirname(f)) for f in glob.glob(f"{tmp_path}/t/v=000002/*/*.parquet")} == {"in_month=200002"}
    assert store.read("t").count() == 1205 - 140 and store.newest_month("t") == (APR, dt.date(2000, 4, 30))
    # rows that get another date go to its month; one file of the first version is left twice over
    store.update_where("t", F.col("day") == F.lit(dt.date(2000, 2, 1)), {"day": F.lit("2001-07-04")})
    assert store.newest_month("t") == (dt.date(2001, 7, 1), dt.date(2001, 7, 31))
    moved = store.read("t", dates=(dt.date(2001, 7, 1), dt.date(2001, 7, 31)))
    assert rows(moved, "id") == rows(days(spark).where("day = '2000-02-01'"), "id")
    assert store.read("t").count() == 1205 - 140 and store.read("t").where("day is null").count() == 5
    # all rows of a month go: nothing is written, the rest is read where it lies
    store.delete_where("t", F.year("day") == 2001)
    assert store.newest_month("t") == (APR, dt.date(2000, 4, 30))
    assert store.read("t").count() == 1205 - 140 - moved.count()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    store = SnapshotStore(spark, str(tmp_path_factory.mktemp("lake")))
    lake = Lake(spark, SF_SMALL, placement=Placement(mart=True), store=store, auto_refresh=True)
    lake.refresh("mart.position_with_external_keys")
    lake.refresh("mart.aum_daily_by_portfolio")
    return lake


def test_month_report_opens_one_month(spark, lake):
    whole = lake.get("mart.position_with_external_keys").filter(F.col("position_date").between(JAN, dt.date(2000, 1, 31)))
    expect = rows(whole, "position_id", "position_date", "market_value")
    assert expect
    name = "mart.position_with_external_keys"
    assert spoil(f"{lake.store.root}/{name}/v=000001", ["200001"]) > 10
    got = QUERIES["recon_month"](lake)
    assert rows(got, "position_id", "position_date", "market_value") == expect


def test_as_of_report_opens_the_newest_month(spark, lake):
    name = "mart.aum_daily_by_portfolio"
    whole = lake.get(name)
    last = whole.agg(F.max("position_date")).first()[0]
    expect = rows(whole.filter(F.col("position_date") == last))
    assert spoil(f"{lake.store.root}/{name}/v=000001", [f"{last:%Y%m}"]) > 10
    assert rows(lake.latest(name)) == expect


def test_every_fact_with_a_date_order_is_dated():
    registry._load_all()
    ordered = {n: e for n, e in registry.REGISTRY.items() if any(c.endswith("_date") for c in e.cluster)}
    assert len(ordered) >= 14 and all(e.dated in e.cluster for e in ordered.values())


def test_readers_that_do_without_a_number_get_the_same_rows(spark, lake):
    live = Lake(spark, SF_SMALL)
    cols = ["position_date", "portfolio_sk", "security_sk", "market_value"]
    plain = live.get("mart.fact_position", ids=False)
    assert plain.where("position_id is not null").count() == 0
    assert plain.select(cols).exceptAll(lake.get("mart.fact_position").select(cols)).count() == 0
    # numbered by key columns where it is stored, as whole rows where it is live
    numbered = live.get("mart.fact_position").select("position_id", *cols)
    assert numbered.exceptAll(lake.get("mart.fact_position").select(numbered.columns)).count() == 0
    # Catalyst sees through the first to the sources, the second is cut

    def plan(df):
        return df.select("position_date", "market_value")._jdf.queryExecution().optimizedPlan().toString()
    assert "l_extendedprice" in plan(plain) and "l_extendedprice" not in plan(numbered)
