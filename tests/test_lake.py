import os
import shutil
import subprocess
import sys
import tempfile

from pyspark.sql import functions as F

from lake_helpers import SF_SMALL, rows
from lakeworks.plans.registry import S3, Lake
from lakeworks.plans.store import SnapshotStore


def test_snapshot_versions_and_reader_isolation(spark):
    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="lw-store-"))
    v1 = store.write("t.x", spark.range(3))
    old_reader = store.read("t.x")
    v2 = store.write("t.x", spark.range(5))
    assert (v1, v2) == (1, 2) and store.current_version("t.x") == 2
    assert old_reader.count() == 3                      # a reader on the old version keeps it
    assert store.read("t.x").count() == 5 and store.read("t.x", 1).count() == 3
    assert rows(store.history("t.x"), "version", "row_count", "is_current") == [(1, 3, False), (2, 5, True)]


def test_view_mv_freshness_and_parity(spark):
    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="lw-store-"))
    lake = Lake(spark, SF_SMALL, store=store)
    lake.refresh("silver.security_dim")
    view = lake.get("silver.security_dim", mode="view")
    mv = lake.get("silver.security_dim", mode="mv")
    assert view.count() == mv.count()
    assert view.exceptAll(mv).count() == 0 and mv.exceptAll(view).count() == 0
    s3 = Lake(spark, SF_SMALL, placement=S3, store=store)
    assert s3.get("silver.security_dim").count() == mv.count()           # stored layer is read back
    assert store.refresh_log().filter(F.col("entity") == "silver.security_dim").count() == 1


def test_dependency_order_is_known_before_anything_ran(spark):
    # in a process of its own: no builder has run there
    code = ("import sys; sys.path.insert(0, sys.argv[1])\n"
            "from lakeworks.plans.registry import dependency_order, dependencies, _load_all\n"
            "order = dependency_order()\n"
            "_load_all()\n"
            "bad = [(n, d) for n in order for d in dependencies(n) if order.index(d) > order.index(n)]\n"
            "print(bad, len(order), order.index('silver.contract_dim') < order.index('silver.contract_details_fact'),\n"
            "      order.index('silver.security_dim') < order.index('silver.position_analytics_fact'),\n"
            "      order.index('silver.portfolio_dim') < order.index('silver.portfolio_analytics_fact'))")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code, root], capture_output=True, text=True, check=True).stdout.split()
    assert out[0] == "[]" and out[2:] == ["True"] * 3


def _copy(tmp_path):
    target = str(tmp_path / "sf")
    shutil.copytree(SF_SMALL, target)
    os.chmod(target, 0o755)  # the folder too: it is copied as it is, read-only
    for root, dirs, files in os.walk(target):
        for n in dirs + files:
            os.chmod(os.path.join(root, n), 0o755)
    return target


def _cut_lineitem(spark, sf, keep):
    """Replace lineitem by some of its rows."""
    os.remove(f"{sf}/lineitem.parquet")
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").filter(keep).write.parquet(f"{sf}/lineitem.parquet")


def test_refresh_sees_changed_sources(spark, tmp_path):
    sf = _copy(tmp_path)
    store = SnapshotStore(spark, str(tmp_path / "store"))
    lake = Lake(spark, sf, store=store)
    lake.refresh("bronze.position")
    before = store.read("bronze.position").count()
    assert lake.get("bronze.position").count() == before
    _cut_lineitem(spark, sf, "l_orderkey % 2 = 0")
    lake.refresh("bronze.position")                      # the same lake
    after = store.read("bronze.position").count()
    assert 0 < after < before
    assert lake.get("bronze.position").count() == after
    assert after == Lake(spark, sf).get("bronze.position").count()


def test_crosswalk_follows_files_in_nested_folders(spark, tmp_path):
    sf = _copy(tmp_path)
    rows_ = spark.read.parquet(f"{SF_SMALL}/supplier.parquet")
    os.remove(f"{sf}/supplier.parquet")
    rows_.filter("s_suppkey <= 3").write.parquet(f"{sf}/supplier.parquet/day=1")
    few = Lake(spark, sf).get("bronze.crosswalk").filter("source_key LIKE 'SUP%'").count()
    rows_.filter("s_suppkey > 3").write.parquet(f"{sf}/supplier.parquet/day=1/more")
    spark.read.parquet(f"{sf}/supplier.parquet/day=1/more").coalesce(1).write.mode("append").parquet(f"{sf}/supplier.parquet/day=1")
    assert Lake(spark, sf).get("bronze.crosswalk").filter("source_key LIKE 'SUP%'").count() >= few
    from lakeworks.plans.registry import _fingerprint
    assert any("day=1/more" in f[1] for f in _fingerprint(Lake(spark, sf)))


def test_parity_can_fail_and_skip(spark, tmp_path):
    from lakeworks.plans.gates import parity_rows
    store = SnapshotStore(spark, str(tmp_path / "store"))
    lake = Lake(spark, SF_SMALL, store=store)
    name = "bronze.position"
    assert rows(parity_rows(lake, [name]), "status") == [("SKIP",)]
    lake.refresh(name)
    assert rows(parity_rows(lake, [name]), "status") == [("PASS",)]
    store.write(name, store.read(name).limit(5))
    assert rows(parity_rows(lake, [name]), "status") == [("FAIL",)]


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    v1 = store.write("t.x", spark.range(3))
    v2 = store.write("t.x", spark.range(9))
    os.remove(f"{tmp_path}/store/t.x/v={v2:06d}/_SUCCESS")      # as after a crash
    assert store.current_version("t.x") == v1 and store.read("t.x").count() == 3
    assert store.write("t.x", spark.range(4)) > v2 and store.read("t.x").count() == 4


def test_every_refreshed_entity_can_be_read(spark, tmp_path):
    """Refresh one entity of each layer with its stored inputs."""
    store = SnapshotStore(spark, str(tmp_path / "store"))
    lake = Lake(spark, SF_SMALL, placement=S3, store=store, auto_refresh=True)
    for n in ("bronze.asset", "silver.business_unit_dim", "gold.security_dim"):
        lake.refresh(n)
        assert store.read(n).count() > 0
    assert store.refresh_log().count() == 3


def test_cascade_refresh_builds_missing_upstream(spark):
    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="lw-store-"))
    lake = Lake(spark, SF_SMALL, placement=S3, store=store, auto_refresh=True)
    n = lake.get("gold.consolidated_position_book").count()
    assert store.exists("silver.position_analytics_fact") and store.exists("gold.position_analytics_fact")
    assert n == Lake(spark, SF_SMALL).get("gold.consolidated_position_book").count()


def test_streaming_multi_batch_equals_batch(spark):
    from lakeworks.streaming.refresh import cash_flow_rows, streaming_refresh
    src = tempfile.mkdtemp(prefix="lw-stream-")
    ev = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))
    for k in range(4):
        ev.filter(F.col("event_id") % 4 == k).coalesce(1).write.parquet(os.path.join(src, f"batch={k}"))
    state = streaming_refresh(spark, os.path.join(src, "*"), ev.schema)
    expect = cash_flow_rows(ev).groupBy("portfolio_source_key", "cash_flow_date", "cash_flow_type").agg(
        F.sum("amount_local").alias("s"), F.count(F.lit(1)).alias("n"))
    assert rows(state, "portfolio_source_key", "cash_flow_date", "cash_flow_type", "sum_amount_local", "row_count") == \
        rows(expect, "portfolio_source_key", "cash_flow_date", "cash_flow_type", "s", "n")


def test_stream_continues_and_replays_once(spark, tmp_path):
    from lakeworks.streaming.refresh import cash_flow_rows, partials, streaming_refresh, write_batch
    src, root = str(tmp_path / "src"), str(tmp_path / "root")
    ev = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))

    def total(df):
        return df.agg(F.sum("row_count")).first()[0]
    ev.filter("event_id % 2 = 0").coalesce(1).write.parquet(os.path.join(src, "batch=0"))
    first = total(streaming_refresh(spark, os.path.join(src, "*"), ev.schema, root=root))
    ev.filter("event_id % 2 = 1").coalesce(1).write.parquet(os.path.join(src, "batch=1"))
    state = streaming_refresh(spark, os.path.join(src, "*"), ev.schema, root=root)     # a later run goes on
    assert 0 < first < total(state) == cash_flow_rows(ev).count()
    write_batch(root, spark.read.schema(ev.schema).parquet(os.path.join(src, "batch=1")), 1)   # replayed
    assert total(partials(spark, root)) == cash_flow_rows(ev).count()
