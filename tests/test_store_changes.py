"""Deletes and updates by predicate rewrite only the files that hold a match."""

from pyspark.sql import functions as F

from lake_helpers import rows
from lakeworks.plans.registry import S0, S1, S2, S3, S4
from lakeworks.plans.store import SnapshotStore


def test_only_touched_files_are_rewritten(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    df = spark.range(100).select("id", (F.col("id") % 3).alias("k"), F.when(F.col("id") != 7, F.col("id")).alias("v"))
    store.write("t", df.repartitionByRange(5, "id"))
    before = set(store.read("t").inputFiles())
    assert len(before) == 5
    old = store.read("t")
    version, n = store.delete_where("t", F.col("v").between(3, 12))
    assert (version, n) == (2, 1)
    after = set(store.read("t").inputFiles())
    assert len(before & after) == 4 and store.current_version("t") == 2
    assert [r.id for r in store.read("t").orderBy("id").collect()] == [0, 1, 2, 7, *range(13, 100)]   # v is null for 7
    assert old.count() == 100 and store.read("t", 1).count() == 100                                   # readers keep theirs
    assert store.update_where("t", F.col("id") >= 60, {"k": F.lit(9)}) == (3, 2)
    assert rows(store.read("t").where("k = 9").agg(F.min("id"), F.count("id"))) == [(60, 40)]
    assert store.delete_where("t", F.col("id") < 0) == (3, 0)                                         # nothing to do
    assert rows(store.history("t"), "version", "row_count") == [(1, 100), (2, 91), (3, 91)]


def test_partitioned_snapshots_and_shapes(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.write("t", spark.range(20).withColumn("p", F.col("id") % 2), ["p"])
    store.delete_where("t", F.col("p") == 1)
    assert store.read("t").count() == 10 and set(store.read("t").columns) == {"id", "p"}
    store.clone_shape("t", "like")
    assert store.read("like").count() == 0 and store.read("like").schema == store.read("t").schema


def test_placements():
    stored = {n: [p.stored(layer) for layer in ("silver", "gold", "mart")] for n, p in zip("01234", (S0, S1, S2, S3, S4))}
    assert stored == {"0": [False] * 3, "1": [False, True, False], "2": [True, False, False], "3": [True, True, False], "4": [True] * 3}
