"""Entities against their stored versions, and long lists of source keys in pages."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from lake_helpers import SF_SMALL, rows
from lakeworks.operators.keys import source_keys_of
from lakeworks.plans.gates import entity_coverage
from lakeworks.plans.registry import Lake, Placement
from lakeworks.plans.store import SnapshotStore


def test_source_keys_come_in_pages(spark):
    g = random.Random(4)
    mappings = {(g.choice("AB"), f"KEY{g.randrange(900):04d}", "HOT") for _ in range(400)}     # a third of all rows or more
    mappings |= {(g.choice("ABC"), f"K{i}", f"E{i % 200}") for i in range(600)}
    mappings |= {("A", "", "E0"), ("B", "é漢", "E0"), ("A", "K7", "OTHER"), ("A", "lost", None)}
    df = spark.createDataFrame(sorted(mappings, key=str), "source_system string, source_key string, enterprise_key string")
    df = df.withColumn("page", F.lit("clash")).repartition(4)
    want = defaultdict(list)
    for s, k, e in sorted(mappings, key=lambda m: (m[0], m[1].encode())):
        want[e].append((s, k))
    pages = {(e, i // 16): own[i:i + 16] for e, own in want.items() for i in range(0, len(own), 16)}
    got = source_keys_of(df, page=16).collect()
    assert {(r.enterprise_key, r.page): [tuple(x) for x in r.source_keys] for r in got} == pages and len(got) == len(pages)
    assert len(want["HOT"]) > 300 and source_keys_of(df.limit(0)).count() == 0


def test_entities_are_held_against_their_stored_versions(spark, tmp_path):
    lake = Lake(spark, SF_SMALL, placement=Placement(silver=True), store=SnapshotStore(spark, str(tmp_path)))
    names = [f"silver.{n}" for n in ("security_dim", "portfolio_dim", "business_unit_dim")]
    for n in names[:2]:
        lake.refresh(n)
    seen = ("entity", "version", "only_live", "only_stored", "coverage")
    n = len(lake.get(names[2], mode="view").columns)
    assert rows(entity_coverage(lake, names), *seen) == sorted([
        (names[0], 1, 0, 0, "COVERED"), (names[1], 1, 0, 0, "COVERED"), (names[2], None, n, 0, "MISSING")])
    old = lake.store.read(names[0])
    lake.store.write(names[0], old.drop("is_current").withColumn("more", F.lit(1)).withColumn("security_sk", F.lit("1")))
    found = {r.entity: r for r in entity_coverage(lake, names[:1]).collect()}
    assert (found[names[0]].only_live, found[names[0]].only_stored, found[names[0]].coverage) == (2, 2, "DIFFERENT")
