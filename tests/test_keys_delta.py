import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from lake_helpers import rows
from lakeworks.operators.delta import delta_counts, hash_delta, incremental_agg, merge_update
from lakeworks.operators.keys import build_crosswalk, explode_keys, lookup_keys, lookup_of, merge_insert, resolve_keys
from lakeworks.plans.maintenance import add_mappings, supersede_mappings

D = dt.date
XW_SCHEMA = ("domain_code string, source_system string, source_key string, target_system string, target_key string, "
             "relationship_type string, split_sequence int, effective_start_date date, effective_end_date date, "
             "is_current boolean, crosswalk_sk long, succeeding_record_sk long, preceding_record_sk long")


def test_crosswalk_build_and_resolution(spark):
    a = spark.createDataFrame([("s1", "k1", "E1"), ("s1", "k2", "E2")], "source_system string, source_key string, enterprise_key string")
    b = spark.createDataFrame([("s1", "k1", "E1"), ("s1", "k2", "E9"), ("s1", None, "E0")], a.schema)
    xw = build_crosswalk([a, b])
    assert xw.count() == 3                                           # same pair kept once, NULL key dropped
    facts = spark.createDataFrame([(1, "k1"), (2, "k2"), (3, "zz")], "id int, key string")
    got = rows(resolve_keys(facts, xw, "s1", "key", "ek"), "id", "ek")
    assert got == [(1, "E1"), (2, "E9"), (3, None)]                  # newest wins, unmapped -> NULL
    again = merge_insert(xw, xw, ["source_system", "source_key", "enterprise_key"])
    assert again.count() == xw.count()                               # rerun inserts nothing


def _xw(spark):
    return spark.createDataFrame([
        ("ENTITY", "STATE_STREET", "S1", "ENTERPRISE", "E1", "ONE_TO_ONE", 1, D(1990, 1, 1), None, True, 1, None, None)],
        XW_SCHEMA)


def test_add_mappings_errors(spark):
    batch = spark.createDataFrame([
        ("ENTITY", "STATE_STREET", "S2", "ENTERPRISE", "E2", "ONE_TO_ONE", D(2001, 1, 1)),
        ("FUND", "STATE_STREET", "S3", "ENTERPRISE", "E3", "ONE_TO_ONE", D(2001, 1, 1)),
        ("ENTITY", "NOPE", "S4", "ENTERPRISE", "E4", "ONE_TO_ONE", D(2001, 1, 1)),
        ("ENTITY", "STATE_STREET", "S5", "NOPE", "E5", "ONE_TO_ONE", D(2001, 1, 1)),
        ("ENTITY", "STATE_STREET", "S1", "ENTERPRISE", "E1", "ONE_TO_ONE", D(2001, 1, 1))],
        "domain_code string, source_system string, source_key string, target_system string, target_key string, "
        "relationship_type string, effective_start_date date")
    new_xw, res = add_mappings(_xw(spark), batch)
    codes = dict(rows(res, "source_key", "error_code"))
    assert codes == {"S2": None, "S3": 45001, "S4": 45002, "S5": 45003, "S1": 45004}
    assert new_xw.count() == 2 and rows(res.filter("status = 'INSERTED'"), "crosswalk_sk") == [(2,)]


def test_supersede_chain_of_three(spark):
    xw = _xw(spark)
    b1 = spark.createDataFrame([("ENTITY", "STATE_STREET", "S1", "ENTERPRISE", "E1b"),
                                ("ENTITY", "STATE_STREET", "MISSING", "ENTERPRISE", "E")],
                               "domain_code string, source_system string, source_key string, target_system string, target_key string")
    xw2, r1 = supersede_mappings(xw, b1, D(2000, 1, 1))
    assert dict(rows(r1, "source_key", "error_code")) == {"S1": None, "MISSING": 45005}
    xw3, _ = supersede_mappings(xw2, b1.limit(1).withColumn("target_key", F.lit("E1c")), D(2001, 1, 1))
    chain = {r.crosswalk_sk: r for r in xw3.collect()}
    assert [chain[k].target_key for k in (1, 2, 3)] == ["E1", "E1b", "E1c"]
    assert chain[1].effective_end_date == D(1999, 12, 31) and chain[2].effective_end_date == D(2000, 12, 31)
    assert chain[2].preceding_record_sk == 1 and chain[2].succeeding_record_sk == 3 and chain[3].is_current
    assert sum(r.is_current for r in chain.values()) == 1


def test_hash_delta_null_vs_empty(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "k int, v string")
    src = spark.createDataFrame([(1, "a"), (2, "B"), (3, ""), (5, "e")], "k int, v string")
    acts = dict(rows(hash_delta(src, tgt, ["k"], ["v"]), "k", "action"))
    assert acts == {1: "UNCHANGED", 2: "UPDATE", 3: "UPDATE", 4: "SOFT_DELETE", 5: "INSERT"}
    c = delta_counts(hash_delta(src, tgt, ["k"], ["v"])).collect()[0]
    assert (c.rows_inserted, c.rows_updated, c.rows_soft_deleted, c.rows_unchanged) == (1, 2, 1, 1)


def test_incremental_equals_recompute(spark):
    base = spark.createDataFrame([("p", 1, Decimal("1.00")), ("p", 1, Decimal("2.00")), ("q", 2, Decimal("5.00"))],
                                 "g string, d int, m decimal(18,2)")
    ins = spark.createDataFrame([("p", 1, Decimal("4.00")), ("r", 3, Decimal("7.00"))], base.schema)
    dels = spark.createDataFrame([("q", 2, Decimal("5.00")), ("p", 1, Decimal("1.00"))], base.schema)
    state = incremental_agg(None, base, None, ["g", "d"], ["m"])
    state = incremental_agg(state, ins, dels, ["g", "d"], ["m"])
    assert rows(state, "g", "d", "sum_m", "row_count") == [("p", 1, Decimal("6.00"), 2), ("r", 3, Decimal("7.00"), 1)]


def test_merge_update(spark):
    tgt = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, n int")
    upd = spark.createDataFrame([(2, "B", 99)], "k int, v string, n int")
    assert rows(merge_update(tgt, upd, ["k"], ["v"])) == [(1, "a", 10), (2, "B", 20)]


def test_add_mappings_in_batch_order_and_splits(spark):
    cols = ("domain_code string, source_system string, source_key string, target_system string, target_key string, "
            "relationship_type string, effective_start_date date, split_sequence int")
    one, many = "ONE_TO_ONE", "ONE_TO_MANY"
    batch = spark.createDataFrame([
        ("ENTITY", "STATE_STREET", "S2", "ENTERPRISE", "E2", one, D(2001, 1, 1), None),
        ("ENTITY", "STATE_STREET", "S2", "ENTERPRISE", "E9", one, D(2001, 2, 1), None),      # the key is taken by now
        ("ENTITY", "STATE_STREET", "S6", "ENTERPRISE", "E6a", many, D(2001, 1, 1), 1),
        ("ENTITY", "STATE_STREET", "S6", "ENTERPRISE", "E6b", many, D(2001, 1, 1), 2),       # another part of the split
        ("ENTITY", "STATE_STREET", "S6", "ENTERPRISE", "E6c", many, D(2001, 3, 1), 2),
        ("ENTITY", "STATE_STREET", "S1", "ENTERPRISE", "E1b", many, D(2001, 3, 1), 2)], cols)
    new_xw, res = add_mappings(_xw(spark), batch)
    assert dict(rows(res, "target_key", "error_code")) == {
        "E2": None, "E9": 45004, "E6a": None, "E6b": None, "E6c": 45004, "E1b": None}
    assert new_xw.count() == 5 and new_xw.select("crosswalk_sk").distinct().count() == 5


def test_supersede_one_key_twice_in_a_batch(spark):
    batch = spark.createDataFrame([
        ("ENTITY", "STATE_STREET", "S1", "ENTERPRISE", "E1c", D(2002, 1, 1), None),
        ("ENTITY", "STATE_STREET", "S1", "ENTERPRISE", "E1b", D(2000, 1, 1), "MERGED")],
        "domain_code string, source_system string, source_key string, target_system string, target_key string, "
        "effective_date date, new_relationship_type string")
    xw, res = supersede_mappings(_xw(spark), batch, D(1999, 1, 1))
    chain = {r.target_key: r for r in xw.collect()}
    assert len(chain) == xw.count() == 3 and [k for k, r in chain.items() if r.is_current] == ["E1c"]
    assert chain["E1"].effective_end_date == D(1999, 12, 31) and chain["E1b"].effective_end_date == D(2001, 12, 31)
    assert chain["E1"].succeeding_record_sk == chain["E1b"].crosswalk_sk == chain["E1c"].preceding_record_sk
    assert chain["E1b"].succeeding_record_sk == chain["E1c"].crosswalk_sk
    assert (chain["E1b"].relationship_type, chain["E1c"].relationship_type) == ("MERGED", "ONE_TO_ONE")
    assert dict(rows(res, "target_key", "superseded_sk")) == {"E1b": 1, "E1c": chain["E1b"].crosswalk_sk}


def test_merge_update_with_repeated_keys(spark):
    tgt = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    upd = spark.createDataFrame([(1, "x"), (1, "z"), (1, "y"), (None, "q")], "k int, v string")
    assert sorted(map(tuple, merge_update(tgt, upd, ["k"], ["v"]).collect()), key=str) == [(1, "z"), (None, "n")]


def test_incremental_null_keys_are_one_group(spark):
    base = spark.createDataFrame([(None, 1, Decimal("1.00"))], "g string, d int, m decimal(18,2)")
    state = incremental_agg(None, base, None, ["g", "d"], ["m"])
    state = incremental_agg(state, base, None, ["g", "d"], ["m"])
    assert [tuple(r) for r in state.collect()] == [(None, 1, Decimal("2.00"), 2)]
    over = incremental_agg(state, None, base.unionByName(base).unionByName(base), ["g", "d"], ["m"])
    assert over.count() == 0


def test_merge_insert_matches_on_the_source_key(spark):
    cols = "source_system string, source_key string, enterprise_key string"
    tgt = spark.createDataFrame([("s", "k1", "E1")], cols)
    src = spark.createDataFrame([("s", "k1", "E9"), ("s", "k2", "E2")], cols)
    assert rows(merge_insert(src, tgt, ["source_system", "source_key"])) == [("s", "k1", "E1"), ("s", "k2", "E2")]


def test_lookup_resolves_keys_of_any_form(spark):
    raw = spark.createDataFrame([("SS_PORT_TEAM_01", "EK_PORT_TEAM_01", "sec-1"), ("p2", "EK2", None), (None, "EK3", "p2")],
                                "source_key string, enterprise_key string, security_key string")
    keys = explode_keys(raw, [("state_street", "portfolio", "source_key", F.col("enterprise_key")),
                              ("state_street", "security", "security_key", F.concat(F.lit("EK_"), F.col("security_key")))])
    assert rows(keys, "domain", "source_key", "enterprise_key") == [
        ("portfolio", "SS_PORT_TEAM_01", "EK_PORT_TEAM_01"), ("portfolio", "p2", "EK2"), ("security", "p2", "EK_p2"),
        ("security", "sec-1", "EK_sec-1")]
    plan = keys._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 or plan.count("LocalRelation") <= 1          # one pass over the frame
    by_hand = spark.createDataFrame([("state_street", None, "h1", "EKH"), ("state_street", None, "sec-1", "EK_zz")],
                                    "source_system string, domain string, source_key string, enterprise_key string")
    lookup = lookup_of(keys.unionByName(by_hand))
    facts = spark.createDataFrame([(1, "SS_PORT_TEAM_01"), (2, "p2"), (3, "h1"), (4, "sec-1"), (5, None), (6, "?")], "id int, key string")

    def found(domain, system="state_street"):
        return [r[1] for r in rows(lookup_keys(facts, lookup, system, "key", "ek", domain), "id", "ek")]
    # the newest mapping of a key wins in all domains that name it
    assert found("portfolio") == ["EK_PORT_TEAM_01", "EK_p2", "EKH", "EK_zz", None, None]
    assert found("security") == [None, "EK_p2", "EKH", "EK_zz", None, None]
    assert found(None) == found("portfolio") and found("portfolio", "aspen") == [None] * 6
    whole = keys.unionByName(by_hand).drop("domain")
    assert [r[1] for r in rows(resolve_keys(facts, whole, "state_street", "key", "ek"), "id", "ek")] == found(None)


def test_null_keys_in_deltas_and_merges(spark):
    t = spark.createDataFrame([(None, "a", 1), (2, None, 1)], "k int, v string, w int")
    assert rows(hash_delta(t, t, ["k"], ["v"]).select("action")) == [("UNCHANGED",), ("UNCHANGED",)]
    gone = {r.k: r.action for r in hash_delta(t.where("k = 2"), t, ["k"], ["v"]).collect()}
    assert gone == {2: "UNCHANGED", None: "SOFT_DELETE"}
    from lakeworks.operators.delta import watermark_delta
    newer = spark.createDataFrame([(None, "b", 5), (7, "c", 5)], t.schema)
    assert {r.k: r.action for r in watermark_delta(newer, t, ["k"], "w").collect()} == {None: "UPDATE", 7: "INSERT"}
    once = merge_insert(newer, t, ["k"])
    assert once.count() == 3 and merge_insert(newer, once, ["k"]).count() == 3
