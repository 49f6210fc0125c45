import datetime as dt
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from lake_helpers import rows
from lakeworks.operators.dedup import latest_wins
from lakeworks.operators.fx import normalize_currency
from lakeworks.operators.rowid import dense_row_id
from lakeworks.operators.scd2 import apply_scd2, close_versions, scd2_chain, soft_delete
from lakeworks.operators.snapshot import month_end_snapshot
from lakeworks.operators.temporal import temporal_join
from lakeworks.operators.windows import dense_rank_within, share_of_total

D = dt.date


def test_latest_wins_ties_single_and_null(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("b", 5, "p"), ("b", 5, "q"), ("c", None, "n"), ("c", 1, "m"), ("d", 1, "s")],
        "k string, loaded int, v string")
    out = latest_wins(df, ["k"], [F.col("loaded").desc_nulls_last(), F.col("v")])
    assert rows(out, "k", "v") == [("a", "y"), ("b", "p"), ("c", "m"), ("d", "s")]


def test_dense_row_id_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("a"), (F.col("id") % 13).alias("b"))
    expect = df.withColumn("rn", F.row_number().over(Window.orderBy("b", "a")))
    for parts in (1, 3, 11):
        got = dense_row_id(df.repartition(parts), ["b", "a"], "rid")
        assert rows(got, "a", "b", "rid") == rows(expect, "a", "b", "rn")
    bounded = dense_row_id(df, ["b", "a"], "rid", bounded=True)
    assert rows(bounded, "a", "b", "rid") == rows(expect, "a", "b", "rn")


def test_scd2_chain_versions_null_and_future(spark):
    df = spark.createDataFrame([
        ("k1", D(2000, 1, 1), 1), ("k2", None, 1), ("k2", D(2001, 1, 1), 2),
        ("k3", D(1999, 1, 1), 1), ("k3", D(2005, 6, 1), 2), ("k3", D(2030, 1, 1), 3)],
        "key string, start date, ver int")
    ch = scd2_chain(df, "key", [F.col("start").asc_nulls_first(), F.col("ver")], "start", "sk")
    got = {(r.key, r.ver): r for r in ch.collect()}
    assert got[("k1", 1)].effective_start_date == D(2000, 1, 1)
    assert got[("k1", 1)].effective_end_date == D(9999, 12, 31) and got[("k1", 1)].is_current
    assert got[("k2", 1)].effective_start_date == D(1900, 1, 1)
    assert got[("k2", 1)].effective_end_date == D(2000, 12, 31)
    assert got[("k3", 2)].effective_end_date == D(2029, 12, 31)
    assert got[("k3", 3)].is_current and not got[("k3", 2)].is_current       # future-dated version is current
    assert got[("k3", 2)].preceding_record_sk == got[("k3", 1)].sk
    assert got[("k3", 2)].succeeding_record_sk == got[("k3", 3)].sk
    assert got[("k1", 1)].preceding_record_sk is None


def _dim(spark):
    return spark.createDataFrame([
        (1, "a", D(2000, 1, 1), D(9999, 12, 31), True, None, None),
        (2, "b", D(2000, 1, 1), D(9999, 12, 31), True, None, None)],
        "sk long, key string, effective_start_date date, effective_end_date date, is_current boolean, "
        "preceding_record_sk long, succeeding_record_sk long")


def test_close_apply_soft_delete(spark):
    dim = _dim(spark)
    ch = spark.createDataFrame([(D(2001, 1, 1), "a")], "effective_start_date date, key string")
    out = {r.sk: r for r in apply_scd2(dim, ch, "key", "sk").collect()}
    assert out[1].effective_end_date == D(2000, 12, 31) and not out[1].is_current
    assert out[1].succeeding_record_sk == 3 and out[3].preceding_record_sk == 1 and out[3].is_current
    assert out[2].is_current and out[2].effective_end_date == D(9999, 12, 31)      # untouched key
    dels = spark.createDataFrame([("b", D(2002, 3, 4))], "key string, event_date date")
    sd = {r.sk: r for r in soft_delete(dim, dels, "key", "sk").collect()}
    assert sd[2].effective_end_date == D(2002, 3, 4) and not sd[2].is_current    # inclusive, not -1
    closed = close_versions(dim, spark.createDataFrame([(1, D(2003, 1, 1), 9)], "sk long, close_date date, successor_sk long"), "sk")
    assert {r.sk: r.effective_end_date for r in closed.collect()}[1] == D(2002, 12, 31)


def test_temporal_join_edges(spark):
    dim = spark.createDataFrame([("k", D(2000, 1, 1), D(2000, 1, 31), 1), ("k", D(2000, 2, 5), None, 2)],
                                "dk string, s date, e date, v int")
    fact = spark.createDataFrame([(1, "k", D(2000, 1, 1)), (2, "k", D(2000, 1, 31)), (3, "k", D(2000, 2, 2)),
                                  (4, "k", D(1999, 1, 1)), (5, "k", D(2010, 1, 1))], "id int, fk string, d date")
    closed = temporal_join(fact, dim, "fk", "dk", "d", "s", "e", how="left")
    assert rows(closed, "id", "v") == [(1, 1), (2, 1), (3, None), (4, None), (5, None)]
    opened = temporal_join(fact, dim, "fk", "dk", "d", "s", "e", how="left", open_end=True)
    assert rows(opened, "id", "v") == [(1, 1), (2, 1), (3, None), (4, None), (5, 2)]


def test_fx_default_null_mode_and_half_cent(spark):
    fx = spark.createDataFrame([("EUR", "USD", D(2000, 1, 1), Decimal("1.50000000"))],
                               "from_currency string, to_currency string, rate_date date, fx_rate decimal(18,8)")
    df = spark.createDataFrame([(1, "USD", D(2000, 1, 1), Decimal("10.00")), (2, "EUR", D(2000, 1, 1), Decimal("0.01")),
                                (3, "EUR", D(2000, 1, 2), Decimal("3.00"))], "id int, ccy string, d date, amt decimal(18,2)")
    one = {r.id: r.usd for r in normalize_currency(df, fx, {"usd": "amt"}, "ccy", "d").collect()}
    assert one == {1: Decimal("10.00"), 2: Decimal("0.02"), 3: Decimal("3.00")}   # 0.015 rounds half up
    null = {r.id: r.usd for r in normalize_currency(df, fx, {"usd": "amt"}, "ccy", "d", missing="null").collect()}
    assert null[1] is None and null[3] is None


def test_month_end_modes(spark):
    df = spark.createDataFrame([("p", D(2000, 2, 29), 1), ("p", D(2000, 2, 10), 2), ("p", D(2000, 3, 30), 4),
                                ("q", D(2000, 3, 31), 8)], "k string, d date, v int")
    cal = month_end_snapshot(df, "d", ["k"], [F.sum("v").alias("v")])
    assert rows(cal, "k", "monthend_date", "v") == [("p", D(2000, 2, 29), 1), ("q", D(2000, 3, 31), 8)]
    last = month_end_snapshot(df, "d", ["k"], [F.sum("v").alias("v")], mode="last_in_month")
    assert rows(last, "k", "monthend_date", "v") == [("p", D(2000, 2, 29), 1), ("p", D(2000, 3, 31), 4),
                                                     ("q", D(2000, 3, 31), 8)]


def test_share_and_dense_rank_match_windows(spark):
    df = spark.createDataFrame([("g", 1, 5.0), ("g", 2, 5.0), ("g", 3, 2.0), ("h", 4, 0.0), ("h", 5, 0.0),
                                ("i", 6, None)], "g string, id int, v double")
    s = {r.id: r.share for r in share_of_total(df, ["g"], "v", "share").collect()}
    assert s[1] == 5.0 / 12.0 and s[4] is None and s[6] is None            # zero / NULL totals -> NULL
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    expect = df.withColumn("r", F.dense_rank().over(w))
    got = dense_rank_within(df, ["g"], "v", "r")
    assert rows(got, "id", "r") == rows(expect, "id", "r")


def test_scd2_chain_keeps_null_keys(spark):
    from lakeworks.operators.scd2 import scd2_chain
    df = spark.createDataFrame([(None, 1, dt.date(2000, 1, 1)), (None, 2, dt.date(2001, 1, 1)), ("a", 1, None)],
                               "k string, v int, d date")
    got = {(r.k, r.v): r for r in scd2_chain(df, "k", [F.col("v")], "d", "sk").collect()}
    assert len(got) == 3 and got[None, 1].effective_end_date == dt.date(2000, 12, 31)
    assert [got[None, v].is_current for v in (1, 2)] == [False, True] and got["a", 1].is_current


def test_apply_scd2_with_several_changes_to_a_key(spark):
    from lakeworks.operators.scd2 import apply_scd2, scd2_chain
    dim = scd2_chain(spark.createDataFrame([("a", 1, dt.date(2000, 1, 1)), ("b", 1, dt.date(2000, 1, 1))],
                                           "k string, v int, d date"), "k", [F.col("v")], "d", "sk") \
        .select("sk", "k", "v", "effective_start_date", "effective_end_date", "is_current", "preceding_record_sk",
                "succeeding_record_sk")
    changes = spark.createDataFrame([("a", 5, dt.date(2002, 1, 1)), ("a", 4, dt.date(2001, 1, 1)),
                                     ("a", 3, dt.date(2001, 1, 1)), ("c", 9, dt.date(2001, 1, 1))],
                                    "k string, v int, effective_start_date date")
    out = apply_scd2(dim, changes, "k", "sk").collect()
    a = sorted((r for r in out if r.k == "a"), key=lambda r: r.effective_start_date)
    assert [r.v for r in a] == [1, 4, 5] and [r.is_current for r in a] == [False, False, True]
    assert [str(r.effective_end_date) for r in a] == ["2000-12-31", "2001-12-31", "9999-12-31"]
    assert [r.succeeding_record_sk for r in a] == [a[1].sk, a[2].sk, None]
    assert [r.preceding_record_sk for r in a] == [None, a[0].sk, a[1].sk]
    assert len(out) == 5 and len({r.sk for r in out}) == 5


def test_close_versions_with_a_repeated_change(spark):
    from lakeworks.operators.scd2 import close_versions
    dim = spark.createDataFrame([(1, True, dt.date(9999, 12, 31), None)],
                                "sk long, is_current boolean, effective_end_date date, succeeding_record_sk long")
    changes = spark.createDataFrame([(1, dt.date(2001, 1, 1), 7), (1, dt.date(2000, 1, 1), 6), (None, dt.date(2000, 1, 1), 5)],
                                    "sk long, close_date date, successor_sk long")
    assert [tuple(r) for r in close_versions(dim, changes, "sk").collect()] == [(1, False, dt.date(1999, 12, 31), 6)]


def test_numbers_by_key_columns_alone(spark):
    """``of``: only the order columns are numbered; rows that share them share the number."""
    of = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("a", None)], "k string, n int")
    whole = dense_row_id(of, ["k", "n"], "id")
    rich = of.join(spark.createDataFrame([(1, "x"), (2, "y"), (2, "z")], "n int, v string"), "n", "left")
    got = dense_row_id(rich, ["k", "n"], "id", of=of)
    by_key = {(r.k, r.n): r.id for r in whole.collect()}
    assert sorted(by_key.values()) == [1, 2, 3, 4]
    assert got.count() == 5 and all(r.id == by_key[r.k, r.n] for r in got.collect())
    assert dense_row_id(of.limit(0), ["k", "n"], "id", of=of.limit(0)).count() == 0


def test_latest_wins_with_null_and_alike_keys(spark):
    df = spark.createDataFrame([("EK_POS_1", 1), ("EK_POS_1", 5), ("EK_POS_10", 2), (None, 3), (None, 4)], "k string, v int")
    got = {r.k: r.v for r in latest_wins(df, ["k"], [F.col("v").desc()]).collect()}
    assert got == {"EK_POS_1": 5, "EK_POS_10": 2, None: 4}
