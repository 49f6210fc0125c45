"""Change capture, segmented windows and overlap-safe intervals against brute force."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lake_helpers import rows
from lakeworks.operators.changes import CHANGE, changes, merged_state, star_changes, state_of
from lakeworks.operators.segments import segmented_window
from lakeworks.operators.temporal import disjoint, overlapping, temporal_join, valid_at

D = dt.date


def fact_rows(g, n):
    return [(g.choice([1, 2, 3, None]), D(2000, 1, 1) + dt.timedelta(days=g.randrange(9)), g.choice([1, 2, 3]),
             g.choice([None, Decimal("1.50"), Decimal("-2.25"), Decimal("7.00")])) for _ in range(n)]


FACT = "p int, d date, e int, m decimal(18,2)"


@pytest.mark.parametrize("by", [(), ("d",), ("p", "d")])
def test_changes_equal_multiset_difference(spark, by):
    g = random.Random(len(by))
    old = fact_rows(g, 300)
    new = old[20:] + fact_rows(g, 25) + old[40:42]
    got = {tuple(r)[:-1]: r[CHANGE] for r in changes(spark.createDataFrame(old, FACT), spark.createDataFrame(new, FACT), by).collect()}
    want = Counter(new)
    want.subtract(Counter(old))
    assert got == {k: v for k, v in want.items() if v}


def test_star_changes_bring_state_up_to_date(spark):
    g = random.Random(7)
    facts = [fact_rows(g, 200)]
    facts.append(facts[0][5:] + fact_rows(g, 9))
    dims = [[(1, "x"), (2, "y"), (3, "y")], [(1, "x"), (2, "z"), (3, "y"), (3, "again")]]

    def star(f):
        cols = [c for c in ("p", "d", "m", "kind", CHANGE) if c in f["fact"].columns + f["dim"].columns]
        return f["fact"].join(f["dim"], "e").select(*cols)

    old, new = ({"fact": spark.createDataFrame(f, FACT), "dim": spark.createDataFrame(d, "e int, kind string")} for f, d in zip(facts, dims))
    keys = ["p", "d", "kind"]
    state = state_of(star(old), keys, ["m"])
    change = star_changes(star, old, new, {"fact": ("d",), "dim": ()})
    after = merged_state(state, state_of(change, keys, ["m"]), keys)
    full = state_of(star(new), keys, ["m"])
    assert Counter(map(tuple, after.select(*full.columns).collect())) == Counter(map(tuple, full.collect()))
    assert star_changes(star, old, new, {}) is None
    none = state_of(star_changes(star, old, old, {"fact": ()}), keys, ["m"])
    assert none.count() == 0


def test_segmented_windows_equal_plain_ones(spark):
    g = random.Random(3)
    days = {p: sorted(g.sample(range(6000), n)) for p, n in ((1, 1500), (2, 400), (3, 1), (None, 700))}
    data = [(p, D(1990, 1, 1) + dt.timedelta(days=k), g.randrange(1000)) for p, ks in days.items() for k in ks]
    df = spark.createDataFrame(data, "p int, d date, v long")
    w = Window.partitionBy("p").orderBy("d")
    plain = df.withColumn("s", F.sum("v").over(w.rowsBetween(-29, 0))).withColumn("l", F.lag("v", 365).over(w))
    for block in (1, 400, 4096):
        got = segmented_window(df, ["p"], ["d"], F.year("d"), 365, {
            "s": lambda w: F.sum("v").over(w.rowsBetween(-29, 0)), "l": lambda w: F.lag("v", 365).over(w)}, block)
        assert Counter(map(tuple, got.select(*plain.columns).collect())) == Counter(map(tuple, plain.collect()))


def test_a_hot_partition_is_spread_over_tasks(spark):
    df = spark.range(20_000).select(F.lit(1).alias("p"), F.date_add(F.lit(D(1950, 1, 1)), F.col("id").cast("int")).alias("d"), "id")
    got = segmented_window(df, ["p"], ["d"], F.year("d"), 10, {"n": lambda w: F.count("id").over(w)}, 1000)
    # no window holds more than a block and its halo
    assert got.agg(F.max("n")).first()[0] == 1010 and got.count() == 20_000


def versions(g, n, keys, hot=0):
    out = []
    for i in range(n + hot):
        s = D(1999, 1, 1) + dt.timedelta(days=g.randrange(1500))
        e = None if g.random() < 0.1 else s + dt.timedelta(days=g.randrange(400))
        out.append((g.choice(keys) if i < n else "hot", s, e, i))
    return out


DIM = "k string, s date, e date, sk int"


def best_on(vs, key, day):
    live = [v for v in vs if v[0] == key and v[1] <= day and (v[2] is None or v[2] >= day)]
    return max(live, key=lambda v: (v[1], v[3]))[3] if live else None


def test_intervals_equal_brute_force(spark):
    g = random.Random(5)
    vs = versions(g, 60, list("abcdefghijklmn"), hot=120) + [("z", D(2000, 1, 1), D(2000, 6, 1), 900), ("z", D(2000, 6, 2), None, 901)]
    dim = spark.createDataFrame(vs, DIM)
    got = {r.sk for r in overlapping(dim, ["k"], "s", "e").collect()}
    far = D(9999, 12, 31)
    order = sorted(vs, key=lambda v: (v[1], v[2] or far))
    want = set()
    for i, v in enumerate(order):
        ends = [u[2] or far for u in order[:i] if u[0] == v[0]]
        if ends and max(ends) >= v[1]:
            want.add(v[3])
    assert {v for v in got ^ want if Counter((x[0], x[1]) for x in vs)[next((x[0], x[1]) for x in vs if x[3] == v)] < 2} == set()
    facts = [(i, g.choice([*"abcdefghijklmn", "hot", "z", "none"]), D(1998, 12, 1) + dt.timedelta(days=g.randrange(2200))) for i in range(400)]
    f = spark.createDataFrame(facts, "id int, fk string, d date")
    want = sorted((i, best_on(vs, k, d)) for i, k, d in facts)
    for bins in (None, 90):
        j = temporal_join(f, dim, "fk", "k", "d", "s", "e", open_end=True, on_overlap="latest", newest=[F.col("sk").desc()], bin_days=bins)
        assert sorted((r.id, r.sk) for r in j.collect()) == want
    flat = disjoint(dim, ["k"], "s", "e", [F.col("sk").desc()])
    assert overlapping(flat, ["k"], "s", "e").count() == 0
    assert rows(flat.where("k = 'z'"), "sk", "s") == [(900, D(2000, 1, 1)), (901, D(2000, 6, 2))]
    day = D(2000, 7, 1)
    at = {r.k: r.sk for r in valid_at(dim, ["k"], day, "s", "e", ["sk"]).collect()}
    assert at == {k: best_on(vs, k, day) for k in {v[0] for v in vs} if best_on(vs, k, day) is not None}


def test_overlaps_can_be_an_error(spark):
    f = spark.createDataFrame([(1, "a", D(2000, 5, 1))], "id int, fk string, d date")
    fine = spark.createDataFrame([("a", D(2000, 1, 1), D(2000, 6, 1), 1), ("a", D(2000, 6, 2), None, 2)], DIM)
    assert temporal_join(f, fine, "fk", "k", "d", "s", "e", on_overlap="error").first().sk == 1
    bad = fine.unionByName(spark.createDataFrame([("a", D(2000, 5, 30), D(2000, 7, 1), 3)], DIM))
    with pytest.raises(Exception, match="overlap"):
        temporal_join(f, bad, "fk", "k", "d", "s", "e", on_overlap="error").collect()
