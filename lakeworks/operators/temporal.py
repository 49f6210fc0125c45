"""Temporal (SCD2 interval) joins and anchor resolution.

Every temporal join carries an equality key, so Spark plans a hash / sort-merge
join on the key with the date range as a residual - never a nested loop.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.config import OPEN_END

EPOCH = dt.date(1970, 1, 1)
LAST_DAY = OPEN_END - dt.timedelta(days=1)


OVERLAP = "versions of one key overlap"


def overlapping(dim: DataFrame, key: Sequence[str], start_col: str, end_col: str) -> DataFrame:
    """``dim``'s rows that begin before an earlier row of their key has ended.

    An interval sweep: in order of the start, a row overlaps if the greatest end
    so far reaches its start. A key's rows are swept year by year, with the
    greatest end of all earlier years carried in, so that a key with very many
    versions isn't sorted in one task. NULL ends are open; keys may be NULL."""
    end = F.coalesce(F.col(end_col), F.lit(OPEN_END))
    d = dim.withColumn("__year", F.year(start_col)).withColumn("__end", end)
    years = d.groupBy(*key, "__year").agg(F.max("__end").alias("__most"))
    earlier = Window.partitionBy(*key).orderBy("__year").rowsBetween(Window.unboundedPreceding, -1)  # a row for each year
    years = years.select(*[F.col(c).alias(f"__y_{c}") for c in [*key, "__year"]], F.max("__most").over(earlier).alias("__before"))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__y_{c}")) for c in [*key, "__year"]])
    here = Window.partitionBy(*key, "__year").orderBy(start_col, "__end").rowsBetween(Window.unboundedPreceding, -1)
    swept = d.join(years, same).withColumn("__reach", F.greatest(F.max("__end").over(here), F.col("__before")))
    return swept.where(F.col("__reach") >= F.col(start_col)).select(*dim.columns)


def disjoint(dim: DataFrame, key: Sequence[str], start_col: str, end_col: str, newest: Sequence[Column] = ()) -> DataFrame:
    """``dim`` with versions of a key that never overlap: on each day the one that
    started last counts (then ``newest``), and an earlier one counts again once
    it has ended. Only keys with overlaps are taken apart: their starts and the
    days after their ends cut the time into stretches, which meet the versions
    of their key in bins of a year, and of each stretch one version is kept."""
    bad = overlapping(dim, key, start_col, end_col).select(*key).distinct()
    same = reduce(lambda x, y: x & y, [dim[c].eqNullSafe(bad[c]) for c in key])
    fine, mixed = dim.join(bad, same, "left_anti"), dim.join(bad, same, "left_semi")
    end = F.coalesce(F.col(end_col), F.lit(OPEN_END))
    points = mixed.select(*key, F.explode(F.array(F.col(start_col), F.date_add(F.least(end, F.lit(LAST_DAY)), 1))).alias("__from")).distinct()
    nxt = F.lead("__from").over(Window.partitionBy(*key).orderBy("__from"))  # of the keys with overlaps only
    cuts = points.withColumn("__next", nxt).where("__next is not null").withColumn("__bin", F.year("__from"))
    bins = cuts.select(*key, "__bin").distinct()
    versions = _with_bins(mixed, bins, key, start_col, end)
    k = [*key, "__bin"]
    same = reduce(lambda x, y: x & y, [versions[c].eqNullSafe(cuts[c]) for c in k])
    held = versions.join(cuts.select(*k, "__from", "__next"), same & (F.col(start_col) <= F.col("__from")) & (end >= F.col("__from")))
    held = held.select(*[versions[c] for c in dim.columns], "__from", "__next")
    last = Window.partitionBy(*key, "__from").orderBy(F.col(start_col).desc(), *newest)
    held = held.withColumn("__rn", F.row_number().over(last)).where("__rn = 1")
    until = F.date_sub(F.col("__next"), 1)
    open_ = F.col(end_col).isNull() & (until >= F.lit(LAST_DAY))
    own = held.withColumn("__end", F.when(~open_, until)).withColumn(start_col, F.col("__from")).withColumn(end_col, F.col("__end"))
    return fine.unionByName(own.select(*dim.columns))


def _with_bins(dim: DataFrame, bins: DataFrame, key: Sequence[str], start_col: str, end: Column) -> DataFrame:
    """A version once for each of its key's bins that it reaches into."""
    b = bins.select(*[F.col(c).alias(f"__b_{c}") for c in key], "__bin")
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__b_{c}")) for c in key])
    reaches = (F.year(start_col) <= F.col("__bin")) & (F.year(end) >= F.col("__bin"))
    return dim.join(b, same & reaches).drop(*[f"__b_{c}" for c in key])


def valid_at(dim: DataFrame, key: Sequence[str], as_of, start_col: str = "effective_start_date",
             end_col: str = "effective_end_date", newest: Sequence[str] = ()) -> DataFrame:
    """The time slice of a versioned table: of each key the version valid on
    ``as_of`` (of several the one that started last, then by ``newest``). A
    partial max-by aggregate, no window: map tasks send one row a key."""
    day = F.lit(as_of).cast("date")
    live = dim.where((F.col(start_col) <= day) & (F.col(end_col).isNull() | (F.col(end_col) >= day)))
    row = F.struct(*[F.col(c) for c in dim.columns])
    best = F.max_by(row, F.struct(F.col(start_col), *[F.col(c) for c in newest]))
    return live.groupBy(*[F.col(c).alias(f"__k_{c}") for c in key]).agg(best.alias("__row")).select("__row.*")


def temporal_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, date_col: str,
                  start_col: str = "effective_start_date", end_col: str = "effective_end_date",
                  how: str = "left", open_end: bool = False, on_overlap: str | None = None,
                  newest: Sequence[Column] = (), bin_days: int | None = None) -> DataFrame:
    """Join each fact row to the dimension version valid on ``date_col``.

    Inclusive on both ends. ``open_end`` treats a NULL end as open (J4).
    Dimension columns must not clash with fact column names. Where versions of a
    key overlap a fact row has several partners, unless ``on_overlap`` is
    "latest" (the version that started last counts, see :func:`disjoint`) or
    "error" (the job fails). With ``bin_days`` facts and versions meet by key and
    stretch of so many days, for keys with very many versions."""
    if on_overlap == "error":
        bad = overlapping(dim, [dim_key], start_col, end_col).limit(1).select(F.lit(1).alias("__bad"))
        dim = dim.join(F.broadcast(bad.agg(F.count(F.lit(1)).alias("__bad"))))  # one row
        dim = dim.where(F.when(F.col("__bad") > 0, F.raise_error(F.lit(OVERLAP)).cast("boolean")).otherwise(F.lit(True))).drop("__bad")
    elif on_overlap == "latest":
        dim = disjoint(dim, [dim_key], start_col, end_col, newest)
    d = F.col(date_col)
    end = F.col(end_col)
    cond = (F.col(fact_key) == F.col(dim_key)) & (F.col(start_col) <= d)
    cond = cond & ((end.isNull() | (end >= d)) if open_end else (end >= d))
    if not bin_days:
        if fact_key == dim_key:
            cond = (fact[fact_key] == dim[dim_key]) & (dim[start_col] <= fact[date_col])
            cond = cond & ((dim[end_col].isNull() | (dim[end_col] >= fact[date_col])) if open_end else (dim[end_col] >= fact[date_col]))
        return fact.join(dim, cond, how)
    number = F.floor(F.datediff(d, F.lit(EPOCH)) / bin_days)
    span = fact.agg(F.min(number).alias("__lo"), F.max(number).alias("__hi"))  # one row
    first = F.greatest(F.floor(F.datediff(F.col(start_col), F.lit(EPOCH)) / bin_days), F.col("__lo"))
    last = F.least(F.floor(F.datediff(F.coalesce(end, F.lit(OPEN_END)), F.lit(EPOCH)) / bin_days), F.col("__hi"))
    dealt = dim.join(F.broadcast(span)).where(first <= last).withColumn("__bin", F.explode(F.sequence(first, last))).drop("__lo", "__hi")
    out = fact.withColumn("__fbin", number).join(dealt, cond & (F.col("__fbin") == F.col("__bin")), how)
    return out.drop("__fbin", "__bin")


def anchor_resolve(df: DataFrame, anchor_col: str, dim: DataFrame, sk: str, durable: str,
                   date_col: str, out_col: str, how: str = "inner") -> DataFrame:
    """Anchor sk -> durable id -> version valid on ``date_col`` (one hop of J5).

    ``dim`` needs ``sk``, ``durable``, ``effective_start_date``,
    ``effective_end_date``. The anchor row may be any version (also closed).
    """
    ids = dim.select(F.col(sk).alias("__a_sk"), F.col(durable).alias("__a_id"))
    versions = dim.select(F.col(durable).alias("__v_id"), F.col(sk).alias(out_col),
                          F.col("effective_start_date").alias("__v_start"),
                          F.col("effective_end_date").alias("__v_end"))
    step = df.join(ids, F.col(anchor_col) == F.col("__a_sk"), "inner")
    out = temporal_join(step, versions, "__a_id", "__v_id", date_col, "__v_start", "__v_end", how=how)
    return out.drop("__a_sk", "__a_id", "__v_id", "__v_start", "__v_end")
