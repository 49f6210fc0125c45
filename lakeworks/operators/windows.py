"""Group-relative measures that stay skew-safe on fact-sized groups.

A window ``PARTITION BY g`` puts every row of a group in one task. For groups
that grow with the fact (team x day, portfolio x day) we use:

* share of total: a grouped sum (map-side combined) joined back on the
  group; AQE's skew join splits a hot group's rows over several tasks;
* dense rank: distinct (group, value) pairs get global row ids from a range
  sort (:func:`dense_row_id`), the rank is the id minus the group's first id;
  ranks are joined back on (group, value).

Windows stay in use where the group is bounded by a dimension (e.g. one row
per portfolio and day after aggregation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.operators.rowid import dense_row_id


def _ns_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``cols`` treating NULL = NULL (null-safe equality)."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in cols],
                     *[F.col(c) for c in right.columns if c not in cols])
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"__r_{c}" for c in cols])


def share_of_total(df: DataFrame, group: Sequence[str], value: str, out: str, digits: int | None = None) -> DataFrame:
    """``value / NULLIF(SUM(value) OVER (PARTITION BY group), 0)`` as DOUBLE."""
    tot = df.groupBy(*group).agg(F.sum(value).alias("__tot"))
    j = _ns_join(df, tot, list(group))
    t = F.col("__tot").cast("double")
    share = F.col(value).cast("double") / F.when(t != 0, t)
    if digits is not None:
        share = F.round(share, digits)
    return j.withColumn(out, share).drop("__tot")


def dense_rank_within(df: DataFrame, group: Sequence[str], value: str, out: str, descending: bool = True,
                      share: str | None = None) -> DataFrame:
    """``DENSE_RANK() OVER (PARTITION BY group ORDER BY value [DESC])`` (NULLs last). ``share``
    adds :func:`share_of_total` as well: totals go with the ranks, so rows are dealt once for both."""
    vals = df.select(*group, value).distinct()
    o: Column = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    ids = dense_row_id(vals, [F.col(g).asc_nulls_first() for g in group] + [o], "__rid")
    first = ids.groupBy(*group).agg(F.min("__rid").alias("__first"))
    if share:
        first = _ns_join(first, df.groupBy(*group).agg(F.sum(value).alias("__tot")), list(group))
    total = ["__tot"] if share else []
    ranked = _ns_join(ids, first, list(group), "inner").select(
        *group, value, (F.col("__rid") - F.col("__first") + 1).cast("bigint").alias(out), *total)
    ranked = _ns_join(df, ranked, list(group) + [value])
    if not share:
        return ranked
    t = F.col("__tot").cast("double")
    return ranked.withColumn(share, F.col(value).cast("double") / F.when(t != 0, t)).drop("__tot")
