"""Month-end snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_end_snapshot(df: DataFrame, date_col: str, keys: Sequence[str], aggs: Sequence[Column],
                       mode: str = "calendar", out_date: str = "monthend_date") -> DataFrame:
    """Aggregate rows that represent a month end.

    ``calendar``: rows dated exactly on the last day of their month (the
    reference rule). ``last_in_month``: rows on the last date present for the
    group in that month (found with a grouped max and a semi-join, so no
    per-group window).
    """
    me = F.last_day(F.col(date_col))
    if mode == "calendar":
        picked = df.filter(F.col(date_col) == me)
    elif mode == "last_in_month":
        last = df.groupBy(*keys, me.alias("__me")).agg(F.max(date_col).alias("__last"))
        cond = [F.col(date_col) == F.col("__last"), me == F.col("__me")]
        cond += [df[k].eqNullSafe(last[k]) for k in keys]
        picked = df.join(last, cond, "left_semi")
    else:
        raise ValueError(mode)
    return picked.groupBy(me.alias(out_date), *keys).agg(*aggs)
