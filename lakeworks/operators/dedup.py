"""Latest-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols):
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def latest_wins(df: DataFrame, keys: Sequence, order: Sequence, rank_col: str = "_rn", hashed: bool = True) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order`` (give a total order).

    ``row_number() = 1`` is planned as a WindowGroupLimit, which also runs
    before the shuffle, so a hot key is cut to one row per map task before it
    is exchanged. Rows are sorted by a hash of the keys first: keys that begin
    alike (``EK_POS_...``) are told apart by one long, not by whole strings; keys
    that are numbers need no hash (``hashed=False``).
    """
    by = _cols(keys)
    w = Window.partitionBy(*([F.xxhash64(*by)] if hashed else []), *by).orderBy(*_cols(order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)


def check_total_order(df: DataFrame, keys: Sequence, order: Sequence) -> DataFrame:
    """Rows whose (keys, order) values are shared by another row: ties that
    would make :func:`latest_wins` pick arbitrarily (Hard 4, strict mode)."""
    cols = _cols(list(keys) + [o if isinstance(o, (str, Column)) else o for o in order])
    plain = [c for c in cols]
    return df.groupBy(*plain).count().filter(F.col("count") > 1)
