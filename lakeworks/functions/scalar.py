"""Column helpers shared by the builders (pure ``pyspark.sql.functions``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeworks.config import CURRENCIES, RATING_SCORES


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """DECIMAL(18,2) money value."""
    return col(c).cast("decimal(18,2)")


def day(c) -> Column:
    return col(c).cast("date")


def out_money(c) -> Column:
    """Final measure for reports: rounded to cents, DOUBLE."""
    return F.round(col(c), 2).cast("double")


def out_ratio(c) -> Column:
    return F.round(col(c).cast("double"), 6)


def safe_div(num, den) -> Column:
    """num / NULLIF(den, 0) as DOUBLE."""
    d = col(den).cast("double")
    return col(num).cast("double") / F.when(d != 0, d)


def currency_of(idx) -> Column:
    """CURRENCIES[idx % 6] (1-based element_at)."""
    return F.element_at(F.array(*[F.lit(c) for c in CURRENCIES]), (col(idx) % 6 + 1).cast("int"))


def pick(values: Sequence[str], idx) -> Column:
    """values[idx % n] - deterministic category pick."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (col(idx) % len(values) + 1).cast("int"))


def rating_score(c) -> Column:
    """Ordinal score of a rating letter (D7); NULL for anything else."""
    expr = None
    for letter, score in RATING_SCORES.items():
        expr = (F.when(col(c) == letter, F.lit(score)) if expr is None
                else expr.when(col(c) == letter, F.lit(score)))
    return expr.cast("int")


def hash_int(tag: str, cols: Sequence, digits: int, mod: int, lo: int = 0) -> Column:
    """``lo + conv(substr(sha2(tag || cols, 256), 1, digits), 16, 10) % mod``."""
    h = F.sha2(F.concat_ws("|", F.lit(tag), *[col(c).cast("string") for c in cols]), 256)
    return (F.lit(lo) + F.conv(F.substring(h, 1, digits), 16, 10).cast("bigint") % F.lit(mod)).cast("bigint")


def hash_pick(tag: str, cols: Sequence, values: Sequence[str]) -> Column:
    """``element_at(array(values), 1 + h % n)`` (Y2)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (hash_int(tag, cols, 8, len(values)) + 1).cast("int"))
