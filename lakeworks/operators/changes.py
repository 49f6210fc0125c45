"""Change capture between two versions of a table, and its propagation through
star joins into additive aggregate state (R10m).

A change is a row with a weight: +n if the new version holds it n times more
often, -n if less. Weighted rows pass selections, filters and inner joins like
any other row, and sums and counts of a group are linear in them. So a stored
aggregate is brought up to date by aggregating the changes alone:

    change of (A join B) = change of A join new B + old A join change of B
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE = "_change"
COUNT = "_rows"


def _checksums(df: DataFrame, by: Sequence[str], side: str) -> DataFrame:
    """Per group: rows and two sums of row hashes; aggregated before the shuffle."""
    first, second = F.xxhash64(*_marked(df)), F.hash(*_marked(df))
    return df.groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg(
        F.count(F.lit(1)).alias(f"{side}_n"), F.sum(first.cast("decimal(38,0)")).alias(f"{side}_a"),
        F.sum(second.cast("long")).alias(f"{side}_b"))


def _marked(df: DataFrame) -> list[Column]:
    """All columns with their null marks (a null leaves a hash as it was)."""
    return [x for c in df.columns for x in (F.col(c).isNull(), F.col(c))]


def changes(old: DataFrame, new: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of ``new`` with the weight CHANGE by which it differs from ``old``.

    One shuffle of both versions on all columns, in which rows that both hold
    cancel. With ``by`` (a date, say) only groups whose row count or checksums
    differ are compared row by row, so an unchanged stretch isn't shuffled; that
    list has a row for each changed group. Nulls are equal to nulls; repeated
    rows count."""
    if by:
        a, b = _checksums(old, by, "o"), _checksums(new, by, "n")
        a = a.select(*[F.col(f"__{c}").alias(f"__o_{c}") for c in by], "o_n", "o_a", "o_b")
        same = reduce(lambda x, y: x & y, [F.col(f"__{c}").eqNullSafe(F.col(f"__o_{c}")) for c in by])
        both = b.join(a, same, "full_outer")
        differs = ~reduce(lambda x, y: x & y, [F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) for k in "nab"])
        groups = both.where(differs).select(*[F.when(F.col("n_n").isNull(), F.col(f"__o_{c}")).otherwise(F.col(f"__{c}")).alias(f"__g_{c}")
                                              for c in by])
        inside = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in by])
        old, new = (x.join(groups, inside, "left_semi") for x in (old, new))
    cols = new.columns
    both = new.withColumn(CHANGE, F.lit(1)).unionByName(old.select(*cols).withColumn(CHANGE, F.lit(-1)))
    return both.groupBy(*cols).agg(F.sum(CHANGE).cast("long").alias(CHANGE)).where(F.col(CHANGE) != 0)


def star_changes(rows: Callable[[Mapping[str, DataFrame]], DataFrame], old: Mapping[str, DataFrame],
                 new: Mapping[str, DataFrame], by: Mapping[str, Sequence[str]]) -> DataFrame | None:
    """Change of ``rows(inputs)``, which joins its inputs (inner) and carries the
    column CHANGE through if an input has it. ``by`` names the inputs that have
    changed. One term for each: the inputs before it new, those after it old."""
    terms, names = [], list(new)
    for k, name in enumerate(names):
        if name not in by:
            continue
        frames = {n: new[n] if i < k else old[n] for i, n in enumerate(names)}
        frames[name] = changes(old[name], new[name], by[name])
        terms.append(rows(frames))
    return reduce(DataFrame.unionByName, terms) if terms else None


def state_of(rows: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Additive state per key: row count, and of each measure the sum and the
    count of values (a sum over nulls only is null, not 0). ``rows`` may be weighted."""
    weight = F.col(CHANGE) if CHANGE in rows.columns else F.lit(1).cast("long")
    aggs = [F.sum(weight).alias(COUNT)]
    for m in measures:
        value = F.coalesce(F.col(m), F.lit(0).cast(rows.schema[m].dataType))
        aggs += [F.sum(value * weight).cast("decimal(38,6)").alias(f"_sum_{m}"),
                 F.sum(F.when(F.col(m).isNotNull(), weight).otherwise(0)).alias(f"_n_{m}")]
    return rows.groupBy(*keys).agg(*aggs)


def merged_state(state: DataFrame, change: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State after a change; keys whose row count falls to 0 go."""
    cols = [c for c in state.columns if c not in keys]
    both = state.unionByName(change.select(*state.columns))
    out = both.groupBy(*keys).agg(*[F.sum(c).cast(state.schema[c].dataType).alias(c) for c in cols])
    return out.where(F.col(COUNT) > 0).select(*state.columns)


def measure(name: str, kind) -> Column:
    """A measure's sum as the full aggregate gives it."""
    return F.when(F.col(f"_n_{name}") > 0, F.col(f"_sum_{name}").cast(kind)).alias(name)
