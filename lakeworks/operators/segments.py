"""Row windows over long partitions, cut into blocks with halo rows.

``partition by p order by o rows between n preceding and current row`` puts a
whole partition into one task. Here a partition's rows get their position first
(counts per segment, prefix sums over the segments, position in the segment),
then blocks of a fixed number of rows; a block also gets the last ``before`` rows
of the block in front of it. No task holds more than a segment, or a block and
its halo, whatever the size of the partition.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096


def positions(df: DataFrame, part: Sequence[str], order: Sequence[str], segment: Column, out: str) -> DataFrame:
    """Add ``out``: the row's position (from 0) in its partition. ``segment`` must
    not fall along ``order``, as a date's year doesn't along the date."""
    df = df.withColumn("__seg", segment)
    counts = df.groupBy(*part, "__seg").agg(F.count(F.lit(1)).alias("__n"))
    # one row for each segment of a partition
    before = Window.partitionBy(*part).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    key = [*part, "__seg"]
    same = None
    for c in key:
        e = F.col(c).eqNullSafe(F.col(f"__r{c}"))
        same = e if same is None else same & e
    placed = df.join(counts.select(*[F.col(c).alias(f"__r{c}") for c in key], "__off"), same).drop(*[f"__r{c}" for c in key])
    here = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return placed.withColumn(out, F.col("__off") + here - 1).drop("__seg", "__off")


def segmented_window(df: DataFrame, part: Sequence[str], order: Sequence[str], segment: Column, before: int,
                     columns: Mapping[str, Callable[[Window], Column]], block: int = BLOCK) -> DataFrame:
    """Add ``columns``, each made from a window over ``part`` in ``order`` that
    looks back ``before`` rows at most. ``order`` must be total in a partition."""
    block = max(block, before, 1)
    at = positions(df, part, order, segment, "__at")
    own = F.floor(F.col("__at") / block).cast("long")
    last = F.col("__at") % block >= block - before
    # a row is in its own block, and ahead of the next one if it is among the last rows
    homes = F.when(last, F.array(own, own + 1)).otherwise(F.array(own))
    dealt = at.withColumn("__own", own).withColumn("__block", F.explode(homes))
    w = Window.partitionBy(*part, "__block").orderBy("__at")
    for name, make in columns.items():
        dealt = dealt.withColumn(name, make(w))
    return dealt.where("__block = __own").drop("__at", "__own", "__block")
