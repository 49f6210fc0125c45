"""Change detection, merges without MERGE, and incremental aggregates (H1, S11, S12, R10m)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(cols: Sequence[str]) -> Column:
    """xxhash64 over the compared columns with explicit NULL markers, so NULL
    and the empty string hash differently."""
    parts = []
    for c in cols:
        parts += [F.col(c).isNull(), F.coalesce(F.col(c).cast("string"), F.lit(""))]
    return F.xxhash64(*parts)


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of ``keys`` with the columns named ``prefix`` + key."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def hash_delta(src: DataFrame, tgt: DataFrame, keys: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Classify every key as INSERT / UPDATE / SOFT_DELETE / UNCHANGED.

    Full outer join on the keys with a per-row hash compare: one shuffle of
    each side on the keys. Null keys are keys like any other.
    """
    s = src.select(*keys, row_hash(compare).alias("__hs"), F.lit(True).alias("__in_s"))
    t = tgt.select(*[F.col(k).alias(f"__t_{k}") for k in keys], row_hash(compare).alias("__ht"), F.lit(True).alias("__in_t"))
    j = s.join(t, same_keys(keys, "__t_"), "full_outer")
    j = j.select(*[F.when(F.col("__in_s").isNull(), F.col(f"__t_{k}")).otherwise(F.col(k)).alias(k) for k in keys],
                 "__hs", "__ht", "__in_s", "__in_t")
    action = (F.when(F.col("__in_t").isNull(), "INSERT")
              .when(F.col("__in_s").isNull(), "SOFT_DELETE")
              .when(F.col("__hs") != F.col("__ht"), "UPDATE")
              .otherwise("UNCHANGED"))
    return j.select(*keys, action.alias("action"))


def delta_counts(actions: DataFrame) -> DataFrame:
    """One row: source_row_count, rows_inserted, rows_updated, rows_soft_deleted, rows_unchanged."""
    a = F.col("action")

    def cnt(name):
        return F.sum(F.when(a == name, 1).otherwise(0)).cast("bigint")

    return actions.agg(
        F.sum(F.when(a != "SOFT_DELETE", 1).otherwise(0)).cast("bigint").alias("source_row_count"),
        cnt("INSERT").alias("rows_inserted"), cnt("UPDATE").alias("rows_updated"),
        cnt("SOFT_DELETE").alias("rows_soft_deleted"), cnt("UNCHANGED").alias("rows_unchanged"))


def watermark_delta(src: DataFrame, tgt: DataFrame, keys: Sequence[str], wm_col: str) -> DataFrame:
    """Rows of ``src`` newer than the target's high-water mark, classified as
    INSERT (new key) or UPDATE (known key). The watermark is a 1-row aggregate."""
    wm = tgt.agg(F.max(wm_col).alias("__wm"))
    fresh = src.crossJoin(F.broadcast(wm)).filter(F.col("__wm").isNull() | (F.col(wm_col) > F.col("__wm")))
    known = tgt.select(*[F.col(k).alias(f"__t_{k}") for k in keys]).distinct().withColumn("__known", F.lit(True))
    j = fresh.join(known, same_keys(keys, "__t_"), "left")
    return j.withColumn("action", F.when(F.col("__known").isNull(), "INSERT").otherwise("UPDATE")).drop(
        "__wm", "__known", *[f"__t_{k}" for k in keys])


def merge_update(tgt: DataFrame, updates: DataFrame, keys: Sequence[str], set_cols: Sequence[str]) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE SET c = src.c for ``set_cols``.

    Of several updates to a key the largest (by ``set_cols``, nulls first)
    counts, so no target row is repeated; null keys match nothing."""
    u = updates.groupBy(*keys).agg(F.max(F.struct(*set_cols)).alias("__u")).select(
        *keys, *[F.col(f"__u.{c}").alias(f"__u_{c}") for c in set_cols], F.lit(True).alias("__m"))
    j = tgt.join(u, list(keys), "left")
    for c in set_cols:
        j = j.withColumn(c, F.when(F.col("__m").isNotNull(), F.col(f"__u_{c}")).otherwise(F.col(c)))
    return j.select(*tgt.columns)


def incremental_agg(state: DataFrame | None, inserts: DataFrame | None, deletes: DataFrame | None,
                    keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Maintain ``sum_<m>`` and ``row_count`` per key from row changes.

    Inserted rows add, deleted rows subtract; groups whose count isn't above 0
    vanish. Null keys are keys like any other. Replaying the same change twice
    is the caller's concern (the streaming driver keys batches by id).
    """
    parts = []
    if inserts is not None:
        parts.append(inserts.select(*keys, *[F.col(m).alias(m) for m in measures], F.lit(1).alias("__sign")))
    if deletes is not None:
        parts.append(deletes.select(*keys, *[(-F.col(m)).alias(m) for m in measures], F.lit(-1).alias("__sign")))
    aggs = [F.sum(m).alias(f"sum_{m}") for m in measures] + [F.sum("__sign").cast("bigint").alias("row_count")]
    if not parts:
        return state
    delta = parts[0]
    for p in parts[1:]:
        delta = delta.unionByName(p)
    delta = delta.groupBy(*keys).agg(*aggs)
    if state is None:
        return delta.filter(F.col("row_count") > 0)
    cols = [f"sum_{m}" for m in measures] + ["row_count"]
    both = state.select(*keys, *cols).unionByName(delta.select(*keys, *cols))
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in cols]).filter(F.col("row_count") > 0)
