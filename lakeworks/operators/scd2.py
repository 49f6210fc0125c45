"""SCD2 chains and maintenance.

Chain building avoids per-key windows: surrogate keys are assigned in
(key, chain order) order, so the versions of one key hold consecutive sks.
Chain position, previous/next links and the next start date then come from a
grouped count (map-side combined) and an equi self-join on ``sk + 1`` (unique
keys), so a key with a huge number of versions is never sorted in one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.config import OPEN_END, OPEN_START
from lakeworks.operators.dedup import latest_wins
from lakeworks.operators.rowid import dense_row_id

SCD_COLS = ("effective_start_date", "effective_end_date", "is_current",
            "preceding_record_sk", "succeeding_record_sk")


def scd2_chain(df: DataFrame, key: str, order: Sequence[Column], start_col: str, sk: str,
               start_default: dt.date = OPEN_START, end_default: dt.date = OPEN_END) -> DataFrame:
    """Build an SCD2 chain from version rows.

    ``order`` orders versions inside a key and must be total with ``key``.
    Adds ``sk`` (global row number over key, order), ``chain_pos``,
    ``chain_len``, inclusive ``effective_start_date`` / ``effective_end_date``
    (next start - 1 day, else ``end_default``), ``is_current`` (last in chain)
    and the previous / next surrogate keys.
    """
    with_sk = dense_row_id(df, [F.col(key)] + list(order), sk)
    stats = with_sk.groupBy(F.col(key).alias("__skey")).agg(F.min(sk).alias("__first"),
                                                            F.count(F.lit(1)).alias("chain_len"))
    nxt = with_sk.select((F.col(sk) - 1).alias(sk), F.col(key).alias("__nkey"),
                         F.col(start_col).alias("__next_start"))
    # null-safe: versions without a key form a chain like any other
    joined = with_sk.join(stats, F.col(key).eqNullSafe(F.col("__skey")), "inner").join(nxt, sk, "left")
    next_start = F.when(F.col("__nkey").eqNullSafe(F.col(key)), F.col("__next_start"))
    pos = (F.col(sk) - F.col("__first") + 1).cast("bigint")
    return (
        joined.withColumn("chain_pos", pos)
        .withColumn("chain_len", F.col("chain_len").cast("bigint"))
        .withColumn("effective_start_date", F.coalesce(F.col(start_col), F.lit(start_default)))
        .withColumn("effective_end_date",
                    F.coalesce(F.date_sub(next_start, 1), F.lit(end_default)))
        .withColumn("is_current", F.col("chain_pos") == F.col("chain_len"))
        .withColumn("preceding_record_sk", F.when(F.col("chain_pos") > 1, F.col(sk) - 1))
        .withColumn("succeeding_record_sk", F.when(F.col("chain_pos") < F.col("chain_len"), F.col(sk) + 1))
        .drop("__first", "__skey", "__nkey", "__next_start")
    )


def scd1_as_scd2(df: DataFrame, order: Sequence, sk: str, start: dt.date = OPEN_START,
                 end: dt.date = OPEN_END, bounded: bool = False) -> DataFrame:
    """Single-version dimension (D2): fixed range, current, no links."""
    return (
        dense_row_id(df, order, sk, bounded=bounded)
        .withColumn("effective_start_date", F.lit(start))
        .withColumn("effective_end_date", F.lit(end))
        .withColumn("is_current", F.lit(True))
        .withColumn("preceding_record_sk", F.lit(None).cast("bigint"))
        .withColumn("succeeding_record_sk", F.lit(None).cast("bigint"))
    )


def close_versions(dim: DataFrame, changes: DataFrame, sk: str) -> DataFrame:
    """Close dimension rows (D3 / D5) - a MERGE ... WHEN MATCHED UPDATE.

    ``changes``: (``sk``, ``close_date``, ``successor_sk``). A row with a
    successor ends the day before ``close_date``; a row without one (soft
    delete) ends on ``close_date`` itself. Of several changes to a row the
    earliest one closes it.
    """
    ch = changes.filter(F.col(sk).isNotNull()).groupBy(sk).agg(
        F.min(F.struct("close_date", "successor_sk")).alias("__c")).select(
        F.col(sk), F.col("__c.close_date").alias("__close"), F.col("__c.successor_sk").alias("__succ"),
        F.lit(True).alias("__hit"))
    j = dim.join(ch, sk, "left")
    hit = F.col("__hit").isNotNull()
    end = F.when(F.col("__succ").isNotNull(), F.date_sub(F.col("__close"), 1)).otherwise(F.col("__close"))
    return (
        j.withColumn("is_current", F.when(hit, F.lit(False)).otherwise(F.col("is_current")))
        .withColumn("effective_end_date", F.when(hit, end).otherwise(F.col("effective_end_date")))
        .withColumn("succeeding_record_sk",
                    F.when(hit, F.col("__succ").cast("bigint")).otherwise(F.col("succeeding_record_sk")))
        .drop("__close", "__succ", "__hit")
    )


def apply_scd2(dim: DataFrame, changes: DataFrame, key: str, sk: str, start_col: str = "effective_start_date") -> DataFrame:
    """Insert successor versions and close their predecessors.

    ``changes`` has ``key``, ``start_col`` and the dimension's attribute
    columns. New sks continue after the current maximum, in key order. Several
    changes to a key follow each other by start date, so the key keeps one
    current row; of changes to a key on the same date the largest row counts.
    """
    rest = [F.col(c).desc_nulls_last() for c in changes.columns if c not in (key, start_col)]
    changes = latest_wins(changes, [key, start_col], rest) if rest else changes.dropDuplicates([key, start_col])
    max_sk = dim.agg(F.coalesce(F.max(sk), F.lit(0)).alias("__max"))
    new = dense_row_id(changes, [F.col(key), F.col(start_col)], "__local")
    new = new.crossJoin(F.broadcast(max_sk)).withColumn(sk, (F.col("__max") + F.col("__local")).cast("bigint"))
    new = chain_batch(new.drop("__max", "__local"), [key], sk, start_col)
    cur = dim.filter(F.col("is_current")).groupBy(F.col(key).alias("__ckey")).agg(F.max(sk).alias("__cur"))
    new = new.join(cur, F.col(key).eqNullSafe(F.col("__ckey")), "left")
    close = new.filter(F.col("__prev").isNull()).select(
        F.col("__cur").alias(sk), F.col(start_col).alias("close_date"), F.col(sk).alias("successor_sk"))
    closed = close_versions(dim, close, sk)
    inserted = (
        new.withColumn("effective_start_date", F.col(start_col))
        .withColumn("effective_end_date", F.coalesce(F.date_sub("__next_start", 1), F.lit(OPEN_END)))
        .withColumn("is_current", F.col("__next").isNull())
        .withColumn("preceding_record_sk", F.coalesce("__prev", "__cur").cast("bigint"))
        .withColumn("succeeding_record_sk", F.col("__next").cast("bigint"))
    )
    return closed.unionByName(inserted.select(*closed.columns))


def chain_batch(new: DataFrame, keys: Sequence[str], sk: str, start_col: str) -> DataFrame:
    """Link the rows of a batch whose ``sk`` is consecutive in (keys, start):
    adds ``__prev``, ``__next`` (sk of the neighbour with the same keys) and
    ``__next_start``. Two equi joins on unique keys, no window."""
    side = F.struct(*keys)
    after = new.select((F.col(sk) - 1).alias(sk), side.alias("__akey"), F.col(sk).alias("__a"),
                       F.col(start_col).alias("__astart"))
    before = new.select((F.col(sk) + 1).alias(sk), side.alias("__bkey"), F.col(sk).alias("__b"))
    same_after = F.col("__akey").eqNullSafe(side)
    return (new.join(after, sk, "left").join(before, sk, "left")
            .withColumn("__next", F.when(same_after, F.col("__a")))
            .withColumn("__next_start", F.when(same_after, F.col("__astart")))
            .withColumn("__prev", F.when(F.col("__bkey").eqNullSafe(side), F.col("__b")))
            .drop("__akey", "__a", "__astart", "__bkey", "__b"))


def soft_delete(dim: DataFrame, deletions: DataFrame, key: str, sk: str) -> DataFrame:
    """Close the current row of each deleted key on the event date."""
    cur = dim.filter(F.col("is_current")).select(key, sk)
    ch = deletions.join(cur, key, "inner").select(
        sk, F.col("event_date").alias("close_date"), F.lit(None).cast("bigint").alias("successor_sk"))
    return close_versions(dim, ch, sk)
