"""Crosswalk build and key resolution.

Resolution is always a join against the crosswalk, never a per-row function:
the crosswalk grows with the data, so it is shuffled like any other table and
AQE turns the join into a broadcast only when the runtime size allows it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.operators.dedup import latest_wins
from lakeworks.operators.segments import positions
from lakeworks.session import cut_lineage

XW_COLS = ("source_system", "source_key", "enterprise_key")
#: Mappings in one array of an enterprise key's source keys, and the characters of a
#: source key by which a long list is dealt.
PAGE, SEGMENT_CHARS = 10_000, 12


def build_crosswalk(arms: Sequence[DataFrame]) -> DataFrame:
    """UNION (distinct) of (source_system, source_key, enterprise_key) arms."""
    out = None
    for arm in arms:
        a = arm.select(*XW_COLS).filter(F.col("source_key").isNotNull())
        out = a if out is None else out.unionByName(a)
    return out.distinct()


def merge_insert(src: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE ... WHEN NOT MATCHED INSERT: target plus source rows with new keys
    (S10). Null keys are keys like any other, so a second run inserts none again."""
    known = tgt.select(*[F.col(k).alias(f"__k_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    new = src.join(known, same, "left_anti")
    return tgt.unionByName(new.select(*tgt.columns))


def current_mappings(xw: DataFrame) -> DataFrame:
    """One enterprise key per (system, key): the newest mapping wins."""
    order = [F.col(c).desc() for c in ("mapped_at",) if c in xw.columns] + [F.col("enterprise_key").desc()]
    return latest_wins(xw, ["source_system", "source_key"], order)


def resolve_keys(df: DataFrame, xw: DataFrame, system: str | Column, key_col: str,
                 out_col: str) -> DataFrame:
    """Left-join a source key column to its enterprise key (NULL when unmapped).

    The crosswalk is first cut to the distinct keys the input actually uses
    (a left-semi join that Catalyst pushes into every arm of the crosswalk
    union), then deduplicated (newest mapping wins) - so the mapping joined
    back is as small as the set of distinct keys, and AQE broadcasts it when
    that is small instead of shuffling the fact.
    """
    sys_col = system if isinstance(system, Column) else F.lit(system)
    need = df.select(sys_col.alias("__ns"), F.col(key_col).alias("__nk")).distinct()
    m = xw.join(need, (F.col("source_system") == F.col("__ns")) & (F.col("source_key") == F.col("__nk")), "left_semi")
    m = current_mappings(m).select(F.col("source_system").alias("__xs"), F.col("source_key").alias("__xk"),
                                   F.col("enterprise_key").alias(out_col))
    return df.join(m, (F.col("__xk") == F.col(key_col)) & (F.col("__xs") == sys_col), "left").drop("__xs", "__xk")


def explode_keys(df: DataFrame, keys: Sequence[tuple[str, str, str, Column]]) -> DataFrame:
    """All key columns of a raw frame in one pass over it (C7, C8): one row
    (source_system, domain, source_key, enterprise_key) for each of ``keys``
    (system, domain, key column, enterprise key). Null keys are dropped."""
    found = F.array(*[F.struct(F.lit(system).alias("source_system"), F.lit(domain).alias("domain"),
                               F.col(key).cast("string").alias("source_key"), ek.alias("enterprise_key"))
                      for system, domain, key, ek in keys])
    return df.select(F.inline(found)).filter(F.col("source_key").isNotNull())


def lookup_of(keys: DataFrame) -> DataFrame:
    """source_system, domain, source_key, enterprise_key: the current mapping of
    every (system, key), once for each domain that a frame names the key in. A
    mapping of no domain (added by hand) has domain NULL and counts for all."""
    by_domain = keys.groupBy("source_system", "domain", "source_key").agg(F.max("enterprise_key").alias("enterprise_key"))
    w = Window.partitionBy("source_system", "source_key")          # a row for each domain, a handful of code values
    best = by_domain.withColumn("enterprise_key", F.max("enterprise_key").over(w)).withColumn(
        "__for_all", F.max(F.col("domain").isNull()).over(w))
    return best.where(~F.col("__for_all") | F.col("domain").isNull()).select(
        "source_system", "domain", "source_key", "enterprise_key")


def lookup_keys(df: DataFrame, lookup: DataFrame, system: str, key_col: str, out_col: str,
                domain: str | None = None) -> DataFrame:
    """As :func:`resolve_keys`, from a stored lookup (:func:`lookup_of`) kept in
    folders by system and domain: one join, no pass over ``df`` before it. With a
    ``domain`` only the keys that some frame names in that domain are read, so a
    dimension's keys stay small next to a fact's; without one, all of the system."""
    m = mappings_of(lookup, system, domain, "__xk", out_col)
    return df.join(m, F.col("__xk") == F.col(key_col), "left").drop("__xk")


def mappings_of(lookup: DataFrame, system: str, domain: str | None, key: str, out_col: str) -> DataFrame:
    """The lookup's mappings of one system and, where given, domain: ``key``, ``out_col``."""
    m = lookup.filter(F.col("source_system") == system)
    if domain:
        m = m.filter((F.col("domain") == domain) | F.col("domain").isNull())
    m = m.select(F.col("source_key").alias(key), F.col("enterprise_key").alias(out_col))
    return m if domain else m.distinct()  # a key may be listed in several domains


def source_keys_of(xw: DataFrame, page: int = PAGE) -> DataFrame:
    """enterprise key -> its (source_system, source_key) in order, as arrays of at
    most ``page`` of them, numbered from 0 (C6). Keys that fit one page are gathered as
    they are. Mappings of the others get their place by counts per system and beginning
    of the key, so an enterprise key with very many of them is neither sorted nor
    gathered in one task."""
    xw = xw.select(*XW_COLS)
    # at most a row for each full page of mappings; its files tell whether joins may broadcast it
    many = cut_lineage(xw.groupBy(F.col("enterprise_key").alias("__many")).agg(F.count(F.lit(1)).alias("__n"))
                       .filter(F.col("__n") > page).select("__many"))
    is_long = F.col("enterprise_key").eqNullSafe(F.col("__many"))
    pair = F.struct("source_system", "source_key")
    short = xw.join(many, is_long, "left_anti").groupBy("enterprise_key").agg(
        F.sort_array(F.collect_list(pair)).alias("source_keys")).select("enterprise_key", F.lit(0).cast("bigint").alias("page"), "source_keys")
    begins = F.struct("source_system", F.substring("source_key", 1, SEGMENT_CHARS))
    placed = positions(xw.join(many, is_long, "left_semi"), ["enterprise_key"], ["source_system", "source_key"], begins, "__at")
    paged = placed.withColumn("page", F.floor(F.col("__at") / page).cast("bigint"))
    return short.unionByName(paged.groupBy("enterprise_key", "page").agg(F.sort_array(F.collect_list(pair)).alias("source_keys")))


# --- star crosswalk (SCD2 mapping rows with relationship types) -------------

def star_current(xw: DataFrame) -> DataFrame:
    """Current rows, one per (domain, source system, source key, target system):
    the highest crosswalk_sk wins (C1)."""
    cur = xw.filter(F.col("is_current"))
    return latest_wins(cur, ["domain_code", "source_system", "source_key", "target_system"],
                       [F.col("crosswalk_sk").desc()])


def resolve_as_of(df: DataFrame, xw: DataFrame, domain: str, source: str, target: str,
                  key_col: str, date_col: str, out_col: str, id_col: str) -> DataFrame:
    """Target key valid on a date (C2): start <= d <= coalesce(end, inf),
    ties broken by the highest crosswalk_sk. ``id_col`` must identify the
    input row so ties collapse to one row per input."""
    m = xw.filter((F.col("domain_code") == domain) & (F.col("source_system") == source)
                  & (F.col("target_system") == target)).select(
        F.col("source_key").alias("__sk"), F.col("target_key").alias(out_col),
        F.col("crosswalk_sk").alias("__xsk"), F.col("effective_start_date").alias("__s"),
        F.col("effective_end_date").alias("__e"))
    d = F.col(date_col)
    j = df.join(m, (F.col("__sk") == F.col(key_col)) & (F.col("__s") <= d)
                & (F.col("__e").isNull() | (F.col("__e") >= d)), "left")
    return latest_wins(j, [id_col], [F.col("__xsk").desc_nulls_last()]).drop("__sk", "__xsk", "__s", "__e")
