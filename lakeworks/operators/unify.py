"""Multi-source merge with per-column provenance and conflict detection (B pattern, B16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unify_sources(primary: DataFrame, primary_name: str, key: str,
                  overlays: Sequence[tuple[str, DataFrame, str, dict[str, str]]]) -> DataFrame:
    """Left-join overlay sources onto the primary and record provenance.

    ``overlays``: (source name, frame, join key in the overlay, {out column:
    overlay column}). Adds ``_source_pref`` = primary name plus every overlay
    that matched, joined with ``+``.
    """
    out = primary
    hits = []
    for name, frame, okey, cols in overlays:
        flag = f"__hit_{name}"
        sel = [F.col(okey).alias(f"__k_{name}")] + [F.col(src).alias(dst) for dst, src in cols.items()]
        sel.append(F.lit(True).alias(flag))
        out = out.join(frame.select(*sel), F.col(key) == F.col(f"__k_{name}"), "left").drop(f"__k_{name}")
        hits.append((name, flag))
    parts = [F.lit(primary_name)] + [F.when(F.col(flag).isNotNull(), F.lit(name)) for name, flag in hits]
    out = out.withColumn("_source_pref", F.concat_ws("+", *parts))
    return out.drop(*[flag for _, flag in hits])


def conflict_sources(pairs: Sequence[tuple[str, str, str]]):
    """``_sources_in_conflict`` column: overlay source names whose value for an
    overlapping attribute differs (null-safe) from the primary's; sorted,
    distinct. ``pairs``: (source name, primary column, overlay column)."""
    items = [F.when(F.col(o).isNotNull() & ~F.col(p).eqNullSafe(F.col(o)), F.lit(name))
             for name, p, o in pairs]
    return F.array_sort(F.array_distinct(F.filter(F.array(*items), lambda x: x.isNotNull())))
