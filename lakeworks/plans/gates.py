"""Data-quality gates (E1-E12) and view / snapshot parity (R9m, U3, A11).

Every gate returns rows ``(gate, subject, metric, expected, status)`` with
status PASS / FAIL / SKIP, computed as Spark aggregates - nothing is
collected to the driver to decide a status.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.operators.segments import segmented_window
from lakeworks.plans.bronze import BRONZE_ENTITIES
from lakeworks.plans.gold import teams_with_positions
from lakeworks.session import cut_lineage, passing_cuts

SCD_DIMS = {"security_dim": "security_sk", "contract_dim": "contract_sk", "entity_dim": "entity_sk",
            "rating_dim": "security_rating_sk"}


def _row(gate: str, subject, metric, expected, ok) -> list:
    return [F.lit(gate).alias("gate"), (subject if not isinstance(subject, str) else F.lit(subject)).alias("subject"),
            metric.cast("double").alias("metric"), F.lit(expected).cast("double").alias("expected"),
            F.when(ok, "PASS").otherwise("FAIL").alias("status")]


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def gate_fk_orphans(lake) -> DataFrame:
    """E2 (R10: against all versions): position rows whose portfolio /
    security sk matches no dimension row."""
    # both numbers of each row from one pass; how often each number comes is what meets the dimension
    p = cut_lineage(lake.get("silver.position_analytics_fact", ids=False).select("portfolio_sk", "security_sk"))
    checks = []
    for col_name, dim, sk in (("portfolio_sk", "silver.portfolio_dim", "portfolio_sk"),
                              ("security_sk", "silver.security_dim", "security_sk")):
        named = p.groupBy(col_name).agg(F.count(F.lit(1)).alias("__rows"))
        orphans = named.join(lake.get(dim).select(F.col(sk).alias(col_name)), col_name, "left_anti")
        m = orphans.agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("n"))
        checks.append(m.select(*_row("fk_orphans", col_name, F.col("n"), 0, F.col("n") == 0)))
    return _union(checks)


def gate_duplicates(lake) -> DataFrame:
    """Business keys repeated within a dimension version (key, start)."""
    out = []
    for dim in SCD_DIMS:
        d = lake.get(f"silver.{dim}")
        dup = d.groupBy("enterprise_key", "effective_start_date").count().filter(F.col("count") > 1)
        m = dup.agg(F.count(F.lit(1)).alias("n"))
        out.append(m.select(*_row("duplicates", dim, F.col("n"), 0, F.col("n") == 0)))
    return _union(out)


def gate_team_nonempty(lake) -> DataFrame:
    """Every current team has at least one position in its mart."""
    teams = lake.get("silver.business_unit_dim").filter(F.col("is_current")).select(F.col("bu_code").alias("team_code"))
    counts = lake.get("gold.position_analytics_fact", ids=False).groupBy("team_code").agg(F.count(F.lit(1)).alias("n"))
    j = teams.join(counts, "team_code", "left").withColumn("n", F.coalesce(F.col("n"), F.lit(0)))
    return j.select(*_row("team_nonempty", F.col("team_code"), F.col("n"), 1, F.col("n") >= 1))


def gate_consolidated_sum(lake) -> DataFrame:
    """E5: consolidated position rows = sum of the PD teams' rows."""
    pd_teams = lake.get("silver.business_unit_dim").filter(F.col("is_current") & F.col("is_pd_strategy")) \
        .select(F.col("bu_code").alias("team_code"))
    teams = lake.get("gold.position_analytics_fact", ids=False).join(F.broadcast(pd_teams), "team_code", "left_semi") \
        .agg(F.count(F.lit(1)).alias("teams_n"))
    cons = lake.get("gold.consolidated_position_book", ids=False).agg(F.count(F.lit(1)).alias("cons_n"))
    j = cons.crossJoin(teams)
    return j.select(F.lit("consolidated_sum").alias("gate"), F.lit("consolidated_position_book").alias("subject"),
                    F.col("cons_n").cast("double").alias("metric"), F.col("teams_n").cast("double").alias("expected"),
                    F.when(F.col("cons_n") == F.col("teams_n"), "PASS").otherwise("FAIL").alias("status"))


def gate_scd2_current(lake) -> DataFrame:
    """Exactly one current row per key."""
    out = []
    for dim in SCD_DIMS:
        d = lake.get(f"silver.{dim}")
        key = "rated_enterprise_key" if dim == "rating_dim" else "enterprise_key"
        bad = d.groupBy(key).agg(F.sum(F.col("is_current").cast("int")).alias("c")).filter(F.col("c") != 1)
        m = bad.agg(F.count(F.lit(1)).alias("n"))
        out.append(m.select(*_row("scd2_current", dim, F.col("n"), 0, F.col("n") == 0)))
    return _union(out)


def gate_scd2_overlap(lake) -> DataFrame:
    """Overlapping validity ranges. Sorting versions by start, two ranges
    of a key overlap iff some version starts on or before the previous one's
    end, so one lag per row replaces the pairwise self-join. Versions are taken
    in blocks with the one before, so a key with very many is not one task."""
    out = []
    for dim in SCD_DIMS:
        d = lake.get(f"silver.{dim}")
        key = "rated_enterprise_key" if dim == "rating_dim" else "enterprise_key"
        sk = SCD_DIMS[dim]
        d = d.select(key, sk, "effective_start_date", "effective_end_date")
        seen = segmented_window(d, [key], ["effective_start_date", sk], F.year("effective_start_date"), 1, {
            "prev_end": lambda w: F.lag("effective_end_date").over(w)})
        bad = seen.filter(F.col("effective_start_date") <= F.col("prev_end"))
        m = bad.agg(F.count(F.lit(1)).alias("n"))
        out.append(m.select(*_row("scd2_overlap", dim, F.col("n"), 0, F.col("n") == 0)))
    return _union(out)


def gate_scd2_dates(lake) -> DataFrame:
    """Start <= end on every row."""
    out = []
    for dim in SCD_DIMS:
        d = lake.get(f"silver.{dim}")
        m = d.filter(F.col("effective_start_date") > F.col("effective_end_date")).agg(F.count(F.lit(1)).alias("n"))
        out.append(m.select(*_row("scd2_dates", dim, F.col("n"), 0, F.col("n") == 0)))
    return _union(out)


def gate_scd2_links(lake) -> DataFrame:
    """Every previous-version link points at an existing row."""
    out = []
    for dim, sk in SCD_DIMS.items():
        d = lake.get(f"silver.{dim}")
        links = d.filter(F.col("preceding_record_sk").isNotNull()).select(F.col("preceding_record_sk").alias(sk))
        dangling = links.join(d.select(sk), sk, "left_anti")
        m = dangling.agg(F.count(F.lit(1)).alias("n"))
        out.append(m.select(*_row("scd2_links", dim, F.col("n"), 0, F.col("n") == 0)))
    return _union(out)


def gate_nonempty(lake) -> DataFrame:
    """No bronze entity is empty."""
    out = []
    for name in BRONZE_ENTITIES:
        m = lake.get(f"bronze.{name}").agg(F.count(F.lit(1)).alias("n"))
        out.append(m.select(*_row("nonempty", name, F.col("n"), 1, F.col("n") >= 1)))
    return _union(out)


def gate_conflict_density(lake) -> DataFrame:
    """Share of rows with a source conflict stays below 50 % per entity."""
    a = lake.get("bronze.lineage_audit").groupBy("entity_name").agg(
        F.sum("row_count").alias("rows"), F.sum("conflict_rows").alias("conf"))
    ratio = F.col("conf").cast("double") / F.when(F.col("rows") != 0, F.col("rows").cast("double"))
    return a.select(*_row("conflict_density", F.col("entity_name"), ratio, 0.5, F.coalesce(ratio, F.lit(0.0)) < 0.5))


def gate_missing_fx(lake) -> DataFrame:
    """Positions whose currency has no rate on their day (the default rate of 1
    was used): per currency, none is allowed."""
    p = lake.get("silver.position_analytics_fact", ids=False).filter(F.col("currency_code") != "USD")
    m = p.groupBy("currency_code").agg(F.sum(F.col("fx_rate_to_usd").isNull().cast("int")).alias("n"))
    return m.select(*_row("missing_fx", F.col("currency_code"), F.col("n"), 0, F.col("n") == 0))


def triplet_coverage(lake) -> DataFrame:
    """E1 re-aimed at the team marts (U4): teams of the business-unit dimension
    EXCEPT (teams with positions INTERSECT teams with portfolio analytics)."""
    teams = lake.get("silver.business_unit_dim").filter(F.col("is_current")).select(F.col("bu_code").alias("team_code"))
    with_pos = teams_with_positions(lake)
    with_pa = lake.get("gold.portfolio_analytics_fact").select("team_code")
    covered = with_pos.intersect(with_pa)
    missing = teams.subtract(covered)
    present = teams.intersect(covered)
    return missing.select("team_code", F.lit("MISSING").alias("coverage")).unionByName(
        present.select("team_code", F.lit("COVERED").alias("coverage")))


def entity_coverage(lake, names=None) -> DataFrame:
    """Entities (``names``, or all of the stored layers) against their stored
    versions. One row each: the stored version, the columns that are missing in it or
    only in it, and COVERED if it exists with the columns and types of the live frame."""
    wanted = lake.stored_names() if names is None else list(names)
    kinds = "entity string, column string, type string"

    def columns(read, of) -> DataFrame:
        return lake.spark.createDataFrame([(n, *c) for n in of for c in read(n).dtypes], kinds)
    version = {n: lake.store.current_version(n) for n in wanted}
    live = columns(lambda n: lake.get(n, mode="view"), wanted)
    stored = columns(lake.store.read, [n for n in wanted if version[n] is not None])
    apart = live.subtract(stored).withColumn("side", F.lit("live")).unionByName(
        stored.subtract(live).withColumn("side", F.lit("stored")))
    counts = apart.groupBy("entity").agg(F.sum((F.col("side") == "live").cast("bigint")).alias("only_live"),
                                         F.sum((F.col("side") == "stored").cast("bigint")).alias("only_stored"))
    every = lake.spark.createDataFrame(list(version.items()), "entity string, version int")
    n = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("only_live", "only_stored")}
    state = F.when(F.col("version").isNull(), "MISSING").when(n["only_live"] + n["only_stored"] > 0, "DIFFERENT")
    return every.join(counts, "entity", "left").select(
        "entity", "version", *[v.alias(c) for c, v in n.items()], state.otherwise("COVERED").alias("coverage"))


# ----------------------------------------------------------------- parity
PARITY_ENTITIES = ["bronze.position", "silver.position_analytics_fact", "gold.position_analytics_fact"]


def _materialised(lake, names):
    """Refresh the entities into the lake's snapshot store (table / mv); one that reads
    another of them reads what was just stored."""
    fresh = {}
    for n in names:
        with lake.reading(fresh):
            lake.refresh(n)
        fresh[n] = lake.store.read(n)
    return fresh


def _live(lake):
    """A lake of its own that shares no frame with ``lake``: every entity is
    built again from the sources."""
    return type(lake)(lake.spark, lake.sf_dir, lake.cfg)


def _view(lake, name: str) -> DataFrame:
    """An entity's live rows, written; what was written on the way to them goes."""
    kept = f"{name}@view"
    with passing_cuts(lake.spark):
        version = lake.store.write(kept, _live(lake).get(name, mode="view"))
    return lake.store.read(kept, version)


OLD = dt.date(2000, 1, 1)


def _old(lake, name: str) -> DataFrame:
    """A snapshot that is behind: it ends before 2000."""
    df = lake.store.read(name).filter(F.col("position_date") < F.lit(OLD))
    return lake.store.read(f"{name}@old", lake.store.write(f"{name}@old", df))


def gate_parity(lake) -> DataFrame:
    """E6 / R9m / J17 over freshly stored snapshots, and over ones that are behind."""
    _materialised(lake, PARITY_ENTITIES)
    for n in PARITY_ENTITIES:
        _old(lake, n)
    return parity_rows(lake, [x for n in PARITY_ENTITIES for x in (n, f"{n}@old")])


def parity_rows(lake, names) -> DataFrame:
    """Live view vs stored snapshot, by count and measure sum (two 1-row
    aggregates joined); SKIP where the lake has no snapshot."""
    live = _live(lake)
    out, views = [], {}
    for n in names:
        entity = n.split("@")[0]
        measure = "market_value_local" if n.startswith("bronze") else "market_value_usd"
        if entity not in views:          # one row, for all snapshots of the entity
            views[entity] = cut_lineage(live.get(entity, mode="view", ids=False).agg(
                F.count(F.lit(1)).alias("v_n"), F.sum(measure).alias("v_sum")))
        a = views[entity]
        there = lake.store is not None and lake.store.exists(n)
        if there:
            b = lake.store.read(n).agg(F.count(F.lit(1)).alias("mv_n"), F.sum(measure).alias("mv_sum"))
            j = a.crossJoin(b)
            same = F.col("v_n").eqNullSafe(F.col("mv_n")) & F.col("v_sum").eqNullSafe(F.col("mv_sum"))
            status = F.when(same, "PASS").otherwise("FAIL")
        else:
            j = a.withColumn("mv_n", F.lit(None).cast("bigint")).withColumn("mv_sum", F.lit(None).cast("double"))
            status = F.lit("SKIP")
        out.append(j.select(F.lit("parity").alias("gate"), F.lit(n).alias("subject"),
                            F.col("v_n").alias("view_rows"), F.col("mv_n").alias("mv_rows"),
                            F.col("v_sum").cast("double").alias("view_sum"),
                            F.col("mv_sum").cast("double").alias("mv_sum"), status.alias("status")))
    return _union(out)


def gate_set_difference(lake) -> DataFrame:
    """EXCEPT ALL in both directions between the view and the snapshot."""
    n = "gold.position_analytics_fact"
    stored = _materialised(lake, [n])[n]
    v = _view(lake, n)                   # compared with each of the snapshots
    late = F.col("position_date") >= F.lit(OLD)
    value = F.when(late, F.col("market_value_usd") + 1).otherwise(F.col("market_value_usd"))
    changed = stored.withColumn("market_value_usd", value.cast(stored.schema["market_value_usd"].dataType))
    # rows that the change leaves as they are go with the stored ones
    is_late = F.coalesce(late, F.lit(False))
    counts = _counts(v.columns, [
        (v, {"v": F.lit(1)}), (stored, {"mv": F.lit(1), "changed": F.when(is_late, 0).otherwise(1)}),
        (changed.filter(is_late), {"changed": F.lit(1)}), (_old(lake, n), {"old": F.lit(1)})])
    # one row of all differences, written so that the rows are compared once
    more = cut_lineage(counts.agg(*[_surplus(a, b).alias(f"{a}_minus_{b}") for s in ("mv", "old", "changed") for a, b in (("v", s), (s, "v"))]))
    out = []
    for tag, s in (("", "mv"), ("@old", "old"), ("@changed", "changed")):
        out.append(more.select(F.col(f"v_minus_{s}").alias("view_minus_mv"), F.col(f"{s}_minus_v").alias("mv_minus_view")).select(
            F.lit(n + tag).alias("subject"), "view_minus_mv", "mv_minus_view",
            F.when((F.col("view_minus_mv") == 0) & (F.col("mv_minus_view") == 0), "PASS").otherwise("FAIL").alias("status")))
    return _union(out)


def _both_ways(a: DataFrame, b: DataFrame, a_minus_b: str, b_minus_a: str) -> DataFrame:
    """Row counts of ``a`` EXCEPT ALL ``b`` and ``b`` EXCEPT ALL ``a``."""
    counts = _counts(a.columns, [(a, {"a": F.lit(1)}), (b, {"b": F.lit(1)})])
    return counts.agg(_surplus("a", "b").alias(a_minus_b), _surplus("b", "a").alias(b_minus_a))


def _counts(columns: list[str], frames: list) -> DataFrame:
    """How often each row comes on each side, from one pass over all: ``frames`` are pairs of
    rows and the sides that they count for."""
    sides = sorted({side for _, marks in frames for side in marks})
    every = _union([df.select(*columns, *[marks.get(side, F.lit(0)).cast("int").alias(f"__{side}") for side in sides]) for df, marks in frames])
    return every.groupBy(*columns).agg(*[F.sum(f"__{side}").alias(f"__{side}") for side in sides])


def _surplus(a: str, b: str):
    """Rows of side ``a`` EXCEPT ALL side ``b``: how many more of each row the one holds than the other."""
    return F.coalesce(F.sum(F.greatest(F.col(f"__{a}") - F.col(f"__{b}"), F.lit(0))), F.lit(0)).cast("bigint")


def parity_pivot(lake) -> DataFrame:
    """Row counts of view / mv / table per entity, pivoted to columns."""
    stored = _materialised(lake, PARITY_ENTITIES)
    live = _live(lake)
    parts = []
    for n in PARITY_ENTITIES:
        rows = live.get(n, mode="view")
        with passing_cuts(lake.spark):       # its frames are kept for the next entity, the rows themselves only until they are stored
            view = cut_lineage(rows)
            counted = lake.store.write(f"v_{n}", view.agg(F.count(F.lit(1)).alias("n")))
            t_version = lake.store.write(f"t_{n}", view)
        parts.append(lake.store.read(f"v_{n}", counted).select(F.lit(n).alias("entity"), F.lit("v").alias("kind"), "n"))
        parts.append(stored[n].agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(n).alias("entity"), F.lit("mv").alias("kind"), "n"))
        parts.append(lake.store.read(f"t_{n}", t_version).agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(n).alias("entity"), F.lit("t").alias("kind"), "n"))
        parts.append(_old(lake, n).agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(n).alias("entity"), F.lit("old").alias("kind"), "n"))
    long = _union(parts)
    return long.groupBy("entity").agg(
        F.max(F.when(F.col("kind") == "v", F.col("n"))).alias("v_count"),
        F.max(F.when(F.col("kind") == "mv", F.col("n"))).alias("mv_count"),
        F.max(F.when(F.col("kind") == "t", F.col("n"))).alias("t_count"),
        F.max(F.when(F.col("kind") == "old", F.col("n"))).alias("old_count"))
