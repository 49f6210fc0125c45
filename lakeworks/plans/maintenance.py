"""Change operations on stored dimensions and the key crosswalk.

Each function takes the current state and a change batch (both DataFrames)
and returns the new state or the classified batch - the Spark equivalent of
the reference's procedures, as one set-based plan per call instead of a row
loop. The report builders at the bottom derive their change batches from the
driver tables (customer segments), so every run covers whole tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.operators.dedup import latest_wins
from lakeworks.operators.delta import delta_counts, hash_delta, watermark_delta
from lakeworks.operators.keys import resolve_as_of, star_current
from lakeworks.operators.rowid import dense_row_id
from lakeworks.operators.scd2 import apply_scd2, chain_batch, close_versions, soft_delete
from lakeworks.operators.temporal import anchor_resolve
from lakeworks.plans.mart import KEY_DOMAINS, SOURCE_REGISTRY

SUPERSEDE_DATE = dt.date(2001, 1, 1)
SOFT_DELETE_DATE = dt.date(1999, 6, 30)
APPLY_DATE = dt.date(2001, 1, 1)
XW_KEY = ["domain_code", "source_system", "source_key", "target_system"]


# ------------------------------------------------------------- crosswalk ops
def add_mappings(xw: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Validate and insert a batch of mappings.

    Error codes: 45001 unknown domain, 45002 unknown source system, 45003
    unknown target system, 45004 a current mapping already exists. Returns
    (new crosswalk, batch with status / error_code / crosswalk_sk).
    """
    spark = xw.sparkSession
    domains = spark.createDataFrame([(d,) for d, _ in KEY_DOMAINS], "domain_code string")
    systems = spark.createDataFrame([(s,) for s, _ in SOURCE_REGISTRY], "sys string")
    b = batch.join(F.broadcast(domains.withColumn("__dom_ok", F.lit(True))), "domain_code", "left")
    b = b.join(F.broadcast(systems.select(F.col("sys").alias("source_system"), F.lit(True).alias("__src_ok"))),
               "source_system", "left")
    b = b.join(F.broadcast(systems.select(F.col("sys").alias("target_system"), F.lit(True).alias("__tgt_ok"))),
               "target_system", "left")
    if "split_sequence" not in b.columns:
        b = b.withColumn("split_sequence", F.lit(None).cast("int"))
    # a row without a split sequence clashes with any current mapping of its
    # key, a row with one only with the same sequence; rows of the batch count
    # in the order of (effective_start_date, target_key)
    cur = xw.filter(F.col("is_current"))
    any_ = cur.select(*XW_KEY).distinct().withColumn("__any", F.lit(True))
    same = cur.select(*XW_KEY, "split_sequence").distinct().withColumn("__same", F.lit(True))
    b = b.join(any_, XW_KEY, "left").join(same, [*XW_KEY, "split_sequence"], "left")
    order = ["effective_start_date", "target_key", "split_sequence"]
    in_key = F.row_number().over(Window.partitionBy(*XW_KEY).orderBy(*order))
    in_split = F.row_number().over(Window.partitionBy(*XW_KEY, "split_sequence").orderBy(*order))
    b = b.withColumn("__k", in_key).withColumn("__s", in_split)
    dup = F.when(F.col("split_sequence").isNull(), F.col("__any").isNotNull() | (F.col("__k") > 1)) \
        .otherwise(F.col("__same").isNotNull() | (F.col("__s") > 1))
    err = (F.when(F.col("__dom_ok").isNull(), F.lit(45001)).when(F.col("__src_ok").isNull(), F.lit(45002))
           .when(F.col("__tgt_ok").isNull(), F.lit(45003)).when(dup, F.lit(45004)))
    b = b.withColumn("error_code", err).withColumn(
        "status", F.when(F.col("error_code").isNull(), "INSERTED").otherwise("REJECTED")) \
        .drop("__dom_ok", "__src_ok", "__tgt_ok", "__any", "__same", "__k", "__s")
    ok = b.filter(F.col("status") == "INSERTED")
    base = xw.agg(F.coalesce(F.max("crosswalk_sk"), F.lit(0)).alias("__max"))
    ok = dense_row_id(ok, XW_KEY + ["target_key", "split_sequence"], "__n").crossJoin(F.broadcast(base)) \
        .withColumn("crosswalk_sk", (F.col("__max") + F.col("__n")).cast("bigint")).drop("__n", "__max")
    rejected = b.filter(F.col("status") == "REJECTED").withColumn("crosswalk_sk", F.lit(None).cast("bigint"))
    result = ok.unionByName(rejected)
    new_rows = ok.select(
        *XW_KEY, "target_key", "relationship_type", F.coalesce("split_sequence", F.lit(1)).alias("split_sequence"),
        "effective_start_date", F.lit(None).cast("date").alias("effective_end_date"), F.lit(True).alias("is_current"),
        "crosswalk_sk", F.lit(None).cast("bigint").alias("succeeding_record_sk"),
        F.lit(None).cast("bigint").alias("preceding_record_sk"))
    return xw.unionByName(new_rows.select(*xw.columns)), result


def supersede_mappings(xw: DataFrame, batch: DataFrame, eff_date: dt.date) -> tuple[DataFrame, DataFrame]:
    """Replace the current target of each (domain, source, key, target system)
    (C10): insert the new version, close the old one the day before and link
    both ways. Keys without a current mapping: error 45005.

    Optional batch columns: ``effective_date`` (default ``eff_date``) and
    ``new_relationship_type`` (default: the old one's). Several rows for a key
    supersede each other in the order of (effective date, target_key)."""
    cur = star_current(xw).select(*XW_KEY, F.col("crosswalk_sk").alias("__old_sk"),
                                  F.col("relationship_type").alias("__rel"))
    b = batch.join(cur, XW_KEY, "left")
    date = F.coalesce(F.col("effective_date"), F.lit(eff_date)) if "effective_date" in batch.columns else F.lit(eff_date)
    rel = F.coalesce("new_relationship_type", "__rel") if "new_relationship_type" in batch.columns else F.col("__rel")
    b = b.withColumn("__date", date).withColumn("__rel", rel)
    b = b.withColumn("error_code", F.when(F.col("__old_sk").isNull(), F.lit(45005))) \
        .withColumn("status", F.when(F.col("__old_sk").isNull(), "REJECTED").otherwise("SUPERSEDED"))
    base = xw.agg(F.coalesce(F.max("crosswalk_sk"), F.lit(0)).alias("__max"))
    ok = dense_row_id(b.filter(F.col("status") == "SUPERSEDED"), [*XW_KEY, "__date", "target_key"], "__n") \
        .crossJoin(F.broadcast(base)) \
        .withColumn("crosswalk_sk", (F.col("__max") + F.col("__n")).cast("bigint")).drop("__n", "__max")
    ok = chain_batch(ok, XW_KEY, "crosswalk_sk", "__date") \
        .withColumn("superseded_sk", F.coalesce("__prev", "__old_sk").cast("bigint"))
    changes = ok.filter(F.col("__prev").isNull()).select(
        F.col("__old_sk").alias("crosswalk_sk"), F.col("__date").alias("close_date"),
        F.col("crosswalk_sk").alias("successor_sk"))
    closed = close_versions(xw, changes, "crosswalk_sk")
    new_rows = ok.select(
        *XW_KEY, "target_key", F.col("__rel").alias("relationship_type"), F.lit(1).alias("split_sequence"),
        F.col("__date").alias("effective_start_date"), F.date_sub("__next_start", 1).alias("effective_end_date"),
        F.col("__next").isNull().alias("is_current"), "crosswalk_sk",
        F.col("__next").cast("bigint").alias("succeeding_record_sk"),
        F.col("superseded_sk").alias("preceding_record_sk"))
    out = [*XW_KEY, "target_key", "status", "error_code", "superseded_sk", "crosswalk_sk"]
    none = F.lit(None).cast("bigint")
    rejected = b.filter(F.col("status") == "REJECTED").withColumn("superseded_sk", none).withColumn("crosswalk_sk", none)
    return closed.unionByName(new_rows.select(*closed.columns)), ok.select(*out).unionByName(rejected.select(*out))


# ------------------------------------------------------------ report builders
def _segment_batch(lake, segment: str) -> DataFrame:
    return lake.roles.t.customer.filter(F.col("c_mktsegment") == segment).select(
        F.col("c_custkey").cast("bigint").alias("c"))


def mapping_add_report(lake) -> DataFrame:
    """Batch: BUILDING customers get new ids (accepted); AUTOMOBILE re-send an
    existing id (duplicate); FURNITURE / HOUSEHOLD / MACHINERY use an unknown
    domain / source / target system."""
    cs = F.col("c").cast("string")

    def arm(segment, domain, source, target, key):
        return _segment_batch(lake, segment).select(
            F.lit(domain).alias("domain_code"), F.lit(source).alias("source_system"), key.alias("source_key"),
            F.lit(target).alias("target_system"), F.concat(F.lit("EK_CUS_"), cs).alias("target_key"),
            F.lit("ONE_TO_ONE").alias("relationship_type"), F.lit(dt.date(2001, 1, 1)).alias("effective_start_date"))

    batch = (arm("BUILDING", "ENTITY", "STATE_STREET", "ENTERPRISE", F.concat(F.lit("SS_NEW_"), cs))
             .unionByName(arm("AUTOMOBILE", "ENTITY", "STATE_STREET", "ENTERPRISE", F.concat(F.lit("SS_ENT_"), cs)))
             .unionByName(arm("FURNITURE", "FUND", "STATE_STREET", "ENTERPRISE", F.concat(F.lit("SS_F_"), cs)))
             .unionByName(arm("HOUSEHOLD", "ENTITY", "CUSTODIAN_X", "ENTERPRISE", F.concat(F.lit("SS_H_"), cs)))
             .unionByName(arm("MACHINERY", "ENTITY", "STATE_STREET", "LEDGER_X", F.concat(F.lit("SS_M_"), cs))))
    _, result = add_mappings(lake.get("mart.key_crosswalk"), batch)
    return result.select("domain_code", "source_system", "source_key", "target_system", "target_key", "status",
                         "error_code", "crosswalk_sk")


def mapping_supersede_report(lake) -> DataFrame:
    """BUILDING customers' custody ids move to a merged target from 2001-01-01;
    FURNITURE ids that were never mapped are rejected (45005). Returns the
    touched crosswalk rows (closed and new) plus the rejects."""
    cs = F.col("c").cast("string")
    ok = _segment_batch(lake, "BUILDING").select(
        F.lit("ENTITY").alias("domain_code"), F.lit("STATE_STREET").alias("source_system"),
        F.concat(F.lit("SS_ENT_"), cs).alias("source_key"), F.lit("ENTERPRISE").alias("target_system"),
        F.concat(F.lit("EK_CUS_"), cs, F.lit("_M")).alias("target_key"))
    bad = _segment_batch(lake, "FURNITURE").select(
        F.lit("ENTITY").alias("domain_code"), F.lit("STATE_STREET").alias("source_system"),
        F.concat(F.lit("SS_MISSING_"), cs).alias("source_key"), F.lit("ENTERPRISE").alias("target_system"),
        F.concat(F.lit("EK_CUS_"), cs).alias("target_key"))
    xw = lake.get("mart.key_crosswalk")
    new_xw, result = supersede_mappings(xw, ok.unionByName(bad), SUPERSEDE_DATE)
    touched = result.filter(F.col("status") == "SUPERSEDED").select(
        F.col("superseded_sk").alias("sk1"), F.col("crosswalk_sk").alias("sk2"))
    sks = touched.select(F.col("sk1").alias("crosswalk_sk")).unionByName(touched.select(F.col("sk2").alias("crosswalk_sk")))
    rows = new_xw.join(sks, "crosswalk_sk", "left_semi").select(
        "crosswalk_sk", "source_key", "target_key", "effective_start_date", "effective_end_date", "is_current",
        "preceding_record_sk", "succeeding_record_sk", F.lit("SUPERSEDED").alias("status"),
        F.lit(None).cast("int").alias("error_code"))
    rej = result.filter(F.col("status") == "REJECTED").select(
        F.lit(None).cast("bigint").alias("crosswalk_sk"), "source_key", "target_key",
        F.lit(None).cast("date").alias("effective_start_date"), F.lit(None).cast("date").alias("effective_end_date"),
        F.lit(None).cast("boolean").alias("is_current"), F.lit(None).cast("bigint").alias("preceding_record_sk"),
        F.lit(None).cast("bigint").alias("succeeding_record_sk"), "status", "error_code")
    return rows.unionByName(rej)


def resolve_as_of_report(lake) -> DataFrame:
    """Custody entity id of every star position resolved on the position date."""
    f = lake.get("mart.fact_position").select("position_id", "position_date", "entity_sk")
    e = lake.get("mart.dim_entity").select("entity_sk", "enterprise_entity_id")
    f = f.join(e, "entity_sk").withColumn(
        "source_key", F.concat(F.lit("SS_ENT_"), F.substring("enterprise_entity_id", 8, 20)))
    out = resolve_as_of(f, lake.get("mart.key_crosswalk"), "ENTITY", "STATE_STREET", "ENTERPRISE", "source_key",
                        "position_date", "target_key", "position_id")
    return out.select("position_id", "position_date", "source_key", "target_key")


def resolve_all_targets_report(lake) -> DataFrame:
    """Every current custody id with all its targets (one-to-many splits in order)."""
    cur = lake.get("mart.key_crosswalk").filter(
        F.col("is_current") & (F.col("domain_code") == "ENTITY") & (F.col("source_system") == "STATE_STREET"))
    n = cur.groupBy("source_key").agg(F.count(F.lit(1)).alias("n_targets"))
    return cur.join(n, "source_key").select("source_key", "split_sequence", "target_key", "relationship_type",
                                            "n_targets")


def resolve_all_sources_report(lake) -> DataFrame:
    """C4: every target key with all current source ids that map to it."""
    cur = lake.get("mart.key_crosswalk").filter(F.col("is_current"))
    n = cur.groupBy("target_key").agg(F.count(F.lit(1)).alias("n_sources"))
    return cur.join(n, "target_key").select("target_key", "source_system", "source_key", "relationship_type",
                                            "n_sources")


# ----------------------------------------------------------------- SCD2 ops
_DIM_COLS = ["entity_sk", "enterprise_key", "effective_start_date", "effective_end_date", "is_current",
             "preceding_record_sk", "succeeding_record_sk", "entity_name"]


def scd2_close_chain_report(lake) -> DataFrame:
    """Versions inserted open-ended are closed through the chain
    self-join (successor.preceding_sk = row.sk)."""
    d = lake.get("silver.entity_dim").select(*_DIM_COLS)
    open_rows = d.withColumn("effective_end_date", F.lit(dt.date(9999, 12, 31))) \
        .withColumn("is_current", F.lit(True)).withColumn("succeeding_record_sk", F.lit(None).cast("bigint"))
    succ = d.filter(F.col("preceding_record_sk").isNotNull()).select(
        F.col("preceding_record_sk").alias("entity_sk"), F.col("effective_start_date").alias("close_date"),
        F.col("entity_sk").alias("successor_sk"))
    return close_versions(open_rows, succ, "entity_sk")


def scd2_apply_report(lake) -> DataFrame:
    """BUILDING entities restructure on 2001-01-01 (successor inserted,
    predecessor closed and linked)."""
    d = lake.get("silver.entity_dim").select(*_DIM_COLS)
    ents = lake.get("silver.entity_dim").filter(F.col("is_current") & (F.col("entity_type") == "BUILDING"))
    changes = ents.select("enterprise_key", F.lit(APPLY_DATE).alias("effective_start_date"),
                          F.concat(F.col("entity_name"), F.lit(" (Merged)")).alias("entity_name"))
    return apply_scd2(d, changes, "enterprise_key", "entity_sk").select(*_DIM_COLS)


def scd2_soft_delete_report(lake) -> DataFrame:
    """HOUSEHOLD entities are deleted on 1999-06-30: their current
    row closes on that day with no successor."""
    d = lake.get("silver.entity_dim").select(*_DIM_COLS)
    dels = lake.get("silver.entity_dim").filter(F.col("is_current") & (F.col("entity_type") == "HOUSEHOLD")) \
        .select("enterprise_key", F.lit(SOFT_DELETE_DATE).alias("event_date"))
    return soft_delete(d, dels, "enterprise_key", "entity_sk")


# --------------------------------------------------------------- deltas (H1)
def hash_delta_report(lake) -> DataFrame:
    """Previous snapshot = first entity versions without MACHINERY customers;
    current = bronze entities without FURNITURE customers."""
    prev = lake.roles.entity.filter((F.col("version_no") == 1) & (F.col("entity_type") != "MACHINERY"))
    cur = lake.get("bronze.entity").filter(F.col("entity_type") != "FURNITURE")
    acts = hash_delta(cur, prev, ["enterprise_key"], ["entity_name", "entity_type", "jurisdiction"])
    return delta_counts(acts)


def watermark_delta_report(lake) -> DataFrame:
    """Target loaded up to 1998-12-31 (signing date); the source's newer rows
    are new keys (INSERT) or amendments of loaded keys (UPDATE)."""
    src = lake.roles.contract
    tgt = src.filter(F.col("signing_date") <= F.lit(dt.date(1998, 12, 31)))
    acts = watermark_delta(src, tgt, ["enterprise_key"], "signing_date")
    return acts.groupBy("action").agg(F.count(F.lit(1)).alias("row_count"),
                                      F.sum("principal_local").alias("principal_local"))


# ------------------------------------------------------------- anchor chain
def anchor_chain_report(lake) -> DataFrame:
    """Positions carry the FIRST version sk of their security and owner
    entity (anchors); each anchor resolves to the version valid on the
    position date. HOUSEHOLD entities are soft-deleted on 1999-06-30, so their
    later positions drop out of the inner resolution."""
    sec = lake.get("silver.security_dim")
    ent = scd2_soft_delete_report(lake)
    p = lake.get("bronze.position").select("enterprise_key", "position_date", "security_enterprise_key",
                                           "contract_source_key")
    sa = sec.filter(F.col("preceding_record_sk").isNull()).select(
        F.col("enterprise_key").alias("__sek"), F.col("security_sk").alias("security_anchor_sk"))
    p = p.join(sa, F.col("security_enterprise_key") == F.col("__sek"), "inner").drop("__sek")
    owners = lake.roles.contract.filter(F.col("version_no") == 1).select(
        F.col("source_key").alias("__ck"), F.concat(F.lit("EK_"), F.col("entity_source_key")).alias("__eek"))
    ea = ent.filter(F.col("preceding_record_sk").isNull()).select(
        F.col("enterprise_key").alias("__eek2"), F.col("entity_sk").alias("entity_anchor_sk"))
    p = p.join(owners, F.col("contract_source_key") == F.col("__ck"), "inner") \
        .join(ea, F.col("__eek") == F.col("__eek2"), "inner").drop("__ck", "__eek", "__eek2")
    p = anchor_resolve(p, "security_anchor_sk", sec, "security_sk", "enterprise_key", "position_date",
                       "security_sk_on_date")
    p = anchor_resolve(p, "entity_anchor_sk", ent, "entity_sk", "enterprise_key", "position_date",
                       "entity_sk_on_date")
    return p.select("enterprise_key", "position_date", "security_anchor_sk", "security_sk_on_date",
                    "entity_anchor_sk", "entity_sk_on_date")


# -------------------------------------------------------------------- JSON
def json_techniques_report(lake) -> DataFrame:
    """Parse the event payload into a map, explode its entries and
    aggregate per event type and key (also the typed path lookup)."""
    e = lake.roles.t.events.select("event_id", "event_type", "props")
    kv = e.select("event_type", F.explode(F.from_json("props", "map<string,int>")).alias("json_key", "json_value"),
                  F.get_json_object("props", "$.k").cast("int").alias("k_path"))
    return kv.groupBy("event_type", "json_key").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("json_value").alias("sum_value"),
        F.min("json_value").alias("min_value"), F.max("json_value").alias("max_value"),
        F.sum("k_path").alias("sum_k_path"))


def latest_mapping(xw: DataFrame) -> DataFrame:
    return latest_wins(xw, XW_KEY, [F.col("crosswalk_sk").desc()])
