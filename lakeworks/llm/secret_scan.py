"""Operator 11: secrets in texts, in DataFrame operations only.

Three kinds are found by their form alone: ``assign`` (a password, secret, token
or API key that is given a value), ``access`` (an access identifier) and ``hex``
(a long hexadecimal string). Three more are weak, for ordinary texts hold them
too: ``login`` (a user or account name that is given), ``key`` (a long mixed
string) and ``endpoint`` (an address). A credential has several parts, so a weak
candidate is reported only where the parts that complete it stand nearby:

* every identifier (``access``, ``login``) opens a scope that reaches ``reach``
  code points to either side;
* secrets and endpoints are joined to the scopes that hold their start: scopes
  are laid into bins of the reach's width, a part lies in one bin, and the join
  is on row and bin with the range as a residual;
* a scope is complete if it has a secret that is sure (``assign``, ``hex``), or a
  weak one (``key``) beside an ``access`` or an ``endpoint``. Complete scopes
  report their ``login`` and endpoints, and their keys where an access
  identifier or an endpoint stands by.

Spans are in code points, end exclusive. They are never cut short: matches come
from the whole text, whatever its length, in one pass over the texts that keeps
the lengths of matches and of the gaps between them; only those are shuffled.

Defined cases: a null text is empty; rows are told apart by their place in the
input, so repeated rows and equal or null ids are scanned each for itself;
empty texts have no spans; an empty table gives no rows; other columns are not
looked at, whatever their names. Ties in the order of spans go by kind, then end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

REACH = 400

# The three base kinds are given by contract, with the least
# length of their group; the weak kinds follow.
KINDS = ("assign", "access", "hex", "login", "key", "endpoint")
VALUE = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": r"(?i)(password|passwd|secret|token|api_?key)" + VALUE,
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "login": r"(?i)(user_?name|user_?id|login|account|client_?id)" + VALUE,
    "key": r"[A-Za-z0-9+/_-]{32,}+={0,2}",
    "endpoint": r"(?i)(?:https?|wss?|s?ftp|ssh|s3|gs|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D\"'<>]+",
}
VALUE_CHARS = {"assign": 6, "login": 3}
BASE = ("assign", "access", "hex")
IDENTIFIERS = ("access", "login")

FOUND = "array<struct<kind:int,nth:int,gap:int,size:int,ok:boolean,text:string>>"


def _matches(text: Column, kind: str) -> Column:
    """What the pattern of ``kind`` matches in ``text``, from left to right: the
    number, the code points since the last match, its own, and whether it counts."""
    pattern = PATTERNS[kind]
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2 if kind in VALUE_CHARS else 0))

    def one(x: Column, i: Column) -> Column:
        match = x["match"]
        ok = {"assign": F.length(x["value"]) >= VALUE_CHARS["assign"], "login": F.length(x["value"]) >= VALUE_CHARS["login"],
              "key": match.rlike("[a-z]") & match.rlike("[A-Z]") & match.rlike("[0-9]")}.get(kind, F.lit(True))
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("nth"), F.length(x["gap"]).alias("gap"),
                        F.length(match).alias("size"), ok.alias("ok"), match.alias("text"))

    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"), value.alias("value"))
    # the text after the last match is the gap of none
    found = F.transform(F.filter(zipped, lambda x: x["match"].isNotNull()), one)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(FOUND))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows: row, doc_id; spans: row, kind, start, end, text). One pass over the texts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    seen = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.concat(*(_matches(text, k) for k in KINDS)).alias("found"))
    seen = cut(seen)  # row numbers hold for all that follows
    before = Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    each = seen.where(F.size("found") > 0).select("row", F.inline("found"))
    ends = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before))
    spans = ends.where("ok").select("row", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "text")
    return seen.select("row", "doc_id"), spans


def _is(column: str, *kinds: str) -> Column:
    return F.col(column).isin([KINDS.index(k) for k in kinds])


def link(spans: DataFrame, reach: int = REACH) -> DataFrame:
    """Interval join of identifiers with the parts in their scopes, of complete
    scopes only: row, id_kind, id_start, id_end, kind, start, end (kinds by number)."""
    # a weak candidate that overlaps what is found by form alone is no part of its own
    bins = F.explode(F.expr(f"sequence(start div {reach}, (end - 1) div {reach})"))
    base = spans.where(_is("kind", *BASE)).select("row", bins.alias("bin"), F.col("start").alias("b0"), F.col("end").alias("b1"))
    weak = spans.where(~_is("kind", *BASE)).select("row", "kind", "start", "end", bins.alias("bin"))
    covered = weak.join(base, ["row", "bin"]).where("start < b1 and b0 < end").select("row", "kind", "start").distinct()
    left = spans.join(covered, ["row", "kind", "start"], "left_anti")

    first, last = F.col("start") - reach, F.col("end") + reach
    scopes = left.where(_is("kind", *IDENTIFIERS)).select(
        "row", F.col("kind").alias("id_kind"), F.col("start").alias("id_start"), F.col("end").alias("id_end"),
        F.explode(F.sequence(F.floor(F.greatest(first, F.lit(0)) / reach), F.floor(last / reach))).alias("bin"))
    parts = left.where(~_is("kind", *IDENTIFIERS)).select("row", "kind", "start", "end", F.floor(F.col("start") / reach).alias("bin"))
    held = scopes.join(parts, ["row", "bin"]).where(
        (F.col("start") >= F.col("id_start") - reach) & (F.col("start") < F.col("id_end") + reach)).drop("bin")
    scope = Window.partitionBy("row", "id_kind", "id_start")
    sure, weak_key, address = (F.max(_is("kind", *k)).over(scope) for k in (("assign", "hex"), ("key",), ("endpoint",)))
    strong = _is("id_kind", "access")
    return (held.withColumn("backed", strong | address)
            .withColumn("complete", sure | (weak_key & F.col("backed")))
            .where(F.col("complete") & (~_is("kind", "key") | F.col("backed"))).drop("backed", "complete"))


def reported(spans: DataFrame, reach: int = REACH) -> DataFrame:
    """row, kind, start, end: the base spans, and the weak ones that a complete scope reports."""
    linked = link(spans, reach)
    login = linked.where(_is("id_kind", "login")).select("row", F.col("id_kind").alias("kind"), F.col("id_start").alias("start"),
                                                         F.col("id_end").alias("end"))
    parts = linked.where(~_is("kind", *BASE)).select("row", "kind", "start", "end")
    return (spans.where(_is("kind", *BASE)).select("row", "kind", "start", "end")
            .unionByName(login.unionByName(parts).distinct()))


def report(docs: DataFrame, reach: int = REACH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    rows, spans = scan(docs, id_col, text_col)
    span = F.struct("start", "kind", "end")
    all_ = rows.select("row", "doc_id", F.lit(None).cast("struct<start:bigint,kind:int,end:bigint>").alias("span")).unionByName(
        reported(spans, reach).select("row", F.lit(None).cast("long").alias("doc_id"), span.alias("span")))
    own = all_.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sort_array(F.collect_list("span")).alias("s"))
    names = F.array(*map(F.lit, KINDS))

    def joined(column: Column) -> Column:
        return F.array_join(F.transform(column, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kinds: range) -> Column:
        return F.size(F.filter("s", lambda s: s["kind"].between(kinds[0], kinds[-1]))).cast("long")

    base = F.filter("s", lambda s: s["kind"] < len(BASE))
    counts = [count(range(i, i + 1)).alias(f"n_{k}") for i, k in enumerate(BASE)]
    return own.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"),
                      count(range(len(BASE), len(KINDS))).alias("n_linked"))


def redact(docs: DataFrame, reach: int = REACH, text_col: str = "text") -> DataFrame:
    """``docs`` with every assigned value, access identifier and hexadecimal
    string of its texts replaced by the name of its kind in brackets; null texts
    stay null. Needs no positions, so it is one pass without a shuffle."""
    def masked(text: Column, kind: str) -> Column:
        keep = VALUE_CHARS.get(kind)
        pattern = PATTERNS[kind] if keep is None else PATTERNS[kind][:-2] + f"{{{keep},}})"
        return F.regexp_replace(text, pattern, f"[{kind}]")

    return docs.withColumn(text_col, reduce(masked, BASE, F.col(text_col).cast("string")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
