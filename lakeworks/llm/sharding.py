"""Operator 2: shards by extendible hashing, in DataFrame operations only.

A directory maps prefixes of a 60-bit hash of the key to shards. It starts
with the empty prefix; only a bucket over the byte limit is split on one more
bit, so the depth differs from shard to shard. Sixteen bits are settled in one
pass from a histogram of byte sums by prefix (summed before the shuffle);
further passes look only at buckets that are still too large.

Defined cases: null text counts 0 bytes, a null key hashes as the empty
string. A bucket of one row is never split, so a row over the limit is a shard
of its own. Rows with the same hash (repeated keys) cannot be parted by bits:
they are laid out in pages by running byte totals, each page within the limit
(rows over half the limit have a page of their own). Empty input gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

BITS, STEP, PASSES = 60, 15, 4
LIMIT_BYTES = 1 << 20


def key_hash(key: Column) -> Column:
    """The first 60 bits of the key's md5."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("long")


def _directory(rows: DataFrame, done: int, limit: int) -> DataFrame:
    """(fine, depth): for each prefix of ``done + STEP`` bits the depth at which
    its bucket fits; null depth if it still doesn't at the full length."""
    fine = F.shiftright("h", BITS - done - STEP)
    hist = rows.groupBy(fine.alias("fine")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    levels = hist.select("*", F.explode(F.sequence(F.lit(0), F.lit(STEP))).alias("d"))
    levels = levels.withColumn("pre", F.expr(f"shiftright(fine, {STEP} - d)"))
    fits = (levels.groupBy("d", "pre").agg(F.sum("size").alias("total"), F.sum("n").alias("rows"))
            .where((F.col("total") <= limit) | (F.col("rows") == 1)).select("d", "pre"))
    found = levels.join(fits, ["d", "pre"]).groupBy("fine").agg(F.min("d").alias("d"))
    return hist.select("fine").join(found, "fine", "left").select("fine", (F.col("d") + done).alias("depth"))


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Pages for rows that share all bits: offsets per task first, then running
    totals inside each task's part, so that no key is numbered in one task."""
    part = rows.withColumn("part", F.shiftright("uid", 33))
    big = F.col("size") * 2 > limit
    part = part.withColumn("small", F.when(big, 0).otherwise(F.col("size"))).withColumn("big", big.cast("long"))
    sums = part.groupBy("h", "part").agg(F.sum("small").alias("s"), F.sum("big").alias("b"))
    before = Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("h", "part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s0"),
                       F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"))
    here = Window.partitionBy("h", "part").orderBy("uid")
    numbered = part.join(sums, ["h", "part"]).withColumn("at", F.col("s0") + F.sum("small").over(here))
    numbered = numbered.withColumn("nth", F.col("b0") + F.sum("big").over(here))
    page = F.when(F.col("big") == 1, -F.col("nth")).otherwise(
        F.greatest(F.expr(f"(at - 1) div {max(limit // 2, 1)}"), F.lit(0)))
    more = [c for c in ("doc",) if c in rows.columns]
    return numbered.select("doc_id", "size", "h", F.lit(BITS).alias("depth"), page.cast("long").alias("page"), *more)


def assign(docs: DataFrame, limit: int = LIMIT_BYTES, id_col: str = "doc_id", text_col: str = "text",
           whole: bool = False) -> DataFrame:
    """doc_id, n_bytes, depth, prefix (the shard's bits as text), page; with
    ``whole`` also doc, the row itself as a struct."""
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long")
    more = ["doc"] if whole else []
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), size.alias("size"), key_hash(F.col(id_col)).alias("h"),
                           F.monotonically_increasing_id().alias("uid"),
                           *([F.struct(*docs.columns).alias("doc")] if whole else [])))
    settled, left, page = [], rows, F.lit(0).cast("long").alias("page")
    for k in range(PASSES):
        directory = _directory(left.drop(*more), k * STEP, limit)
        if k == 0:
            directory = F.broadcast(directory)  # at most 2**15 rows of 12 bytes
        joined = left.withColumn("fine", F.shiftright("h", BITS - (k + 1) * STEP)).join(directory, "fine")
        settled.append(joined.where("depth is not null").select("doc_id", "size", "h", "depth", page, *more))
        left = cut(joined.where("depth is null").select("doc_id", "size", "h", "uid", *more))
        if left.isEmpty():
            break
    else:
        settled.append(_pages(left, limit))
    bits = F.expr(f"substring(lpad(bin(h), {BITS}, '0'), 1, depth)")
    return reduce(DataFrame.unionByName, settled).select(
        "doc_id", F.col("size").alias("n_bytes"), F.col("depth").cast("int").alias("depth"),
        bits.alias("prefix"), "page", *more)


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write all rows of ``docs``, one folder per shard. Rows are carried along
    with their keys, so a key may occur in any number of rows."""
    shards = assign(docs, limit, id_col, text_col, whole=True)
    tagged = shards.select("doc.*", F.concat_ws("-", "prefix", "page").alias("_shard"))
    tagged.repartition("_shard").write.partitionBy("_shard").parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH rows_ AS (
  SELECT doc_id, CAST(COALESCE(strlen(text), 0) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
levels AS (SELECT r.*, d, CAST(h >> CAST({BITS} - d AS BIGINT) AS BIGINT) AS pre
           FROM rows_ r, generate_series(0, {BITS}) AS g(d)),
sums AS (SELECT *, SUM(n_bytes) OVER w AS total, COUNT(*) OVER w AS n FROM levels WINDOW w AS (PARTITION BY d, pre)),
best AS (SELECT doc_id, n_bytes, h, MIN(d) AS depth FROM sums WHERE total <= {LIMIT_BYTES} OR n = 1
         GROUP BY doc_id, n_bytes, h)
SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth,
       substr(lpad(bin(h), {BITS}, '0'), 1, CAST(depth AS INTEGER)) AS prefix, CAST(0 AS BIGINT) AS page
FROM best
"""
