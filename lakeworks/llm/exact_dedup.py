"""Operator 9: exact dedup by an extendible-hash index on shared files.

The key of a text is the leading bits of its normalised text's sha256. A first
scan records (doc_id, key, sha256, size) of every row; from the sizes by
key prefix a directory is grown by doubling: it starts with one bucket and
only a bucket whose entries exceed the byte limit is split on one more bit.
A second scan writes the index: each scan task pre-aggregates its own copies,
sends one entry per distinct text to the bucket that owns its key, and the
buckets become files in the shared checkpoint folder. Owner tasks then read
their bucket, chain entries with equal keys and compare the bytes of their
texts; each chain link is one class of equal texts.

White space runs `[\\x20\\x09-\\x0D]+` count as one space. Null texts are empty and
equal to each other. Of repeated rows with the smallest doc_id exactly one is
kept; null doc_ids sort last. No rows, no result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, cut, ids_and_texts, table, text_batches, utf8

RUNS = re.compile(rb"[\x20\x09-\x0d]+")
KEY_BITS = 60
BUCKET_BYTES = 24 << 20
FLUSH_BYTES = 32 << 20
ROUND_BITS = 12


def normalised(text: bytes) -> bytes:
    return RUNS.sub(b" ", text)


def key_of(digest: bytes, key_bits: int) -> int:
    return int.from_bytes(digest[:8], "big") >> (64 - key_bits)


def entries(texts: DataFrame, key_bits: int) -> DataFrame:
    """doc_id, key, sha (binary), n_bytes of the normalised text; one row per document."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("sha", pa.binary()), ("n_bytes", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            norm = [normalised(t) for t in utf8(batch.column(1))]
            shas = [hashlib.sha256(t).digest() for t in norm]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([key_of(s, key_bits) for s in shas], pa.int64()),
                 pa.array(shas, pa.binary()), pa.array([len(t) for t in norm], pa.int64())], schema=schema)

    return texts.mapInArrow(run, "doc_id long, key long, sha binary, n_bytes long")


def grow_directory(rows: DataFrame, key_bits: int, limit: int) -> list[tuple[int, int]]:
    """(depth, prefix) of every bucket. Each round reads byte sums for the next
    bits of the overfull buckets only: at most 2**ROUND_BITS sums per bucket.
    A bucket that holds one single key can't be split and stays."""
    done: list[tuple[int, int]] = []
    open_: list[int] = [0]
    depth = 0
    # equal texts are one entry of the index; so they count once here
    distinct = rows.groupBy("key", "sha").agg(F.max("n_bytes").alias("n_bytes"))
    while open_ and depth < key_bits:
        bits = min(ROUND_BITS, key_bits - depth)
        prefix = F.shiftright("key", key_bits - depth - bits)
        part = distinct
        if depth:
            part = part.join(F.broadcast(rows.sparkSession.createDataFrame([(p,) for p in open_], "p long")),
                             F.shiftright("key", key_bits - depth) == F.col("p"), "left_semi")
        sums = dict(part.groupBy(prefix.alias("p")).agg(F.sum("n_bytes").alias("s")).collect())
        size = {}
        for p, s in sums.items():
            for k in range(bits + 1):
                at = (depth + k, p >> (bits - k))
                size[at] = size.get(at, 0) + s
        todo, open_ = [(depth, p) for p in open_], []
        while todo:
            d, p = todo.pop()
            if size.get((d, p), 0) <= limit:
                done.append((d, p))
            elif d < depth + bits:
                todo += [(d + 1, 2 * p), (d + 1, 2 * p + 1)]
            else:
                open_.append(p)
        depth += bits
    return done + [(depth, p) for p in open_]


def write_index(texts: DataFrame, directory: list[tuple[int, int]], key_bits: int) -> DataFrame:
    """The index: bucket, key, text (compressed), keep_id, copies; one file of
    the shared folder per bucket."""
    lows = sorted((p << (key_bits - d), k) for k, (d, p) in enumerate(directory))
    spark = texts.sparkSession
    owners = spark.sparkContext.broadcast(lows)  # one pair per bucket
    schema = pa.schema([("bucket", pa.int64()), ("key", pa.int64()), ("text", pa.binary()), ("keep_id", pa.int64()),
                        ("copies", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        import bisect
        starts = [a for a, _ in owners.value]
        squeeze = zstandard.ZstdCompressor(level=1).compress
        held: dict[bytes, list] = {}
        room = 0

        def flush() -> Iterator[tuple]:
            for t, (keep, n) in held.items():
                key = key_of(hashlib.sha256(t).digest(), key_bits)
                yield owners.value[bisect.bisect_right(starts, key) - 1][1], key, squeeze(t), keep, n
        for batch in it:
            for doc, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                t = normalised(raw)
                if (e := held.get(t)) is None:
                    held[t] = [doc, 1]
                    room += len(t) + 200
                else:
                    e[0] = least(e[0], doc)
                    e[1] += 1
            if room > FLUSH_BYTES:
                yield from flush()
                held, room = {}, 0
        yield from flush()

    out = texts.mapInArrow(lambda it: batches(run(it), schema, 256),
                           "bucket long, key long, text binary, keep_id long, copies long")
    # bucket k is owned by task k, so a file holds one bucket
    return cut(out.repartitionById(max(1, len(directory)), F.col("bucket").cast("int")))


def least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def classes(index: DataFrame) -> DataFrame:
    """sha, keep_id, group_size of every class of equal texts; run by the owners."""
    schema = pa.schema([("sha", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        unpack = zstandard.ZstdDecompressor().decompress
        chains: dict[int, list[list]] = {}  # key -> [compressed text, keep_id, copies] of each different text
        for batch in it:
            for key, packed, keep, n in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4))):
                chain = chains.setdefault(key, [])
                for link in chain:
                    if link[0] == packed or unpack(link[0]) == unpack(packed):
                        link[1], link[2] = least(link[1], keep), link[2] + n
                        break
                else:
                    chain.append([packed, keep, n])
        for chain in chains.values():
            for packed, keep, n in chain:
                yield hashlib.sha256(unpack(packed)).digest(), keep, n

    return index.mapInArrow(lambda it: batches(run(it), schema), "sha binary, keep_id long, group_size long")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bits: int = KEY_BITS,
          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    text_batches(docs.sparkSession)
    texts = ids_and_texts(docs, id_col, text_col)
    rows = cut(entries(texts, key_bits).withColumn("uid", F.monotonically_increasing_id()))
    index = write_index(texts, grow_directory(rows, key_bits, bucket_bytes), key_bits)
    found = classes(index)
    all_rows = rows.join(found, "sha")
    # of repeated rows with the smallest id one stays
    first = (all_rows.where(F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("group_size") > 1))
             .groupBy("sha").agg(F.min("uid").alias("first")))
    return all_rows.join(first, "sha", "left").select(
        "doc_id", "keep_id", "group_size",
        ((F.col("group_size") == 1) | (F.col("uid") == F.col("first"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, MIN(doc_id) OVER w AS keep_id, COUNT(*) OVER w AS group_size,
       ROW_NUMBER() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
