"""Operator 10: concatenate all documents' tokens and cut.

The documents are encoded once, into the shared checkpoint folder, and two
passes read those files without a shuffle. The first sums the tokens of every
partition; prefix sums over these totals (one row per partition) are the
partitions' global offsets. The second places every document at its global
offset and cuts at the multiples of the window length: a document that crosses
a cut leaves boundary pieces on both sides. Each partition's checksum of its
documents from the first pass is compared in the second.

Null texts count as empty: one piece with the end token. Repeated rows are
packed as often as they occur. No rows, no pieces.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import LONGEST_KEPT, cut, ids_and_texts, text_batches, utf8

CACHE_WORDS = 1_000_000
WINDOW, END = 4096, 2

# a full stop or comma between a letter and white space is a token run of its own
STOPS = re.compile(rb"(?<=[a-z])[.,](?=[ \n])")


class WordCodec:
    """Token ids as packed little-endian integers. The tokenizer lowers letters
    and drops white space, and no token crosses white space, so texts are encoded
    word by word; the ids of short words are kept while the cache has room. Texts that
    may hold a special token's string, where case matters, are encoded as they are."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")

    def _ids(self, text: bytes) -> bytes:
        return np.asarray(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, self.kind).tobytes()

    def encode(self, text: bytes) -> bytes:
        known = self.known
        words = (text if b"<|" in text else STOPS.sub(rb" \g<0>", text.lower())).split()
        found = list(map(known.get, words))
        if None in found:
            if len(known) > CACHE_WORDS:
                known.clear()
            for i, w in enumerate(words):
                if found[i] is None:
                    got = known.get(w)
                    if got is None:
                        got = self._ids(w)
                        if len(w) <= LONGEST_KEPT:
                            known[w] = got
                    found[i] = got
        return b"".join(found)


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordCodec:
    return WordCodec(path)


def encode_documents(docs: DataFrame, path: str, end: int) -> DataFrame:
    """doc_id, ids (packed): every document's ids with the end token."""
    text_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path)
        tail = np.asarray([end], codec.kind).tobytes()
        for batch in it:
            ids = [codec.encode(t) + tail for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], schema=schema)

    return docs.mapInArrow(run, "doc_id long, ids binary")


def _mark(mark: int, doc: int | None, n: int) -> int:
    return zlib.crc32(f"{doc}:{n};".encode(), mark)


def partition_offsets(encoded: DataFrame, width: int) -> dict[int, tuple[int, int]]:
    """Partition -> (global offset, checksum). One row per partition comes to
    the driver."""
    schema = pa.schema([("part", pa.int32()), ("total", pa.int64()), ("mark", pa.int64())])

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = mark = 0
        for batch in it:
            for doc, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total += n // width
                mark = _mark(mark, doc, n // width)
        yield pa.RecordBatch.from_pylist(
            [{"part": TaskContext.get().partitionId(), "total": total, "mark": mark}], schema=schema)

    offsets, at = {}, 0
    sizes = encoded.select("doc_id", F.octet_length("ids").alias("n"))
    for r in sorted(sizes.mapInArrow(count, "part int, total long, mark long").collect()):
        offsets[r.part] = (at, r.mark)
        at += r.total
    return offsets


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and with ``with_ids`` the ids themselves."""
    encoded = cut(encode_documents(ids_and_texts(docs, id_col, text_col), path, end))
    kind = load(path).kind
    width = kind.itemsize
    offsets = docs.sparkSession.sparkContext.broadcast(partition_offsets(encoded, width))
    fields = [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    if with_ids:
        fields.append(("ids", pa.binary()))
    schema = pa.schema(fields)

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, expected = offsets.value[TaskContext.get().partitionId()]
        mark, cols = 0, [[] for _ in schema]
        for batch in it:
            for doc, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(packed, kind).astype("<u4").tobytes()
                n = len(ids) // 4
                mark = _mark(mark, doc, n)
                start = 0
                while start < n:
                    length = min(n - start, window - (at + start) % window)
                    piece = ids[4 * start:4 * (start + length)]
                    row = (doc, start, length, zlib.crc32(piece), n, (at + start) // window, (at + start) % window, piece)
                    for c, v in zip(cols, row):
                        c.append(v)
                    start += length
                at += n
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
            cols = [[] for _ in schema]
        if mark != expected:
            raise RuntimeError("the documents of a partition changed between the two passes")

    ddl = ", ".join(f"{f.name} {'binary' if f.name == 'ids' else 'long'}" for f in schema)
    return encoded.mapInArrow(place, ddl)


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences from pieces packed ``with_ids``: sequence_id, ids binary, n_tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))  # at most a window's tokens
    return (pieces.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").alias("n_tokens"))
            .select("sequence_id", F.unhex(F.array_join(F.col("p.ids"), "")).alias("ids"), "n_tokens"))
