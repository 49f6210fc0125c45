"""Operator 4: exact token counts of texts of any length.

A text up to ``chunk_chars`` characters is encoded in one call. A longer one
is encoded in overlapping chunks with byte offsets of all token ends. Two
neighbouring chunks are spliced at an offset inside their overlap where both
have a token end and which is proven stable: the characters on its two sides
stand next to each other in no piece of the vocabulary, so no merge ever
crosses it and both sides encode independently of each other. If the overlap
holds no such offset, it is doubled and the later chunk encoded again; in the
worst case it grows until one chunk is the rest of the text.

Null texts count as empty: 0 bytes, 0 tokens. Repeated rows give repeated results.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import ids_and_texts, text_batches

MARK = "▁"  # how the library writes a space inside pieces


class PieceCounter:
    def __init__(self, path: str, chunk_chars: int = 16_384, overlap_chars: int = 512):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk_chars, overlap_chars
        sizes = np.zeros(self.model.vocab_size(), np.int64)
        self.inside: set[str] = set()
        for i in range(len(sizes)):
            if self.model.is_byte(i):
                sizes[i] = 1
            elif not self.model.is_control(i):
                piece = self.model.id_to_piece(i).replace(MARK, " ")
                sizes[i] = len(piece.encode())
                self.inside.update(a + b for a, b in zip(piece, piece[1:]))
        self.sizes = sizes

    def _ends(self, chunk: str) -> np.ndarray:
        """Byte offset in the chunk of the end of every token; the space the
        library puts in front of a text has no bytes there."""
        ends = np.cumsum(self.sizes[np.asarray(self.model.encode(chunk), np.int64)])
        if len(ends) == 0 or ends[-1] - 1 != len(chunk.encode()):
            raise ValueError("token offsets do not cover the text")
        return ends - 1

    def _seam(self, text: str, start: int, stop: int, left: np.ndarray, left_at: int,
              right: np.ndarray, right_at: int, byte_at: int) -> tuple[int, int] | None:
        """Tokens of the left chunk before, and of the right chunk up to, the last common stable offset."""
        part = text[start:stop]
        offsets = byte_at + np.cumsum([len(c.encode()) for c in part])
        stable = [o for o, a, b in zip(offsets[:-1].tolist(), part, part[1:]) if a + b not in self.inside]
        for o in reversed(stable):
            k = int(np.searchsorted(left, o - left_at))
            m = int(np.searchsorted(right, o - right_at))
            if k < len(left) and m < len(right) and left[k] == o - left_at and right[m] == o - right_at:
                return k + 1, m + 1
        return None

    def count(self, text: str) -> int:
        if len(text) <= self.chunk:
            return len(self.model.encode(text))
        text = text.replace(MARK, " ")  # the library reads both alike; offsets then agree
        total = 0
        start, stop, byte_at = 0, self.chunk, 0
        ends = self._ends(text[:stop])
        skipped = 0  # tokens of the current chunk that an earlier chunk has counted
        while stop < len(text):
            overlap = self.overlap
            while True:
                begin = max(start, stop - overlap)
                if begin == start:  # no stable offset in the whole chunk: make the chunk itself longer
                    stop = min(len(text), start + 2 * (stop - start))
                    ends = self._ends(text[start:stop])
                    if stop == len(text):
                        return total + len(ends) - skipped
                    overlap = self.overlap
                    continue
                next_stop = min(len(text), begin + self.chunk + overlap)
                at = byte_at + len(text[start:begin].encode())
                new = self._ends(text[begin:next_stop])
                seam = self._seam(text, begin, stop, ends, byte_at, new, at, at)
                if seam and seam[0] > skipped:
                    break
                overlap *= 2
            total += seam[0] - skipped
            skipped, start, stop, byte_at, ends = seam[1], begin, next_stop, at, new
        return total + len(ends) - skipped


@functools.lru_cache(maxsize=4)
def load(path: str, chunk_chars: int, overlap_chars: int) -> PieceCounter:
    return PieceCounter(path, chunk_chars, overlap_chars)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, chunk_chars: int = 16_384,
                 overlap_chars: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row."""
    text_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                        ("over_limit", pa.bool_())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path, chunk_chars, overlap_chars)
        for batch in it:
            texts = batch.column(1).to_pylist()
            tokens = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())], schema=schema)

    return ids_and_texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
