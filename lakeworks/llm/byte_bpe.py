"""Operator 3: byte-level BPE by dynamic programming over byte prefixes.

For a piece of text (one match of the split pattern) every prefix has exactly
one valid encoding, so it is enough to store, for each prefix, the last token
of that encoding: ``last[i]``. A token ``t = piece[j:i]`` is the last token of
prefix ``i`` iff the pair ``(last[j], t)`` is valid, i.e. merging the bytes of
both tokens from scratch gives back the same two tokens. Walking ``last`` from
the end yields the encoding. The table makes appending exact and cheap (only
new prefixes are added) and an edit needs re-encoding from the changed byte on.

Null texts count as empty: no ids. Repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import LONGEST_KEPT, ids_and_texts, text_batches, utf8

#: What a worker keeps; it only saves time. Words: in each of two generations.
CACHE_WORDS = 500_000
CACHE_PREFIXES = 1_500_000
NEVER = 1 << 60


class PrefixBpe:
    """Encoder and decoder for a rank file and a split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.vocab = {i: b for b, i in ranks.items()}
        self.split = regex.compile(pattern)
        self.children: dict[int, tuple[int, int]] = {}
        self.usable: dict[bytes, int] = {}
        self._grow_merge_trees()
        self.longest = max(map(len, self.usable))
        self._pairs: dict[int, bool] = {}
        self._last: dict[bytes, int] = {}
        self._spines: dict[int, tuple[list[bytes], list[int]]] = {}

    def _grow_merge_trees(self) -> None:
        """The two tokens whose merge makes each token. Tokens that merging
        never reaches stay out of the table of last tokens."""
        for b, i in sorted(self.ranks.items(), key=lambda x: x[1]):
            if len(b) == 1:
                self.usable[b] = i
                continue
            parts = self._merged(b, below=i)
            if len(parts) == 2 and all(p in self.usable for p in parts):
                self.children[i] = self.ranks[parts[0]], self.ranks[parts[1]]
                self.usable[b] = i

    def _merged(self, b: bytes, below: int) -> list[bytes]:
        """Plain merging of single bytes by rank, using ranks under ``below``."""
        parts = [b[k:k + 1] for k in range(len(b))]
        get = self.ranks.get
        while len(parts) > 1:
            best, at = below, -1
            for k in range(len(parts) - 1):
                r = get(parts[k] + parts[k + 1], below)
                if r < best:
                    best, at = r, k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _spine(self, token: int, side: int) -> tuple[list[bytes], list[int]]:
        """The nodes of a merge tree along one side, from the single byte up to
        the token, and the rank at which each of them is merged into the next."""
        nodes = [token]
        while nodes[-1] in self.children:
            nodes.append(self.children[nodes[-1]][side])
        nodes.reverse()
        return [self.vocab[n] for n in nodes], nodes[1:] + [NEVER]

    def _pair_is_valid(self, a: int, b: int) -> bool:
        """Do the bytes of tokens a and b, put together, encode as [a, b]?

        While both tokens are being built, the symbols that touch the seam are
        nodes on a's right spine and b's left spine. The pair breaks iff some
        touching nodes make a token whose rank comes up before either of them
        is merged away (on equal ranks the merge further left is first).
        """
        spines, get = self._spines, self.ranks.get
        left = spines.get(a << 1)
        if left is None:
            left = spines[a << 1] = self._spine(a, 1)
        right = spines.get(b << 1 | 1)
        if right is None:
            right = spines[b << 1 | 1] = self._spine(b, 0)
        (xs, x_ends), (ys, y_ends) = left, right
        i = k = 0
        while True:
            x_end, y_end = x_ends[i], y_ends[k]
            m = get(xs[i] + ys[k])
            if m is not None and m < x_end and m <= y_end:
                return False
            if x_end <= y_end:
                if x_end == NEVER:
                    return True
                i += 1
            else:
                k += 1

    def last_tokens(self, piece: bytes, last: list[int] | None = None) -> list[int]:
        """``last[i]`` for every prefix of ``piece``; a table for a shorter
        prefix is extended in place of being computed again."""
        last = [-1] if last is None else last
        for i in range(len(last), len(piece) + 1):
            last.append(self._last_token(piece, last, i))
        return last

    def _last_token(self, piece: bytes, last: list[int], i: int) -> int:
        """The last token of ``piece[:i]``, from those of the ``longest`` prefixes before it."""
        get, pairs, longest = self.usable.get, self._pairs, self.longest
        for j in range(i - longest if i > longest else 0, i):
            t = get(piece[j:i])
            if t is None:
                continue
            if not j:
                return t
            key = last[j] << 20 | t
            ok = pairs.get(key)
            if ok is None:
                if len(pairs) > 2_000_000:
                    pairs.clear()
                ok = pairs[key] = self._pair_is_valid(last[j], t)
            if ok:
                return t
        raise ValueError("a byte that no token holds")

    def tokens_of(self, last: list[int]) -> list[int]:
        """The encoding that a table of last tokens describes."""
        out, i = [], len(last) - 1
        while i > 0:
            out.append(last[i])
            i -= len(self.vocab[last[i]])
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        """One piece's ids. Last tokens depend on nothing but the prefix, so
        they are kept by prefix and pieces that begin alike share them."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > 64:  # long pieces share little
            return self.tokens_of(self.last_tokens(piece))
        last = self._last
        if len(last) > CACHE_PREFIXES:
            last.clear()
        get, pairs, n = self.usable.get, self._pairs, len(piece)
        known = n
        while known and piece[:known] not in last:
            known -= 1
        for i in range(known + 1, n + 1):
            prefix = piece[:i]
            for j in range(i - self.longest if i > self.longest else 0, i):
                t = get(prefix[j:])
                if t is not None:
                    if not j:
                        break
                    key = last[piece[:j]] << 20 | t
                    ok = pairs.get(key)
                    if ok is None:
                        if len(pairs) > 2_000_000:
                            pairs.clear()
                        ok = pairs[key] = self._pair_is_valid(key >> 20, t)
                    if ok:
                        break
            last[prefix] = t
        out = []
        while n:
            t = last[piece[:n]]
            out.append(t)
            n -= len(self.vocab[t])
        return out[::-1]

    def append(self, piece: bytes, last: list[int], more: bytes) -> list[int]:
        """The table of ``piece + more`` from the table of ``piece``."""
        return self.last_tokens(piece + more, list(last))

    def edit(self, piece: bytes, last: list[int], at: int, removed: int, added: bytes) -> tuple[bytes, list[int]]:
        """Replace ``removed`` bytes at ``at``. Prefixes before it keep their entries;
        behind it the table is made anew until it meets the old one: an entry follows
        from ``longest`` bytes and the entries of the ``longest`` prefixes before it, so
        once as many in a row are as before (the bytes too), all the others are."""
        new = piece[:at] + added + piece[at + removed:]
        table, shift, same = last[:at + 1], len(added) - removed, 0
        for i in range(at + 1, len(new) + 1):
            table.append(self._last_token(new, table, i))
            old = i - shift
            met = i > at + len(added) and old > 0 and table[i] == last[old]
            same = same + 1 if met else 0
            if same > self.longest and min(i, old) > 2 * self.longest and i > at + len(added) + self.longest:
                return new, table + last[old + 1:]
        return new, table

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for p in self.split.findall(text):
            ids += self.encode_piece(p.encode())
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids))


class Words:
    """Encodes whole texts word by word and keeps what it has made of a word.

    Texts are cut before single spaces, where the pattern cuts too: it takes a
    space together with what follows it, unless that is white space or nothing.
    Texts with such places are encoded in one go. ``made`` turns ids into what
    is kept, ``joined`` puts two of these together. When the kept words reach
    their limit, those not met since the last time it was reached are dropped.
    """

    def __init__(self, bpe: PrefixBpe, made, joined):
        self.bpe, self.made, self.joined = bpe, made, joined
        self.now: dict = {}
        self.before: dict = {}

    def _word(self, word: str):
        got = self.now.get(word) or self.before.get(word)
        if got is None:
            if word.isalpha():  # one piece
                got = self.made(self.bpe.encode_piece(b" " + word.encode()))
            elif word[-1] in ".," and word[:-1].isalpha():  # two pieces
                return self.joined(self._word(word[:-1]), self._word_end(word[-1]))
            else:
                got = self.made(self.bpe.encode(" " + word))
        if len(word) > LONGEST_KEPT:
            return got
        if len(self.now) >= CACHE_WORDS:
            self.before, self.now = self.now, {}
        self.now[word] = got
        return got

    def _word_end(self, stop: str):
        return self.made(self.bpe.encode_piece(stop.encode()))

    def of(self, text: str) -> list:
        words = text.split(" ")
        out = list(map(self.now.get, words))
        out[0] = self.made(self.bpe.encode(words[0]))
        if None in out:
            for i, made in enumerate(out):
                if made is None:
                    word = words[i]
                    if not word or word[0].isspace():
                        return [self.made(self.bpe.encode(text))]
                    out[i] = self._word(word)
        return out


@functools.lru_cache(maxsize=2)
def load(path: str, pattern: str) -> PrefixBpe:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return PrefixBpe(ranks, pattern)


@functools.lru_cache(maxsize=2)
def digest_words(path: str, pattern: str) -> Words:
    """Words as (number of ids, ids as text, decoded bytes)."""
    bpe = load(path, pattern)
    return Words(bpe, lambda ids: (len(ids), ",".join(map(str, ids)), bpe.decode(ids)),
                 lambda a, b: (a[0] + b[0], f"{a[1]},{b[1]}", a[2] + b[2]))


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>, decoded binary (the ids decoded again)."""
    text_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in it:
            ids = [bpe.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, schema.field(1).type), pa.array(map(bpe.decode, ids), pa.binary())],
                schema=schema)

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digest_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip: as
    :func:`encode_documents`, with digests taken where the ids are made."""
    text_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string()), ("round_trip", pa.bool_())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = digest_words(path, pattern)
        sha = hashlib.sha256
        for batch in it:
            n, a, b, same = [], [], [], []
            for text, raw in zip(batch.column(1).to_pylist(), utf8(batch.column(1))):
                sizes, names, decoded = zip(*words.of(text))
                back = b"".join(decoded)
                n.append(sum(sizes))
                a.append(sha(",".join(names if sizes[0] else names[1:]).encode()).hexdigest())
                b.append(sha(back).hexdigest())
                same.append(back == raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, f.type) for x, f in zip((n, a, b, same), list(schema)[1:]))],
                schema=schema)

    return ids_and_texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean")
