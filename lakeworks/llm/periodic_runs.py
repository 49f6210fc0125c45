"""Operator 12: runs of repeated word sequences, found in a grammar.

A run is a longest stretch of words with smallest period q that is at least
``least`` words and two periods long. For every text:

1. Words become numbers. A run of at least 12 words agrees with itself, q words
   on, over at least 6 words, so each of its words lies in a 6-gram that occurs
   twice in the text; words that don't are put aside, which parts the text into
   islands. Hashes only choose the islands (a false hit makes one longer).
2. Re-Pair over all islands: the most frequent pair of symbols becomes a new
   symbol until no pair occurs twice; ties go to the pair that was counted first,
   which keeps derivations shallow. What is left of an island is joined in halves.
3. A run lies across the boundary of the lowest symbol that derives it, so each
   distinct symbol's boundary is searched once: for all periods at a time, from
   the prefix tables of its two sides, to the right and to the left.
4. The runs of a symbol are carried to all places where the derivation has it.
   Intervals of one period that lie in a larger one are merged into it.

Time and memory are linear in the islands, times the depth of a derivation. A
text is handled whole in one task; texts stream through in small batches.

Defined cases: a null text has no words; a text without words has no runs and an
empty rest; a null id gives the row back under a null id (in the query its words
stay as they are); repeated rows are handled each for itself; an empty table
gives no rows; other columns are not looked at, whatever their names. Of runs
that are equally long the first, then the one with the smaller period, is named.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import batches, ids_and_texts, table, text_batches, utf8

LEAST = 12
ROUNDS = 4  # of narrowing islands, which saves time only
U = np.uint64
Run = tuple[int, int, int]  # start, end, period


# --- islands -----------------------------------------------------------------

def numbered(words: list[bytes]) -> np.ndarray:
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))


def islands(x: np.ndarray, least: int) -> list[tuple[int, int]]:
    """[start, end) of the stretches that words of repeated grams cover. A run of
    ``least`` words or more repeats grams of half that many, inside its own
    island, so grams are looked up again in each island a few times over."""
    gram = max(least // 2, 1)
    n = len(x) - gram + 1
    if n < 2 or len(x) < least:
        return []
    h = np.zeros(n, U)
    for k in range(gram):
        h = (h ^ x[k:k + n].astype(U)) * U(0x9E3779B97F4A7C15)
        h ^= h >> U(29)
    ranked = np.sort(h)
    if not (ranked[1:] == ranked[:-1]).any():
        return []
    at, island = np.arange(n), np.zeros(n, np.int64)
    for _ in range(ROUNDS):
        order = np.lexsort((h[at], island))
        i, k = at[order], island[order]
        same = (h[i[1:]] == h[i[:-1]]) & (k[1:] == k[:-1])
        left = np.sort(i[np.append(same, False) | np.append(False, same)])
        done = len(left) in (0, len(at))
        at, island = left, np.append(0, np.cumsum(left[1:] > left[:-1] + gram)) if len(left) else left
        if done:
            break
    if not len(at):
        return []
    new = np.flatnonzero(np.append(True, island[1:] != island[:-1]))
    ends = at[np.append(new[1:] - 1, len(at) - 1)] + gram
    return [(a, e) for a, e in zip(at[new].tolist(), ends.tolist()) if e - a >= least]


# --- grammar -----------------------------------------------------------------

class Grammar:
    """Re-Pair over several strings. Symbols under ``letters`` stand for
    themselves; symbol ``letters + i`` derives ``rules[i]``, its two parts."""

    def __init__(self, strings: list[list[int]], letters: int):
        self.letters = letters
        self.rules: list[tuple[int, int]] = []
        self.strings = self._pair(strings)

    def _pair(self, strings: list[list[int]]) -> list[list[int]]:
        # one doubly linked list; -1 parts the strings and is in no pair
        s: list[int] = [-1]
        for x in strings:
            s += x
            s.append(-1)
        n = len(s)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        places: dict[tuple[int, int], set[int]] = {}
        for i in range(n - 1):
            if s[i] >= 0 and s[i + 1] >= 0:
                places.setdefault((s[i], s[i + 1]), set()).add(i)
        turn = 0
        heap = []
        for pair, at in places.items():
            if len(at) > 1:
                heap.append((-len(at), turn, pair))
                turn += 1
        heapq.heapify(heap)

        while heap:
            count, order, pair = heapq.heappop(heap)
            at = places.get(pair, ())
            if len(at) < 2:
                continue
            if len(at) != -count:  # counted anew since it was put there
                heapq.heappush(heap, (-len(at), order, pair))
                continue
            new = self.letters + len(self.rules)
            touched: dict[tuple[int, int], None] = {}
            made = 0
            left, right = pair
            for i in sorted(at):
                j = after[i]
                if s[i] != left or j >= n or s[j] != right:  # overlaps the one before, as in aaa
                    continue
                h, k = before[i], after[j]
                if s[h] >= 0:
                    held = places.get((s[h], left))
                    if held is not None:
                        held.discard(h)
                if s[k] >= 0:
                    held = places.get((right, s[k]))
                    if held is not None:
                        held.discard(j)
                s[i], s[j] = new, -2
                after[i] = k
                before[k] = i
                made += 1
                if s[h] >= 0:
                    key = (s[h], new)
                    places.setdefault(key, set()).add(h)
                    touched[key] = None
                if s[k] >= 0:
                    key = (new, s[k])
                    places.setdefault(key, set()).add(i)
                    touched[key] = None
            del places[pair]
            if made:
                self.rules.append(pair)
            for key in touched:
                if len(places.get(key, ())) > 1:
                    heapq.heappush(heap, (-len(places[key]), turn, key))
                    turn += 1

        out: list[list[int]] = []
        i = after[0]
        held = []
        while i < n:
            if s[i] == -1:
                out.append(held)
                held = []
            else:
                held.append(s[i])
            i = after[i]
        return out


# --- runs across a boundary --------------------------------------------------

def prefix_table(x: list[int]) -> list[int]:
    """For each place, how long the string there agrees with the beginning."""
    n = len(x)
    z = [0] * n
    if n:
        z[0] = n
    a = b = 0
    for i in range(1, n):
        k = 0
        if i < b:
            k = z[i - a]
            if k < b - i:
                z[i] = k
                continue
            k = b - i
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > b:
            a, b = i, i + k
    return z


def _beyond(left: list[int], right: list[int]) -> Iterator[tuple[int, int, int]]:
    """(period, words before, words after) of stretches with at least one period
    to the right of the boundary, and a word to its left."""
    n, m = len(right), len(left)
    forth = prefix_table(right)
    # how long left and left + right[:q] agree backwards
    turned = left[::-1]
    back = prefix_table(turned + [-1] + right[::-1] + turned)
    at = m + 1 + n
    for q in range(1, n + 1):
        b = back[at - q]
        if b:
            f = forth[q] if q < n else 0
            if b + f >= q:
                yield q, min(b, m), q + f


def boundary_runs(left: list[int], right: list[int], least: int) -> list[Run]:
    """Runs of ``left + right`` that lie across the boundary, each with its smallest period."""
    m = len(left)
    found: dict[tuple[int, int], int] = {}
    for q, b, f in _beyond(left, right):
        if b + f >= least:
            key = (m - b, m + f)
            found[key] = min(q, found.get(key, q))
    for q, f, b in _beyond(right[::-1], left[::-1]):
        if b + f >= least:
            key = (m - b, m + f)
            found[key] = min(q, found.get(key, q))
    return [(a, e, q) for (a, e), q in found.items()]


def _halves(parts: list[list[int]], at: int, least: int, out: list[Run]) -> list[int]:
    """Join the derived parts of one island in halves; runs across the boundaries go to ``out``."""
    if len(parts) == 1:
        return parts[0]
    # halves by length, so that a long part isn't copied at each level
    total, k, size = sum(map(len, parts)), 0, 0
    while k < len(parts) - 1 and (k == 0 or 2 * (size + len(parts[k])) <= total):
        size += len(parts[k])
        k += 1
    left = _halves(parts[:k], at, least, out)
    right = _halves(parts[k:], at + len(left), least, out)
    if len(left) + len(right) >= least:
        out += [(at + a, at + e, q) for a, e, q in boundary_runs(left, right, least)]
    return left + right


def runs(x: np.ndarray, least: int = LEAST) -> list[Run]:
    """All runs of ``x`` (start, end, smallest period), by start, then period."""
    spans = islands(x, least)
    if not spans:
        return []
    names, flat = np.unique(np.concatenate([x[a:b] for a, b in spans]), return_inverse=True)
    letters, flat, at = len(names), flat.tolist(), 0
    strings = []
    for a, b in spans:
        strings.append(flat[at:at + b - a])
        at += b - a
    grammar = Grammar(strings, letters)

    # each symbol's derivation, and the runs across its boundary
    derived: list[list[int]] = []

    def of(symbol: int) -> list[int]:
        return [symbol] if symbol < letters else derived[symbol - letters]

    own: list[list[Run]] = []
    for left, right in grammar.rules:
        y, z = of(left), of(right)
        own.append(boundary_runs(y, z, least) if len(y) + len(z) >= least else [])
        derived.append(y + z)

    # places of the symbols: first in the islands, then from rule to rule
    places: list[list[int]] = [[] for _ in derived]
    found: list[Run] = []
    for (start, _), string in zip(spans, grammar.strings):
        at = start
        for symbol in string:
            if symbol >= letters:
                places[symbol - letters].append(at)
            at += len(of(symbol))
        _halves([of(s) for s in string], start, least, found)
    for k in range(len(derived) - 1, -1, -1):
        if len(derived[k]) < least:
            continue
        left, right = grammar.rules[k]
        size = len(of(left))
        if left >= letters:
            places[left - letters] += places[k]
        if right >= letters:
            places[right - letters] += [p + size for p in places[k]]
        found += [(p + a, p + e, q) for a, e, q in own[k] for p in places[k]]
    return merged(found)


def merged(found: list[Run]) -> list[Run]:
    """The longest intervals: of those with one period that overlap by a period, the union."""
    out: list[Run] = []
    for a, e, q in sorted(set(found), key=lambda r: (r[2], r[0], -r[1])):
        if out and out[-1][2] == q and a <= out[-1][1] - q:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e, q)
        else:
            out.append((a, e, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(n: int, found: list[Run]) -> np.ndarray:
    """Which of ``n`` words stay when each run is cut to its first period."""
    marks = np.zeros(n + 1, np.int64)
    for a, e, q in found:
        marks[a + q] += 1
        marks[e] -= 1
    return np.cumsum(marks)[:n] == 0


# --- Spark jobs --------------------------------------------------------------

Words = Callable[[int | None, list[bytes]], list[bytes]]


def _per_text(texts: DataFrame, least: int, words: Words | None, make, fields: pa.Schema, ddl: str) -> DataFrame:
    text_batches(texts.sparkSession, 64)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in it:
            for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                own = text.split()  # at \x20 and \x09-\x0D
                if words:
                    own = words(doc, own)
                yield from make(doc, own, runs(numbered(own), least))

    return texts.mapInArrow(lambda it: batches(run(it), fields, 512), ddl)


def find_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text",
              words: Words | None = None) -> DataFrame:
    """One row per run: doc_id, start, length, period (in words)."""
    names = ("doc_id", "start", "length", "period")
    return _per_text(ids_and_texts(docs, id_col, text_col), least, words,
                     lambda doc, own, found: [(doc, a, e - a, q) for a, e, q in found],
                     pa.schema([(n, pa.int64()) for n in names]), ", ".join(f"{n} long" for n in names))


def collapse(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text: the words left when each run is cut to its first period, with one space between."""
    def make(doc, own, found):
        stay = kept(len(own), found).tolist()
        yield doc, b" ".join(w for w, s in zip(own, stay) if s).decode()
    return _per_text(ids_and_texts(docs, id_col, text_col), least, None, make,
                     pa.schema([("doc_id", pa.int64()), ("text", pa.string())]), "doc_id long, text string")


def digests(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text",
            words: Words | None = None) -> DataFrame:
    """One row per document: doc_id, n_runs, the longest run's start, length,
    period and exponent_milli, runs_sha256, collapsed_sha256."""
    longs = ("n_runs", "start", "length", "period", "exponent_milli")
    fields = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in longs),
                        ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])

    def make(doc, own, found):
        text = b" ".join(own)
        best = (None, None, None, None)
        if found:
            a, e, q = min(found, key=lambda r: (r[0] - r[1], r[0], r[2]))
            best = (a, e - a, q, 1000 * (e - a) // q)
            text = b" ".join([w for w, s in zip(own, kept(len(own), found).tolist()) if s])
        listed = "".join(f"{a},{e - a},{q}\n" for a, e, q in found)
        yield (doc, len(found), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest())

    ddl = "doc_id long, " + ", ".join(f"{n} long" for n in longs) + ", runs_sha256 string, collapsed_sha256 string"
    return _per_text(ids_and_texts(docs, id_col, text_col), least, words, make, fields, ddl)


def planted(doc: int | None, words: list[bytes]) -> list[bytes]:
    """The query's words: a tenth of the texts, by a checksum of the id, repeat a
    stretch of their own from some word on to the end."""
    n = len(words)
    if doc is None or not n:
        return words
    h = zlib.crc32(str(doc).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // len(unit) + 1))[:n - a]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), words=planted)
