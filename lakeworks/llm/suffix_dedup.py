"""Operator 7: repeated byte strings by column-wise suffix sorting.

Every byte that a repeated string of ``length`` bytes covers is removed.

1. Each window of ``length`` bytes picks an anchor: the place of its smallest
   32-byte hash. Equal windows pick the same place, so they share the anchor's
   bytes and, on its longer side, the context up to the middle of a window.
   Hashes of both contexts are counted over all documents; an anchor whose
   contexts occur once has no repeated window and is done.
2. For each anchor left, the segment of text that its windows cover goes to the
   task that owns the anchor's hash; equal segments are sent and kept once, with
   a count. There, collections of segments are sorted column by column: each
   round inserts one symbol (a block of bytes) in front of every string, placing
   the new suffixes among the sorted ones from the ranks of their tails, and
   updates the common-prefix lengths. Rows are merged sequentially, in files
   if a collection is large. A window is repeated iff its suffix has a neighbour
   with a common prefix of a whole window, or its segment occurs twice.
3. The spans found go back to their texts.

Windows whose context occurs more than ``hot`` times aren't gathered in one task:
they are compared by 128-bit digests spread over all tasks. The path is chosen
window by window, by the context that lies inside it, so equal windows take the same.

Equal texts are one text with a count; null texts are empty; texts under
``length`` bytes lose nothing. Repeated rows and null ids are documents like
any other. Hashes that stand for blocks of bytes have 64 bits.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, cut, ids_and_texts, table, text_batches, utf8
from .shingle_join import mixed

LENGTH, SYMBOLS = 400, 8
GRAM = 32
COLLECTION_BYTES = 1 << 20
HOT = 100_000
FILE_BYTES = 64 << 20
PLACE_BITS = 26  # of a place in a stretch of text; longer texts are read in stretches
U = np.uint64
BASE = 0x9E3779B97F4A7C15
DOC, CAND = 0, 1
RIGHT, HOT_FLAG = 1 << 31, 1 << 32  # beside a place, which is under 2**31


class Powers:
    """Powers of the hash base and its inverse modulo 2**64, grown as needed."""

    def __init__(self):
        self.up, self.down = np.ones(1, U), np.ones(1, U)

    def reach(self, n: int) -> None:
        if len(self.up) <= n:
            n = max(n, 1 << 17)
            self.up = np.cumprod(np.append(U(1), np.full(n, BASE, U)))
            self.down = np.cumprod(np.append(U(1), np.full(n, pow(BASE, -1, 1 << 64), U)))


POWERS = Powers()


class Rolled:
    """Hashes of all substrings of a text."""

    def __init__(self, text: bytes):
        n = len(text)
        POWERS.reach(n + 1)
        self.sums = np.zeros(n + 1, U)
        np.cumsum((np.frombuffer(text, np.uint8).astype(U) + U(1)) * POWERS.down[:n], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * POWERS.up[starts])

    def every(self, size: int) -> np.ndarray:
        """Hash of the ``size`` bytes at each place."""
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * POWERS.up[:n])


def anchors(rolled: Rolled, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, first window, end of windows) of every anchor, in order.
    Of equal hashes the first is taken."""
    grams = rolled.every(GRAM)
    low = U((1 << PLACE_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=U)
    span, width = 1, length - GRAM + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    place = (least & low).astype(np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    return place[first], grams[place[first]], first, np.append(first[1:], len(place))


def stretches(text: bytes, length: int, most: int = 1 << 24) -> Iterator[tuple[int, bytes]]:
    """Parts of a very long text such that each window is in exactly one."""
    at = 0
    while at == 0 or at + length <= len(text):
        yield at, text[at:at + most + length - 1]
        at += most


def context_keys(rolled: Rolled, place: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the left and right contexts of anchors, [2, n]; 0 where the text is too short for it."""
    side, n = (length - GRAM) // 2, len(rolled.sums) - 1
    left = np.where(place >= side, rolled.hashes(np.maximum(place - side, 0), place + GRAM), U(0))
    end = place + GRAM + side
    right = np.where(end <= n, rolled.hashes(place, np.minimum(end, n)) ^ U(1 << 40), U(0))
    return np.stack([left, right])


def middle(place: int, first: int, end: int, length: int) -> int:
    """Of an anchor's windows [first, end), those before the result hold its
    left context, the others its right one."""
    return min(max(first, place - (length - GRAM + 1) // 2), end)


# --- column-wise construction ------------------------------------------------

def column(size: int, kind) -> np.ndarray:
    """Room for a column of rows; in an unnamed file of its own if it is large."""
    if size * np.dtype(kind).itemsize <= FILE_BYTES:
        return np.empty(size, kind)
    return np.memmap(tempfile.TemporaryFile(), kind, "w+", shape=(size,))


def merged(old: np.ndarray, new: np.ndarray, is_new: np.ndarray) -> np.ndarray:
    out = column(len(is_new), old.dtype)
    out[is_new] = new
    out[~is_new] = old
    return out


class RangeMin:
    """Minimum of lcp[a+1 .. b] for many pairs a < b."""

    def __init__(self, values: np.ndarray, widest: int):
        self.levels = [values]
        span = 1
        while 2 * span <= widest:
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-span], last[span:]))
            span *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(a), np.uint8)
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            some = level == k
            row = self.levels[k]
            out[some] = np.minimum(row[a[some] + 1], row[b[some] + 1 - (1 << k)])
        return out


def insert_columns(symbol: np.ndarray, first: np.ndarray, count: np.ndarray, width: int,
                   most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort all suffixes of strings by inserting one symbol of each string a round.

    String i has ``count[i]`` symbols, at ``first[i]``, ``first[i] + width``, ...
    of ``symbol``. Returns the place of every suffix in sorted order and the
    common-prefix length with the one before it, at most ``most``. A row is
    known by its first symbol and the row of its tail; rows 0 .. n-1 stand for
    the strings' empty suffixes."""
    n = len(first)
    head, tail = np.zeros(0, np.int64), np.zeros(0, np.int64)
    lcp, place = np.zeros(0, np.uint8), np.zeros(0, np.int64)
    at = np.arange(n)  # the row of each string's suffix so far
    for round_ in range(1, int(count.max(initial=0)) + 1):
        active = np.flatnonzero(count >= round_)
        where = first[active] + (count[active] - round_) * width
        key = symbol[where] << 32 | at[active]
        order = np.argsort(key)
        key, where = key[order], where[order]
        spot = np.searchsorted(head << 32 | tail, key)
        rows = spot + np.arange(len(spot))
        is_new = np.zeros(len(head) + len(key), bool)
        is_new[rows] = True
        old_lcp = np.concatenate([np.zeros(n, np.uint8), lcp])
        head = merged(head, key >> 32, is_new)
        tail = merged(tail, key & 0xFFFFFFFF, is_new)
        place = merged(place, where, is_new)
        lcp = merged(lcp, np.zeros(len(rows), np.uint8), is_new)
        # common prefixes change only at the new rows and right after them
        fresh = is_new.copy()
        fresh[1:] |= is_new[:-1]
        fresh[0] = False
        fresh = np.flatnonzero(fresh)
        same = head[fresh] == head[fresh - 1]
        lcp[fresh[~same]] = 0
        fresh = fresh[same]
        if len(fresh):
            a, b = tail[fresh - 1], tail[fresh]
            lcp[fresh] = np.minimum(1 + RangeMin(old_lcp, int((b - a).max()))(a, b), most)
        lcp[0] = 0
        moved = np.concatenate([np.arange(n), n + np.flatnonzero(~is_new)])
        tail = moved[tail]
        at[active[order]] = n + rows
    return place, lcp


def repeated_windows(texts: list[bytes], twice: list[bool], length: int, symbols: int) -> list[np.ndarray]:
    """For each text of a collection: which of its windows occur elsewhere in
    it, at another place or in another text. All windows of a text that counts
    ``twice`` do."""
    width = length // symbols
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    base = np.concatenate([[0], np.cumsum(lengths)])
    whole = b"".join(texts)
    names = np.unique(Rolled(whole).every(width), return_inverse=True)[1].astype(np.int64)
    # one string for each text and phase that holds a window at all
    phases = np.minimum(width, lengths - length + 1)
    owner = np.repeat(np.arange(len(texts)), phases)
    phase = np.arange(len(owner)) - np.repeat(np.cumsum(phases) - phases, phases)
    place, lcp = insert_columns(names, base[owner] + phase, (lengths[owner] - phase) // width, width, symbols)
    hit = lcp >= symbols
    hit[:-1] |= hit[1:]
    found = np.zeros(len(whole) + 1, bool)
    found[place[hit]] = True
    out = []
    for i, both in enumerate(twice):
        windows = int(lengths[i]) - length + 1
        out.append(np.ones(windows, bool) if both else found[base[i]:base[i] + windows])
    return out


def spans_of(windows: np.ndarray, at: int, length: int) -> np.ndarray:
    """Byte spans [start, end) that marked windows cover, places counted from ``at``."""
    marks = np.flatnonzero(windows)
    if not len(marks):
        return np.zeros((0, 2), np.int64)
    new = np.append(True, marks[1:] - marks[:-1] > 1)
    ends = np.append(marks[np.flatnonzero(new)[1:] - 1], marks[-1]) + length
    return np.stack([marks[new], ends], axis=1) + at


def union(spans: np.ndarray) -> np.ndarray:
    """Disjoint spans in order; spans that touch become one."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    return np.stack([spans[new, 0], np.append(reach[np.flatnonzero(new)[1:] - 1], reach[-1])], axis=1)


def without(text: bytes, spans: np.ndarray) -> bytes:
    at, out = 0, []
    for a, b in spans.tolist():
        out.append(text[at:a])
        at = b
    out.append(text[at:])
    return b"".join(out)


# --- Spark jobs --------------------------------------------------------------

FOUND = "kind int, doc_id long, text_key long, n long, sha binary, places binary"
FOUND_FIELDS = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()),
                          ("sha", pa.binary()), ("places", pa.binary())])
DOC_KIND = np.dtype([("doc", "<i8"), ("null", "<i8"), ("key", "<i8"), ("n", "<i8"), ("sha", "S32")])
KEY_KIND = np.dtype([("key", "<u4"), ("text", "<i8"), ("place", "<u4")])


def find_anchors(texts: DataFrame, length: int, parts: int, hot: int) -> DataFrame:
    """DOC rows (one per document) and CAND rows (anchors of a text whose
    contexts occur more than once, packed: place, RIGHT for the right context,
    HOT_FLAG if it occurs more than ``hot`` times)."""
    packed = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])

    def emit(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        docs, keys, seen, size, turn = [], [], {}, 0, 0

        def flush() -> Iterator[tuple]:
            nonlocal turn
            if docs:
                rows = np.asarray(docs, DOC_KIND)
                yield turn % parts, DOC, rows.tobytes()
                turn += 1
            if keys:
                k = np.concatenate([x[0] for x in keys])
                rows = np.empty(len(k), KEY_KIND)
                rows["key"], rows["text"], rows["place"] = (k & U(0xFFFFFFFF), np.concatenate([x[1] for x in keys]),
                                                            np.concatenate([x[2] for x in keys]))
                part = (k >> U(32)) % U(parts)
                order = np.argsort(part, kind="stable")
                ends = np.searchsorted(part[order], np.arange(parts + 1, dtype=U))
                rows = rows[order]
                for p in np.flatnonzero(np.diff(ends)).tolist():
                    yield p, CAND, rows[ends[p]:ends[p + 1]].tobytes()

        for batch in it:
            turn += 1
            for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))):
                docs.append((0 if doc is None else doc, doc is None, key, len(text), hashlib.sha256(text).digest() + b"."))
                # two copies of a text say all that more would
                if len(text) < length or seen.get(key, 0) == 2:
                    continue
                seen[key] = seen.get(key, 0) + 1
                for at, part in stretches(text, length):
                    rolled = Rolled(part)
                    place, *_ = anchors(rolled, length)
                    both = context_keys(rolled, place, length)
                    for side, k in zip((0, RIGHT), both):
                        there = k != 0
                        c = int(there.sum())
                        keys.append((k[there], np.full(c, key, np.int64), (place[there] + at | side).astype(np.uint32)))
                        size += c
            if size > 1 << 19 or len(docs) > 1 << 16:
                yield from flush()
                docs, keys, size = [], [], 0
                if len(seen) > 1_000_000:
                    seen.clear()
        yield from flush()

    def meet(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held = []
        for batch in it:
            for kind, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if kind == CAND:
                    held.append(np.frombuffer(data, KEY_KIND))
                    continue
                raw = np.frombuffer(data, np.uint8).reshape(-1, DOC_KIND.itemsize)
                for row, sha in zip(np.frombuffer(data, DOC_KIND), raw[:, -32:]):
                    yield (DOC, None if row["null"] else int(row["doc"]), int(row["key"]), int(row["n"]),
                           sha.tobytes(), None)
        if not held:
            return
        rows = np.concatenate(held)
        held = []
        rows = rows[np.argsort(rows["key"], kind="stable")]
        starts = np.flatnonzero(np.append(True, rows["key"][1:] != rows["key"][:-1]))
        sizes = np.diff(np.append(starts, len(rows)))
        size = np.repeat(sizes, sizes)
        rows, size = rows[size > 1], size[size > 1]
        order = np.lexsort((rows["place"], rows["text"]))
        rows, size = rows[order], size[order]
        places = rows["place"].astype("<i8") | np.where(size > hot, HOT_FLAG, 0)
        starts = np.flatnonzero(np.append(True, rows["text"][1:] != rows["text"][:-1])) if len(rows) else []
        for a, b in zip(starts, np.append(starts[1:], len(rows)) if len(rows) else []):
            yield CAND, None, int(rows["text"][a]), None, None, np.unique(places[a:b]).astype("<i8").tobytes()

    dealt = texts.mapInArrow(lambda it: batches(emit(it), packed, 64), "part int, kind int, data binary")
    return cut(dealt.repartitionById(parts, "part").mapInArrow(lambda it: batches(meet(it), FOUND_FIELDS, 2048), FOUND))


REF = np.dtype([("id", "<i8"), ("text", "<i8"), ("at", "<i8"), ("times", "<i4")])
WINDOW = np.dtype([("a", "<i8"), ("b", "<i8"), ("text", "<i8"), ("at", "<i8"), ("times", "<i4")])


def repeated_spans(rows: DataFrame, length: int, symbols: int, parts: int) -> DataFrame:
    """(text_key, spans): packed spans to remove. ``rows`` has text_key, times,
    places (packed lists) and text."""
    packed = pa.schema([("part", pa.int32()), ("refs", pa.binary()), ("windows", pa.binary()),
                        ("ids", pa.list_(pa.int64())), ("grams", pa.list_(pa.int64())), ("segments", pa.list_(pa.binary()))])

    def emit(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        sent: set[int] = set()
        refs, windows, segments = {}, {}, {}
        room = 0

        def flush() -> Iterator[tuple]:
            for p in sorted({*refs, *windows, *segments}):
                own = segments.get(p, [])
                yield (p, np.asarray(refs.get(p, []), REF).tobytes(), b"".join(windows.get(p, [])),
                       [s[0] for s in own], [s[1] for s in own], [s[2] for s in own])

        for batch in it:
            for key, times, places, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                batch.column(2).to_pylist(), utf8(batch.column(3))):
                marked = np.unique(np.concatenate([np.frombuffer(x, "<i8") for x in places]))
                is_hot = {m & (HOT_FLAG - 1): m >= HOT_FLAG for m in marked.tolist()}
                wanted = np.unique(marked & (RIGHT - 1))
                for at, part in stretches(text, length):
                    rolled = Rolled(part)
                    place, gram, first, end = anchors(rolled, length)
                    for k in np.flatnonzero(np.isin(place + at, wanted)).tolist():
                        spot = int(place[k]) + at
                        mid = middle(int(place[k]), int(first[k]), int(end[k]), length)
                        cold = []
                        for side, a, b in ((0, int(first[k]), mid), (RIGHT, mid, int(end[k]))):
                            hot = is_hot.get(spot | side)
                            if a == b or hot is None:  # a context that occurs once
                                continue
                            if not hot:
                                cold += [a, b]
                                continue
                            made = np.empty(b - a, WINDOW)
                            for w in range(a, b):
                                d = xxhash.xxh3_128_intdigest(part[w:w + length])
                                made[w - a] = (d >> 65, d & ((1 << 63) - 1), key, w + at, times)
                            owner = made["a"] % parts
                            for p in np.unique(owner).tolist():
                                windows.setdefault(p, []).append(made[owner == p].tobytes())
                            room += made.nbytes
                        if not cold:
                            continue
                        a, b = cold[0], cold[-1]
                        segment = part[a:b - 1 + length]
                        id_ = xxhash.xxh3_64_intdigest(segment) >> 1
                        p = int(gram[k]) % parts
                        refs.setdefault(p, []).append((id_, key, a + at, times))
                        room += 28
                        if id_ not in sent:
                            sent.add(id_)
                            segments.setdefault(p, []).append((id_, int(gram[k]) >> 1, segment))
                            room += len(segment)
                if room > 16 << 20:
                    yield from flush()
                    refs, windows, segments, room = {}, {}, {}, 0
                    if len(sent) > 2_000_000:
                        sent.clear()
        yield from flush()

    def meet(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        texts: dict[int, tuple[int, bytes]] = {}
        refs, windows = [], []
        for batch in it:
            for _, r, w, ids, grams, segments in zip(*(c.to_pylist() for c in batch.columns)):
                refs.append(np.frombuffer(r, REF))
                windows.append(np.frombuffer(w, WINDOW))
                for i, g, s in zip(ids, grams, segments):
                    texts.setdefault(i, (g, s))
        out: dict[int, list[np.ndarray]] = {}
        if windows and len(rows_ := np.concatenate(windows)):
            rows_ = rows_[np.lexsort((rows_["b"], rows_["a"]))]
            same = (rows_["a"][1:] == rows_["a"][:-1]) & (rows_["b"][1:] == rows_["b"][:-1])
            hit = (rows_["times"] > 1) | np.append(False, same) | np.append(same, False)
            for text, at in zip(rows_["text"][hit].tolist(), rows_["at"][hit].tolist()):
                out.setdefault(text, []).append(np.asarray([[at, at + length]]))
        if refs and len(own := np.concatenate(refs)):
            own = own[np.argsort(own["id"], kind="stable")]
            ids, starts = np.unique(own["id"], return_index=True)
            ends = np.append(starts[1:], len(own))
            times = dict(zip(ids.tolist(), np.add.reduceat(own["times"], starts).tolist()))
            of = dict(zip(ids.tolist(), zip(starts.tolist(), ends.tolist())))
            # collections hold all segments of an anchor
            todo, size, last = [], 0, None
            for id_ in [*sorted(texts, key=lambda i: (texts[i][0], i)), None]:
                if todo and (id_ is None or size > COLLECTION_BYTES and texts[id_][0] != last):
                    marks = repeated_windows([texts[i][1] for i in todo], [times[i] > 1 for i in todo], length, symbols)
                    for i, mark in zip(todo, marks):
                        spans = spans_of(mark, 0, length)
                        if len(spans):
                            a, b = of[i]
                            for text, at in zip(own["text"][a:b].tolist(), own["at"][a:b].tolist()):
                                out.setdefault(text, []).append(spans + at)
                    todo, size = [], 0
                if id_ is not None:
                    todo.append(id_)
                    size += len(texts[id_][1])
                    last = texts[id_][0]
        for text, spans in out.items():
            yield text, union(np.concatenate(spans)).astype("<i8").tobytes()

    fields = pa.schema([("text_key", pa.int64()), ("spans", pa.binary())])
    dealt = rows.mapInArrow(lambda it: batches(emit(it), packed, 4), "part int, refs binary, windows binary, "
                            "ids array<long>, grams array<long>, segments array<binary>").repartitionById(parts, "part")
    spans = dealt.mapInArrow(lambda it: batches(meet(it), fields, 2048), "text_key long, spans binary")
    return cut(spans.groupBy("text_key").agg(F.collect_list("spans").alias("spans")))


BLANK = np.isin(np.arange(256), [32, *range(9, 14)])


def short_passages(text: bytes, words: int, under: int) -> np.ndarray:
    """[start, end) of every run of ``words`` words that has fewer than ``under`` bytes."""
    blank = np.ones(len(text) + 2, bool)
    blank[1:-1] = BLANK[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    runs = np.stack([edges[::2][:max(0, len(edges) // 2 - words + 1)], edges[1::2][words - 1:]], axis=1)
    return runs[runs[:, 1] - runs[:, 0] < under]


def short_spans(texts: DataFrame, words: int, under: int) -> DataFrame:
    """(text_key, spans): passages of ``words`` words and fewer than ``under``
    bytes that occur more than once, in one text or in several. They are compared
    by 126 bits of their digests. Digests are counted before the shuffle and the
    join can be split, so a common passage doesn't meet in one task."""
    fields = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("text_key", pa.int64()), ("span", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in it:
            for key, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                for span in short_passages(text, words, under):
                    d = xxhash.xxh3_128_intdigest(text[span[0]:span[1]])
                    yield d >> 65, d & ((1 << 63) - 1), key, span.astype("<i8").tobytes()

    found = cut(texts.select(text_key(F.col("text")).alias("text_key"), "text").mapInArrow(
        lambda it: batches(run(it), fields), "a long, b long, text_key long, span binary"))
    repeated = found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("a", "b")
    return (found.join(repeated, ["a", "b"], "left_semi")
            .groupBy("text_key").agg(F.collect_set("span").alias("spans")))


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def find_spans(texts: DataFrame, length: int, symbols: int, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, text_key, n, sha; spans by text_key)."""
    if length % symbols or length < 2 * GRAM:
        raise ValueError("length must be a multiple of symbols and twice an anchor's bytes at least")
    spark = texts.sparkSession
    text_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = texts.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    found = find_anchors(keyed, length, parts, hot)
    docs = found.where(F.col("kind") == DOC).select("doc_id", "text_key", "n", "sha")
    first = docs.groupBy("text_key").agg(F.min("doc_id").alias("first"), F.least(F.count(F.lit(1)), F.lit(2)).cast("int").alias("times"))
    places = found.where(F.col("kind") == CAND).groupBy("text_key").agg(F.collect_list("places").alias("places"))
    wanted = places.join(first, "text_key").withColumnRenamed("text_key", "want")
    # one document of each text; of rows that share its id too, each is sent
    rows = keyed.join(wanted, (F.col("text_key") == F.col("want")) & F.col("doc_id").eqNullSafe(F.col("first")))
    return docs, repeated_spans(rows.select("text_key", "times", "places", "text"), length, symbols, parts)


def _spans(packed: list[bytes]) -> np.ndarray:
    return union(np.concatenate([np.frombuffer(x, "<i8").reshape(-1, 2) for x in packed]))


def digests(docs: DataFrame, length: int = LENGTH, symbols: int = SYMBOLS, id_col: str = "doc_id",
            text_col: str = "text", hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    texts = ids_and_texts(docs, id_col, text_col)
    plain, spans = find_spans(texts, length, symbols, hot)
    fields = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in it:
            for doc, text, packed in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist()):
                own = _spans(packed)
                yield (doc, len(text), int((own[:, 1] - own[:, 0]).sum()), len(own),
                       hashlib.sha256(without(text, own)).hexdigest())

    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    changed = texts.withColumn("text_key", text_key(F.col("text"))).join(spans, "text_key")
    changed = changed.select("doc_id", "text", "spans").mapInArrow(lambda it: batches(run(it), fields, 1024), ddl)
    same = plain.join(spans.select("text_key"), "text_key", "left_anti").select(
        "doc_id", F.col("n").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.lower(F.hex("sha")).alias("kept_sha256"))
    return changed.unionByName(same)


def remove_repeats(docs: DataFrame, length: int = LENGTH, symbols: int = SYMBOLS, text_col: str = "text",
                   words: int | None = None) -> DataFrame:
    """``docs`` with every repeated string of ``length`` bytes taken out of its
    texts, and every repeated passage of ``words`` words if that is given, however
    few its bytes. Pieces of a character that a cut leaves are dropped; null texts stay null."""
    from pyspark.sql.functions import arrow_udf
    texts = ids_and_texts(docs, "doc_id", text_col)
    _, spans = find_spans(texts, length, symbols)
    if words:  # a passage of ``length`` bytes or more is among the spans
        spans = spans.unionByName(short_spans(texts, words, length)).groupBy("text_key").agg(
            F.flatten(F.collect_list("spans")).alias("spans"))
    spans = spans.select(F.col("text_key").alias("_repeat_key"), F.col("spans").alias("_repeat_spans"))

    @arrow_udf("string")
    def kept(text: pa.Array, packed: pa.Array) -> pa.Array:
        return pa.array([t if p is None else without(t.encode(), _spans(p)).decode(errors="ignore")
                         for t, p in zip(text.to_pylist(), packed.to_pylist())], pa.string())

    keyed = docs.withColumn("_repeat_key", text_key(F.coalesce(F.col(text_col), F.lit(""))))
    joined = keyed.join(spans, "_repeat_key", "left")
    return joined.withColumn(text_col, kept(F.col(text_col), F.col("_repeat_spans"))).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
