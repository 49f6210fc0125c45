"""Operator 1: exact n-gram Jaccard join on size-banded tiles.

Sets of hashed word n-grams are banded by size so that two sets over the
threshold lie in the same or in neighbouring bands. For a pair of neighbouring
bands the symmetric difference of two linked sets is at most some D; if the
hash space is cut into D + 1 parts or more, the two sets agree on a whole part.
So each set sends a key for each of its parts, and only sets that share a key
can be linked: no pair is lost. Every set has a bitmap of its hashes; the count
of differing bits bounds the overlap from above. In the groups of a common key,
short bitmaps drop the pairs that can't be linked; sets joined by what is left
form a tile. In a tile longer bitmaps are compared first, and only pairs that
pass have their sorted arrays intersected. Pairs that are connected already
are skipped, so a group of copies costs one comparison for each member.

Equal sets are one node from the start. A tile over ``tile_nodes`` sets is
taken apart: first every set is compared with the leader of each of its key
groups, then only groups that still hold more than one component are compared
in blocks.

Null and empty texts and texts without words have an empty set and are linked
with nothing. Null ids are kept, and don't name a component unless it has no
other. Hashes have 64 bits.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LONGEST_KEPT, batches, cut, ids_and_texts, table, text_batches, utf8
from .graph import components

TILE_NODES = 8192
SHORT_WORDS = 8
FLUSH_ROWS = 1 << 20
CACHE_WORDS = 500_000
U = np.uint64


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONGEST_KEPT:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = h
        return h


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(31))) * U(0x7FB5D329728EA185)
    h = (h ^ (h >> U(27))) * U(0x81DADEF4BC2DD44D)
    return h ^ (h >> U(33))


def sets_of(texts: list[bytes], n: int, known: WordHashes) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    split = [t.lower().split() for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.fromiter((known[w] for words in split for w in words), U, int(counts.sum()))
    grams = np.zeros(max(0, len(flat) - n + 1), U)
    for k in range(n):
        grams = mixed(grams + flat[k:len(flat) - n + 1 + k] * U(2 * k + 3))
    at = 0
    for words, c in zip(split, counts.tolist()):
        if c >= n:
            yield np.unique(grams[at:at + c - n + 1])
        elif c:  # the whole sequence is one n-gram
            yield np.asarray([xxhash.xxh3_64_intdigest(b" ".join(words), seed=c)], U)
        else:
            yield np.zeros(0, U)
        at += c


class Bands:
    """Size bands for a threshold num/den and the number of parts of each level.
    Level i holds the sets of bands i and i + 1."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.low = [1]

    def band(self, size: int) -> int:
        import bisect
        while self.low[-1] <= size:
            self.low.append(self.low[-1] * self.den // self.num + 1)
        return bisect.bisect_right(self.low, size) - 1

    @functools.lru_cache(maxsize=None)
    def parts(self, level: int) -> tuple[int, int]:
        """(parts, spare): two linked sets of this level agree on more than
        ``spare`` parts. 0 parts: only equal sets are linked."""
        while len(self.low) < level + 3:
            self.low.append(self.low[-1] * self.den // self.num + 1)
        most = self.low[level + 1] + self.low[level + 2] - 2
        differ = most * (self.den - self.num) // (self.den + self.num)
        if differ == 0:
            return 0, 0
        spare = 0
        while spare < differ + 2:  # enough spare parts for those that happen to be empty
            m = differ + 1 + spare
            empty = m * math.exp(-self.low[level] / m)
            if spare >= empty + 2.5 * math.sqrt(empty) + 1:
                break
            spare += 1
        return differ + 1 + spare, spare


def keys_of(h: np.ndarray, bands: Bands) -> np.ndarray:
    """The part keys of a set, for the levels of its band."""
    out = []
    band = bands.band(len(h))
    sums = np.concatenate([np.zeros(1, U), np.cumsum(mixed(h))])
    for level in (band, band - 1):
        if level < 0:
            continue
        m, spare = bands.parts(level)
        if not m:
            continue
        cuts = (np.arange(1, m, dtype=U) * U((1 << 64) // m))
        ends = np.concatenate([np.zeros(1, np.int64), np.searchsorted(h, cuts), np.asarray([len(h)])])
        part = sums[ends[1:]] - sums[ends[:-1]]
        key = mixed(part ^ mixed(np.arange(m, dtype=U) + U(level << 32)))
        full = ends[1:] > ends[:-1]
        # two linked sets agree on more than `spare` parts: on a part that is not
        # empty, or both have more than `spare` empty ones
        out.append(key[full] if m - int(full.sum()) <= spare else key)
    return np.concatenate(out) if out else np.zeros(0, U)


def node_of(h: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(h.tobytes()) >> 1


CANDIDATES = "kind int, a long, b long, n long, nodes array<long>, bits binary"
CANDIDATE_FIELDS = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()),
                              ("nodes", pa.list_(pa.int64())), ("bits", pa.binary())])
DOC, KEYS, GROUP = 0, 1, 2


def candidates(texts: DataFrame, n: int, bands_of: tuple[int, int], parts: int) -> DataFrame:
    """Rows of two kinds: DOC (doc_id, node, set size, short bitmap) and GROUP
    (digest, nodes: sets with a common key, in chunks).

    Keys travel packed, 12 bytes each, dealt by key, and meet in sorted arrays;
    partition counts follow the session's shuffle partitions."""
    packed = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])

    def emit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, known = Bands(*bands_of), WordHashes()
        keys, nodes, docs, held = [], [], [], 0
        turn = 0

        def flush() -> Iterator[tuple]:
            nonlocal turn
            for head, bits in docs:
                yield turn % parts, DOC, np.asarray(head, "<i8").tobytes() + bits
                turn += 1
            if keys:
                k, v = np.concatenate(keys), np.concatenate(nodes)
                part = (k >> U(32)) % U(parts)
                order = np.argsort(part, kind="stable")
                k, v, part = k[order], v[order], part[order]
                ends = np.searchsorted(part, np.arange(parts + 1, dtype=U))
                for p in range(parts):
                    a, b = ends[p], ends[p + 1]
                    if b > a:
                        yield p, KEYS, (k[a:b] & U(0xFFFFFFFF)).astype("<u4").tobytes() + v[a:b].astype("<i8").tobytes()

        def rows() -> Iterator[tuple]:
            nonlocal keys, nodes, docs, held, turn
            for batch in it:
                turn += 1
                for doc, h in zip(batch.column(0).to_pylist(), sets_of(utf8(batch.column(1)), n, known)):
                    node = node_of(h) if len(h) else 0
                    docs.append(((0 if doc is None else doc, doc is None, node, len(h)),
                                 bitmap(h, SHORT_WORDS << (len(h) // 1024).bit_length()).tobytes()))
                    if len(h):
                        k = keys_of(h, bands)
                        keys.append(k)
                        nodes.append(np.full(len(k), node, np.int64))
                        held += len(k)
                if held > FLUSH_ROWS or len(docs) > 1 << 15:
                    yield from flush()
                    keys, nodes, docs, held = [], [], [], 0
            yield from flush()
        yield from batches(rows(), packed, 64)

    def meet(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        keys, nodes = [], []
        for batch in it:
            for kind, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if kind == DOC:
                    doc, null, node, size = np.frombuffer(data, "<i8", 4).tolist()
                    yield DOC, None if null else doc, node, size, None, data[32:]
                else:
                    c = len(data) // 12
                    keys.append(np.frombuffer(data, "<u4", c))
                    nodes.append(np.frombuffer(data, "<i8", c, 4 * c))
        if not keys:
            return
        k, v = np.concatenate(keys), np.concatenate(nodes)
        keys, nodes = [], []
        order = np.lexsort((v, k))
        k, v = k[order], v[order]
        fresh = np.ones(len(k), bool)
        fresh[1:] = (k[1:] != k[:-1]) | (v[1:] != v[:-1])  # copies of a set are one node
        k, v = k[fresh], v[fresh]
        starts = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        sizes = np.diff(np.append(starts, len(k)))
        starts, sizes = starts[sizes > 1], sizes[sizes > 1]
        if not len(starts):
            return
        seen: set[int] = set()
        for s, c in zip(starts.tolist(), sizes.tolist()):
            group = v[s:s + c]
            digest = xxhash.xxh3_64_intdigest(group.tobytes()) >> 1
            if digest in seen:
                continue
            seen.add(digest)
            for at in range(0, c, 4096):
                yield GROUP, digest, None, c, group[at:at + 4096].tolist(), None

    dealt = texts.mapInArrow(emit, "part int, kind int, data binary").repartitionById(parts, "part")
    return cut(dealt.mapInArrow(lambda it: batches(meet(it), CANDIDATE_FIELDS), CANDIDATES))


def sets_for(texts: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(tile, node, hashes) for nodes that have a row in ``wanted`` (doc_id, node,
    tile), computed from one document of each."""
    fields = pa.schema([("tile", pa.int64()), ("node", pa.int64()), ("hashes", pa.binary())])
    rows = texts.join(wanted.withColumnRenamed("doc_id", "want"), F.col("doc_id").eqNullSafe(F.col("want")))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        known = WordHashes()
        for batch in it:
            tile, node, text = batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))
            for t, v, h in zip(tile, node, sets_of(text, n, known)):
                if len(h) and node_of(h) == v:  # rows may share a doc_id
                    yield t, v, h.astype("<u8").tobytes()

    found = rows.select("tile", "node", "text").mapInArrow(
        lambda it: batches(run(it), fields, 256), "tile long, node long, hashes binary")
    return found.dropDuplicates(["tile", "node"])


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Exact: both arrays are sorted and distinct."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return den * shared >= num * (len(both) - shared)


def bitmap(h: np.ndarray, words: int) -> np.ndarray:
    """A set's bits in ``words`` (a power of two) words: hash modulo the number of bits."""
    out = np.zeros(words, U)
    np.bitwise_or.at(out, (h >> U(6)) % U(words), U(1) << (h & U(63)))
    return out


def folded(bits: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of several lengths, all brought to the shortest."""
    words = min(map(len, bits))
    return np.stack([np.bitwise_or.reduce(b.reshape(-1, words), axis=0) for b in bits])


def tile_edges(nodes: list[int], sizes: list[int], maps: np.ndarray, sets: list[np.ndarray] | None, group: list[int],
               num: int, den: int) -> list[tuple[int, int]]:
    """Every set of a component of two or more with the component's smallest
    node. ``group``: what is connected already. Without ``sets`` all pairs that
    pass the bitmaps' bound count as linked."""
    order = sorted(range(len(nodes)), key=lambda i: (sizes[i], nodes[i]))
    nodes, maps = [nodes[i] for i in order], maps[order]
    sizes = np.asarray([sizes[i] for i in order], np.int64)
    sets = sets and [sets[i] for i in order]
    _, root = np.unique(np.asarray([group[i] for i in order]), return_inverse=True)
    last = np.searchsorted(sizes, sizes * den // num, side="right")  # the band each set reaches up to
    for i in range(len(nodes)):
        later = i + 1 + np.flatnonzero(root[i + 1:last[i]] != root[i])
        for at in range(0, len(later), 2048):
            part = later[at:at + 2048]
            part = part[root[part] != root[i]]
            differ = np.bitwise_count(maps[part] ^ maps[i]).sum(axis=1, dtype=np.int64)
            bound = (sizes[i] + sizes[part] - differ) // 2
            part = part[den * bound >= num * (sizes[i] + sizes[part] - bound)]
            if sets is None:
                root[np.isin(root, root[part])] = root[i]
                continue
            for j in part.tolist():
                if root[j] != root[i] and linked(sets[i], sets[j], num, den):
                    root[root == root[j]] = root[i]
    least: dict[int, int] = {}
    for node, r in zip(nodes, root.tolist()):
        least[r] = min(node, least.get(r, node))
    return [(node, least[r]) for node, r in zip(nodes, root.tolist()) if node != least[r]]


EDGE_FIELDS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def join_tiles(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): sets and the smallest node of their component inside each tile;
    ``sets`` has tile, node, grp, hashes. One tile is in memory at a time."""
    ordered = sets.select("tile", "node", "grp", "hashes").repartition("tile").sortWithinPartitions("tile")

    def edges(nodes: list[int], groups: list[int], held: list[np.ndarray]) -> list[tuple[int, int]]:
        sizes = list(map(len, held))
        words = min(256, max(4, (1 << (4 * max(sizes) - 1).bit_length()) // 64))
        return tile_edges(nodes, sizes, np.stack([bitmap(h, words) for h in held]), held, groups, num, den)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, nodes, groups, held = None, [], [], []
        for batch in it:
            for tile, node, grp, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if tile != key and nodes:
                    yield from edges(nodes, groups, held)
                    nodes, groups, held = [], [], []
                key = tile
                nodes.append(node)
                groups.append(grp)
                held.append(np.frombuffer(raw, "<u8"))
        if nodes:
            yield from edges(nodes, groups, held)

    return ordered.mapInArrow(lambda it: batches(run(it), EDGE_FIELDS), "a long, b long")


def bounded_links(groups: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) that join the sets of each key group which their short bitmaps let
    pass. A group's bitmaps are in memory at a time, some 100 bytes a set."""
    rows = groups.select("grp", "node").distinct().join(nodes.select("node", "size", "bits"), "node")
    ordered = rows.select("grp", "node", "size", "bits").repartition("grp").sortWithinPartitions("grp")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, held, done = None, [], set()

        def edges() -> Iterator[tuple]:
            maps = folded([np.frombuffer(bits, "<u8") for _, _, bits in held])
            members = [node for node, _, _ in held]
            for edge in tile_edges(members, [size for _, size, _ in held], maps, None, members, num, den):
                if edge not in done:
                    done.add(edge)
                    yield edge
        for batch in it:
            for grp, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if grp != key and held:
                    yield from edges()
                    held = []
                    if len(done) > 1_000_000:
                        done.clear()
                key = grp
                held.append(row)
        if held:
            yield from edges()

    return ordered.mapInArrow(lambda it: batches(run(it), EDGE_FIELDS), "a long, b long")


def join_leaders(sets: DataFrame, pairs: DataFrame, num: int, den: int, salts: int) -> DataFrame:
    """(a, b) for those pairs (leader, node) that are linked. A leader meets its
    nodes in several tasks, each with a share of them."""
    salt = F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int")
    members = pairs.join(sets.select("node", "hashes"), "node").select(
        "leader", salt.alias("salt"), F.lit(1).alias("kind"), "node", "hashes")
    heads = (pairs.select("leader", salt.alias("salt")).distinct()
             .join(sets.select(F.col("node").alias("leader"), "hashes"), "leader")
             .select("leader", "salt", F.lit(0).alias("kind"), F.col("leader").alias("node"), "hashes"))
    both = heads.unionByName(members).repartition("leader", "salt").sortWithinPartitions("leader", "salt", "kind")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        head, at = None, None
        for batch in it:
            for leader, _, kind, node, raw in zip(*(c.to_pylist() for c in batch.columns)):
                h = np.frombuffer(raw, "<u8")
                if kind == 0:
                    head, at = h, leader
                elif at == leader and min(len(h), len(head)) * den >= max(len(h), len(head)) * num:
                    if linked(head, h, num, den):
                        yield leader, node

    return both.mapInArrow(lambda it: batches(run(it), EDGE_FIELDS), "a long, b long")


def large_tiles(groups: DataFrame, wanted: DataFrame, texts: DataFrame, n: int, num: int, den: int,
                tile_nodes: int) -> DataFrame:
    """Edges among the nodes of over-large tiles."""
    own = groups.join(wanted.select("node"), "node", "left_semi").distinct()
    degree = own.groupBy("node").agg(F.sum("n").alias("degree"))
    # the set that most others agree with leads: in a group of edited copies, the original
    led = own.join(degree, "node").groupBy("grp").agg(F.max(F.struct("degree", "node")).alias("top"))
    own = cut(own.join(led.select("grp", F.col("top.node").alias("leader")), "grp").select("grp", "node", "leader"))
    sets = cut(sets_for(texts, wanted.withColumn("tile", F.lit(0).cast("long")), n).select("node", "hashes"))
    pairs = own.where("node <> leader").select("leader", "node").distinct()
    edges = cut(join_leaders(sets, pairs, num, den, 64))
    roots = components(edges)
    marked = own.join(roots, "node", "left").select("grp", "node", F.coalesce("root", "node").alias("root"))
    open_ = (marked.groupBy("grp").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                       F.count(F.lit(1)).alias("size")).where("lo <> hi and size > 2"))
    blocks = F.expr(f"cast((size + {tile_nodes - 1}) div {tile_nodes} as int)")
    left = marked.join(open_.select("grp", blocks.alias("blocks")), "grp")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    left = left.select("grp", "node", "root", "blocks", mine.alias("mine"),
                       F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    # each pair of blocks is a tile
    tile = F.xxhash64("grp", F.least("mine", "other"), F.greatest("mine", "other"))
    left = left.select(tile.alias("tile"), "node", F.col("root").alias("grp")).join(sets, "node")
    return cut(edges.unionByName(join_tiles(left, num, den)))


def join(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text",
         tile_nodes: int = TILE_NODES) -> DataFrame:
    """doc_id, n_shingles, node (class of equal sets), component_id for every row."""
    spark = docs.sparkSession
    text_batches(spark)
    texts = ids_and_texts(docs, id_col, text_col)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = candidates(texts, n, (num, den), parts)
    rows = found.where(F.col("kind") == DOC).select(F.col("a").alias("doc_id"), F.col("b").alias("node"), "n", "bits")
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"), F.max("n").alias("size"),
                                                    F.first("bits").alias("bits"))
    groups = found.where(F.col("kind") == GROUP).select(F.col("a").alias("grp"), "n", F.explode("nodes").alias("node"))
    tiles = components(bounded_links(groups, nodes, num, den))
    sizes = tiles.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    placed = cut(tiles.join(sizes, "root").join(nodes.select("node", "first"), "node").select(
        F.col("root").alias("tile"), "node", F.col("first").alias("doc_id"), (F.col("size") > tile_nodes).alias("large")))

    small = sets_for(texts, placed.where("not large").select("tile", "node", "doc_id"), n)
    # a small tile holds whole components; those of large ones are put together from their parts
    roots = join_tiles(small.withColumn("grp", F.col("node")), num, den).select(
        F.col("a").alias("node"), F.col("b").alias("root"))
    large = placed.where("large")
    if not large.isEmpty():
        roots = roots.unionByName(components(
            large_tiles(groups, large.select("node", "doc_id"), texts, n, num, den, tile_nodes)))
    roots = cut(roots)

    named = nodes.select("node", "first").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "first")
    names = named.groupBy("root").agg(F.min("first").alias("component_id"))
    names = named.join(names, "root").select("node", "component_id")
    out = rows.where("n > 0").join(names, "node").select("doc_id", F.col("n").alias("n_shingles"), "node", "component_id")
    return out.unionByName(rows.where("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("node"),
        F.col("doc_id").alias("component_id")))


def query(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
