"""Operator 13: hard negatives by a multiway hyperplane tree with distance ranges.

An anchor's positives are its best rows of the same label; a positive's negatives
are the best rows of other labels whose score lies in a window below its own.
Scores are inner products of integer vectors. One more coordinate gives all rows
the same length M, so that |a - x|^2 = M^2 + |a|^2 - 2<a, x>: a window of scores
is an annulus around the anchor.

1. Copies first: of rows with one vector and label, only the first few can be in
   any answer (one more than the positives of an anchor, which may be one of
   them), so the rest stay out of the index; equal anchors are searched once.
2. The tree is fitted on at most ``sample`` rows (those with the smallest hashes).
   Each inner node has ``fan`` split points, taken far from one another, and a row
   goes to the nearest. All rows are indexed: they walk down to their leaf, and
   for every split point the least and greatest distance to the rows of each
   sibling subtree are stored.
3. A search walks down with an annulus. A subtree is dropped if, for any split
   point of its node, the stored range and the annulus can't meet. The annulus for
   positives starts at the best rows of the sample and of the anchor's home leaf;
   those for negatives at the window and the best rows of the sample in it.
4. The leaves left are searched whole: anchors and rows of a leaf meet in pieces of
   bounded size (large leaves and much visited ones are cut in blocks), exact
   products, best few of each piece, then the best over all pieces.

Leaves grow with the table above ``sample`` rows a leaf's worth; blocks keep tasks
bounded then. Broadcast are the tree, its ranges and the sample: bounded by
``sample`` whatever the size of the table.

Defined cases: rows with a null label or vector, or a component that is null or
not finite, take no part. Shorter vectors count as filled with zeros. A null id
is greater than all others and comes back as null. Rows with one id are rows of
their own; ties go to the smaller id, then to the first read. Fewer rows than
asked for: all there are. An empty table gives no rows. Other columns are not
looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, ship, table

SCALE = 256
SAMPLE, FAN, LEAF_ROWS = 20_000, 8, 1024
BLOCK_ROWS, BLOCK_ANCHORS = 8192, 2048
SALT = 8
NO_ID = (1 << 63) - 1
FLOOR = -(1 << 62)  # a score below all others


# --- tree --------------------------------------------------------------------

@dataclass
class Node:
    points: np.ndarray  # [fan, dim + 1]
    children: list[int]  # a node's number, or -1 - the leaf's
    low: np.ndarray = field(default=None)  # [point, child]: distances from a point to the rows below a child
    high: np.ndarray = field(default=None)


class Tree:
    """Split points over rows lifted to one length; ranges are set once all rows are indexed."""

    def __init__(self, vectors: np.ndarray, square: float, fan: int, most: int):
        self.square, self.nodes, self.leaves = square, [], 0
        self.slack = 1e-5 * max(square, 1.0) ** 0.5
        x = self.lifted(vectors)
        self.root = self._split(x, fan, most)
        self.child_to = [np.full(max(self.leaves, 1), -1) for _ in self.nodes]  # node -> the child above each leaf
        for number in range(len(self.nodes)):
            for k, child in enumerate(self.nodes[number].children):
                for leaf in self._below(child):
                    self.child_to[number][leaf] = k

    def _below(self, number: int) -> list[int]:
        return [-1 - number] if number < 0 else [x for c in self.nodes[number].children for x in self._below(c)]

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        x = np.asarray(vectors, np.float64)
        more = np.sqrt(np.maximum(self.square - np.einsum("ij,ij->i", x, x), 0))
        return np.concatenate([x, more[:, None]], axis=1)

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _split(self, x: np.ndarray, fan: int, most: int) -> int:
        if len(x) <= most:
            return self._leaf()
        # far apart: each next point is the one farthest from those chosen
        far = distances(x, x.mean(axis=0, keepdims=True))[:, 0]
        chosen = []
        while len(chosen) < fan and far.max() > self.slack:
            chosen.append(int(far.argmax()))
            own = distances(x, x[chosen[-1:]])[:, 0]
            far = own if len(chosen) == 1 else np.minimum(far, own)
        if len(chosen) < 2:
            return self._leaf()
        points = x[chosen]
        near = distances(x, points).argmin(axis=1)
        number = len(self.nodes)
        self.nodes.append(Node(points, []))
        self.nodes[number].children = [self._split(x[near == k], fan, most) for k in range(len(points))]
        return number

    def walk(self, x: np.ndarray, leaf: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(node, rows, distances, child) on the way down, to the nearest point or to a given leaf."""
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            number, rows = todo.pop()
            if number < 0 or not len(rows):
                continue
            node = self.nodes[number]
            d = distances(x[rows], node.points)
            near = d.argmin(axis=1) if leaf is None else self.child_to[number][leaf[rows]]
            yield number, rows, d, near
            todo += [(child, rows[near == k]) for k, child in enumerate(node.children)]

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        x = self.lifted(vectors)
        leaf = np.zeros(len(x), np.int32)
        if self.root < 0:
            return leaf
        for number, rows, _, near in self.walk(x):
            leaf[rows] = -1 - np.asarray(self.nodes[number].children)[near]
        return leaf

    def ranges_of(self, vectors: np.ndarray, leaf: np.ndarray) -> Iterator[tuple[int, int, int, float, float]]:
        """(node, point, child, least, greatest distance) over some rows in their leaves."""
        for number, _, d, near in self.walk(self.lifted(vectors), leaf):
            for k in np.unique(near).tolist():
                own = d[near == k]
                for p, (a, b) in enumerate(zip(own.min(axis=0).tolist(), own.max(axis=0).tolist())):
                    yield number, p, k, a, b

    def set_ranges(self, rows: list) -> None:
        for node in self.nodes:
            shape = (len(node.points), len(node.children))
            node.low, node.high = np.full(shape, np.inf), np.full(shape, -np.inf)
        for number, p, k, a, b in rows:
            self.nodes[number].low[p, k], self.nodes[number].high[p, k] = a, b

    def annulus(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest distance of rows that score from ``low`` to ``high``."""
        base = self.square + np.einsum("ij,ij->i", anchors, anchors)[:, None]
        near = np.sqrt(np.maximum(base - 2 * high, 0)) - self.slack
        return near, np.sqrt(np.maximum(base - 2 * low, 0)) + self.slack

    def visits(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, anchors that must see it). ``low`` and ``high`` are score windows, [anchor, window];
        a window with low > high is none."""
        a = np.asarray(anchors, np.float64)
        near, far = self.annulus(a, low.astype(np.float64), high.astype(np.float64))
        open_ = low <= high
        at = np.concatenate([a, np.zeros((len(a), 1))], axis=1)
        todo = [(self.root, np.flatnonzero(open_.any(axis=1)))]
        while todo:
            number, rows = todo.pop()
            if not len(rows):
                continue
            if number < 0:
                yield -1 - number, rows
                continue
            node = self.nodes[number]
            d = distances(at[rows], node.points)
            for k, child in enumerate(node.children):
                least = np.maximum(d - node.high[:, k], node.low[:, k] - d).max(axis=1)
                most = (d + node.high[:, k]).min(axis=1)
                meets = (least[:, None] <= far[rows]) & (most[:, None] >= near[rows]) & open_[rows]
                todo.append((child, rows[meets.any(axis=1)]))


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", points, points)[None, :] - 2 * (x @ points.T))
    return np.sqrt(np.maximum(square, 0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles while all sums fit them."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, FLOOR + 1, -FLOOR).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, some: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` of ``some`` by score, then id, then row."""
    if len(some) > most:
        cut_ = np.partition(scores[some], len(some) - most)[len(some) - most]
        some = some[scores[some] >= cut_]
    return some[np.lexsort((rows[some], ids[some], -scores[some]))][:most]


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1), flat.dtype)


# --- Spark jobs --------------------------------------------------------------

@dataclass
class Index:
    rows: DataFrame  # row, id, label, v, leaf
    tree: object  # broadcast Tree
    sample: object  # broadcast (ids, rows, labels, vectors)
    leaf_rows: dict[int, int]


def prepared(df: DataFrame, id_col: str, vec_col: str, label: Column, anchor: Column) -> DataFrame:
    """row, id, label, v (integers, all of one length), anchor; stored, so that row numbers hold."""
    ship(df.sparkSession)
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(vec_col, lambda x: F.floor(x.cast("double") * SCALE))
    rows = df.where(F.col(vec_col).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        label.cast("long").alias("label"), whole.alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = cut(rows.where("label is not null"))
    size, most = rows.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()
    size = max(size or 0, 1)
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("v")))
    return rows.withColumn("v", filled.cast("array<int>") if (most or 0) < 1 << 31 else filled)


def build(rows: DataFrame, copies: int, sample: int = SAMPLE, fan: int = FAN, leaf_rows: int = LEAF_ROWS) -> Index:
    """Index the first ``copies`` rows of each vector and label."""
    sc = rows.sparkSession.sparkContext
    first = Window.partitionBy("label", "v").orderBy("id", "row")
    distinct = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= copies)
    distinct = cut(distinct.select("row", "id", "label", "v", "nth"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    total, longest = distinct.agg(F.count(F.lit(1)), F.max(square)).first()
    some = (distinct.where("nth = 1").orderBy(F.xxhash64("v", "label"), "row").limit(sample)
            .select("id", "row", "label", "v").toArrow())
    vectors = matrix(some["v"])
    most = max(int(leaf_rows * len(vectors) / max(total, 1)), 1)
    tree = Tree(vectors, float(longest or 0), fan, most)
    raw = sc.broadcast(tree)
    kind = rows.schema["v"].dataType.elementType
    fields = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("label", pa.int64()),
                        ("v", pa.list_(pa.int32() if kind.typeName() == "integer" else pa.int64())), ("leaf", pa.int32())])

    def assign(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if b.num_rows:
                leaf = raw.value.leaf_of(matrix(b.column(3)))
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(leaf)], names=fields.names)

    def measure(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, tuple] = {}
        for b in it:
            if not b.num_rows:
                continue
            for number, p, k, low, high in raw.value.ranges_of(matrix(b.column(0)), b.column(1).to_numpy()):
                was = seen.get((number, p, k), (low, high))
                seen[number, p, k] = (min(low, was[0]), max(high, was[1]))
        if seen:
            cols = zip(*((*key, *r) for key, r in seen.items()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int32()] * 3 + [pa.float64()] * 2)],
                                             names=["node", "point", "child", "low", "high"])

    placed = cut(distinct.select("row", "id", "label", "v").mapInArrow(
        assign, f"row long, id long, label long, v array<{kind.simpleString()}>, leaf int"))
    ranges = placed.select("v", "leaf").mapInArrow(measure, "node int, point int, child int, low double, high double")
    # at most fan^2 rows for each node of the tree, whose size the sample bounds
    tree.set_ranges([tuple(r) for r in ranges.groupBy("node", "point", "child").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).collect()])
    counts = {r.leaf: r["n"] for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    held = tuple(some[c].to_numpy() for c in ("id", "row", "label")) + (vectors,)
    return Index(placed, sc.broadcast(tree), sc.broadcast(held), counts)


HITS = pa.schema([("cls", pa.int64()), ("window", pa.int64()), ("score", pa.int64()), ("id", pa.int64()), ("row", pa.int64())])
HITS_DDL = "cls long, window long, score long, id long, row long"


def scored(index: Index, visits: DataFrame, same: bool, most: int) -> DataFrame:
    """The first ``most`` rows of each anchor's windows over the leaves it visits.
    ``visits`` has leaf, cls, label, v, low, high (arrays, one entry a window)."""
    visits = cut(visits)
    seen = {r.leaf: r["n"] for r in visits.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    spark = visits.sparkSession
    sizes = [(leaf, -(-n // BLOCK_ROWS), -(-seen[leaf] // BLOCK_ANCHORS)) for leaf, n in index.leaf_rows.items() if leaf in seen]

    def dealt(side: DataFrame, row: str, own: str, other: str) -> DataFrame:
        """A row's own block, beside each block of the other side."""
        known = F.broadcast(spark.createDataFrame(sizes or [(-1, 1, 1)], "leaf int, blocks int, chunks int"))  # a row for each leaf
        parts = {"block": "blocks", "chunk": "chunks"}
        return (side.join(known, "leaf").withColumn(own, F.pmod(F.xxhash64(row), F.col(parts[own])).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(parts[other]) - 1))).drop("blocks", "chunks"))

    key = ["leaf", "block", "chunk"]
    left, right = dealt(index.rows, "row", "block", "chunk"), dealt(visits, "cls", "chunk", "block")

    def meet(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[] for _ in HITS]
        if rows.num_rows and anchors.num_rows:
            id_, row, label = (rows[c].to_numpy() for c in ("id", "row", "label"))
            all_ = products(matrix(anchors["v"]), matrix(rows["v"]))
            low, high = matrix(anchors["low"]), matrix(anchors["high"])
            cls, own = anchors["cls"].to_numpy(), anchors["label"].to_numpy()
            for i, score in enumerate(all_):
                fits = (label == own[i]) == same
                for w in range(low.shape[1]):
                    some = np.flatnonzero(fits & (score >= low[i, w]) & (score <= high[i, w]))
                    if len(some):
                        some = best(score, id_, row, some, most)
                        for c, x in zip(out, (np.full(len(some), cls[i]), np.full(len(some), w), score[some], id_[some], row[some])):
                            c.append(x)
        return pa.Table.from_arrays([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out], schema=HITS)

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, HITS_DDL)
    return first_hits(found, most)


def first_hits(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("cls", "window").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)


def visited(index: Index, anchors: DataFrame, same: bool, most: int, home: bool = False) -> DataFrame:
    """leaf, cls, label, v, low, high: the leaves each anchor must see, its windows
    narrowed by the sample. With ``home`` only the leaf that it lies in itself.
    ``anchors`` has cls, label, v, low, high."""
    fields = anchors.schema
    names = ["leaf", *fields.names]
    tree_, sample_ = index.tree, index.sample

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, (_, _, labels, vectors) = tree_.value, sample_.value
        for b in it:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                a, own = matrix(part.column("v")), part.column("label").to_numpy()
                low, high = matrix(part.column("low")).copy(), matrix(part.column("high"))
                known = products(a, vectors) if len(vectors) else np.zeros((len(a), 0), np.int64)
                for i in range(len(a)):
                    fits = known[i][(labels == own[i]) == same]
                    for w in range(low.shape[1]):
                        inside = fits[(fits >= low[i, w]) & (fits <= high[i, w])]
                        if len(inside) >= most:
                            low[i, w] = np.partition(inside, len(inside) - most)[len(inside) - most]
                cols = {n: part.column(n) for n in fields.names} | {"low": pa.array(low.tolist(), pa.list_(pa.int64()))}
                if home:
                    yield pa.RecordBatch.from_arrays([pa.array(tree.leaf_of(a)), *cols.values()], names=names)
                    continue
                for leaf, rows in tree.visits(a, low, high):
                    rows = pa.array(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), leaf, np.int32)), *(c.take(rows) for c in cols.values())],
                                                     names=names)

    ddl = "leaf int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    return anchors.mapInArrow(run, ddl)


def search(index: Index, anchors: DataFrame, same: bool, most: int) -> DataFrame:
    return scored(index, visited(index, anchors, same, most), same, most)


def mine(df: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None, sample: int = SAMPLE,
         fan: int = FAN, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    for the rows that ``anchor`` marks, negatives that score ``low`` to ``high``
    hundredths of each positive's score."""
    label = F.col("label") if label is None else label
    rows = prepared(df, id_col, vec_col, label, anchor)
    index = build(rows, positives + 1, sample, fan, leaf_rows)
    marked = rows.where("anchor").select("row", "id", "label", "v")
    classes = cut(marked.groupBy("label", "v").agg(F.min("row").alias("cls")).select("cls", "label", "v"))

    # one more than wanted, for an anchor may be among them
    open_ = classes.select("*", F.array(F.lit(FLOOR)).alias("low"), F.array(F.lit(-FLOOR)).alias("high"))
    near = scored(index, visited(index, open_, True, positives + 1, home=True), True, positives + 1)
    bound = near.where(F.col("nth") == positives + 1).select("cls", F.array("score").alias("least"))
    tight = open_.join(bound, "cls", "left").withColumn("low", F.coalesce("least", "low")).drop("least")
    found = cut(search(index, tight, True, positives + 1).select("cls", "score", "id", "row"))

    # one window for each score that a positive of the class has
    ranked = F.sort_array(F.collect_set("score"), asc=False)
    scores = classes.join(found.groupBy("cls").agg(ranked.alias("scores")), "cls")
    slots = F.sequence(F.lit(0), F.lit(positives))

    def window(of) -> Column:
        return F.transform(slots, lambda i: F.coalesce(of(F.get("scores", i)), F.lit(0).cast("long")))

    # a slot without a positive, or with one below 0, has no window: its low end is over its high end
    scores = scores.select(
        "cls", "label", "v", "scores",
        F.transform(slots, lambda i: F.coalesce(F.ceil(F.get("scores", i) * low / 100), F.lit(1).cast("long"))).alias("low"),
        window(lambda s: F.floor(s * high / 100)).alias("high"))
    scores = cut(scores)
    worse = search(index, scores.drop("scores"), False, negatives)
    lists = worse.groupBy("cls", "window").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("negatives"))
    by_score = scores.select("cls", F.posexplode("scores").alias("window", "score")).join(
        lists.withColumn("window", F.col("window").cast("int")), ["cls", "window"]).select("cls", "score", "negatives")
    pairs = found.join(by_score, ["cls", "score"], "left")
    order = F.struct((-F.col("score")).alias("minus"), "id", "row", "negatives")
    answers = pairs.groupBy("cls").agg(F.sort_array(F.collect_list(order)).alias("all")).join(classes, "cls")

    # back to all anchors; a vector that very many share is dealt by salt
    salted = answers.select("label", "v", "all", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    each = marked.withColumn("salt", F.pmod("row", F.lit(SALT)).cast("int")).join(salted, ["label", "v", "salt"])
    own = F.slice(F.filter("all", lambda p: p["row"] != F.col("row")), 1, positives)
    each = each.select(F.col("id").alias("anchor"), F.explode(own).alias("p"))
    each = each.select("anchor", "p.id", (-F.col("p.minus")).alias("positive_score"), F.explode("p.negatives").alias("n"))

    def known(c: str) -> Column:
        return F.when(F.col(c) != NO_ID, F.col(c))

    return each.select(known("anchor").alias("anchor_id"), known("id").alias("positive_id"), F.col("n.nth").cast("int").alias("rank"),
                       known("n.id").alias("negative_id"), "positive_score", F.col("n.score").alias("negative_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows, F.col("vec_id") % 50 == 0, label=label)
