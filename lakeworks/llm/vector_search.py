"""Operator 8: nearest neighbours by stable projections and kd-trees.

The largest inner product is turned into a nearest-neighbour problem (one more
coordinate gives all vectors the same length), and every vector is projected
on ``dims`` Gaussian directions. For a vector at true distance d, its squared
projected distance over d^2 follows a chi-square law with ``dims`` degrees of
freedom, whatever the data. The projections are indexed by a kd-tree: its upper
levels, fitted on a bounded sample, split all vectors into cells, and each cell
has a tree of its own. A query reads projected neighbours in increasing order,
leaf after leaf, and verifies them on the original vectors; it stops when the
chi-square test says that a vector nearer than its k-th best would have shown
up by now with probability ``sure``. It does so in its home cell first; its
k-th distance there then decides which other cells can't be ruled out.

Every row is indexed. Equal vectors are indexed once with their k+1 smallest
ids, which is all that k results can need, and equal queries are searched once.
Vectors that are null, zero or hold null or non-finite components take no
part, nor do vectors whose length isn't the most frequent one (ties: the
longer). Null ids take no part. Without queries or candidates there are no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, cut, ship, table

K, DIMS, SURE = 20, 8, 0.95
CELL_ROWS, LEAF_ROWS, SAMPLE_ROWS = 8192, 64, 20_000
QUERY_BLOCK = 16_384


def chi_square_quantile(p: float, dof: int) -> float:
    """For an even number of degrees of freedom the law is a finite sum."""
    def cdf(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dof // 2))
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


class Projection:
    """From original vectors to projected ones; the same on every executor."""

    def __init__(self, length: int, norm: float, dims: int = DIMS, seed: int = 11):
        self.norm = norm
        self.directions = np.random.default_rng(seed).standard_normal((length + 1, dims))

    def candidates(self, v: np.ndarray) -> np.ndarray:
        scaled = v / self.norm
        rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))
        return scaled @ self.directions[:-1] + rest[:, None] * self.directions[-1]

    def queries(self, v: np.ndarray) -> np.ndarray:
        return (v / np.sqrt((v * v).sum(axis=1))[:, None]) @ self.directions[:-1]


def split_order(points: np.ndarray, leaf_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Median splits down to leaves: the order of points leaf by leaf, and where leaves begin."""
    order, starts, todo = [], [], [np.arange(len(points))]
    at = 0
    while todo:
        some = todo.pop()
        if len(some) <= leaf_rows:
            order.append(some)
            starts.append(at)
            at += len(some)
            continue
        axis = int(np.argmax(np.ptp(points[some], axis=0)))
        half = len(some) // 2
        some = some[np.argpartition(points[some, axis], half)]
        todo += [some[half:], some[:half]]
    return np.concatenate(order), np.asarray(starts)


class Cells:
    """The upper levels of the kd-tree: boxes that cover the whole projected space."""

    def __init__(self, sample: np.ndarray, count: int):
        dims = sample.shape[1]
        self.nodes: list[tuple[int, float, int, int]] = []  # axis, value, low child, high child; leaves are ~cell
        self.low, self.high = [], []
        self._grow(sample, count, np.full(dims, -np.inf), np.full(dims, np.inf))
        self.low, self.high = np.asarray(self.low), np.asarray(self.high)

    def _grow(self, points: np.ndarray, count: int, low: np.ndarray, high: np.ndarray) -> int:
        axis = int(np.argmax(np.ptp(points, axis=0))) if len(points) else 0
        if count <= 1 or len(points) < 2 or np.ptp(points[:, axis]) == 0:
            self.low.append(low)
            self.high.append(high)
            return ~(len(self.low) - 1)
        share = count // 2
        value = float(np.quantile(points[:, axis], share / count))
        under = points[:, axis] < value
        here = len(self.nodes)
        self.nodes.append((0, 0.0, 0, 0))
        top, bottom = high.copy(), low.copy()
        top[axis] = bottom[axis] = value
        self.nodes[here] = (axis, value, self._grow(points[under], share, low, top),
                            self._grow(points[~under], count - share, bottom, high))
        return here

    def home(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        todo = [(0 if self.nodes else ~0, np.arange(len(points)))]
        while todo:
            node, some = todo.pop()
            if node < 0:
                out[some] = ~node
                continue
            axis, value, a, b = self.nodes[node]
            under = points[some, axis] < value
            todo += [(a, some[under]), (b, some[~under])]
        return out

    def squared_distance(self, point: np.ndarray) -> np.ndarray:
        """To every cell's box."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return (gap * gap).sum(axis=1)


class CellIndex:
    """All vectors of one cell with a kd-tree over their projections."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]], projection: Projection):
        projected = projection.candidates(vectors)
        order, starts = split_order(projected, LEAF_ROWS)
        self.vectors, self.ids, self.projected = vectors[order], [ids[i] for i in order], projected[order]
        self.first = np.append(starts, len(order))
        self.low = np.minimum.reduceat(self.projected, starts, axis=0)
        self.high = np.maximum.reduceat(self.projected, starts, axis=0)
        self.norm = projection.norm

    def search(self, q: np.ndarray, point: np.ndarray, reach: float, k: int, quantile: float) -> list[tuple[float, int]]:
        """(score, vec_id) of the best k found, ties to smaller ids. ``reach`` is
        the squared distance of the k-th best known so far."""
        length = math.sqrt(float(q @ q))
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        bound = (gap * gap).sum(axis=1)
        leaves = np.argsort(bound, kind="stable")
        scores, rows = np.zeros(0), np.zeros(0, np.int64)
        at, step = 0, 2
        while at < len(leaves) and bound[leaves[at]] <= quantile * reach:
            part = leaves[at:at + step]
            some = np.concatenate([np.arange(self.first[i], self.first[i + 1]) for i in part])
            away = self.projected[some] - point
            some = some[(away * away).sum(axis=1) <= quantile * reach]
            scores = np.append(scores, (self.vectors[some] * q).sum(axis=1))
            rows = np.append(rows, some)
            if len(scores) > k:
                worst = -np.partition(-scores, k - 1)[k - 1]
                best = scores >= worst  # ties stay
                scores, rows = scores[best], rows[best]
                # squared distance between unit vectors from the inner product
                reach = min(reach, max(0.0, 2 - 2 * float(worst) / (length * self.norm)) + 1e-12)
            at, step = at + step, 2 * step
        found = sorted((-s, i) for s, r in zip(scores.tolist(), rows.tolist()) for i in self.ids[r])
        return [(-s, i) for s, i in found[:k]]


def _vectors(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f4").reshape(len(column), -1).astype(np.float64)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """vec (packed floats), ids (the k smallest of each distinct vector). Copies
    are cut to k per vector and task before the shuffle."""
    first = Window.partitionBy("embedding").orderBy("vec_id")
    return (rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k)
            .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))


def usable(table_: DataFrame) -> DataFrame:
    """vec_id, embedding array<float> of the rows that take part."""
    rows = table_.select(F.col("vec_id").cast("long").alias("vec_id"),
                         F.col("embedding").cast("array<float>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where("vec_id is not null and embedding is not null").where(~bad)
    rows = rows.where(F.exists("embedding", lambda x: x != 0))
    usual = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1)
    return rows.join(F.broadcast(usual.select("n")), F.size("embedding") == F.col("n"), "left_semi")


def _packed(df: DataFrame, extra: str) -> DataFrame:
    """Arrays as packed floats, so that cells and queries travel as bytes."""
    schema = pa.schema([("vec", pa.binary()), ("ids", pa.list_(pa.int64()))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            vec = [np.asarray(v, "<f4").tobytes() for v in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(vec, pa.binary()), b.column(1).cast(pa.list_(pa.int64()))],
                                             schema=schema)
    return df.select("embedding", extra).mapInArrow(run, "vec binary, ids array<long>")


def search(table_: DataFrame, is_query, k: int = K, sure: float = SURE, dims: int = DIMS,
           cell_rows: int = CELL_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every row for which the
    condition ``is_query`` holds, among all rows but the query's own."""
    spark = table_.sparkSession
    ship(spark)
    rows = usable(table_)
    base = cut(_packed(distinct_vectors(rows, k + 1), "ids"))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    stats = _stats(base)
    if stats is None:
        return empty
    count, length, norm, sample = stats
    projection = Projection(length, norm, dims)
    cells = Cells(projection.candidates(_vectors(sample)), max(1, -(-count // cell_rows)))
    quantile = chi_square_quantile(sure, dims)
    shared = spark.sparkContext.broadcast((projection, cells))  # a few hundred bytes for each cell of vectors

    index = cut(_to_cells(base, shared))
    asked = rows.where(is_query)
    queries = cut(_packed(distinct_vectors(asked, 1), "ids").select("vec", F.col("ids")[0].alias("q")))
    home = _visits(queries.withColumn("reach", F.lit(float("inf"))), shared, quantile, home=True)
    found = cut(_search_cells(index, home, shared, k + 1, quantile))
    reach = found.groupBy("q").agg(F.min("reach").alias("reach"))
    others = _visits(queries.join(reach, "q").select("vec", "q", "reach"), shared, quantile, home=False)
    found = found.unionByName(_search_cells(index, others, shared, k + 1, quantile))

    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    top = found.select("q", F.explode("hits").alias("h")).select("q", "h.score", "h.vec_id")
    top = top.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
    lists = top.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("top"))
    # back to all query rows of the same vector, each without itself
    same = asked.select("vec_id", F.col("embedding").alias("e")).join(
        distinct_vectors(asked, 1).select(F.col("embedding").alias("e"), F.col("ids")[0].alias("q")), "e")
    each = same.select(F.col("vec_id").alias("query_id"), "q").join(lists, "q")
    kept = F.slice(F.filter("top", lambda x: x.vec_id != F.col("query_id")), 1, k)
    return each.select("query_id", F.posexplode(kept).alias("rank0", "x")).select(
        "query_id", (F.col("rank0") + 1).alias("rank"), "x.vec_id", "x.score")


def _stats(base: DataFrame) -> tuple[int, int, float, list[bytes]] | None:
    """Number of distinct vectors, their length, the largest norm and a bounded sample."""
    schema = pa.schema([("norm", pa.float64()), ("n", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norm, n = 0.0, 0
        for b in it:
            if b.num_rows:
                v = _vectors(b.column(0).to_pylist())
                norm, n = max(norm, float(np.sqrt((v * v).sum(axis=1)).max())), n + len(v)
        yield pa.RecordBatch.from_pylist([{"norm": norm, "n": n}], schema=schema)

    got = base.mapInArrow(run, "norm double, n long").agg(F.max("norm").alias("norm"), F.sum("n").alias("n")).first()
    if not got.n:
        return None
    sample = [bytes(r.vec) for r in base.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE_ROWS).collect()]
    return got.n, len(sample[0]) // 4, got.norm, sample


def _to_cells(base: DataFrame, shared) -> DataFrame:
    schema = pa.schema([("cell", pa.int64()), ("vec", pa.binary()), ("ids", pa.list_(pa.int64()))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projection, cells = shared.value
        for b in it:
            if b.num_rows:
                home = cells.home(projection.candidates(_vectors(b.column(0).to_pylist())))
                yield pa.RecordBatch.from_arrays([pa.array(home, pa.int64()), b.column(0).cast(pa.binary()),
                                                  b.column(1).cast(pa.list_(pa.int64()))], schema=schema)
    return base.mapInArrow(run, "cell long, vec binary, ids array<long>")


def _visits(queries: DataFrame, shared, quantile: float, home: bool) -> DataFrame:
    """(cell, q, vec, reach): the home cell, or all other cells that the test can't rule out."""
    schema = pa.schema([("cell", pa.int64()), ("q", pa.int64()), ("vec", pa.binary()), ("reach", pa.float64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        projection, cells = shared.value
        for b in it:
            if not b.num_rows:
                continue
            vec, q, reach = (c.to_pylist() for c in b.columns)
            points = projection.queries(_vectors(vec))
            own = cells.home(points).tolist()
            for i, point in enumerate(points):
                if home:
                    yield own[i], q[i], vec[i], reach[i]
                    continue
                near = np.flatnonzero(cells.squared_distance(point) <= quantile * reach[i])
                for c in near.tolist():
                    if c != own[i]:
                        yield c, q[i], vec[i], reach[i]

    return queries.select("vec", "q", "reach").mapInArrow(
        lambda it: batches(run(it), schema), "cell long, q long, vec binary, reach double")


def _search_cells(index: DataFrame, visits: DataFrame, shared, k: int, quantile: float) -> DataFrame:
    """(q, reach, hits) per visit. Cells and their visitors meet in one sorted
    stream, the cell's vectors first; a cell with many visitors is handed to
    several tasks, each with a block of the visitors."""
    visits = visits.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(1 << 30)))
    load_ = visits.groupBy("cell").agg((F.expr(f"cast(count(*) div {QUERY_BLOCK} as int)") + 1).alias("blocks"))
    visits = visits.join(load_, "cell").select(
        "cell", (F.col("block") % F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("kind"), "vec",
        F.array("q").alias("ids"), "reach")
    held = index.join(load_, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("kind"), "vec",
        "ids", F.lit(0.0).alias("reach"))
    both = held.unionByName(visits).repartition("cell", "block").sortWithinPartitions("cell", "block", "kind")
    hit = pa.struct([("score", pa.float64()), ("vec_id", pa.int64())])
    schema = pa.schema([("q", pa.int64()), ("reach", pa.float64()), ("hits", pa.list_(hit))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        projection, _ = shared.value
        key, vecs, ids, tree = None, [], [], None
        for b in it:
            for cell, block, kind, vec, own, reach in zip(*(c.to_pylist() for c in b.columns)):
                if (cell, block) != key:
                    key, vecs, ids, tree = (cell, block), [], [], None
                if kind == 0:
                    vecs.append(vec)
                    ids.append(own)
                    continue
                if tree is None:
                    tree = CellIndex(_vectors(vecs), ids, projection) if vecs else ()
                hits = []
                if tree:
                    q = _vectors([vec])
                    hits = tree.search(q[0], projection.queries(q)[0], reach, k, quantile)
                    if len(hits) >= k:
                        reach = min(reach, max(0.0, 2 - 2 * hits[-1][0] / (math.sqrt(float((q * q).sum())) * projection.norm)) + 1e-12)
                yield own[0], reach, [{"score": s, "vec_id": i} for s, i in hits]

    return both.mapInArrow(lambda it: batches(run(it), schema, 512),
                           "q long, reach double, hits array<struct<score:double,vec_id:long>>")


def query(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
