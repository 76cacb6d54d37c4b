"""Approximate nearest neighbours by low-dimensional stable projections, kd-trees and a chi-square stopping test.

Vectors are scaled to length one, where squared distance is 2 - 2 cos, and
projected on m Gaussian directions.  Over the draw of the directions, the squared projected distance of two
vectors is their squared distance times a chi-square variable of m degrees.  So once the k-th best distance found is d, a vector
that is nearer lies with probability p within d^2 * q_p in the projection: the
search takes projected neighbours in ascending order, verifies them on the
original vectors, and stops when the next one fails that test.

The splits of a kd-tree over the projections, fitted on a bounded sample, deal
all vectors into cells, and large cells into blocks; each block has a kd-tree
of its own.  A query first searches a block of its own cell.  The bound from
there says which other cells its ball meets; it goes to those alone, and each
search goes on from that bound.  So the test is the same over all blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparquill.llm.common import stored

LEAF, SALTS, SLACK = 64, 16, 1e-6


def chi_square_quantile(p: float, m: int) -> float:
    """The p-quantile of the chi-square distribution of m degrees, m even; by bisection of the closed form."""
    if m % 2 or m < 2 or not 0 < p < 1:
        raise ValueError("m must be even and p between 0 and 1")
    beyond = lambda x: math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))
    low, high = 0.0, 1.0
    while beyond(high) > 1 - p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if beyond(mid) > 1 - p else (low, mid)
    return high


@cache
def directions(dim: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, m))


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows, those of extreme size by a power of two nearer to one, and their lengths; such a power changes no cosine."""
    top = np.abs(x).max(1)
    odd = (top < 1e-100) | (top > 1e100)
    if odd.any():
        x = x.copy()
        x[odd] = np.ldexp(x[odd], -np.frexp(top[odd])[1][:, None])
    return x, np.sqrt((x * x).sum(1))


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, dim) of the vectors that take part; a row that repeats both id and vector is one."""
    v = F.col("v")
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
        .where(F.col("id").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
        .select("id", "v", F.size(v).alias("dim"))
    )


# -- the index --------------------------------------------------------------


def split(z: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Axes and cuts of a complete kd-tree, in heap order: the median of the widest axis."""
    axes, cuts, parts = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1), [z]
    for node in range(len(axes)):
        part = parts[node]
        if len(part):
            axes[node] = np.argmax(part.max(0) - part.min(0))
            cuts[node] = np.median(part[:, axes[node]])
        right = part[:, axes[node]] > cuts[node]
        parts += [part[~right], part[right]]
    return axes, cuts


def leaf_of(z: np.ndarray, tree: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    axes, cuts = tree
    node, rows = np.zeros(len(z), np.int64), np.arange(len(z))
    for _ in range(len(axes).bit_length()):
        node = 2 * node + 1 + (z[rows, axes[node]] > cuts[node])
    return node - len(axes)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def placed(rows: DataFrame, trees: dict[int, tuple], m: int, seed: int) -> DataFrame:
    """rows (id, v, dim) with cell and projection z."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                at = batch.filter(pa.array(dims == dim))
                x, length = scaled(_vectors(at.column(1), dim))
                z = (x / length[:, None]) @ directions(dim, m, seed)
                cell = leaf_of(z, trees[dim]) if dim in trees else np.zeros(len(z), np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * m), pa.array(z.ravel()))
                yield pa.RecordBatch.from_arrays([*at.columns, pa.array(cell), lists], ["id", "v", "dim", "cell", "z"])

    return rows.select("id", "v", "dim").mapInArrow(place, "id long, v array<double>, dim int, cell long, z array<double>")


class Block:
    """The vectors of a block under a kd-tree over their projections."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, z: np.ndarray):
        depth = max(0, math.ceil(math.log2(max(1, len(z) / LEAF))))
        leaf = leaf_of(z, split(z, depth)) if depth else np.zeros(len(z), np.int64)
        order = np.argsort(leaf, kind="stable")
        x, self.length = scaled(x[order])
        self.ids, self.x, self.z = ids[order], x, z[order]
        full = np.unique(leaf)
        self.start = np.searchsorted(leaf[order], full)
        self.end = np.append(self.start[1:], len(z))
        self.low, self.high = np.minimum.reduceat(self.z, self.start), np.maximum.reduceat(self.z, self.start)

    def search(self, q: np.ndarray, zq: np.ndarray, k: int, quantile: float, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines) of the k best, by projected neighbours until the test holds; bound: a squared distance known to hold k."""
        gap = np.maximum(np.maximum(self.low - zq, zq - self.high), 0)
        near = (gap * gap).sum(1)
        order, at, take, length = np.argsort(near, kind="stable"), 0, 1, np.sqrt((q * q).sum())
        ids, cosines = np.empty(0, np.int64), np.empty(0)
        while at < len(order) and near[order[at]] <= quantile * bound + SLACK:
            leaves = order[at : at + take]
            at, take = at + take, 2 * take
            rows = np.concatenate([np.arange(self.start[b], self.end[b]) for b in leaves])
            rows = rows[((self.z[rows] - zq) ** 2).sum(1) <= quantile * bound + SLACK]
            got = (self.x[rows] * q).sum(1) / (self.length[rows] * length)
            ids, cosines = np.concatenate([ids, self.ids[rows]]), np.concatenate([cosines, got])
            best = np.lexsort((ids, -cosines))[:k]
            ids, cosines = ids[best], cosines[best]
            if len(ids) == k:
                bound = min(bound, max(0.0, 2 - 2 * cosines[-1]))
        return ids, cosines


_FOUND = ["query", "id", "score"]


def searched(index: DataFrame, queries: DataFrame, k: int, quantile: float) -> DataFrame:
    """(query, id, score): the k best of each block for each of its queries; both sides have dim, cell, block, chunk."""
    by = ["dim", "cell", "block", "chunk"]

    def meet(block: pa.Table, asked: pa.Table) -> pa.Table:
        out = [(np.empty(0, np.int64),) * 2 + (np.empty(0),)]
        if block.num_rows and asked.num_rows:
            dim, m = block.column("dim")[0].as_py(), len(block.column("z")[0])
            rows = lambda t, name, n: _vectors(t.column(name).combine_chunks(), n)
            tree = Block(block.column("id").to_numpy(), rows(block, "v", dim), rows(block, "z", m))
            x, z, bound = scaled(rows(asked, "v", dim))[0], rows(asked, "z", m), asked.column("bound").to_numpy()
            for i, query in enumerate(asked.column("query").to_numpy()):
                ids, cosines = tree.search(x[i], z[i], k, quantile, bound[i])
                out.append((np.full(len(ids), query), ids, cosines))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], names=_FOUND)

    sides = [index.select(*by, "id", "v", "z").groupBy(*by), queries.select(*by, "query", "v", "z", "bound").groupBy(*by)]
    return sides[0].cogroup(sides[1]).applyInArrow(meet, "query long, id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query: the candidates of a query are at most k a block."""
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _small(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, schema))


def nearest(
    vectors: DataFrame, is_query: Column, *, k: int = 5, m: int = 12, certainty: float = 0.99, sample_rows: int = 20_000, cell_rows: int = 2_048, query_rows: int = 4_096, seed: int = 1,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """The k rows nearest by cosine to each row for which is_query (over `id`) holds: query_id, rank, vec_id, score.

    A candidate that belongs to the result is missed with a probability of at
    most 1 - certainty.  Every row is indexed; sample_rows bounds the expected
    sample that the splits are fitted on, and so the number of cells (a
    sixteenth of it).  Scores are exact, ties go to smaller ids.

    Vectors null, empty, zero, or holding null or non-finite components and
    rows without id take no part.  A query's own rows are those of its id.
    Rows that repeat id and vector count once; an id with several vectors is
    as many candidates, and as many queries.  Vectors meet only vectors
    of their own length.  Of identical vectors only the k + 1 smallest ids
    can be in a result, so the index holds no more.  Tasks hold a block and
    query_rows queries; the driver holds the sample's projections and a box a cell.
    """
    spark, wide = vectors.sparkSession, k + 1
    quantile = chi_square_quantile(certainty, m)
    rows = usable(vectors, id_col, vec_col)
    alike = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    points = rows.distinct().withColumn("nth", alike).where(F.col("nth") <= wide).drop("nth")
    points = stored(points)

    # splits, fitted on a sample chosen by a hash of the ids
    sizes = {r.dim: r["count"] for r in points.groupBy("dim").count().collect()}
    share = min(1.0, sample_rows / max(1, sum(sizes.values())))
    drawn = F.shiftrightunsigned(F.xxhash64("id", F.lit(seed)), 1) <= min(int(share * 2.0**63), (1 << 63) - 1)
    sample: dict[int, list] = {}
    for r in placed(points.where(drawn), {}, m, seed).select("dim", "z").collect():
        sample.setdefault(r.dim, []).append(r.z)
    trees = {}
    for dim, z in sample.items():
        depth = min(math.ceil(math.log2(max(1, sizes[dim] / cell_rows))), int(math.log2(max(1, len(z) / 16))))
        if depth > 0:
            trees[dim] = split(np.array(z), depth)
    index = stored(placed(points, trees, m, seed))
    low, high = ([f(F.col("z")[i]).alias(f"{name}{i}") for i in range(m)] for f, name in ((F.min, "low"), (F.max, "high")))
    cells = index.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.array(*low).alias("low"), F.array(*high).alias("high")).collect()
    blocks = {(r.dim, r.cell): -(-r.n // cell_rows) for r in cells}
    boxes = {d: (np.array([r.cell for r in cells if r.dim == d]), np.array([[r.low, r.high] for r in cells if r.dim == d])) for d in sizes}

    # one search for all queries with the same vector
    asked = rows.where(is_query)
    classes = stored(placed(asked.groupBy("v", "dim").agg(F.min("id").alias("id")), trees, m, seed).withColumnRenamed("id", "query").withColumn("key", F.xxhash64("v", "query")))
    by_block = lambda df, key, n: df.withColumn("block", F.pmod(F.xxhash64(key), n))

    def dealt(queries: DataFrame) -> DataFrame:
        """The blocks' answers to queries (dim, cell, block, ...), a chunk of the queries at a time."""
        counts = {(r.dim, r.cell): r["count"] for r in queries.groupBy("dim", "cell").count().collect()}
        sized = _small(spark, [(*at, n, -(-counts.get(at, 1) // query_rows)) for at, n in blocks.items()], "dim int, cell long, blocks int, chunks int")
        each = by_block(index.join(sized, ["dim", "cell"]), "id", F.col("blocks")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        chunked = queries.join(sized, ["dim", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("key", F.lit("chunk")), "chunks").cast("int"))
        return searched(each, chunked, wide, quantile)

    # a search key, not the id, names a query: an id may have several vectors
    keyed = classes.select("dim", "cell", F.col("key").alias("query"), "key", "v", "z")
    home_blocks = _small(spark, [(*at, n) for at, n in blocks.items()], "dim int, cell long, n int")
    home = by_block(keyed.join(home_blocks, ["dim", "cell"], "left").fillna(1, ["n"]), F.struct("key", F.lit("home")), F.col("n")).withColumn("bound", F.lit(float("inf")))
    first = stored(dealt(home))
    bound = first.groupBy("query").agg(F.when(F.count("*") >= wide, F.greatest(F.lit(0.0), 2 - 2 * F.min("score"))).otherwise(F.lit(float("inf"))).alias("bound"))
    open_ = home.drop("bound", "n").withColumnRenamed("cell", "home_cell").withColumnRenamed("block", "home_block").join(bound, "query", "left").fillna(float("inf"), ["bound"])
    names = ["query", "key", "dim", "home_cell", "home_block", "v", "z", "bound"]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, bounds = batch.column(2).to_numpy(), batch.column(7).to_numpy()
            for at in range(batch.num_rows):
                cell, box = boxes[int(dims[at])]
                z = np.array(batch.column(6)[at].as_py())
                gap = np.maximum(np.maximum(box[:, 0] - z, z - box[:, 1]), 0)
                met = cell[(gap * gap).sum(1) <= quantile * bounds[at] + SLACK]
                row = batch.slice(at, 1).take(pa.array(np.zeros(len(met), np.int64)))
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array(met)], [*names, "cell"])

    kinds = "query long, key long, dim int, home_cell long, home_block long, v array<double>, z array<double>, bound double, cell long"
    routed = open_.select(*names).mapInArrow(route, kinds).join(home_blocks, ["dim", "cell"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1)))
    rest = dealt(routed.where("cell != home_cell or block != home_block"))
    best = _best(first.unionByName(rest), wide)
    lists = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("found"))  # k + 1 each

    # back to every query, its own rows left out
    salted = classes.join(lists, classes["key"] == lists["query"]).select("v", "found", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    members = asked.distinct().withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    answers = members.join(salted, ["v", "salt"]).select(F.col("id").alias("query_id"), F.expr(f"slice(filter(found, x -> x.id != id), 1, {k})").alias("found"))
    return answers.select("query_id", F.posexplode("found").alias("at", "x")).select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
