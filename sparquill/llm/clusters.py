"""Centroid clustering with Drake's adaptive bounds, exact in integers.

Each vector keeps lower bounds of its distances to its several nearest other
centroids, and one remainder bound for all the rest.  When centroids move, the
bounds sink by the moves.  A vector stays where it is while its own, exact
distance is below all bounds; otherwise only the stored centroids whose bounds
are not above it are measured, and all centroids only if the remainder cannot
certify the order.  The number of stored bounds shrinks to what a round needed.

Distances are exact integers, so ties are ties; bounds are rounded outwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import remove, scratch

LARGEST = 1 << 27  # of a component; squared distances then fit a long
_UP, _DOWN = 1 + 1e-9, 1 - 1e-9  # how bounds are rounded


def usable(vec: Column, dim: int) -> Column:
    """Whether a vector has `dim` components, none null or non-finite."""
    return (F.size(vec) == dim) & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def to_integers(flat: np.ndarray, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, as rows of dim."""
    out = np.floor(scale * flat.astype(np.float64))
    if out.size and np.abs(out).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} after scaling; its squared distances may not fit a long")
    return out.astype(np.int64).reshape(-1, dim)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows and centroids; in floats where they hold all sums exactly."""
    large = max((int(np.abs(x).max()) for x in (v, c) if x.size), default=0)
    kind = np.float64 if large * large * 8 * v.shape[1] < 1 << 53 else np.int64
    a, b = v.astype(kind), c.astype(kind)
    return ((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)).astype(np.int64)


def scan(v: np.ndarray, c: np.ndarray, bounds: int) -> tuple[np.ndarray, ...]:
    """All centroids measured: cluster, squared distance, ids and lower bounds of the nearest others, remainder bound."""
    d2 = squared(v, c)
    order = np.argsort(d2, axis=1, kind="stable")  # ties: smaller number
    lows = np.sqrt(np.take_along_axis(d2, order, 1)) * _DOWN
    rest = lows[:, bounds + 1] if bounds + 1 < len(c) else np.full(len(v), np.inf)
    return order[:, 0], d2[np.arange(len(v)), order[:, 0]], order[:, 1 : bounds + 1], lows[:, 1 : bounds + 1], rest


def step(v: np.ndarray, c: np.ndarray, moves: np.ndarray, cluster, ids, lows, rest) -> tuple[np.ndarray, ...]:
    """After the centroids moved: cluster, squared distance, ids, lows, rest, and the depth of bounds that each row needed."""
    n, bounds = ids.shape
    lows, rest, cluster, ids = lows - moves[ids], rest - moves.max(), cluster.copy(), ids.copy()
    d2 = ((v - c[cluster]) ** 2).sum(1)
    own = np.sqrt(d2) * _UP
    doubt = lows <= own[:, None]
    depth = doubt.sum(1)
    row, slot = np.nonzero(doubt)
    if len(row):
        met = np.full((n, bounds), np.iinfo(np.int64).max)
        met[row, slot] = ((v[row] - c[ids[row, slot]]) ** 2).sum(1)
        lows[row, slot] = np.sqrt(met[row, slot]) * _DOWN
        for j in range(bounds):  # the best of the measured takes the row's place, which is left to the former
            better = (met[:, j] < d2) | ((met[:, j] == d2) & (ids[:, j] < cluster))
            at = np.flatnonzero(better)
            lows[at, j] = np.sqrt(d2[at]) * _DOWN
            cluster[at], ids[at, j] = ids[at, j], cluster[at]
            d2[at], met[at, j] = met[at, j], d2[at]
        sort = np.argsort(lows, axis=1, kind="stable")
        ids, lows = np.take_along_axis(ids, sort, 1), np.take_along_axis(lows, sort, 1)
    lost = np.flatnonzero(np.sqrt(d2) * _UP >= rest)
    if len(lost):
        cluster[lost], d2[lost], ids[lost], lows[lost], rest[lost] = scan(v[lost], c, bounds)
        depth[lost] = bounds
    return cluster, d2, ids, lows, rest, depth


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel(), kind))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


_STATE = ["vec_id", "v", "cluster", "distance", "ids", "lows", "rest", "depth"]
_SCHEMA = "vec_id long, v array<int>, cluster int, distance long, ids array<int>, lows array<double>, rest double, depth int"


def _state(vec_id, v, cluster, d2, ids, lows, rest, depth) -> pa.RecordBatch:
    columns = [vec_id, _lists(v, pa.int32()), pa.array(cluster, pa.int32()), pa.array(d2, pa.int64()), _lists(ids, pa.int32()), _lists(lows, pa.float64()), pa.array(rest), pa.array(depth, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, _STATE)


def kmeans(
    vectors: DataFrame, *, k: int = 16, rounds: int = 3, bounds: int = 4, dim: int = 64, scale: int = 64, seed: str = "1", id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """Per usable vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Centroids start as the k vectors with the smallest SHA-256 of `seed:id`
    (fewer if there are fewer vectors; rows without id never start one, unless
    none has an id: then nothing can start and the result is empty).  Vectors
    that are null, of another length, or hold null or non-finite components
    are left out; repeated rows count each.  Where a component is beyond 2^27
    after scaling, distances may not fit a long, and the job says so.

    The state of a round (integers and bounds) is a table in the shared
    folder, read by the next round and then removed; what reaches the driver
    is a row of sums per cluster.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec")).where(usable(F.col("vec"), dim))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = kept.where("vec_id is not null").orderBy(order, "vec").limit(k).collect()
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not starts:
        return spark.createDataFrame([], result)
    now = to_integers(np.array([r.vec for r in starts], np.float64), dim, scale)
    k, width = len(now), min(bounds, len(now) - 1)

    def first(batches: Iterator[pa.RecordBatch], c: np.ndarray = now, width: int = width) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = to_integers(batch.column(1).flatten().to_numpy(zero_copy_only=False), dim, scale)
            yield _state(batch.column(0), v, *scan(v, c, width), np.full(len(v), width))

    def again(c: np.ndarray, moves: np.ndarray, stored: int, width: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = {name: batch.column(i) for i, name in enumerate(_STATE)}
                v, ids, lows = _matrix(at["v"], dim).astype(np.int64), _matrix(at["ids"], stored), _matrix(at["lows"], stored)
                rest = at["rest"].to_numpy()
                if width < stored:  # fewer bounds are kept: the first that goes bounds the rest
                    rest, ids, lows = np.minimum(rest, lows[:, width]), ids[:, :width], lows[:, :width]
                yield _state(at["vec_id"], v, *step(v, c, moves, at["cluster"].to_numpy(), ids, lows, rest))

        return run

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch(spark, "clusters")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    state, path = written(kept.mapInArrow(first, _SCHEMA))
    for _ in range(rounds):
        sums = state.groupBy("cluster").agg(F.count("*").alias("n"), F.max("depth").alias("depth"), *(F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dim))).collect()
        before, now, stored = now, now.copy(), width
        for r in sums:
            now[r.cluster] = [r[f"s{i}"] // r.n for i in range(dim)]
        moves = np.sqrt(np.einsum("ij,ij->i", now - before, now - before)) * _UP
        width = min(width, max(1, k // 8, *(r.depth for r in sums))) if width else 0
        state, old = state.mapInArrow(again(now, moves, stored, width), _SCHEMA), path
        state, path = written(state)
        remove(spark, old)
    spread = {r.cluster: r.d for r in state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    nth = F.col("cluster") + 1
    return state.select(
        "vec_id", "cluster", "distance",
        F.element_at(F.array(*(F.lit(spread.get(i, 0)).cast("long") for i in range(k))), nth).alias("cluster_inertia"),
        F.lit(sum(spread.values())).cast("long").alias("inertia"),
        F.element_at(F.array(*map(F.lit, prints)), nth).alias("centroid_sha256"),
    )
