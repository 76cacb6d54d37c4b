"""Ordered-state operators: carrying forward, replay, bands, components, range and nearest joins."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.functions.geometry import overlaps, rect
from sparquill.stages import stored


def _upto(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def carry_forward(df: DataFrame, value: str, keys: list[str], order: list[str], into: str) -> DataFrame:
    """The last non-null value up to each row."""
    return df.withColumn(into, F.last(value, ignorenulls=True).over(_upto(keys, order)))


def running_sum(df: DataFrame, value: str, keys: list[str], order: list[str], into: str) -> DataFrame:
    return df.withColumn(into, F.sum(value).over(_upto(keys, order)))


def replay(df: DataFrame, absolute: Column, value: str, keys: list[str], order: list[str]) -> DataFrame:
    """epoch and state: an absolute row sets the state, the others add to it."""
    with_epoch = running_sum(df.withColumn("_set", F.when(absolute, 1).otherwise(0)), "_set", keys, order, "epoch")
    return running_sum(with_epoch, value, [*keys, "epoch"], order, "state").drop("_set")


def tolerance_distinct(values: Column, tolerance: float) -> Column:
    """Values of an array that are not within the tolerance of an earlier kept one."""
    keep = lambda acc, x: F.when(F.exists(acc, lambda y: F.abs(y - x) < tolerance), acc).otherwise(F.array_append(acc, x))
    return F.aggregate(values, F.slice(values, 1, 0), keep)


def band_index(bands: Column, x: Column) -> Column:
    """Zero-based index of the first inclusive band struct(lo, hi) that holds x; one past the last if none does."""
    at = F.array_position(F.transform(bands, lambda b: x.between(b["lo"], b["hi"])), F.lit(True)).cast("int")
    return F.when(at > 0, at - 1).otherwise(F.size(bands))


def bands_between(bounds: Column) -> Column:
    """Bands struct(lo, hi) between neighbouring bounds of a sorted array, ascending or descending."""
    pair = lambda i: F.struct(F.least(F.get(bounds, i), F.get(bounds, i + 1)).alias("lo"), F.greatest(F.get(bounds, i), F.get(bounds, i + 1)).alias("hi"))
    return F.transform(F.filter(F.sequence(F.lit(0), F.size(bounds)), lambda i: i < F.size(bounds) - 1), pair)


def anchor_index(anchors: Column, x: Column, tolerance: float) -> Column:
    """Zero-based index of the first anchor within the tolerance of x; 0 if none is."""
    at = F.array_position(F.transform(anchors, lambda a: F.abs(a - x) < tolerance), F.lit(True)).cast("int")
    return F.greatest(at - 1, F.lit(0))


def overlapping(boxes: DataFrame, key: str, number: str) -> DataFrame:
    """Pairs i < j of boxes of the same key that overlap or touch."""
    side = lambda name, prefix: boxes.select(F.col(key), F.col(number).alias(name), *(c.alias(f"{prefix}{n}") for n, c in zip(("x0", "y0", "x1", "y1"), rect())))
    return side("i", "a_").join(side("j", "b_"), key).where(F.expr("i < j") & overlaps(rect("a_"), rect("b_")))


def _components(n: list, x0: list, y0: list, x1: list, y1: list) -> list:
    """The smallest number of each box's group: a sweep from left to right.

    What is open is kept as disjoint pieces of the y axis, each with a group
    and the right edge up to which it is covered.  A box joins the groups of
    the pieces that it meets and takes over those that end no later than it,
    so that boxes that lie over each other do not pile up.
    """
    parent = list(range(len(n)))

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    lows: list = []
    highs: list = []
    held: list = []  # (a box of the group, right edge)
    for j in sorted(parent, key=x0.__getitem__):
        low, high, left, right = y0[j], y1[j], x0[j], x1[j]
        first, last = bisect_left(highs, low), bisect_right(lows, high)
        pieces: list[list] = []

        def add(start, end, owner, pieces=pieces):
            if pieces and pieces[-1][2] == owner and pieces[-1][1] == start:
                pieces[-1][1] = end
            else:
                pieces.append([start, end, owner])

        at, met, tail = low, False, None  # j covers from `at` on, up to the next piece that outlasts it
        for k in range(first, last):
            a, b, (i, until) = lows[k], highs[k], held[k]
            if until < left:
                continue
            parent[root(i)] = root(j)
            if a < low:
                add(a, low, (i, until))
            if until > right:
                if max(a, low) > at:
                    add(at, max(a, low), (j, right))
                add(max(a, low), min(b, high), (i, until))
                at, met = min(b, high), True
            if b > high:
                tail = (high, b, (i, until))
        if at < high or not met:
            add(at, high, (j, right))
        if tail:
            add(*tail)
        lows[first:last], highs[first:last], held[first:last] = [x[0] for x in pieces], [x[1] for x in pieces], [x[2] for x in pieces]
    least: dict[int, int] = {}
    for i, v in enumerate(n):
        r = root(i)
        least[r] = min(v, least.get(r, v))
    return [least[root(i)] for i in range(len(n))]


def _labelled(boxes: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Boxes with the smallest number of their group among those of the same keys, which are one task's unit."""

    @F.arrow_udf("array<bigint>")
    def label(pages: pa.Array) -> pa.Array:
        ends, flat = pages.offsets.to_pylist(), pages.flatten()
        columns = [flat.field(c).to_pylist() for c in ("n", "x0", "y0", "x1", "y1")]
        base = ends[0]
        out = [x for a, b in zip(ends, ends[1:]) for x in (_components(*(c[a - base : b - base] for c in columns)) if b - a > 1 else columns[0][a - base : b - base])]
        return pa.ListArray.from_arrays(pa.array([e - base for e in ends], pa.int32()), pa.array(out, pa.int64()))

    box = F.struct(F.col(number).cast("bigint").alias("n"), "x0", "y0", "x1", "y1")
    pages = boxes.groupBy(*keys).agg(F.collect_list(box).alias("_page"))
    zipped = F.arrays_zip(F.col("_page.n").alias("n"), label("_page").alias("c"))
    return pages.select(*keys, F.explode(zipped).alias("_z")).select(*keys, F.col("_z.n").alias(number), F.col("_z.c").alias("component"))


def star_components(edges: DataFrame, key: str, rounds: int = 60) -> DataFrame:
    """(key, node, root): the smallest node that each node of the undirected edges (key, a, b) reaches, in rounds of large and small stars.

    Every round is a stage written once; a node with many edges costs a partly
    aggregated minimum.
    """
    now = stored(edges.where("a != b").select(key, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    said = None
    for _ in range(rounds):
        both = now.select(key, F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(key, "b", "a"))
        low = both.groupBy(key, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, [key, "u"]).where("v > u and v != m").select(key, F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        small = large.join(large.groupBy(key, "b").agg(F.min("a").alias("m")), [key, "b"])
        stars = small.select(key, F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a < b").distinct()
        now = stored(stars, "edges")
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64(key, "a", "b").cast("decimal(20,0)"))).first())
        if state == said:
            return now.select(key, F.col("b").alias("node"), F.col("a").alias("root"))
        said = state
    raise RuntimeError(f"the components did not settle in {rounds} rounds")


def overlap_components(boxes: DataFrame, key: str, number: str, task_boxes: int = 50_000) -> DataFrame:
    """Every box with the smallest number of its connected group; groups never span keys.

    A key (a page) with at most task_boxes boxes is one task's unit.  A larger
    one is cut into a grid at the quantiles of its boxes' left and lower
    edges; a box lies in every cell that it touches, and the groups of cells
    are joined where they share a box.  Boxes with the same four sides are one.
    """
    sizes = boxes.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > task_boxes)
    most = sizes.agg(F.max("_n")).first()[0]
    if most is None:
        return _labelled(boxes, [key], number)
    sides = ["x0", "y0", "x1", "y1"]
    small = _labelled(boxes.join(sizes, key, "left_anti"), [key], number)
    mine = boxes.join(sizes, key, "left_semi")
    rects = stored(mine.groupBy(key, *sides).agg(F.min(F.col(number).cast("bigint")).alias("_rect")), "rects")
    steps = math.ceil(math.sqrt(most / task_boxes)) + 1
    shares = F.array(*(F.lit(i / steps) for i in range(1, steps)))
    cuts = rects.groupBy(key).agg(F.percentile_approx("x0", shares, 10_000).alias("_xs"), F.percentile_approx("y0", shares, 10_000).alias("_ys"))
    band = lambda cut, c: F.size(F.filter(cut, lambda x: x < F.col(c)))
    spread = lambda cut, a, b: F.explode(F.sequence(band(cut, a), band(cut, b)))
    # a cell holds what begins in it or reaches into it; a touch at a cut is within the lower cell for both sides
    celled = rects.join(cuts, key).withColumn("_cx", spread(F.col("_xs"), "x0", "x1")).withColumn("_cy", spread(F.col("_ys"), "y0", "y1"))
    labels = stored(_labelled(celled, [key, "_cx", "_cy"], "_rect").groupBy(key, "_rect").agg(F.min("component").alias("label"), F.collect_set("component").alias("_all")), "labels")
    joins = labels.where(F.size("_all") > 1).select(key, F.col("label").alias("a"), F.explode("_all").alias("b"))
    roots = star_components(joins, key).withColumnRenamed("node", "label")
    known = labels.join(roots, [key, "label"], "left").select(key, "_rect", F.coalesce("root", "label").alias("component"))
    large = mine.select(key, F.col(number).cast("bigint").alias(number), *sides).join(rects, [key, *sides]).join(known, [key, "_rect"])
    return small.unionByName(large.select(key, number, "component"))


def first_range_match(points: DataFrame, cells: DataFrame, key: str, value: str, bounds: tuple[str, str], slack: float, ids: list[str], cell: str, into: str, width: float = 4.0) -> DataFrame:
    """The smallest cell of the same key whose bounds, widened by slack, hold each point's value; points without one are left out.

    Distinct values meet cells in strips of `width`, so a value is compared
    with the cells of its strip only, and each (key, value) once.
    """
    low, high = F.col(bounds[0]) - slack, F.col(bounds[1]) + slack
    strip = lambda x: F.floor(x / F.lit(float(width)))
    cut = cells.select(F.col(key), low.alias("_low"), high.alias("_high"), F.col(cell).alias("_cell")).where("_low <= _high").withColumn("_strip", F.explode(F.sequence(strip(F.col("_low")), strip(F.col("_high")))))
    asked = points.select(key, F.col(value).alias("_value")).distinct().withColumn("_strip", strip(F.col("_value")))
    first = asked.join(cut, [key, "_strip"]).where("_value between _low and _high").groupBy(key, "_value").agg(F.min("_cell").alias(into))
    return points.select(key, F.col(value).alias("_value"), *ids).join(first, [key, "_value"]).groupBy(*ids).agg(F.min(into).alias(into))


def nearest(left: DataFrame, right: DataFrame, keys: tuple[str, str], value: str, at: str, order: str) -> DataFrame:
    """Each left row with the right row of the same key whose `at` is largest but not above its value, the smallest `order` among equals; nulls if none.

    Both sides go through one ordered pass per key, so work grows with their
    rows and not with their pairs.
    """
    mine, theirs = keys
    carried = F.struct(*(F.col(c) for c in right.columns))
    rights = right.where(F.col(at).isNotNull()).select(F.col(theirs).alias("_key"), F.col(at).alias("_at"), F.lit(0).alias("_side"), (-F.col(order)).alias("_order"), carried.alias("_right"), F.lit(None).alias("_left"))
    lefts = left.select(F.col(mine).alias("_key"), F.col(value).alias("_at"), F.lit(1).alias("_side"), F.lit(None).alias("_order"), F.lit(None).alias("_right"), F.struct(*left.columns).alias("_left"))
    upto = Window.partitionBy("_key").orderBy("_at", "_side", "_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = rights.unionByName(lefts).withColumn("_best", F.last("_right", ignorenulls=True).over(upto)).where("_side = 1")
    return both.select("_left.*", *(F.when(F.col("_key").isNotNull(), F.col("_best")[c]).alias(c) for c in right.columns))


def grid_rows(cells: DataFrame, keys: list[str], column: str, text: str) -> DataFrame:
    """One array of cell texts per key, with empty texts where a column has no cell."""
    grouped = cells.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col(column).cast("int"), F.col(text)))).alias("m"), F.max(column).cast("int").alias("n"))
    filled = F.transform(F.sequence(F.lit(1), F.col("n")), lambda k: F.coalesce(F.try_element_at(F.col("m"), k), F.lit("")))
    return grouped.select(*keys, filled.alias("cells"))


def upper_median(df: DataFrame, keys: list[str], value: str, into: str) -> DataFrame:
    """The element at n div 2 of the sorted values, over counts of distinct values."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys)
    ranked = counts.withColumn("upto", F.sum("n").over(w.orderBy(value))).withColumn("total", F.sum("n").over(w))
    middle = F.expr("total div 2")
    return ranked.where((F.col("upto") > middle) & (F.col("upto") - F.col("n") <= middle)).select(*keys, F.col(value).alias(into))


def dominant_scale(scales: Column, tolerance: float = 0.5) -> Column:
    """The most frequent of an array of scales, bucketed by first-seen representative; the last bucket wins ties."""
    zero = F.array(F.struct(F.lit(0.0).cast("float").alias("s"), F.lit(0).alias("n")))

    def add(acc, x):
        hit = F.exists(acc, lambda b: F.abs(b["s"] - x) < tolerance)
        raised = F.transform(acc, lambda b: F.when(F.abs(b["s"] - x) < tolerance, F.struct(b["s"].alias("s"), (b["n"] + 1).alias("n"))).otherwise(b))
        return F.when(hit, raised).otherwise(F.concat(acc, F.array(F.struct(x.cast("float").alias("s"), F.lit(1).alias("n")))))

    buckets = F.aggregate(scales, F.slice(zero, 1, 0), add)
    best = lambda acc, b: F.when(b["n"] >= acc["n"], b).otherwise(acc)
    return F.aggregate(buckets, F.element_at(zero, 1), best)["s"]


def suffixed(df: DataFrame, name: str, order: list[str], into: str) -> DataFrame:
    """Names made distinct: the k-th repeat gets _k."""
    k = F.row_number().over(Window.partitionBy(name).orderBy(*order)) - 1
    return df.withColumn(into, F.when(k == 0, F.col(name)).otherwise(F.concat(F.col(name), F.lit("_"), k.cast("string"))))
