"""Cells of ruled tables, page by page, in 32-bit floats."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparquill.functions.geometry import holds_point, rect
from sparquill.operators import folds

CELLS = "page_no int, group_id int, cell_id int, x0 float, y0 float, x1 float, y1 float"


def filled_rects(ops: DataFrame) -> DataFrame:
    """(page_no, rect_id, x0..y1) of fills: every f or F takes the latest re of the page, a zero rectangle before any."""
    n = lambda i: F.element_at("operands", i)["num"].cast("float")
    rect = F.when(F.col("operator") == "re", F.struct(n(1).alias("x0"), n(2).alias("y0"), (n(1) + n(3)).cast("float").alias("x1"), (n(2) + n(4)).cast("float").alias("y1")))
    order = Window.partitionBy("page_no").orderBy("op_idx")
    last = ops.withColumn("rect", F.last(rect, ignorenulls=True).over(order)).where(F.lower("operator") == "f")
    part = lambda c: F.coalesce(F.col(f"rect.{c}"), F.lit(0.0).cast("float")).alias(c)
    return last.select("page_no", (F.row_number().over(order) - 1).alias("rect_id"), *map(part, ("x0", "y0", "x1", "y1")))


def _bands(values: np.ndarray, down: bool) -> list[np.float32]:
    kept: list[np.float32] = []
    for v in values:
        if all(abs(v - k) >= np.float32(2.0) for k in kept):
            kept.append(v)
    return sorted(kept, reverse=down)


def _meet(a: np.ndarray, b: np.ndarray, slack: float) -> np.ndarray:
    e = np.float32(slack)
    return (a[:, None, 0] <= b[None, :, 2] + e) & (b[None, :, 0] <= a[:, None, 2] + e) & (a[:, None, 1] <= b[None, :, 3] + e) & (b[None, :, 1] <= a[:, None, 3] + e)


def groups(rects: np.ndarray) -> list[np.ndarray]:
    """Row numbers of connected groups of touching rectangles, by their first member."""
    near, left, out = _meet(rects, rects, 0.0), set(range(len(rects))), []
    while left:
        reached, front = set(), {min(left)}
        while front:
            reached |= front
            front = {int(j) for i in front for j in np.flatnonzero(near[i])} - reached
        left -= reached
        out.append(np.array(sorted(reached)))
    return out


def grid_cells(rects: np.ndarray) -> list[tuple[np.float32, ...]]:
    """Cells (x0, y0, x1, y1) between neighbouring rules whose four corners are closed by a horizontal and a vertical rule that meet."""
    w, h = rects[:, 2] - rects[:, 0], rects[:, 3] - rects[:, 1]
    across, upright = rects[w > h], rects[h > w]
    if len(across) < 2 or len(upright) < 2:
        return []
    two = np.float32(2.0)
    cy, cx = (across[:, 1] + across[:, 3]) / two, (upright[:, 0] + upright[:, 2]) / two
    touch = _meet(across, upright, 0.5)
    rows, columns, out = _bands(cy, True), _bands(cx, False), []
    for top, bottom in zip(rows, rows[1:]):
        for left, right in zip(columns, columns[1:]):
            at_y, at_x = {y: np.abs(cy - y) < two for y in (top, bottom)}, {x: np.abs(cx - x) < two for x in (left, right)}
            if not all(touch[np.ix_(at_y[y], at_x[x])].any() for y in (top, bottom) for x in (left, right)):
                continue
            cell = (upright[at_x[left], 2].max(), across[at_y[bottom], 3].max(), upright[at_x[right], 0].min(), across[at_y[top], 1].min())
            if cell[0] < cell[2] and cell[1] < cell[3]:
                out.append(cell)
    return out


def cells(rects: DataFrame) -> DataFrame:
    """Table cells of every page; pages with fewer than four rectangles have none."""

    def page(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rect_id")
        boxes = pdf[["x0", "y0", "x1", "y1"]].to_numpy(np.float32)
        rows = []
        if len(boxes) >= 4:
            for g, members in enumerate(groups(boxes)):
                rows += [(int(pdf.page_no.iloc[0]), g, i, *map(float, c)) for i, c in enumerate(grid_cells(boxes[members]))]
        return pd.DataFrame(rows, columns=["page_no", "group_id", "cell_id", "x0", "y0", "x1", "y1"])

    return rects.groupBy("page_no").applyInPandas(page, CELLS)


_STRIP = 32.0  # height of the strips by which points meet cells


def glyphs_in_cells(glyphs: DataFrame, cell_table: DataFrame, ids: list[str]) -> DataFrame:
    """(page_no, *ids, group_id, cell_id): per glyph and group, the first cell that holds the glyph's centre, with a tolerance of one.

    Points and cells meet in strips of a page, so a point is compared with the
    cells of its strip only, and of cells that lie over each other exactly with
    the first.  Points are dealt by their ids, which are also the keys of the
    result, and not by page.
    """
    strip = lambda y: F.floor(y / F.lit(_STRIP))
    sides = [F.col(x).alias(f"c_{x}") for x in ("x0", "y0", "x1", "y1")]
    cut = cell_table.groupBy("page_no", "group_id", *sides).agg(F.min("cell_id").alias("cell_id"))
    cut = cut.withColumn("strip", F.explode(F.sequence(strip(F.col("c_y0") - 1), strip(F.col("c_y1") + 1))))
    two = F.lit(2.0).cast("float")
    points = glyphs.withColumn("cx", (F.col("x0") + F.col("x1")) / two).withColumn("cy", (F.col("y0") + F.col("y1")) / two).withColumn("strip", strip(F.col("cy")))
    points = points.select("page_no", *ids, "cx", "cy", "strip").repartition("page_no", *ids)
    inside = points.join(cut, ["page_no", "strip"]).where(holds_point(rect("c_"), F.col("cx"), F.col("cy")))
    return inside.groupBy("page_no", *ids, "group_id").agg(F.min("cell_id").alias("cell_id"))


def consumed(letters: DataFrame, cell_table: DataFrame) -> DataFrame:
    """Letters (page_no, seq, pos, text) in table cells.  A string belongs to the first group that holds any of its letters."""
    held = glyphs_in_cells(letters, cell_table, ["seq", "pos"])
    first = held.groupBy("page_no", "seq").agg(F.min("group_id").alias("group_id"))
    return held.join(first, ["page_no", "seq", "group_id"]).join(letters.select("page_no", "seq", "pos", "text"), ["page_no", "seq", "pos"])


def filled(held: DataFrame, cell_table: DataFrame) -> DataFrame:
    """Tables (page_no, table_id, top, headers, rows) of consumed(): cell texts on the grid of their group, the first row as headers."""
    ordered = lambda key, x, sep: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, x))), lambda s: s[x]), sep)
    cell = ["page_no", "group_id", "cell_id"]
    texts = held.groupBy(*cell, "seq").agg(F.trim(ordered("pos", "text", "")).alias("text")).groupBy(*cell).agg(ordered("seq", "text", " ").alias("text"))
    sides = F.array_sort(F.collect_list(F.struct("cell_id", "x0", "y0", "x1", "y1")))
    bounds = lambda low, high: folds.tolerance_distinct(F.flatten(F.transform("sides", lambda c: F.array(c[low], c[high]))), 1.0)
    grids = cell_table.groupBy("page_no", "group_id").agg(sides.alias("sides"), F.max("y1").alias("top"))
    grids = grids.select("page_no", "group_id", "top", F.sort_array(bounds("y0", "y1"), False).alias("ys"), F.sort_array(bounds("x0", "x1")).alias("xs"))
    middle = lambda a, b: (F.col(a) + F.col(b)) / F.lit(2.0).cast("float")
    placed = cell_table.join(texts, cell).join(grids, ["page_no", "group_id"])
    placed = placed.withColumn("row", folds.band_index(folds.bands_between(F.col("ys")), middle("y0", "y1"))).withColumn("column", folds.band_index(folds.bands_between(F.col("xs")), middle("x0", "x1")))
    grid = placed.groupBy("page_no", "group_id", "top", "row", "column").agg(F.max_by("text", "cell_id").alias("text"))
    at = F.struct("row", "column")
    whole = grid.groupBy("page_no", F.col("group_id").alias("table_id"), "top").agg(F.map_from_entries(F.collect_list(F.struct(at, "text"))).alias("m"), F.max("row").alias("last"), F.max("column").alias("width"))
    line = lambda r: F.transform(F.sequence(F.lit(0), F.col("width")), lambda c: F.coalesce(F.try_element_at("m", F.struct(r.alias("row"), c.alias("column"))), F.lit("")))
    rows = F.transform(F.filter(F.sequence(F.lit(0), F.col("last")), lambda r: r > 0), line)
    return whole.select("page_no", "table_id", "top", line(F.lit(0)).alias("headers"), rows.alias("rows"))
