"""Steps whose cost must not outgrow their input: crowded pages against plain versions, and within a minute where all pairs take many."""

import random
import re
import time

from pyspark.sql import functions as F

from sparquill.operators import sections, tables
from sparquill.sources import fonts

CELL = "page_no int, group_id int, cell_id int, x0 float, y0 float, x1 float, y1 float"
HEADED = "page_no int, table_id int, top float, rows array<string>"
LINE = "page_no int, seq int, text string, font_scale double, y0 float, y1 float"
GLYPH = "page_no int, seq int, x0 float, y0 float, x1 float, y1 float"


def test_glyphs_in_cells_that_repeat(spark):
    rng = random.Random(1)
    cells = [(rng.randrange(2), rng.randrange(3), i, *(lambda x, y: (x, y, x + 8.0, y + 40.0))(rng.randrange(3) * 5.0, rng.randrange(3) * 30.0)) for i in range(120)]
    glyphs = [(rng.randrange(3), i, x, y, x + 1.0, y + 1.0) for i in range(100) for x, y in [(rng.randrange(60) / 2, rng.randrange(250) / 2)]]
    plain = {}
    for p, s, x, y, _, _ in glyphs:
        for q, g, c, x0, y0, x1, y1 in cells:
            if p == q and x0 - 1 <= x + 0.5 <= x1 + 1 and y0 - 1 <= y + 0.5 <= y1 + 1:
                plain[p, s, g] = min(c, plain.get((p, s, g), c))
    got = tables.glyphs_in_cells(spark.createDataFrame(glyphs, GLYPH), spark.createDataFrame(cells, CELL), ["seq"]).collect()
    assert len(got) == len(plain) > 50 and {(r.page_no, r.seq, r.group_id): r.cell_id for r in got} == plain


def test_glyphs_in_crowded_page(spark):
    start, n = time.perf_counter(), 80_000
    side = lambda *values: [F.lit(v).cast("float").alias(c) for c, v in zip(("x0", "y0", "x1", "y1"), values)]
    cells = spark.range(n).select(F.lit(1).alias("page_no"), (F.col("id") % 2).alias("group_id"), F.col("id").alias("cell_id"), *side(0, 0, 10, 10))
    glyphs = spark.range(n).select(F.lit(1).alias("page_no"), F.col("id").alias("seq"), *side(4, 4, 5, 5))
    got = tables.glyphs_in_cells(glyphs, cells, ["seq"]).groupBy("group_id", "cell_id").count().collect()
    assert sorted(map(tuple, got)) == [(0, 0, n), (1, 1, n)] and time.perf_counter() - start < 60


def test_table_headings_of_a_page(spark):
    rng = random.Random(2)
    rows = [(rng.choice([1, 2, 3, None]), i, rng.choice([None, *(v / 2 for v in range(-4, 24))]), [str(i)]) for i in range(90)]
    lines = [(rng.choice([1, 2, None]), i, rng.choice([f" Name {i} ", "Opcode", "Exceptions"]), rng.choice([9.0, 10.0, 12.0]), y, y) for i in range(60) for y in [rng.choice([None, *map(float, range(-3, 14))])]]
    plain = {}
    for p, t, top, _ in rows:
        above = [(y - top, s, "Instruction" if size == 12.0 or text == "Opcode" else text.strip()) for q, s, text, size, y, _ in lines if None not in (p, q, top, y) and p == q and y > top and size > 9.5]
        plain[t] = min(above)[2] if above else None
    got = sections.table_heading(spark.createDataFrame(rows, HEADED), spark.createDataFrame(lines, LINE))
    assert got.columns == ["page_no", "table_id", "top", "rows", "heading"]
    found = {r.table_id: r for r in got.collect()}
    assert {t: r.heading for t, r in found.items()} == plain and len(set(plain.values())) > 3
    assert all(r.rows == [str(t)] for t, r in found.items())


def test_table_headings_of_a_crowded_page(spark):
    start, n = time.perf_counter(), 60_000
    lines = spark.range(n).select(F.lit(1).alias("page_no"), F.col("id").alias("seq"), F.concat(F.lit("h"), "id").alias("text"), F.lit(10.0).alias("font_scale"), *(F.col("id").cast("double").alias(c) for c in ("y0", "y1")))
    made = spark.range(n).select(F.lit(1).alias("page_no"), F.col("id").alias("table_id"), (F.col("id") + 0.5).cast("double").alias("top"))
    got = sections.table_heading(made, lines)
    assert got.where(F.col("heading") == F.concat(F.lit("h"), F.col("table_id") + 1)).count() == n - 1 and time.perf_counter() - start < 60


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_unicode_maps_are_not_shuffled(spark):
    text = "2 beginbfchar <01><0041> <01><0042> endbfchar 2 beginbfrange <02><04><0061> <03><04>[<0030>] endbfrange 1 beginbfchar <01><0043> endbfchar"
    got = fonts.to_unicode(spark.createDataFrame([(1, text), (2, "1 beginbfchar <02><0041> endbfchar"), (3, None), (4, "")], "object int, to_unicode string"))
    assert sorted(map(tuple, got.collect())) == [(1, 1, 0x43), (1, 2, 0x61), (1, 3, 0x30), (1, 4, 0x63), (2, 2, 0x41)]
    assert "Exchange" not in _plan(got) and "Sort" not in _plan(got)


def test_titles_are_summed_over_blocks_of_pages(spark):
    """Only the sums of blocks are a window over a whole range: of 10,000 pages some ten rows."""
    lines = spark.range(-300, 20_000).select(F.expr("id & 1").alias("range_id"), F.col("id").alias("page_no"), F.lit(1).alias("seq"), F.lit("ADD—Add").alias("text"), F.lit(12.0).alias("font_scale"))
    routed = sections.routed(lines)
    assert routed.where("instr_id != (page_no - range_id + 300) div 2 + 1").count() == 0
    assert not re.search(r"windowspecdefinition\(range_id#\w+, page_no#\w+ ASC", _plan(routed))
