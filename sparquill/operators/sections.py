"""Routing of lines into instruction records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.functions import text as T
from sparquill.operators import folds


def body_lines(strings: DataFrame) -> DataFrame:
    """Lines without headers and footers: small scale, or within five per cent of the page's text extent from an end."""
    page = Window.partitionBy("range_id", "page_no")
    low, high, cy = F.min("y0").over(page), F.max("y1").over(page), (F.col("y0") + F.col("y1")) / 2
    margin = (high - low) * 0.05
    edge = (F.col("font_scale") <= 8.5) | (cy < low + margin) | (cy > high - margin)
    return strings.withColumn("_edge", edge).where("not _edge").drop("_edge")


_BLOCK = 10  # pages whose numbers agree but for so many of their last bits are a block


def routed(lines: DataFrame) -> DataFrame:
    """Lines (range_id, page_no, seq, text, font_scale) with instr_id, titled, section, section_name and segment.

    A title opens a record; text before the first belongs to record 1, and is
    not `titled`.  A
    section holds until the next heading or title, across pages.  Titles are
    counted by blocks of pages first, and only these counts are summed over a
    whole range; the other windows run over a block or a record.
    """
    sized = T.scale_class(F.col("font_scale")).isin("Title", "Heading")
    flagged = lines.withColumn("is_title", T.is_title(F.col("text")) & sized).withColumn("heading", F.when(~F.col("is_title"), T.detect_section(F.col("text"))))
    flagged = flagged.withColumn("_block", F.shiftright("page_no", _BLOCK))
    counts = flagged.groupBy("range_id", "_block").agg(F.count_if("is_title").alias("n"))
    before = counts.select("range_id", "_block", (F.sum("n").over(Window.partitionBy("range_id").orderBy("_block")) - F.col("n")).alias("_before"))
    upto = Window.partitionBy("range_id", "_block").orderBy("page_no", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = flagged.join(before, ["range_id", "_block"]).withColumn("_titles", F.col("_before") + F.sum(F.col("is_title").cast("int")).over(upto))
    numbered = numbered.withColumn("instr_id", F.greatest(F.lit(1), "_titles")).withColumn("titled", F.col("_titles") > 0).drop("_before", "_titles", "_block")
    record = Window.partitionBy("range_id", "instr_id").orderBy("page_no", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.when(F.col("heading").isNotNull(), F.struct(F.col("heading"), F.trim("text").alias("name")))
    carried = numbered.withColumn("_open", F.last(opened, ignorenulls=True).over(record))
    return carried.withColumn("section", F.col("_open.heading")).withColumn("section_name", F.col("_open.name")).withColumn("segment", F.count("heading").over(record)).drop("_open")


def _indented(lines: Column) -> Column:
    """Texts of lines (text, x0) under four blanks for each left edge, within three units, that is further left."""
    edges = folds.tolerance_distinct(F.array_sort(F.transform(lines, lambda x: x["x0"])), 3.0)
    return F.transform(lines, lambda x: F.concat(F.repeat(F.lit("    "), folds.anchor_index(edges, x["x0"], 3.0)), F.trim(x["text"])))


def records(route: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """One row per record: title, summary, description, operation, flag_affected, exceptions, other_sections, instructions, tables.

    Lines between a title and the first heading are description; before the
    first title, only lines under a heading belong to a record.  Of several operation segments the last stays.  Exceptions and other
    sections are grouped by their heading, in order of first appearance.  Lines
    under an instruction table's heading that no table took belong to the
    description.  `tables` has range_id, instr_id, instructions and tables.
    """
    keys = ["range_id", "instr_id"]
    at = F.struct("page_no", "seq", "text", (F.col("x0").cast("float") if "x0" in route.columns else F.lit(0.0).cast("float")).alias("x0"))
    kind = F.when(F.col("section").isNull() | (F.col("section") == "Instruction"), "Description").otherwise(F.col("section"))
    body = route.where("heading is null and not is_title and (section is not null or titled)").withColumn("section", kind)
    ordered = F.array_sort(F.collect_list(at))
    segments = body.where("section = 'Operation'").groupBy(*keys, "segment").agg(ordered.alias("lines"))
    last = segments.groupBy(*keys).agg(F.max_by("lines", "segment").alias("lines")).select(*keys, _indented(F.col("lines")).alias("operation"))
    named = F.when(F.col("section").isin("Exceptions", "Other"), F.col("section_name"))
    parts = body.where("section != 'Operation'").groupBy(*keys, "section", named.alias("name")).agg(ordered.alias("lines"))
    parts = parts.select(*keys, "section", F.struct(F.col("lines")[0].alias("first"), F.col("name"), F.transform("lines", lambda x: F.trim(x["text"])).alias("lines")).alias("part"))
    of = lambda kind: F.array_sort(F.collect_list(F.when(F.col("section") == kind, F.col("part"))))
    flat = lambda kind: F.flatten(F.transform(of(kind), lambda p: p["lines"]))
    grouped = lambda kind: F.transform(of(kind), lambda p: F.struct(p["name"].alias("name"), p["lines"].alias("lines")))
    rest = parts.groupBy(*keys).agg(
        flat("Description").alias("description"),
        F.array_join(flat("FlagsAffected"), " ").alias("flag_affected"),
        flat("Intrinsic").alias("c_and_cpp_equivalent"),
        grouped("Exceptions").alias("exceptions"),
        grouped("Other").alias("other_sections"),
    )
    heads = route.groupBy(*keys).agg(F.min(F.when(F.col("is_title"), F.struct("page_no", "seq", "text"))).getField("text").alias("t"))
    parsed = T.parse_title(F.coalesce("t", F.lit("")))
    titled = heads.select(*keys, parsed["title"].alias("title"), parsed["summary"].alias("summary"))
    joined = titled.join(rest, keys, "left").join(last, keys, "left")
    fix = F.transform("operation", lambda x: T.repair_operation(x))
    joined = joined.withColumn("operation", F.coalesce(F.array_join(fix, "\n"), F.lit("")))
    if tables is not None:
        return joined.join(tables, keys, "left")
    return joined.withColumn("instructions", F.lit(None).cast(INSTRUCTIONS)).withColumn("tables", F.lit(None).cast(TABLES))


INSTRUCTIONS = "array<struct<mnemonic:string,description:string>>"
TABLES = "array<struct<name:string,headers:array<string>,rows:array<array<string>>>>"


def table_heading(tables: DataFrame, lines: DataFrame) -> DataFrame:
    """Tables (page_no, table_id, top) with the name of the nearest title or heading above their top, null without one; ties keep the earlier line.

    Titles and headings of instruction tables give the name Instruction.  Tables
    and headings of a page are read once from its upper end down, each table
    taking the last heading passed; at its own height it comes first.
    """
    size = T.scale_class(F.col("font_scale"))
    opcode = (size == "Title") | F.coalesce(T.detect_section(F.col("text")) == "Instruction", F.lit(False))
    heads = lines.where(size.isin("Title", "Heading") & F.col("page_no").isNotNull()).select(
        "page_no", F.when(opcode, "Instruction").otherwise(F.trim("text")).alias("heading"), "seq", ((F.col("y0") + F.col("y1")) / F.lit(2.0).cast("float")).alias("_y")
    )
    firsts = heads.where("_y is not null").groupBy("page_no", "_y").agg(F.min_by(F.struct("heading"), F.struct("seq")).alias("_head"))
    both = tables.withColumn("_y", F.col("top")).unionByName(firsts, allowMissingColumns=True)
    down = Window.partitionBy("page_no").orderBy(F.desc("_y"), F.col("_head").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = both.withColumn("_met", F.last("_head", ignorenulls=True).over(down)).where("_head is null")
    return met.select("page_no", "table_id", *(c for c in tables.columns if c not in ("page_no", "table_id")), F.when(F.col("top").isNotNull(), F.col("_met.heading")).alias("heading"))


def owned_tables(tables: DataFrame, route: DataFrame, lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(range_id, instr_id, instructions, tables): tables of tables.filled() by the record that holds at the end of their page.

    A table is named by table_heading(), else by the section that holds at the
    start of its page.  Tables go by page and from the top down; those before
    the first title are left out.  `pages` has range_id and page_no.
    """
    page = ["range_id", "page_no"]
    marks = route.where("is_title or heading is not null").withColumn("name", F.when(F.col("is_title"), "Instruction").otherwise(F.trim("text")))
    ends = pages.join(marks.groupBy(*page).agg(F.max_by("name", "seq").alias("name"), F.max(F.when(F.col("is_title"), F.col("instr_id"))).alias("opened")), page, "left")
    order = Window.partitionBy("range_id").orderBy("page_no")  # a row for each page
    state = ends.select(*page, F.last("opened", ignorenulls=True).over(order).alias("instr_id"), F.last("name", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    named = table_heading(tables, lines).join(state, "page_no").where("instr_id is not null").withColumn("name", F.coalesce("heading", "before", F.lit("Instruction")))
    listed = F.array_sort(F.collect_list(F.struct("page_no", (-F.col("top")).alias("down"), "table_id", "name", "headers", "rows")))
    of = named.groupBy("range_id", "instr_id").agg(listed.alias("listed"))
    described = F.filter(F.transform(F.filter("listed", lambda t: t["name"] == "Instruction"), lambda t: T.variants(t["headers"], t["rows"])), lambda v: F.size(v) > 0)
    shown = F.transform("listed", lambda t: F.struct(t["name"].alias("name"), t["headers"].alias("headers"), t["rows"].alias("rows")))
    return of.select("range_id", "instr_id", F.get(described, F.lit(0)).alias("instructions"), shown.alias("tables"))
