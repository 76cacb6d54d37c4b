"""Plans: the manual to records, the archive to records, entries to functions and verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.functions import registry
from sparquill.functions import text as T
from sparquill.functions.names import names
from sparquill.operators import dispatch, glyphs, render, sections, tables, validate
from sparquill.sources import named_files, pdf, text_files, xml_archive
from sparquill.stages import stored


def page_letters(ops: DataFrame, fonts: DataFrame) -> DataFrame:
    """Letters in reading order of all pages' operations."""
    table = glyphs.glyphs(ops, fonts.select("page_no", "font", "code", "width"), fonts.select("page_no", "font", F.col("code").alias("cid"), "codepoint"))
    return glyphs.letters(table)


def manual_records(spark: SparkSession, path: str, ranges: list[tuple[int, int]]) -> DataFrame:
    """Records of a PDF manual's page ranges, with their tables; strings that tables took are in no other section.

    Operations, letters, cells, consumed strings and routed lines are each read
    by several branches, so each is a stage, written once: the file is read
    twice, for its pages and for their fonts.
    """
    ops = stored(pdf.pdf_ops(spark, path, ranges), "ops")
    pages, letters = ops.select("range_id", "page_no").distinct(), stored(page_letters(ops, pdf.pdf_fonts(spark, path, ranges)), "letters")
    cells = stored(tables.cells(tables.filled_rects(ops)), "cells")
    held = stored(tables.consumed(letters, cells), "held")
    lines = stored(sections.body_lines(glyphs.joined(letters).join(pages, "page_no")), "lines")
    route = stored(sections.routed(lines.join(held.select("page_no", "seq").distinct(), ["page_no", "seq"], "left_anti")), "route")
    return sections.records(route, sections.owned_tables(tables.filled(held, cells), route, lines, pages))


def manual_pages(spark: SparkSession, path: str, ranges: list[tuple[int, int]]) -> DataFrame:
    """(range_id, page_no, value): the plain text of the pages of a manual's ranges."""
    ops = stored(pdf.pdf_ops(spark, path, ranges), "ops")
    return render.page_dump(glyphs.joined(page_letters(ops, pdf.pdf_fonts(spark, path, ranges))), ops.select("range_id", "page_no").distinct())


def manual_files(records: DataFrame) -> DataFrame:
    """(name, md): one Markdown text per name; of equal names the later record stays.  INT n goes by the name INT."""
    shown = records.withColumn("md", render.manual_markdown(records))
    exploded = shown.select(F.explode(names(F.col("title"))).alias("name"), "md", "range_id", "instr_id")
    return exploded.withColumn("name", F.when(F.col("name") == "INT n", "INT").otherwise(F.col("name"))).groupBy("name").agg(F.max_by("md", F.struct("range_id", "instr_id")).alias("md"))


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(name, md): one Markdown text per slug of an XML archive."""
    parsed = xml_archive.instructions(xml_archive.xml_files(spark, path))
    return parsed.select(T.slug(F.col("heading"), F.col("id")).alias("name"), render.archive_markdown().alias("md"))


def save_manual(spark: SparkSession, path: str, ranges: list[tuple[int, int]], folder: str) -> None:
    """Write one Markdown file per instruction name of a manual, all of them or none."""
    named_files.save(manual_files(manual_records(spark, path, ranges)), folder)


def save_archive(spark: SparkSession, path: str, folder: str) -> None:
    """Write one Markdown file per slug of an XML archive, all of them or none; of equal slugs the greatest text stays."""
    files = archive_files(spark, path)
    named_files.save(files.groupBy("name").agg(F.max("md").alias("md")), folder)


def archive_entries(spark: SparkSession, path: str) -> DataFrame:
    """(mnemonic, variant, docs) of an XML archive."""
    parsed = xml_archive.instructions(xml_archive.xml_files(spark, path))
    return render.enum_entries(parsed.withColumn("md", render.archive_markdown()), "filename")


def functions_of(spark: SparkSession, path: str, arch: str, templates: DataFrame | None = None) -> DataFrame:
    """Generated bodies of the instructions of an enum file; on ARM, with those of their aliases, whose status is alias."""
    entries = text_files.instructions(text_files.enum_entries(text_files.numbered_lines(spark, path)))
    made = dispatch.generate(entries.select("mnemonic", "operation", "aliases"), registry.templates(spark, templates), arch)
    if arch != "arm":
        return made
    return made.unionByName(dispatch.alias_functions(made).withColumn("status", F.lit("alias")), allowMissingColumns=True)


def verdicts(functions: DataFrame) -> DataFrame:
    """Generated functions with issues and verdict, by the rules of their arch (any but x86_64 is ARM)."""
    x86 = validate.x86_issues(F.col("name"), F.col("pseudocode"), F.col("body"))
    found = validate.with_arm_issues(functions).withColumn("issues", F.when(F.col("arch") == "x86_64", x86).otherwise(F.col("issues")))
    return found.withColumn("verdict", validate.verdict(F.col("issues"), F.col("is_exception"), validate.MINOR))
