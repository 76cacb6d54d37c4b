"""Sources of enum files and generated code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparquill.functions import text as T
from sparquill.functions.pseudocode import STOPS


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, line) of text files; a file is one row of the reader, so its order is sure."""
    whole = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    return whole.select("file", F.posexplode(F.split("value", "\n")).alias("pos", "line"))


def enum_entries(lines: DataFrame) -> DataFrame:
    """(file, seq, name, docs) of doc-commented enum variants.

    The enum's body lies between "enum X {" and "}".  A variant closes the doc
    lines before it; another line that is neither doc nor blank drops them.
    """
    order = Window.partitionBy("file").orderBy("pos")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    t = F.trim("line")
    opened = lines.withColumn("t", t).withColumn("_in", F.coalesce(F.max(t.rlike(r"^(?:pub )?enum \w+ *\{").cast("int")).over(upto), F.lit(0)))
    opened = opened.withColumn("_out", F.coalesce(F.max(F.when((F.col("_in") == 1) & (F.col("t") == "}"), 1).otherwise(0)).over(order), F.lit(0)))
    inside = opened.where("_in = 1 and _out = 0")
    variant, doc = F.col("t").rlike("^[A-Z][a-zA-Z0-9]*,?$"), F.col("t").startswith("///")
    ends = F.when(variant | (~doc & (F.col("t") != "")), 1).otherwise(0)
    grouped = inside.withColumn("variant", variant).withColumn("doc", doc).withColumn("record", F.coalesce(F.sum(ends).over(upto), F.lit(0)))
    text = F.regexp_replace("t", "^/// ?", "")
    return (
        grouped.groupBy("file", "record")
        .agg(
            F.min(F.when(F.col("variant"), F.regexp_replace("t", ",$", ""))).alias("name"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("doc"), F.struct("pos", text.alias("x"))))), lambda s: s["x"]), "\n").alias("docs"),
        )
        .where("name is not null")
        .select("file", F.col("record").alias("seq"), "name", "docs")
    )


def instructions(entries: DataFrame) -> DataFrame:
    """Entries with mnemonic, operation, first_letter and aliases."""
    block = F.regexp_extract("docs", r"(?s)## Aliases\n(.*?)(?:\n## |\z)", 1)
    bullets = F.regexp_extract_all(block, F.lit(r"(?m)^- (.+)$"), 1)
    parsed = F.transform(
        bullets,
        lambda b: F.struct(
            F.trim(F.substring_index(b, " — Preferred when ", 1)).alias("title"),
            F.lower(F.trim(F.regexp_replace(F.substring_index(b, " — Preferred when ", 1), r"\s*\(.*\)\s*$", ""))).alias("mnemonic"),
            F.when(F.contains(b, F.lit(" — Preferred when ")), F.substring_index(b, " — Preferred when ", -1)).otherwise("").alias("condition"),
        ),
    )
    return entries.select("*", F.lower("name").alias("mnemonic"), T.operation_of(F.col("docs"), STOPS).alias("operation"), F.lower(F.substring("name", 1, 1)).alias("first_letter"), parsed.alias("aliases"))


def generated_functions(lines: DataFrame, arch: str) -> DataFrame:
    """(file, name, pseudocode, body, is_exception, arch) of generated code.

    The body runs to where the brace depth is back at zero; the pseudocode is
    the fenced doc block before the function.
    """
    order = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    name = F.regexp_extract("line", r"^pub\(super\) fn (\w+)", 1)
    started = lines.withColumn("fn", F.nullif(name, F.lit(""))).withColumn("step", F.length("line") - F.length(F.replace("line", F.lit("{"))) - F.length("line") + F.length(F.replace("line", F.lit("}"))))
    # doc lines belong to the function after them
    back = Window.partitionBy("file").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = started.withColumn("at", F.when(F.col("line").startswith("///"), F.last("fn", ignorenulls=True).over(back)).otherwise(F.last("fn", ignorenulls=True).over(order)))
    owned = owned.withColumn("depth", F.sum(F.when(F.col("line").startswith("///"), 0).otherwise(F.col("step"))).over(order))
    text = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("pos", "line")))), lambda s: s["line"]), "\n")
    inner = ~F.col("line").startswith("///") & F.col("fn").isNull() & (F.col("depth") > 0)
    docs = text(F.col("line").startswith("///"))
    out = owned.where("at is not null").groupBy("file", F.col("at").alias("name")).agg(docs.alias("docs"), text(inner).alias("body"))
    code = F.regexp_extract(F.regexp_replace("docs", r"(?m)^/// ?", ""), r"(?s)```[^\n]*\n(.*?)\n?```", 1)
    return out.select("file", "name", code.alias("pseudocode"), "body", F.trim("body").rlike(r'^\[exception\("[^"]*"\)\]\.into\(\)$').alias("is_exception"), F.lit(arch).alias("arch"))


def function_bodies(files: DataFrame) -> DataFrame:
    """(name, body) of the functions in whole files (file, content), braces nested once at most; of equal names the last of the last file stays.

    Files count in order of their names.
    """
    pattern = r"pub(?:\([a-z]+\))? fn (\w+)\s*\([^)]*\)[^{]*\{((?:[^{}]|\{[^{}]*\})*)\}"
    every = lambda g: F.regexp_extract_all("content", F.lit(pattern), g)
    found = files.select("file", F.posexplode(F.arrays_zip(every(1).alias("name"), every(2).alias("body"))).alias("pos", "f"))
    return found.groupBy(F.col("f.name").alias("name")).agg(F.max_by(F.regexp_replace("f.body", r"\A\s+|\s+\z", ""), F.struct("file", "pos")).alias("body"))
