"""Counts and lists over generated functions, comparisons, verdicts and file checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.functions import text as T

STATUSES = ("real_ir", "exception", "todo", "skipped")
# The report's headings by status.
HEADINGS = {"real_ir": "SUCCESSFUL (Real IR)", "exception": "EXCEPTION STUBS", "todo": "TODO STUBS", "skipped": "SKIPPED (no operation pseudocode)"}


def _share(part: Column, whole: Column) -> Column:
    """Whole per cent, rounded down; null of nothing."""
    return F.when(whole > 0, F.floor(100 * part / whole)).cast("long")


def generation(functions: DataFrame) -> DataFrame:
    """Per arch of functions (arch, mnemonic, status): all, with operation, and counts and shares by status; other statuses (aliases) are not counted."""
    n = {s: F.count_if(F.col("status") == s) for s in STATUSES}
    done = n["real_ir"] + n["exception"] + n["todo"]
    return functions.groupBy("arch").agg(
        (done + n["skipped"]).alias("n"),
        done.alias("with_operation"),
        *(c.alias(f"n_{s}") for s, c in n.items()),
        *(_share(n[s], done).alias(f"percent_{s}") for s in STATUSES[:3]),
    )


def generation_lines(functions: DataFrame) -> DataFrame:
    """(arch, place, value): per arch and status a heading with the count, then a line per function by mnemonic; an empty todo list has no heading."""
    at = F.when(F.col("status") == STATUSES[0], 0)
    for i, s in enumerate(STATUSES[1:], 1):
        at = at.when(F.col("status") == s, i)
    heads = F.create_map(*(F.lit(x) for i, s in enumerate(STATUSES) for x in (i, HEADINGS[s])))
    listed = functions.withColumn("part", at).where("part is not null")
    reason = F.when(F.col("status") == "skipped", "").otherwise(F.concat(F.lit(": "), F.coalesce("reason", F.lit(""))))
    rows = listed.select("arch", "part", F.lit(1).alias("row"), "mnemonic", F.concat(F.lit("  "), F.col("mnemonic"), reason).alias("value"))
    parts = functions.select("arch").distinct().crossJoin(F.broadcast(functions.sparkSession.createDataFrame([(i,) for i in range(len(STATUSES))], "part int")))  # four rows an arch
    counts = parts.join(listed.groupBy("arch", "part").agg(F.count("*").alias("n")), ["arch", "part"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    headed = counts.where("n > 0 or part != 2").select("arch", "part", F.lit(0).alias("row"), F.lit(None).cast("string").alias("mnemonic"), F.concat(F.lit("--- "), F.element_at(heads, F.col("part")), F.lit(": "), F.col("n").cast("string"), F.lit(" ---")).alias("value"))
    order = Window.partitionBy("arch").orderBy("part", "row", "mnemonic")
    return headed.unionByName(rows).select("arch", (F.row_number().over(order) - 1).alias("place"), "value")


def severities(compared: DataFrame) -> DataFrame:
    """One row of validate.compared(): n, passed, failed, warnings."""
    of = lambda s: F.count_if(F.col("severity") == s)
    return compared.agg(F.count("*").alias("n"), of("passed").alias("passed"), of("failure").alias("failed"), of("warning").alias("warnings"))


def todos(lines: DataFrame) -> DataFrame:
    """(file, n): how often todo! stands in each file of lines (file, line); files without it are left out."""
    return lines.groupBy("file").agg(F.sum(T.occurrences(F.col("line"), "todo!")).alias("n")).where("n > 0")


def files(checked: DataFrame) -> DataFrame:
    """One row over files (name, filename_issues, content_issues): n, files with errors, and errors by kind."""
    size = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>")))
    total = lambda c: F.coalesce(F.sum(size(F.col(c))), F.lit(0))
    return checked.agg(
        F.count("*").alias("n"),
        F.count_if(size(F.col("filename_issues")) + size(F.col("content_issues")) > 0).alias("with_errors"),
        total("filename_issues").alias("filename_errors"),
        total("content_issues").alias("content_errors"),
    )


def verdict_files(judged: DataFrame) -> DataFrame:
    """Per file of verdicts (file, verdict): functions and counts by verdict."""
    of = lambda v: F.count_if(F.col("verdict") == v).alias(v.lower())
    return judged.groupBy("file").agg(F.count("*").alias("n"), *map(of, ("CORRECT", "ACCEPTABLE", "WRONG", "EXCEPTION_STUB")))


def first_errors(errors: DataFrame, order: list[str], most: int = 50) -> DataFrame:
    """The first `most` errors in order: what a report shows."""
    return errors.orderBy(*order).limit(most)


def enum_rules(lines: DataFrame) -> DataFrame:
    """(file, pos, message) of the rules that an enum file (file, pos, line) breaks; pos is null for rules of the whole file.

    A file that does not begin with an enum's declaration is told so and not
    looked at further.  Compiling it is left to whoever has a compiler.
    """
    t = F.trim("line")
    first = F.max(F.when(F.col("pos") == 0, F.col("line").startswith("enum ").cast("int")))
    marked = lines.withColumn("t", t).withColumn("plain", ~(t.startswith("///") | (t == "") | t.startswith("enum") | (t == "}")))
    variant = F.col("plain") & F.col("t").endswith(",")
    whole = marked.groupBy("file").agg(
        F.coalesce(first, F.lit(0)).alias("declared"), F.count_if(variant).alias("variants"), F.count_if(F.col("t").startswith("/// #")).alias("heads")
    )
    name = F.trim(F.regexp_replace("t", ",$", ""))
    proper = name.rlike("^[A-Z][A-Za-z0-9_]*$")
    told = lambda kind, *parts: F.concat(F.col("file"), F.lit(":"), (F.col("pos") + 1).cast("string"), F.lit(f": {kind}"), *parts)
    found = F.array(
        F.when(variant & ~proper, told("invalid variant name '", name, F.lit("'"))),
        F.when(F.col("t").isin("Unknown,", "Unknown"), told("'Unknown' variant found (empty mnemonic)")),
        F.when(F.col("plain") & ~F.col("t").rlike("^[A-Z][A-Za-z0-9_]*,$"), told("unexpected line outside doc comment: '", F.substring("t", 1, 60), F.lit("'"))),
    )
    good = whole.where("declared = 1")
    by_line = marked.join(good.select("file"), "file").select("file", "pos", F.explode(F.filter(found, lambda m: m.isNotNull())).alias("message"))
    said = lambda when, text: F.when(when, F.concat(F.col("file"), F.lit(f": {text}")))
    of_file = F.when(F.col("declared") == 0, F.array(said(F.lit(True), "doesn't start with 'enum' declaration"))).otherwise(
        F.array(said(F.col("variants") == 0, "no enum variants found"), said(F.col("heads") == 0, "no doc H1 headings found"))
    )
    by_file = whole.select("file", F.lit(None).cast("int").alias("pos"), F.explode(F.filter(of_file, lambda m: m.isNotNull())).alias("message"))
    return by_file.unionByName(by_line.withColumn("pos", F.col("pos").cast("int")))
