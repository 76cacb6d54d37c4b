"""Records to Markdown, enum entries and generated functions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.functions import text as T
from sparquill.functions.registry import X86_CONDITIONS
from sparquill.operators.folds import suffixed


def _section(title: str, lines: Column) -> Column:
    """"## title" and its lines, or an empty array."""
    return F.when(F.size(F.coalesce(lines, F.array().cast("array<string>"))) > 0, F.concat(F.array(F.lit(f"## {title}"), F.lit("")), lines, F.array(F.lit("")))).otherwise(
        F.array().cast("array<string>")
    )


def _code(text: Column) -> Column:
    return F.when(F.length(F.coalesce(text, F.lit(""))) > 0, F.array(F.lit("```"), text, F.lit("```"))).otherwise(F.array().cast("array<string>"))


def _block(title: str, lines: Column) -> Column:
    """A blank line, "## title", a blank line and the lines; nothing without lines."""
    lines = F.coalesce(lines, F.array().cast("array<string>"))
    return F.when(F.size(lines) > 0, F.concat(F.array(F.lit(""), F.lit(f"## {title}"), F.lit("")), lines)).otherwise(F.array().cast("array<string>"))


def _each(items: Column, lines) -> Column:
    """The lines of every item, one after another; none for null."""
    return F.coalesce(F.flatten(F.transform(items, lines)), F.array().cast("array<string>"))


def manual_markdown(r: DataFrame) -> Column:
    """Markdown of sections.records(): title, summary, variants, tables, Description, Intrinsic, Flags, other, Exceptions, Operation."""
    variants = _each(F.col("instructions"), lambda v: F.array(F.concat(F.lit("- `"), v["mnemonic"], F.lit("` — "), v["description"])))
    named = lambda x: F.array(F.lit(""), F.concat(F.lit("## "), x["name"]), F.lit(""))
    flags = F.when(F.length("flag_affected") > 0, F.array("flag_affected"))
    raised = lambda e: F.concat(F.array(F.concat(F.lit("### "), e["name"]), F.lit("")), F.transform(e["lines"], lambda x: F.concat(F.lit("- "), x)), F.array(F.lit("")))
    code = F.when(F.length("operation") > 0, F.concat(F.array(F.lit("```C")), F.split("operation", "\n"), F.array(F.lit("```"))))
    parts = [
        F.array(F.concat(F.lit("# "), F.col("title")), F.lit(""), F.col("summary")),
        F.when(F.size(variants) > 0, F.concat(F.array(F.lit("")), variants)).otherwise(variants),
        _each(F.col("tables"), lambda t: F.concat(named(t), T.markdown_table(t["headers"], t["rows"]))),
        _block("Description", T.sentences(F.array_join("description", " "))),
        _block("Intel C/C++ Compiler Intrinsic Equivalent", F.col("c_and_cpp_equivalent")),
        _block("Flags Affected", flags),
        _each(F.col("other_sections"), lambda o: F.concat(named(o), o["lines"])),
        _block("Exceptions", _each(F.col("exceptions"), raised)),
        _block("Operation", code),
        F.array(F.lit("")),
    ]
    return F.array_join(F.flatten(F.array(*parts)), "\n")


def archive_markdown() -> Column:
    """Markdown of an XML record: title, brief, encodings, Encoding table, Description, Operands, Aliases, Decode, Operation, Notes."""
    bits = T.markdown_table(F.transform("bitfields", lambda b: T.bit_label(b["hibit"], b["width"])), F.array(F.transform("bitfields", lambda b: b["name"])))
    parts = [
        F.array(F.concat(F.lit("# "), F.col("heading")), F.lit(""), F.coalesce("brief", F.lit("")), F.lit("")),
        F.transform("encodings", lambda e: F.concat(F.lit("- `"), e["asm_template"], F.lit("` "), e["label"])),
        _section("Encoding", F.when(F.size("bitfields") > 0, bits)),
        _section("Description", F.col("description")),
        _section("Operands", F.transform("operand_explanations", lambda o: F.concat(F.lit("- "), o["symbol"], F.lit(": "), o["text"]))),
        _section("Aliases", F.transform("aliases", lambda a: F.concat(F.lit("- "), a["name"], F.when(F.size(a["preferred_conditions"]) > 0, F.concat(F.lit(" — Preferred when "), F.array_join(a["preferred_conditions"], "; "))).otherwise("")))),
        _section("Decode", _code(F.col("decode_pseudocode"))),
        _section("Operation", _code(F.col("operation"))),
        _section("Notes", F.transform("operational_notes", lambda n: F.concat(F.lit("- "), n))),
    ]
    return F.array_join(F.flatten(F.array(*parts)), "\n")


def enum_entries(docs: DataFrame, order: str) -> DataFrame:
    """(mnemonic, variant, docs): the first docs of each mnemonic, sorted; equal variants get a number."""
    first = docs.groupBy("mnemonic").agg(F.min_by("md", order).alias("docs")).withColumn("v", T.identifier(F.col("mnemonic")))
    return suffixed(first, "v", ["mnemonic"], "variant").select("mnemonic", "variant", "docs")


def manual_entries(files: DataFrame) -> DataFrame:
    """(mnemonic, variant, docs) of manual files (name, md): the first letter as it is, the others small."""
    variant = F.concat(F.substring("name", 1, 1), F.lower(F.substring(F.col("name"), F.lit(2), F.length("name"))))
    return files.select(F.col("name").alias("mnemonic"), variant.alias("variant"), F.col("md").alias("docs"))


def enum_text(entries: DataFrame, name: str) -> DataFrame:
    """The lines of one enum in order: its declaration, every entry as doc comments and variant, by mnemonic, and the closing brace."""
    comments = F.transform(F.split("docs", "\n"), lambda x: F.rtrim(F.concat(F.lit("    /// "), x)))
    rows = entries.select(F.lit(1).alias("at"), "mnemonic", F.concat(F.array_join(comments, "\n"), F.lit("\n    "), F.col("variant"), F.lit(",")).alias("value"))
    ends = entries.sparkSession.createDataFrame([(0, None, f"enum {name} {{"), (2, None, "}")], rows.schema)
    return rows.unionByName(ends).orderBy("at", "mnemonic").select("value")


def function_text() -> Column:
    """A documented function of a generated instruction (mnemonic, operation, body)."""
    docs = F.transform(T.dedent(F.split(F.coalesce("operation", F.lit("")), "\n")), lambda x: F.rtrim(F.concat(F.lit("/// "), x)))
    name = F.regexp_replace("mnemonic", "[^A-Za-z0-9_]", "_")
    return F.concat_ws("\n", F.lit("/// # Pseudocode"), F.lit("/// ```text"), F.array_join(docs, "\n"), F.lit("/// ```"), F.lit("#[box_to_static_reference]"), F.concat(F.lit("pub(super) fn "), name, F.lit("() -> &'static [IrStatement] {")), F.array_join("body", "\n"), F.lit("}"))


def generated_files(generated: DataFrame, arch: str) -> DataFrame:
    """(arch, first_letter, value): functions to be written by write.partitionBy('arch', 'first_letter').text."""
    return generated.where("body is not null").select(F.lit(arch).alias("arch"), F.lower(F.substring("mnemonic", 1, 1)).alias("first_letter"), function_text().alias("value"))


_SIGNED = ("g", "ge", "l", "le", "ng", "nge", "nl", "nle")  # conditions that compare SF with OF
# What a generated file begins with, and the helpers that it has where a function needs them.
IMPORTS = ("use super::{super::static_register::*, shortcuts::*};", "use crate::utils::Aos;", "use std::ops::Deref;", "")
HELPERS = {
    "jcc": (
        "#[inline]", "fn jcc(condition_data: Aos<IrData>) -> IrStatement {", "    let fallthrough = b::add(rip.clone(), instruction_byte_size());",
        "    condition(condition_data, [jump(o1())], [jump(fallthrough)])", "}", "",
    ),
    "cmovcc": ("#[inline]", "fn cmovcc(condition_data: Aos<IrData>) -> IrStatement {", "    condition(condition_data, [assign(o2(), o1(), o1_size())], [])", "}", ""),
    "setcc": (
        "#[inline]", "fn setcc(condition_data: Aos<IrData>) -> IrStatement {",
        "    condition(condition_data, [assign(c(1), o1(), o1_size())], [assign(c(0), o1(), o1_size())])", "}", "",
    ),
    "signed": (
        "#[inline]", "fn sf_eq_of() -> Aos<IrData> {", "    b::equal(sf.clone(), of.clone(), size_relative(sf.clone()))", "}", "",
        "#[inline]", "fn sf_ne_of() -> Aos<IrData> {", "    u::not(sf_eq_of())", "}", "",
    ),
}


def needed_helpers(generated: DataFrame) -> DataFrame:
    """(first_letter, jcc, cmovcc, setcc, signed): which helpers the file of a letter needs, by its mnemonics alone."""
    uses, signed = {}, F.lit(False)
    for helper, prefix in (("jcc", "j"), ("cmovcc", "cmov"), ("setcc", "set")):
        coded = lambda codes, prefix=prefix: F.col("mnemonic").isin(*(prefix + c for c in codes))
        uses[helper], signed = coded(X86_CONDITIONS), signed | coded(_SIGNED)
    any_ = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    return generated.where("body is not null").groupBy(F.lower(F.substring("mnemonic", 1, 1)).alias("first_letter")).agg(*(any_(c).alias(h) for h, c in uses.items()), any_(signed).alias("signed"))


def file_headers(generated: DataFrame, arch: str) -> DataFrame:
    """(arch, first_letter, value): the imports and needed helpers of every file; Aos is imported only for the helpers that take it."""
    lines = lambda x: F.array(*map(F.lit, x))
    none = F.array().cast("array<string>")
    first, aos, deref, blank = IMPORTS
    parts = [lines([first]), F.when(F.col("jcc") | F.col("cmovcc") | F.col("setcc"), lines([aos])).otherwise(none), lines([deref, blank])]
    parts += [F.when(F.col(h), lines(text)).otherwise(none) for h, text in HELPERS.items()]
    return needed_helpers(generated).select(F.lit(arch).alias("arch"), "first_letter", F.array_join(F.concat(*parts), "\n").alias("value"))


def write_generated(generated: DataFrame, arch: str, path: str) -> None:
    """Write whole generated files, a folder per letter; what was there before is removed first.

    A file is its header and then its functions by mnemonic; a letter's
    functions are one task's.
    """
    functions = generated_files(generated, arch).withColumn("at", F.concat(F.lit("1"), F.regexp_extract("value", r"pub\(super\) fn (\w+)", 1)))
    both = functions.unionByName(file_headers(generated, arch).withColumn("at", F.lit("0")))
    ordered = both.repartition("arch", "first_letter").sortWithinPartitions("arch", "first_letter", "at").drop("at")
    ordered.write.mode("overwrite").partitionBy("arch", "first_letter").text(path)


def page_dump(strings: DataFrame, pages: DataFrame) -> DataFrame:
    """(range_id, page_no, value): the text of each page of the ranges (range_id, page_no), its strings in order, a line each."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda s: s["text"])
    return strings.join(pages, "page_no").groupBy("range_id", "page_no").agg(F.array_join(ordered, "\n").alias("value"))


DASHES = "\n" + "-" * 50 + "\n"


def write_pages(pages: DataFrame, path: str) -> None:
    """Write text once, pages parted by a dashed line: nothing is done if the path exists.

    With range_id and page_no there is a folder a range, whose files hold runs
    of pages in order: no task holds more than the page it writes.
    """
    if "range_id" in pages.columns:
        ordered = pages.select("range_id", "page_no", "value").repartitionByRange("range_id", "page_no").sortWithinPartitions("range_id", "page_no").drop("page_no")
        ordered.write.mode("ignore").option("lineSep", DASHES).partitionBy("range_id").text(path)
    else:
        pages.select("value").write.mode("ignore").option("lineSep", DASHES).text(path)


def write_documents(files: DataFrame, folder: str, ending: str = ".md") -> DataFrame:
    """Write every row (name, md) as a file of its own under a folder that all executors share; (name, error), error null if it was written.

    A slash in a name becomes an underscore.  A task that runs again writes
    the same files anew; a file that cannot be written is told, not raised.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files_at, place = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        files_at.create_dir(place, recursive=True)
        for batch in batches:
            errors = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    with files_at.open_output_stream(f"{place}/{name.replace('/', '_')}{ending}") as out:
                        out.write((text or "").encode())
                    errors.append(None)
                except OSError as e:
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(errors, pa.string())], ["name", "error"])

    return files.select("name", "md").mapInArrow(work, "name string, error string")
