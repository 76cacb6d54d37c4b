"""From an instruction to its body: exact template, condition code, ranked patterns, compiler, fallback."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.functions import bodies
from sparquill.functions import pseudocode as P
from sparquill.functions import text as T


def ranked(value: Column, rules: list[tuple[str, str]]) -> Column:
    """The expression of the first pattern that matches from the start, or null."""
    return F.coalesce(*(F.when(value.rlike(p), F.lit(x)) for p, x in rules))


_CANDIDATES = "map<string,array<struct<rank:int,pattern:string,body:string>>>"


def candidate(mnemonic: Column) -> Column:
    """struct(rank, pattern, body) of the lowest rank that fits a packed instruction, or null.

    The ranked table is one literal, bucketed by the two letters after a first
    v; only the rows of a mnemonic's bucket are tried, in order of rank.
    """
    table = F.from_json(F.lit(json.dumps(bodies.packed())), _CANDIDATES)
    bucket = F.try_element_at(table, F.substring(F.regexp_replace(mnemonic, "^v", ""), 1, 2))
    return F.get(F.filter(bucket, lambda c: F.regexp_like(mnemonic, c["pattern"])), F.lit(0))


def simd_body(mnemonic: Column) -> Column:
    """Body lines of the first pattern that an x86 mnemonic matches, or null."""
    found = F.coalesce(candidate(mnemonic)["body"], ranked(mnemonic, bodies.families()))
    return F.split(F.replace(found, F.lit(bodies.MNEMONIC), mnemonic), "\n")


def condition_body(mnemonic: Column, arch: str) -> Column:
    """Body lines of a conditional jump, move or set (x86) or branch (ARM), or null."""
    if arch == "x86_64":
        shapes = (("j", ["    [jcc(cond)].into()"]), ("cmov", ["    [cmovcc(cond)].into()"]), ("set", ["    [setcc(cond)].into()"]))
    else:
        onward = "    let fallthrough = b::add(pc.clone(), instruction_byte_size());"
        shapes = (("b.", [onward, "    [condition(cond, [jump(o1())], [jump(fallthrough)])].into()"]),)
    made = []
    for prefix, rest in shapes:
        test = P.condition_of(mnemonic, prefix, arch)
        made.append(F.when(test.isNotNull(), F.array(F.concat(F.lit("    let cond = "), test, F.lit(";")), *map(F.lit, rest))))
    return F.coalesce(*made)


# What the report says of each step.
REASONS = {
    "x86_64": {"compiled": "pseudocode translated", "fallback": "fallback: pseudocode too complex or untranslatable"},
    "arm": {"compiled": "ARM pseudocode translated", "fallback": "ARM fallback: pseudocode too complex"},
    "skipped": "no operation pseudocode",
}


def _answer(step: Column, lines: Column, mnemonic: Column, stubs: bool = True) -> Column:
    """struct(body, reason): the step and the mnemonic, and whether the body only raises."""
    told = F.concat(step, F.when(stubbed(lines), " (exception)").otherwise("") if stubs else F.lit(""), F.lit(": "), mnemonic)
    return F.when(lines.isNotNull(), F.struct(lines.alias("body"), told.alias("reason")))


def stubbed(lines: Column) -> Column:
    return F.exists(lines, lambda x: F.contains(x, F.lit("exception(")))


def generate(instructions: DataFrame, templates: DataFrame, arch: str) -> DataFrame:
    """instructions (mnemonic, operation, ...) with body, status (real_ir, exception, skipped) and reason (the step that answered).

    Rows without pseudocode are skipped even if there is a template.  The
    compiler sees only rows that no cheaper step has answered.  The templates
    are broadcast: a few hundred built-in rows and those that the user gives.
    """
    mnemonic, arm = F.col("mnemonic"), arch == "arm"
    said = REASONS["arm" if arm else "x86_64"]
    own = templates.where(F.col("arch") == arch).select("mnemonic", F.col("body").alias("_template"))
    by_code = "ARM conditional branch" if arm else T.first_of((mnemonic.startswith("j"), "conditional jump"), (mnemonic.startswith("cmov"), "conditional move"), default="conditional set")
    steps = [
        _answer(F.lit("ARM template" if arm else "template"), F.col("_template"), mnemonic),
        _answer(F.lit(by_code) if arm else by_code, condition_body(mnemonic, arch), mnemonic, stubs=False),
    ]
    if not arm:
        steps.append(_answer(F.lit("SIMD pattern"), simd_body(mnemonic), mnemonic))
    has = F.length(F.trim(F.coalesce("operation", F.lit("")))) > 0
    known = instructions.join(F.broadcast(own), "mnemonic", "left").withColumn("_has", has).withColumn("_got", F.when(has, F.coalesce(*steps))).drop("_template")
    known = known.withColumn("body", F.col("_got.body")).withColumn("reason", F.col("_got.reason")).drop("_got")
    misses = known.where("_has and body is null")
    unsupported = P.arm_unsupported(F.col("operation")) if arm else F.lit(None).cast("string")
    compiled = misses.withColumn("_not", unsupported).withColumn("body", P.compile_operation(F.when(F.col("_not").isNull(), F.col("operation")), arch))
    told = T.first_of((F.col("_not").isNotNull(), F.concat(F.lit("ARM "), F.col("_not"))), (F.col("body").isNotNull(), said["compiled"]), default=said["fallback"])
    both = known.where("not _has or body is not null").unionByName(compiled.withColumn("reason", told).drop("_not"))
    lines = F.coalesce("body", F.array(F.concat(F.lit('    [exception("'), F.coalesce("mnemonic", F.lit("")), F.lit('")].into()'))))
    return (
        both.withColumn("body", F.when(F.col("_has"), lines))
        .withColumn("status", F.when(~F.col("_has"), "skipped").when(stubbed(F.col("body")), "exception").otherwise("real_ir"))
        .withColumn("reason", F.when(F.col("_has"), F.col("reason")).otherwise(REASONS["skipped"]))
        .drop("_has")
    )


def alias_functions(generated: DataFrame) -> DataFrame:
    """(mnemonic, operation, body) of the ARM aliases that generated instructions name and that have a body of their own.

    The extracting aliases need a translated instruction that prefers them;
    a name that an instruction has already is left to it.
    """
    table = bodies.arm_aliases()
    lines = F.create_map(*(x for name, rows in table.items() for x in (F.lit(name), F.array(*map(F.lit, rows)))))
    named = generated.where("status != 'skipped'").select("operation", "status", F.explode("aliases").alias("a")).where(F.col("a.mnemonic").isin(*table))
    extracting = F.col("a.mnemonic").isin("ubfx", "sbfx")
    kept = named.where(~extracting | ((F.col("status") == "real_ir") & F.contains(F.coalesce("a.condition", F.lit("")), F.lit("BFXPreferred"))))
    once = kept.groupBy(F.col("a.mnemonic").alias("mnemonic")).agg(F.min("operation").alias("operation"))
    return once.join(generated.where("body is not null").select("mnemonic"), "mnemonic", "left_anti").withColumn("body", F.element_at(lines, F.col("mnemonic")))
