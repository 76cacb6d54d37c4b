"""Rule engines: issues of a row, verdicts, signature differences, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.functions import arm_rules

#: The 33 names of the conditional jump.
JCC = (
    "JA JAE JB JBE JC JCXZ JECXZ JRCXZ JE JG JGE JL JLE JNA JNAE JNB JNBE JNC JNE JNG JNGE JNL JNLE JNO JNP JNS JNZ JO JP JPE JPO JS JZ"
).split()


def issues(rules: list[tuple[Column, str]]) -> Column:
    """The messages of the rules that hold, in order."""
    return F.filter(F.array(*(F.when(c, F.lit(m)) for c, m in rules)), lambda x: x.isNotNull())


def verdict(found: Column, stub: Column, minor: str) -> Column:
    """EXCEPTION_STUB, CORRECT without issues, ACCEPTABLE if all match the pattern `minor`, else WRONG."""
    return (
        F.when(stub, "EXCEPTION_STUB")
        .when(F.size(found) == 0, "CORRECT")
        .when(F.forall(found, lambda x: x.rlike(minor)), "ACCEPTABLE")
        .otherwise("WRONG")
    )


def report(judged: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per verdict, rolled up over the keys, with the integer percentage of CORRECT."""
    n = F.count("*")
    of = lambda v: F.count_if(F.col("verdict") == v)
    return judged.rollup(*keys).agg(
        F.grouping_id().cast("long").alias("level"),
        n.alias("n"),
        of("CORRECT").alias("n_correct"),
        of("ACCEPTABLE").alias("n_acceptable"),
        of("WRONG").alias("n_wrong"),
        F.floor(100 * of("CORRECT") / n).cast("long").alias("percent"),
    )


def order_of(body: Column, first: str, then: str) -> Column:
    """Whether `first` stands before `then` in a text; null if either is missing."""
    a, b = F.instr(body, first), F.instr(body, then)
    return F.when((a > 0) & (b > 0), a < b)


# What a signature looks for.
STATEMENTS = "assign condition jump jump_by_call halt exception calc_flags_automatically extend_undefined_flags type_specified assertion".split()
SIGNED_FLAGS = "cf zf sf of af pf df tf".split()
SIGNED_REGISTERS = (
    "rax rbx rcx rdx rsp rbp rsi rdi rip eax ebx ecx edx esp ebp esi edi ax bx cx dx al ah bl bh cl ch dl dh r8 r9 r10 r11 r12 r13 r14 r15"
).split() + [r"tmp\d+", r"xmm\d+", r"ymm\d+", r"zmm\d+"]
SIGNATURE = {
    "operators": r"[bu]::\w+",
    "statements": rf"\b(?:{'|'.join(STATEMENTS)})\b",
    "flags": rf"\b(?:{'|'.join(SIGNED_FLAGS)})\b",
    "operands": r"\bo[1-4]\(\)",
    "registers": rf"\b(?:{'|'.join(SIGNED_REGISTERS)})\b",
}


def signature(body: Column) -> Column:
    """Sorted sets of operators, statements, flags, operands and registers of a generated body; null for null."""
    every = lambda p: F.sort_array(F.array_distinct(F.regexp_extract_all(body, F.lit(p), 0)))
    return F.when(body.isNotNull(), F.struct(*(every(p).alias(part) for part, p in SIGNATURE.items())))


def signature_difference(ours: Column, theirs: Column) -> Column:
    """Messages: by part, what only the other has (missing), and the operators that only we have (extra); registers are not compared."""
    out = []
    for word, part, a, b in (("missing", "operators", theirs, ours), ("extra", "operators", ours, theirs), *(("missing", p, theirs, ours) for p in ("statements", "flags", "operands"))):
        left = F.array_except(a[part], b[part])
        out.append(F.when(F.size(left) > 0, F.concat(F.lit(f"{word} {part}: "), F.array_join(left, ", "))))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def compared(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(name, differences, severity) of the functions (name, body) that both have; ours `std` answers to theirs `std_`."""
    side = lambda df, name: df.select(F.col("name"), signature(F.col("body")).alias(name))
    own = side(ours, "ours").withColumn("key", F.col("name"))
    # a name of theirs with the underscore counts only where the plain one is missing
    other = side(theirs, "theirs").withColumn("key", F.when(F.col("name") == "std_", "std").otherwise(F.col("name")))
    other = other.groupBy("key").agg(F.min_by("theirs", F.length("name")).alias("theirs"))
    found = own.join(other, "key").select("name", signature_difference(F.col("ours"), F.col("theirs")).alias("differences"))
    return found.withColumn("severity", severity(F.col("differences")))


def severity(messages: Column) -> Column:
    """failure for missing operators, statements or flags; warning for anything else; passed without messages."""
    fails = F.exists(messages, lambda m: m.rlike("^missing (operators|statements|flags)"))
    return F.when(F.size(messages) == 0, "passed").when(fails, "failure").otherwise("warning")


def missing_names(found: DataFrame, column: str, expected: list[str] = JCC) -> DataFrame:
    """The expected names that a column lacks."""
    names = found.sparkSession.createDataFrame([(n,) for n in expected], f"{column} string")
    return names.join(found.select(column).distinct(), column, "left_anti")


# Sections of which a rendered archive record has at least one.
SECTIONS = ("Encoding", "Operands", "Description", "Decode", "Operation")
_RAISED = "⁻⁰¹²³⁴⁵⁶⁷⁸⁹₀₁₂₃₄₅₆₇₈₉"  # superscript and subscript signs


def filename_rules(name: Column, arch: str) -> Column:
    """Issues of a file's name without its ending; a null name counts as empty."""
    name = F.coalesce(name, F.lit(""))
    said = lambda text: F.concat(F.lit("filename '"), name, F.lit(f"' {text}"))
    odd = ~name.rlike(r"^\p{Lu}")
    if arch == "x86_64":  # one issue at most
        raised = F.when(name.rlike(f"[{_RAISED}\ufffd]"), F.array(said("contains superscript/subscript/replacement chars"))).otherwise(F.array().cast("array<string>"))
        found = F.when(odd, F.array(said("doesn't start with uppercase"))).otherwise(raised)
    else:
        found = _told(
            (odd, said("doesn't start with uppercase")),
            (~F.contains(name, F.lit("__")), said("missing '__' separator (heading__id)")),
            (F.contains(name, F.lit("\ufffd")), said("contains replacement char U+FFFD")),
        )
    return F.when(name == "", F.array(F.lit("empty filename"))).otherwise(found)


def _told(*rules: tuple[Column, Column]) -> Column:
    return F.filter(F.array(*(F.when(holds, message) for holds, message in rules)), lambda x: x.isNotNull())


def content_rules(content: Column, name: Column, arch: str) -> Column:
    """Issues of a rendered Markdown file, in one pass over its lines; a null content counts as empty.

    Without a title nothing else is judged.  Issues of the whole file and of
    its lines are told rule by rule, each with the file's name, those of lines
    with the line number.  Sections found are told sorted.
    """
    arm = arch != "x86_64"
    content, name = F.coalesce(content, F.lit("")), F.coalesce(name, F.lit(""))
    lines = F.split(content, "\n")
    told = lambda rank, at, *parts: F.struct(F.lit(rank).alias("rank"), at.alias("at"), F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts)).alias("message"))
    whole, none = F.lit(0), F.lit(None).cast("struct<rank:int,at:int,message:string>")
    keep = lambda *found: F.filter(F.array(*(F.when(holds, issue).otherwise(none) for holds, issue in found)), lambda x: x.isNotNull())
    strip = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    short = lambda x: F.substring(x, 1, 60)

    filled = F.size(F.filter(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))), lambda x: strip(x) != ""))
    heads = F.transform(F.filter(lines, lambda x: x.startswith("## ")), lambda x: strip(F.substring(x, 4, 1 << 30)))
    unknown = F.length(content) - F.length(F.replace(content, F.lit("\ufffd"), F.lit("")))
    bullets = F.size(F.filter(lines, lambda x: x.rlike("^\\s*⁻")))
    of_file = [
        (strip(F.substring(F.element_at(lines, 1), 3, 1 << 30)) == "", told(0, whole, name, ": empty H1 title")),
        (filled < 2, told(1, whole, name, ": too little content (", filled.cast("string"), " non-empty lines)")),
        (F.size(heads) == 0, told(2, whole, name, ": no H2 sections found")),
        (unknown > 0, told(8, whole, name, ": contains ", unknown.cast("string"), " replacement character(s) U+FFFD")),
    ]
    if arm:
        of_file += [
            (~F.arrays_overlap(heads, F.array(*map(F.lit, SECTIONS))), told(3, whole, name, ": missing standard sections (has: ", F.array_join(F.array_sort(F.array_distinct(heads)), ", "), ")")),
        ]
    else:
        of_file += [(bullets > 0, told(9, whole, name, ": ", bullets.cast("string"), " line(s) start with superscript-minus '⁻' as bullet (should be '-')"))]

    def step(state: Column, x: Column) -> Column:
        line, at = x["line"], x["at"]
        here = lambda rank, *parts: told(rank, at, name, ":", at.cast("string"), ": ", *parts)
        fence, row = line.rlike(r"^\s*```\s*$"), line.rlike(r"^\|(?s:.*)\|\s*$") | line.rlike(r"^\|\s*$")
        code, operands = state["code"] & ~fence, F.when(line == "## Operands", True).when(line.startswith("## "), False).otherwise(state["operands"])
        asm = F.substring(line, 4, 1 << 30)
        asm = F.left(asm, F.greatest(F.length(asm) - 1, F.lit(0)))
        found = [(row & ~state["table"] & x["next"].isNotNull() & ~x["next"].rlike(r"^\|[\s\-:|]+\|$"), here(5, "table header not followed by separator row"))]
        if arm:
            found += [
                (line.startswith("- `") & line.endswith("`") & F.contains(asm, F.lit("><")), here(4, "ASM template missing spaces: '", short(asm), "...'")),
                *((code & line.rlike(rf"\b{word}[A-Z]"), here(7, f"pseudocode missing space after '{word}': '", short(strip(line)), "'")) for word in ("then", "else")),
                (operands & (line != "## Operands") & (strip(line) != "") & ~line.startswith("- "), here(10, "broken operand line (not a bullet): '", short(strip(line)), "'")),
            ]
        return F.struct(
            (state["code"] != fence).alias("code"), row.alias("table"), operands.alias("operands"), F.concat(state["found"], keep(*found)).alias("found")
        )

    no, numbered = F.lit(False), F.transform(lines, lambda x, i: F.struct(x.alias("line"), (i + 1).alias("at"), F.get(lines, i + 1).alias("next")))
    start = F.struct(no.alias("code"), no.alias("table"), no.alias("operands"), F.array().cast("array<struct<rank:int,at:int,message:string>>").alias("found"))
    open_fence = lambda s: keep((s["code"], told(6, whole, name, ": unclosed code fence"))) if arm else keep((no, none))
    every = F.aggregate(numbered, start, step, lambda s: F.concat(s["found"], open_fence(s), keep(*of_file)))
    listed = F.transform(F.array_sort(every), lambda x: x["message"])
    return F.when(~F.element_at(lines, 1).startswith("# "), F.array(F.concat(name, F.lit(": missing H1 title")))).otherwise(listed)


# What a pseudocode says, and the operator that the body then has.
_IMPLIED = (
    ("ADD", "b::add", ("dest := dest + src", "dest ← dest + src")),
    ("SUB", "b::sub", ("dest := dest - src", "dest := dest - (src")),
    ("AND", "b::and", ("dest := dest and src",)),
    ("OR", "b::or", ("dest := dest or src",)),
    ("XOR", "b::xor", ("dest := dest xor src",)),
)
MINOR = r"unknown_data|should use u::zero_extend"


def _flag_list(body: Column) -> Column:
    return F.regexp_extract(body, r"calc_flags_automatically\([^)]+,\s*&\[([^\]]+)\]", 1)


def _structure(body: Column) -> list[tuple[Column, Column]]:
    """Rules of every generated function."""
    final = F.regexp_extract(body, r"\[([^\]]+)\]\.into\(\)", 1)
    late = F.coalesce(~order_of(final, "calc_flags", "assignment"), F.lit(False))
    return [
        (late, F.lit("calc_flags_automatically AFTER assign (should be before)")),
        (F.contains(body, F.lit("unknown_data()")), F.lit("contains unknown_data() — expression could not be parsed")),
    ]


def x86_issues(name: Column, pseudocode: Column, body: Column) -> Column:
    """Issues of one generated x86 function: order of flags, operators that the pseudocode implies, flags of families, single instructions.

    Flags are read from a call whose arguments before them hold no closing
    parenthesis; other calls are not judged.
    """
    text = F.lower(F.coalesce(pseudocode, F.lit("")))
    has = lambda *parts: F.greatest(*(F.contains(body, F.lit(p)) for p in parts)) if len(parts) > 1 else F.contains(body, F.lit(parts[0]))
    says = lambda parts: F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(text, p))
    flags = _flag_list(body)
    sets = lambda f: F.contains(flags, F.lit(f))
    counted, logic = name.isin("add", "sub", "adc", "adcx", "adox", "sbb", "neg", "cmp"), name.isin("and", "or", "xor", "test")
    is_ = lambda n: name == n
    rules = [
        *_structure(body),
        *((says(parts) & ~has(ir), F.lit(f"pseudocode implies {op} but body lacks {ir}")) for op, ir, parts in _IMPLIED),
        (name.isin("inc", "dec") & sets("&cf"), F.concat(name, F.lit(" should not affect CF in calc_flags"))),
        *((counted & (flags != "") & ~sets(f"&{f}"), F.concat(name, F.lit(f": missing &{f} in calc_flags"))) for f in ("of", "sf", "zf", "cf", "pf")),
        *((logic & sets(f"&{f.lower()}"), F.concat(name, F.lit(f": {f} should not be in calc_flags (should be explicitly cleared)"))) for f in ("OF", "CF")),
        (is_("mov") & ~has("zero_extend", "sign_extend") & has("assign(o2()"), F.lit("MOV should use u::zero_extend(o2())")),
        (is_("push") & ~has("b::sub", "sp"), F.lit("PUSH should decrement stack pointer")),
        (is_("pop") & ~has("b::add", "sp"), F.lit("POP should increment stack pointer")),
        (is_("call") & ~has("jump_by_call", "jump("), F.lit("CALL should use jump_by_call or jump")),
        (is_("ret") & ~has("jump("), F.lit("RET should use jump()")),
        (is_("jmp") & ~has("jump("), F.lit("JMP should use jump()")),
    ]
    return _told(*rules)


def with_arm_issues(functions: DataFrame, into: str = "issues") -> DataFrame:
    """functions (name, pseudocode, body, any more) with the issues of each as an ARM function.

    The rule table is a fixed list of some hundred mnemonics, so it is
    broadcast; a function's rules are judged by one expression over their
    array.  A null pseudocode counts as empty, a null body as empty, and a name
    without rules has those of every function only.
    """
    spark = functions.sparkSession
    table = spark.createDataFrame(list(arm_rules.rules().items()), arm_rules.SCHEMA).withColumnsRenamed({"name": "_rule_name", "rules": "_rules"})
    name, body = F.col("name"), F.coalesce("body", F.lit(""))
    code = F.coalesce("pseudocode", F.lit(""))
    text, flags = F.lower(code), _flag_list(body)
    has = lambda x: F.contains(body, F.lit(x))
    says = lambda x: F.contains(text, F.lit(x))
    carries, subtracts, shared = says("addwithcarry("), name.isin(arm_rules.SUBTRACTS), name.isin(list(arm_rules.LOGICAL))
    own = ~shared & ~says("case op")
    general = _told(
        *_structure(body),
        (carries & subtracts & ~has("b::sub"), F.lit("pseudocode has AddWithCarry (subtraction variant) but body lacks b::sub")),
        (carries & ~subtracts & ~has("b::add"), F.lit("pseudocode has AddWithCarry but body lacks b::add")),
        (own & says("operand1 eor operand2") & ~has("b::xor"), F.lit("pseudocode has EOR but body lacks b::xor")),
        (own & says("operand1 and operand2") & ~has("b::and"), F.lit("pseudocode has AND but body lacks b::and")),
    )
    preferred = F.regexp_extract_all(code, F.lit(r"- ([A-Z0-9]+)(?: \([^)]*\))? — Preferred when"), 1)
    writes_o1 = body.rlike(r"assign\([^,]+,\s*o1\(\)")

    def broken(r: Column) -> Column:
        applies = (r["alias"].isNull() | F.array_contains(preferred, r["alias"])) & (~r["with_code"] | (code != ""))
        unmet = F.exists(r["needs"], lambda clause: ~F.exists(clause, lambda x: F.contains(body, x)))
        unset = r["flag"].isNotNull() & (flags != "") & ~F.contains(flags, r["flag"])
        return applies & (unmet | F.exists(r["bans"], lambda x: F.contains(body, x)) | F.coalesce(unset, F.lit(False)) | (r["keeps_o1"] & writes_o1))

    single = F.transform(F.filter(F.coalesce("_rules", F.array().cast(table.schema["_rules"].dataType)), broken), lambda r: r["message"])
    joined = functions.join(F.broadcast(table), name == F.col("_rule_name"), "left")
    return joined.withColumn(into, F.concat(general, single)).drop("_rule_name", "_rules")
