"""Vectors of the native schemas."""

import io
import tarfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparquill.functions import bodies, names, pseudocode, registry
from sparquill.functions import text as T
from sparquill.operators import dispatch, folds, glyphs, sections, tables, validate
from sparquill.plans import manual
from sparquill.sources import fonts, text_files, xml_archive

RECTS = {
    "fit": ([(0, 100, 100, 0), (0, 50, 100, 0), (0, 50, 0, 50), (100, 50, 0, 50)], [(0, 50, 100, 100)]),
    "thick": ([(5, 100, 95, 3), (5, 50, 95, 4), (0, 54, 5, 46), (100, 54, 6, 46)], [(5, 54, 100, 100)]),
    "x-unfit 1": ([(5, 100, 93, 3), (5, 50, 95, 4), (0, 54, 5, 46), (100, 54, 6, 46)], []),
    "x-unfit 2": ([(5, 100, 95, 3), (7, 50, 93, 4), (0, 54, 5, 46), (100, 54, 6, 46)], []),
    "y-unfit 1": ([(5, 100, 95, 3), (5, 50, 95, 4), (0, 54, 5, 46), (100, 56, 6, 44)], []),
    "y-unfit 2": ([(5, 100, 95, 3), (5, 50, 95, 4), (0, 54, 5, 44), (100, 54, 6, 46)], []),
}


@pytest.mark.parametrize("case", RECTS)
def test_cells(case):
    rects, expected = RECTS[case]
    boxes = np.array([(x, y, x + w, y + h) for x, y, w, h in rects], np.float32)
    assert [tuple(map(float, c)) for g in tables.groups(boxes) for c in tables.grid_cells(boxes[g])] == expected


def test_cells_from_operations(spark):
    num = lambda x: ("num", float(x), None, None)
    rows = []
    for i, r in enumerate(RECTS["thick"][0]):
        rows += [(1, 2 * i, "re", [num(v) for v in r]), (1, 2 * i + 1, "f", [])]
    kind = "struct<kind:string,num:float,bytes:binary,items:array<struct<kind:string,num:float,bytes:binary>>>"
    ops = spark.createDataFrame(rows, f"page_no int, op_idx int, operator string, operands array<{kind}>")
    assert [tuple(r)[3:] for r in tables.cells(tables.filled_rects(ops)).collect()] == [(5.0, 54.0, 100.0, 100.0)]


@pytest.mark.parametrize(
    ("text", "ir"),
    [
        ("DEST + SRC", "b::add(o1(), o2())"),
        ("DEST * SRC << 1", "b::mul(o1(), b::shl(o2(), c(1)))"),
        ("DEST OR SRC AND 1", "b::or(o1(), b::and(o2(), c(1)))"),
        ("DEST - SRC - 1", "b::sub(b::sub(o1(), o2()), c(1))"),
        ("0FFH", "c(0x0FF)"), ("0x1F", "c(0)"), ("7", "c(7)"),
        ("SignExtend(SRC)", "u::sign_extend(o2())"), ("NOT DEST", "u::not(o1())"), ("EAX[7:0]", "eax.clone()"), ("", "unknown_data()"), ("Foo(1)", "unknown_data()"),
    ],
)
def test_expressions(spark, text, ir):
    assert _said(spark, pseudocode.expression, text) == ir


def _said(spark, function, text, *args, **options):
    """What a column function makes of one text."""
    return spark.createDataFrame([(text,)], "s string").select(function(F.col("s"), *args, **options).alias("x")).first().x


def test_compiler_parts(spark):
    said = lambda *args, **options: _said(spark, *args, **options)
    assert said(pseudocode.condition, "DEST = 0") == "b::equal(o1(), c(0), o1_size())"
    assert said(pseudocode.condition, "DEST >= 0", compat=False).startswith("u::not(")
    assert said(pseudocode.arm_expression, "X[n] EOR X[m]") == "b::xor(o2(), o3())"
    assert said(pseudocode.translate, "temp := SRC\nDEST := temp + 1;") == ["    let v_0 = o2();", "    let stmt_1 = assign(b::add(v_0, c(1)), o1(), o1_size());", "    [stmt_1].into()"]
    assert said(pseudocode.translate, "FOR j := 0 to 3\nDEST := SRC") is None
    assert len(registry.X86_CONDITIONS) == 30 and len(registry.ARM_CONDITIONS) == 17


def test_names():
    assert len(names.expand("Jcc")) == 33
    assert names.expand("MOVDQA,VMOVDQA32/64") == ["MOVDQA", "VMOVDQA32", "MOVDQ64"]
    assert names.expand("VF[,N]MADD[132,213,231]PH", compat=True) == ["VFMADD", "VFNMADD"]
    assert len(names.expand("VF[,N]MADD[132,213,231]PH")) == 6
    assert names.expand("AB/CD") == ["AB", "CD"]


def test_strings(spark):
    row = spark.range(1).select(
        T.parse_title(F.lit("AAA—ASCII Adjust After Addition")).alias("p"),
        T.merged_mnemonic(F.lit("66 0F 58 /r ADDPD xmm1, xmm2/m128")).alias("m"),
        T.slug(F.lit("ADD (immediate)"), F.lit("ADD_addsub_imm")).alias("s"),
        T.identifier(F.lit("B.cond")).alias("i"),
        T.repair_operation(F.lit("zerEoLinSg-mEask ; ing")).alias("r"),
        T.repair_operation(F.lit("THENDEST")).alias("r2"),
        T.bit_label(F.lit(31), F.lit(3)).alias("b"),
        T.code_point(F.lit(8800)).alias("c"),
        T.is_title(F.lit("MOVDQA—Move")).alias("t"),
        T.is_title(F.lit("Description")).alias("t2"),
        folds.dominant_scale(F.array(*(F.lit(x).cast("float") for x in (9.0, 9.2, 6.0, 6.1)))).alias("d"),
    ).first()
    assert tuple(row.p) == ("AAA", "ASCII Adjust After Addition")
    assert (row.m, row.s, row.i, row.b, row.c) == ("ADDPD xmm1, xmm2/m128", "ADD_immediate__ADD_addsub_imm", "B_cond", "31:29", "≠")
    assert row.r.startswith("ELSE ; zeroing-masking") and row.r2 == "THEN DEST"
    assert row.t and not row.t2 and row.d == 6.0


def test_tounicode(spark):
    text = "1 beginbfchar <03ab><2212> <03bb> <221E> endbfchar 1 beginbfrange <03b6><03b7><2264> <0001><0002>[<0041><0042>] endbfrange"
    found = fonts.to_unicode(spark.createDataFrame([(1, text)], "object int, to_unicode string"))
    assert {r.code: r.codepoint for r in found.collect()} == {0x3AB: 0x2212, 0x3BB: 0x221E, 0x3B6: 0x2264, 0x3B7: 0x2265, 1: 0x41, 2: 0x42}


def _pdf(content: bytes) -> bytes:
    packed = zlib.compress(content)
    parts = [
        b"<< /Type /Catalog /Pages 2 0 R >>",
        b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>",
        b"<< /Type /Page /Parent 2 0 R /Contents 4 0 R /Resources << /Font << /F1 5 0 R >> >> >>",
        b"<< /Length %d /Filter /FlateDecode >>\nstream\n" % len(packed) + packed + b"\nendstream",
        b"<< /Type /Font /Subtype /TrueType /FirstChar 32 /Widths [" + b" 500" * 95 + b" ] >>",
    ]
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (i + 1, p) for i, p in enumerate(parts))


def test_manual(spark, tmp_path):
    lines = [(12, "AAA - Adjust"), (10, "Description"), (9, "Adjusts the sum. Sets flags"), (10, "Operation"), (9, "DEST := SRC;")]
    content = b"".join(b"/F1 1 Tf %d 0 0 %d 50 %d Tm (%s) Tj\n" % (s, s, 700 - 60 * i, t.encode()) for i, (s, t) in enumerate(lines))
    # a line above and below, so that no line of the record is near the page's edge
    content = b"/F1 1 Tf 9 0 0 9 50 790 Tm (x) Tj\n" + content + b"9 0 0 9 50 20 Tm (y) Tj\n"
    path = tmp_path / "m.pdf"
    path.write_bytes(_pdf(content))
    (r,) = manual.manual_records(spark, str(path), [(1, 2)]).collect()
    assert (r.title, r.summary, r.operation, r.description) == ("AAA", "Adjust", "DEST := SRC;", ["Adjusts the sum. Sets flags"])
    (f,) = manual.manual_files(manual.manual_records(spark, str(path), [(1, 2)])).collect()
    assert f.name == "AAA" and "Sets flags." in f.md


def test_superscripts():
    scales, middles = np.array([10, 10, 10, 6], np.float32), np.array([5, 5, 5, 9], np.float32)
    assert list(glyphs.raised(scales, middles)) == [0, 0, 0, 1]


XML = b"""<?xml version="1.0"?><instructionsection id="ADD_imm" title="x" type="instruction"><docvars><docvar key="mnemonic" value="ADD"/></docvars>
<heading>ADD (immediate)</heading><desc><brief><para>Add.</para></brief><authored><para>Adds  two.</para></authored></desc>
<classes><iclass name="A"><regdiagram><box hibit="31" name="sf"/><box hibit="30" width="3" name="op"/></regdiagram>
<encoding name="e1" label="32-bit"><asmtemplate><text>ADD </text><a>W</a></asmtemplate></encoding>
<ps_section><ps><pstext section="Decode">d = 1;</pstext></ps></ps_section></iclass></classes>
<explanations><explanation><symbol>W</symbol><account><intro><para>a register</para></intro></account></explanation></explanations>
<ps_section><ps><pstext section="Execute">X[d] = X[n] + X[m];</pstext></ps></ps_section></instructionsection>"""


def test_archive(spark, tmp_path):
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as tar:
        for name, data in (("d/add.xml", XML), ("d/alias.xml", XML.replace(b'type="instruction"', b'type="alias"')), ("d/x.txt", b"")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    (r,) = xml_archive.instructions(xml_archive.xml_files(spark, str(tmp_path / "a.tar.gz"))).collect()
    assert (r.id, r.mnemonic, r.brief, r.operation, r.decode_pseudocode) == ("ADD_imm", "ADD", "Add.", "X[d] = X[n] + X[m];", "d = 1;")
    assert r.encodings[0].asm_template == "ADD W" and [b.hibit for b in r.bitfields] == [31, 30] and r.operand_explanations[0].text == "a register"
    (e,) = manual.archive_entries(spark, str(tmp_path / "a.tar.gz")).collect()
    assert (e.mnemonic, e.variant) == ("ADD", "Add") and "| 31 | 30:28 |" in e.docs


def test_stream(spark, tmp_path):
    from sparquill.streaming import archive

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "add.xml").write_bytes(XML)
    archive.follow(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).first().heading == "ADD (immediate)"


ENUM = """pub enum X {
    /// # ADD
    /// ## Operation
    /// ```
    /// DEST := DEST + SRC;
    /// ```
    Add,
    /// # LOOP
    /// ## Operation
    /// ```
    /// DEST := SRC << 1;
    /// ```
    /// ## Aliases
    /// - FOO (x) — Preferred when a
    Loopx,
    /// # HLT
    Hlt,
    stray
    /// ## Operation
    /// ```
    /// x
    /// ```
    Ja,
    /// ## Operation
    /// ```
    /// IF ZF = 0 THEN RIP := DEST; FI;
    /// ```
    Vaddps,
}
"""


def test_generator(spark, tmp_path):
    (tmp_path / "e.rs").write_text(ENUM)
    out = {r.mnemonic: r for r in manual.functions_of(spark, str(tmp_path / "e.rs"), "x86_64").collect()}
    assert {k: r.status for k, r in out.items()} == {"add": "real_ir", "loopx": "real_ir", "hlt": "skipped", "ja": "real_ir", "vaddps": "real_ir"}
    assert out["loopx"].body == ["    let stmt_0 = assign(b::shl(o2(), c(1)), o1(), o1_size());", "    [stmt_0].into()"]
    assert out["vaddps"].body == ["    let assignment = assign(b::add(o2(), o3()), o1(), o1_size());", "    [assignment].into()"]
    assert out["ja"].body[-1] == "    [jcc(cond)].into()" and {k: r.reason for k, r in out.items()}["loopx"] == "pseudocode translated"
    assert out["loopx"].aliases[0].mnemonic == "foo"
    from sparquill.operators import render

    code = render.generated_files(manual.functions_of(spark, str(tmp_path / "e.rs"), "x86_64"), "x86_64")
    code.coalesce(1).select("value").write.text(str(tmp_path / "code"))
    functions = text_files.generated_functions(text_files.numbered_lines(spark, str(tmp_path / "code")), "x86_64")
    judged = {r.name: r for r in manual.verdicts(functions).collect()}
    assert judged["add"].verdict == "CORRECT" and judged["loopx"].pseudocode == "DEST := SRC << 1;"


def test_sets(spark):
    a = "let x = assign(b::add(o1(), o2()), o1(), o1_size());"
    row = spark.range(1).select(validate.signature_difference(validate.signature(F.lit(a)), validate.signature(F.lit(a.replace("add", "sub")))).alias("d"))
    (d,) = row.select("d", validate.severity(F.col("d")).alias("s")).collect()
    assert d.d == ["missing operators: b::sub", "extra operators: b::add"] and d.s == "failure"
    assert validate.missing_names(spark.createDataFrame([("JA",)], "name string"), "name").count() == 32


def test_content_rules(spark):
    broken = """# ADD -- A64

- `ADD <Xd><Xn>`
| a | b |
| 1 | 2 |

## Operands
- fine
stray \ufffd
## Other
```
if a thenX elseY
"""
    texts = [("A__1", broken), ("B__2", "none"), ("C__3", "# \nx"), ("D__4", "# D\n## Operation\n```\nx then Y\n```\n| a |\n|---|\n|"), (None, None)]
    files = spark.createDataFrame(texts, "name string, content string")
    got = {r.name: r for r in files.select("name", *(validate.content_rules(F.col("content"), F.col("name"), a).alias(a) for a in ("arm", "x86_64"))).collect()}
    assert got["A__1"].arm == [
        "A__1:3: ASM template missing spaces: 'ADD <Xd><Xn>...'",
        "A__1:4: table header not followed by separator row",
        "A__1: unclosed code fence",
        "A__1:12: pseudocode missing space after 'else': 'if a thenX elseY'",
        "A__1:12: pseudocode missing space after 'then': 'if a thenX elseY'",
        "A__1: contains 1 replacement character(s) U+FFFD",
        "A__1:9: broken operand line (not a bullet): 'stray \ufffd'",
    ]
    assert got["A__1"].x86_64 == ["A__1:4: table header not followed by separator row", "A__1: contains 1 replacement character(s) U+FFFD"]
    assert got["B__2"].arm == ["B__2: missing H1 title"] and got[None].arm == [": missing H1 title"]
    assert got["C__3"].arm == ["C__3: empty H1 title", "C__3: too little content (1 non-empty lines)", "C__3: no H2 sections found", "C__3: missing standard sections (has: )"]
    assert got["D__4"].arm == [] and got["D__4"].x86_64 == []
    raised = spark.range(1).select(validate.content_rules(F.lit("# A\n## B\n  ⁻ c\n⁻d"), F.lit("a"), "x86_64").alias("c")).first().c
    assert raised == ["a: 2 line(s) start with superscript-minus '⁻' as bullet (should be '-')"]
    names = spark.createDataFrame([("Add__x",), ("add",), ("A²",), ("",), (None,)], "n string")
    rows = names.select("n", *(validate.filename_rules(F.col("n"), a).alias(a) for a in ("arm", "x86_64"))).collect()
    assert [len(r.arm) for r in rows] == [0, 2, 1, 1, 1] and [len(r.x86_64) for r in rows] == [0, 1, 1, 1, 1]


def test_routing_keeps_sections_over_pages(spark):
    rows = [(0, 1, 0, "stray", 9.0), (0, 1, 1, "AAA—One", 12.0), (0, 1, 2, "Description", 10.0), (0, 2, 0, "goes on", 9.0), (0, 2, 1, "BBB—Two", 12.0), (0, 2, 2, "nowhere", 9.0)]
    lines = spark.createDataFrame(rows, "range_id int, page_no int, seq int, text string, font_scale double")
    got = {r.title: r for r in sections.records(sections.routed(lines)).collect()}
    assert got["AAA"].description == ["goes on"] and got["BBB"].description == ["nowhere"]


def test_ranked(spark):
    names = "vaddpd vmaxss kortestb ktestw kshiftrb fisubr fcompp fxsave fother verr vzeroall vprolvd other".split()
    rows = spark.createDataFrame([(n,) for n in names], "m string").select("m", dispatch.simd_body(F.col("m")).alias("b")).collect()
    got = {r.m: r.b and " ".join(x.strip() for x in r.b) for r in rows}
    one = lambda x: f"let assignment = assign({x}, o1(), o1_size()); [assignment].into()"
    assert got["vaddpd"] == one("b::add(o2(), o3())") and got["vmaxss"] == one("b::sub(o3(), o2())")
    assert got["kortestb"] == one("b::or(o2(), o3())") and got["kshiftrb"] == one("b::shr(o2(), o3())")
    assert got["ktestw"].startswith("let and_val = b::and(o1(), o2());") and got["fcompp"].startswith("let sub = b::sub(o1(), o2());")
    assert got["fisubr"].startswith("let op = b::sub(o1(), o2());") and got["fxsave"] == got["vzeroall"] == "[].into()"
    assert got["fother"] == '[exception("fother")].into()' and got["verr"] == '[exception("verr")].into()' and got["other"] is None
    assert got["vprolvd"] == one("b::or(b::shl(o2(), o3()), b::shr(o2(), b::sub(bit_size_of_o2(), o3())))")


def test_templates():
    x86, arm = bodies.x86(), bodies.arm()
    stubs = lambda table: sum(any("exception(" in x for x in lines) for lines in table.values())
    assert (len(x86), stubs(x86), len(arm), stubs(arm)) == (310, 148, 285, 75)
    assert len(x86["bswap"]) == 42 and x86["cmpsw"][3].endswith("size_result_byte(c(2)), &[&of, &sf, &zf, &af, &cf, &pf]);")
    assert arm["ldapursb"] == ["    let assignment = sign_extend(o2(), o1(), o1_size());", "    [assignment].into()"]
    assert arm["sbfm"][-1] == "    [select, extend_shift, assignment].into()" and all("o3()" not in "".join(bodies.arm_aliases()[n]) for n in ("uxth", "sxth", "sxtw"))


def test_aliases(spark):
    alias = "array<struct<title:string,mnemonic:string,condition:string>>"
    rows = [("ubfm", "x", "real_ir", ["a"], [("t", "ubfx", "BFXPreferred(x)"), ("t", "lsl", "c"), ("t", "uxth", "c")]), ("sbfm", "y", "exception", ["a"], [("t", "sbfx", "BFXPreferred(y)"), ("t", "uxth", None)])]
    made = spark.createDataFrame(rows, f"mnemonic string, operation string, status string, body array<string>, aliases {alias}")
    assert {(r.mnemonic, r.operation) for r in dispatch.alias_functions(made).collect()} == {("ubfx", "x"), ("uxth", "x")}


def test_x86_issues(spark):
    carry = "calc_flags_automatically(add, size, &[&of, &sf])"
    rows = [
        ("adc", "DEST := DEST + SRC", f"let calc_flags = {carry};\n[assignment, calc_flags].into()"),
        ("inc", None, "calc_flags_automatically(add, size, &[&cf])"),
        ("mov", "", "assign(o2(), o1(), o1_size())"),
        ("and", "", "calc_flags_automatically(x, size, &[&of, &zf])"),
        ("call", "", "x"),
        ("add", "DEST := DEST + SRC", "\n".join(bodies.x86()["add"])),
    ]
    made = spark.createDataFrame(rows, "name string, pseudocode string, body string")
    got = {r.name: r.i for r in made.select("name", validate.x86_issues(F.col("name"), F.col("pseudocode"), F.col("body")).alias("i")).collect()}
    assert got["adc"] == [
        "calc_flags_automatically AFTER assign (should be before)", "pseudocode implies ADD but body lacks b::add",
        "adc: missing &zf in calc_flags", "adc: missing &cf in calc_flags", "adc: missing &pf in calc_flags",
    ]
    assert got["inc"] == ["inc should not affect CF in calc_flags"] and got["mov"] == ["MOV should use u::zero_extend(o2())"]
    assert got["and"] == ["and: OF should not be in calc_flags (should be explicitly cleared)"] and len(got["call"]) == 1 and got["add"] == []


def test_arm_issues(spark):
    every = "&[&pstate_n, &pstate_z, &pstate_c, &pstate_v]"
    rows = [
        ("adds", "AddWithCarry(a, b)", "let calc_flags = calc_flags_automatically(x, size, &[&pstate_n, &pstate_z]);"),
        ("subs", "x = AddWithCarry(a, NOT(b))", f"b::sub calc_flags_automatically(x, size, {every})"),
        ("orn", None, "none"), ("orn2", "operand1 EOR operand2", "none"), ("orr", "case op of", "none"),
        ("cbz", "", "condition( jump(o2()) equal fallthrough instruction_byte_size()"), ("tbnz", "", "condition(jump(o2())"),
        ("cmp", "", "calc_flags_automatically; assign(x, o1(), o1_size())"), ("adrp", "", "b::and(pc, 0xfff)"),
        ("bfm", "- BFI (x) — Preferred when y", "b::sar("), ("other", None, None), (None, None, "unknown_data()"),
    ]
    made = spark.createDataFrame(rows, "name string, pseudocode string, body string")
    got = {r.name: r.issues for r in validate.with_arm_issues(made).collect()}
    assert got["adds"] == ["pseudocode has AddWithCarry but body lacks b::add", "adds: missing &pstate_c in calc_flags", "adds: missing &pstate_v in calc_flags"]
    assert got["subs"] == got["orn"] == got["cbz"] == got["adrp"] == got["other"] == []
    assert got["orn2"] == ["pseudocode has EOR but body lacks b::xor"] and got["orr"] == ["pseudocode implies b::or for orr but not found in body"]
    assert got["tbnz"][0] == "tbnz should use shift+mask for bit test" and len(got["tbnz"]) == 3
    assert got["cmp"] == ["cmp should not write to destination register"] and got[None] == ["contains unknown_data() — expression could not be parsed"]
    assert sum("BFI" in x for x in got["bfm"]) == 3 and not any("BFXIL" in x for x in got["bfm"])


def test_arm_templates_have_no_wrong_body(spark):
    """The archive's own templates and alias bodies break no rule, so each is CORRECT or a stub."""
    rows = [(n, "arm", None, "\n".join(lines), any("exception(" in x for x in lines)) for n, lines in {**bodies.arm(), **bodies.arm_aliases()}.items()]
    made = spark.createDataFrame(rows, "name string, arch string, pseudocode string, body string, is_exception boolean")
    judged = {r.name: r for r in manual.verdicts(made).collect()}
    assert len(judged) == len(rows)
    assert {n: r.issues for n, r in judged.items() if r.verdict not in ("CORRECT", "EXCEPTION_STUB")} == {}
