"""Tables, fonts and object streams of a manual, the older reader, reports, and whole generated files."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparquill.functions import geometry
from sparquill.functions import text as T
from sparquill.operators import dispatch, legacy, render, reports, sections, validate
from sparquill.plans import manual
from sparquill.sources import fonts, named_files, pdf, text_files, xml_archive


def _objects(parts: dict[int, bytes]) -> bytes:
    return b"%PDF-1.5\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (n, p) for n, p in parts.items())


def _stream(data: bytes, head: bytes = b"") -> bytes:
    packed = zlib.compress(data)
    return b"<< /Length %d /Filter /FlateDecode %s>>\nstream\n" % (len(packed), head) + packed + b"\nendstream"


FONT = b"<< /Type /Font /Subtype /TrueType /FirstChar 32 /Widths [" + b" 500" * 95 + b" ] >>"


def _page(texts: list[tuple], rules: list[tuple] = ()) -> bytes:
    out = b"".join(b"%g %g %g %g re f\n" % r for r in rules)
    return out + b"".join(b"/F1 1 Tf %d 0 0 %d %d %d Tm (%s) Tj\n" % (s, s, x, y, t.encode("latin-1")) for s, x, y, t in texts)


def _manual(*pages: bytes) -> bytes:
    """Page and font dictionaries lie in an object stream; resources are inherited."""
    kids = b" ".join(b"%d 0 R" % (10 + i) for i in range(len(pages)))
    inner = {2: b"<< /Type /Pages /Kids [%s] /Count %d /Resources << /Font << /F1 5 0 R >> >> >>" % (kids, len(pages)), 5: FONT}
    inner |= {10 + i: b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (100 + i) for i in range(len(pages))}
    places, at = [], 0
    for n, body in inner.items():
        places.append(b"%d %d" % (n, at))
        at += len(body) + 1
    head = b" ".join(places) + b" "
    packed = head + b"\n".join(inner.values())
    parts = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 3: _stream(packed, b"/Type /ObjStm /N %d /First %d " % (len(inner), len(head)))}
    return _objects(parts | {100 + i: _stream(p) for i, p in enumerate(pages)})


EDGES = [(9, 50, 790, "x"), (9, 50, 20, "y")]
RULES = [(50, y, 300.5, 0.5) for y in (600, 580, 560)] + [(x, 560, 0.5, 40.5) for x in (50, 200, 350)]


def test_manual_tables(spark, tmp_path):
    first = [(12, 50, 700, "ADDPD - Add"), (10, 50, 640, "Opcode"), (9, 55, 585, "Opcode/ Instruction"), (9, 205, 585, "Description"), (9, 55, 565, "66 0F 58 /r ADDPD xmm1"), (9, 205, 565, "Adds."), (10, 50, 500, "Operation"), (9, 50, 480, "IF a"), (9, 80, 460, "THENDEST := b;")]
    second = [(9, 50, 700, "FI;"), (10, 50, 660, "Table 1"), (9, 55, 585, "a"), (9, 205, 565, "b"), (10, 50, 500, "SIMD Floating-Point Exceptions"), (9, 50, 480, "None."), (9, 50, 440, "NOTES"), (9, 50, 420, "n1"), (10, 50, 380, "Other Exceptions"), (9, 50, 360, "o1")]
    path = tmp_path / "m.pdf"
    path.write_bytes(_manual(_page(EDGES + first, RULES), _page(EDGES + second, RULES)))
    records = manual.manual_records(spark, str(path), [(1, 3)])
    (r,) = records.collect()
    assert [tuple(i) for i in r.instructions] == [("ADDPD xmm1", "Adds.")]
    assert [(t.name, t.headers, t.rows) for t in r.tables] == [
        ("Instruction", ["Opcode/ Instruction", "Description"], [["66 0F 58 /r ADDPD xmm1", "Adds."]]),
        ("Table 1", ["a", ""], [["", "b"]]),
    ]
    assert r.operation == "IF a\n    THEN DEST := b;\nFI;" and [(e.name, e.lines) for e in r.exceptions] == [("SIMD Floating-Point Exceptions", ["None."]), ("Other Exceptions", ["o1"])]
    assert [(o.name, o.lines) for o in r.other_sections] == [("NOTES", ["n1"])] and r.description is None or r.description == []
    (f,) = manual.manual_files(records).collect()
    assert f.md.startswith("# ADDPD\n\nAdd\n\n- `ADDPD xmm1` — Adds.\n\n## Instruction\n\n| Opcode/ Instruction | Description |\n| --- | --- |\n| 66 0F 58 /r ADDPD xmm1 | Adds. |\n\n## Table 1\n")
    assert "\n## Exceptions\n\n### SIMD Floating-Point Exceptions\n\n- None.\n\n### Other Exceptions\n\n- o1\n\n" in f.md and "```C\nIF a\n    THEN DEST := b;\nFI;\n```" in f.md
    enum = [x.value for x in render.enum_text(render.manual_entries(manual.manual_files(records)), "X64").collect()]
    assert enum[0] == "enum X64 {" and enum[-1] == "}" and enum[1].endswith("\n    Addpd,") and "    ///\n" in enum[1]
    (page,) = manual.manual_pages(spark, str(path), [(1, 2)]).collect()
    assert page.value.split("\n")[:2] == ["x", "ADDPD - Add"]
    render.write_pages(manual.manual_pages(spark, str(path), [(1, 2)]), str(tmp_path / "dump"))
    render.write_pages(spark.createDataFrame([("other",)], "value string"), str(tmp_path / "dump"))
    assert spark.read.text(str(tmp_path / "dump")).first().value == "x"
    both = manual.manual_pages(spark, str(path), [(1, 3)])
    assert [r.page_no for r in both.orderBy("page_no").collect()] == [1, 2]
    render.write_pages(both, str(tmp_path / "both"))
    found = "".join(f.read_text() for f in sorted((tmp_path / "both" / "range_id=0").glob("part-*")))
    assert found.count("-" * 50) == 2 and found.index("ADDPD - Add") < found.index("Other Exceptions")
    manual.save_manual(spark, str(path), [(1, 3)], str(tmp_path / "md"))
    assert [(f.name, f.read_text()) for f in (tmp_path / "md").iterdir()] == [("ADDPD.md", manual.manual_files(records).first().md)]


def test_named_files(spark, tmp_path):
    """All files or none: a task that fails leaves nothing."""
    rows = spark.createDataFrame([("a/b", "x"), ("c", None), ("d", "é")], "name string, md string")
    named_files.save(rows, str(tmp_path / "ok"), ".txt")
    assert {f.name: f.read_text() for f in (tmp_path / "ok").iterdir()} == {"a_b.txt": "x", "c.txt": "", "d.txt": "é"}
    broken = rows.repartition(1).unionByName(spark.createDataFrame([(None, "y")], "name string, md string"))
    with pytest.raises(Exception, match="no name"):
        named_files.save(broken, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists() or list((tmp_path / "none").iterdir()) == []
    named_files.save(rows.limit(0), str(tmp_path / "empty"))


def test_save_archive(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_bytes(XML)
    manual.save_archive(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert [f.name for f in (tmp_path / "out").iterdir()] == ["A__A.md"]


def test_predictors():
    rows = [bytes([1, 2, 3, 4]), bytes([5, 6, 250, 8]), bytes([9, 9, 9, 9])]
    for kind in range(5):
        data, above = b"", bytes(4)
        for row in rows:
            coded = bytearray([kind])
            for i, x in enumerate(row):
                left, up, corner = (row[i - 1] if i else 0), above[i], (above[i - 1] if i else 0)
                p = left + up - corner
                paeth = left if abs(p - left) <= abs(p - up) and abs(p - left) <= abs(p - corner) else up if abs(p - up) <= abs(p - corner) else corner
                coded.append((x - (0, left, up, (left + up) // 2, paeth)[kind]) & 255)
            data, above = data + bytes(coded), row
        assert pdf.unpredicted(data, 10 + kind, 4) == b"".join(rows)
    assert pdf.unpredicted(bytes([1, 1, 1, 1]), 2, 4) == bytes([1, 2, 3, 4]) and pdf.unpredicted(b"abc", 1, 1) == b"abc"


def _font(glyphs: dict[int, int], advances: list[int]) -> bytes:
    """A font program with advances and one character map of single characters (format 4)."""
    codes = sorted(glyphs)
    half = len(codes) + 1
    pack = lambda values, kind="H": b"".join(struct.pack(f">{kind}", v) for v in values)
    body = pack([*codes, 0xFFFF]) + pack([0]) + pack([*codes, 0xFFFF]) + pack([(glyphs[c] - c) & 0xFFFF for c in codes] + [1]) + pack([0] * half)
    sub = struct.pack(">HHHHHHH", 4, 14 + len(body), 0, 2 * half, 0, 0, 0) + body
    tables = {b"cmap": struct.pack(">HHHHL", 0, 1, 3, 1, 12) + sub, b"hhea": bytes(34) + struct.pack(">H", len(advances)), b"hmtx": b"".join(struct.pack(">Hh", a, 0) for a in advances)}
    at, head, data = 12 + 16 * len(tables), b"", b""
    for tag, table in tables.items():
        head += struct.pack(">4sLLL", tag, 0, at + len(data), len(table))
        data += table
    return b"\0\1\0\0" + struct.pack(">HHHH", len(tables), 0, 0, 0) + head + data


def test_two_byte_fonts(spark):
    # glyph 1 is both a Greek letter and a mathematical sign, which comes first
    program = _font({0x41: 3, 0x221E: 1, 0x3B1: 1, 0x222B: 2}, [0, 1348, 700, 650])
    parts = {
        1: b"<< /Subtype /Type0 /DescendantFonts [2 0 R] /ToUnicode 5 0 R >>", 2: b"<< /FontDescriptor 3 0 R /DW 900 /W [7 [554 600] 20 21 851] >>", 3: b"<< /FontFile2 4 0 R >>",
        4: _stream(program), 5: _stream(b"1 beginbfchar <0007> <0041> endbfchar"), 6: b"<< /Subtype /Type0 /DescendantFonts 7 0 R /ToUnicode 5 0 R >>", 7: b"[8 0 R]", 8: b"<< /DW 900 /W [8 [554 600] 20 21 851] >>",
    }
    doc = pdf.Document(_objects(parts))
    raw = spark.createDataFrame([tuple(doc.font(n).values()) for n in (1, 6)], "object int, wide boolean, to_unicode string, first_char int, default_width double, widths string, advances array<int>, glyphs array<struct<codepoint:int,glyph:int>>")
    rows = fonts.codes(raw).collect()
    points = lambda n: {r.code: r.codepoint for r in rows if r.object == n and r.codepoint is not None}
    widths = lambda n: {r.code: round(r.width, 4) for r in rows if r.object == n and r.width is not None}
    assert points(1) == {1: 0x221E, 2: 0x222B, 3: 0x41, 7: 0x41} and widths(1) == {1: 1.348, 2: 0.7, 3: 0.65, 7: 0.65}
    assert points(6) == {7: 0x41} and widths(6) == {7: 0.9, 8: 0.554, 9: 0.6, 20: 0.851, 21: 0.851}


def test_geometry(spark):
    f = lambda *x: tuple(F.lit(float(v)) for v in x)
    row = spark.range(1).select(
        geometry.contains(f(0, 0, 10, 10), f(-1, 0, 11, 10)).alias("a"), geometry.contains(f(0, 0, 10, 10), f(-2, 0, 5, 5)).alias("b"),
        geometry.same_line(F.lit(10.0), F.lit(4.0), F.lit(9.0)).alias("c"), geometry.same_line(F.lit(10.1), F.lit(4.0), F.lit(9.0)).alias("d"),
        geometry.near_on_line(F.lit(0.0), F.lit(18.6), F.lit("é"), F.lit(10.0)).alias("e"), geometry.near_on_line(F.lit(0.0), F.lit(18.7), F.lit("é"), F.lit(10.0)).alias("f"),
    ).first()
    assert tuple(row) == (True, False, True, False, True, False)


def test_legacy_texts():
    tm = lambda x, y: ("Tm", [9.0, 0.0, 0.0, 9.0, float(x), float(y)])
    ops = [tm(50, 700), ("TJ", [[b"ab\n", -900.0, b"c", 10.0, b"\x92"]]), ("Td", [0.0, -2.0]), ("Tj", [b"low"]), ("T*", []), ("Tj", [b"\\\x95x"])]
    found = legacy.texts(ops)
    assert [t[0] for t in found] == ["ab \x01c'", "low", " - x"] and [round(float(t[2]), 2) for t in found] == [700, 682, 669.85]
    a, b, far = ["left", 50.0, 700.0, 9.0, 9.0], ["right", 70.0, 703.0, 9.0, 9.0], ["far", 300.0, 700.0, 9.0, 9.0]
    assert [t[0] for t in legacy.merged([b, far, a])] == ["leftright", "far"]


def _merged_by_lists(found):
    """The plain form: a list that is searched from its start for each text."""
    left, out = [list(t) for t in found], []
    while left:
        now = left.pop(0)
        while (at := next((i for i, o in enumerate([*out, *left]) if legacy._together(now, o)), None)) is not None:
            other = out.pop(at) if at < len(out) else left.pop(at - len(out))
            a, b = (now, other) if now[1] < other[1] else (other, now)
            now = [a[0] + b[0], a[1], a[2], max(a[3], b[3]), max(a[4], b[4])]
        out.append(now)
    return out


def test_legacy_merging():
    rng = random.Random(2)
    for trial in range(300):
        f = np.float32
        page = [["t" * rng.randrange(1, 9), f(rng.randrange(0, 300)), f(rng.choice([700, 702, 690.5, 680, 650, 400 + rng.randrange(90)])), f(rng.choice([6, 9, 12])), f(rng.choice([0, 6, 9, 12]))] for _ in range(rng.randrange(1, 50))]
        assert legacy.merged(page) == _merged_by_lists(page), trial
    long = [["word", np.float32(60 * (i % 10)), np.float32(12 * (i // 10)), np.float32(9), np.float32(9)] for i in range(100_000)]
    assert len(legacy.merged(long)) == 100_000 and legacy.merged([]) == []


def test_legacy_records(spark):
    one = ["header", "AAA", "Opcode/", "37", "Description", "Adds.", "Operation", "x := y;", "Flags Affected", "ZF.", "Protected Mode Exceptions", "#UD", "1.\x01 note", "AAA-ASCII ", "Adjust", "Vol. 2A3-18"]
    two = ["header", "Operation", "z;", "3-19Vol. 2A", "AAA-ASCII Adjust"]
    three = ["header", "title", "Opcode", "Description", "text", "F2XM1-Other", "Vol. 2A3-20"]
    lone = ["header", "no footer"]
    pages = spark.createDataFrame([(n, i, t) for n, p in enumerate((one, two, three, lone), 1) for i, t in enumerate(p)], "page_no int, place int, text string")
    feet = {r.page_no: (r.last, r.title, r.summary) for r in legacy.footers(pages).collect()}
    assert feet == {1: (12, "AAA", "ASCII Adjust"), 2: (2, "AAA", "ASCII Adjust"), 3: (4, "F2XM1", "Compute (2^x)-1")}
    rows = {r.title: r for r in legacy.records(pages).collect()}
    a = rows["AAA"]
    assert (a.description, a.operation, a.flag_affected, [(e.name, e.lines) for e in a.exceptions]) == (["Adds."], "x := y;z;", "ZF.", [("Protected Mode Exceptions", ["#UD"])])
    assert rows["F2XM1"].description == ["text"] and len(rows) == 2
    ok = spark.createDataFrame([("ADD-x",), ("T1-x",), ("KSHIFTLW/KSHIFTLB/KSHIFTLQ/KSHIF",), ("Cmovcc-y",), ("FCMOVcc-y",)], "t string").select(legacy.is_titled(F.col("t")).alias("x")).collect()
    assert [r.x for r in ok] == [True, False, True, False, True]


XML = b"""<instructionsection id="A" type="instruction"><heading>A</heading><explanations><explanation><symbol>&lt;shift&gt;</symbol>
<definition encodedin="shift"><intro>Is the shift, encoded in <field>shift</field></intro><table><tgroup><thead><row><entry>shift</entry><entry>meaning</entry></row></thead>
<tbody><row><entry>00</entry><entry>LSL</entry><entry>more</entry></row><row><entry>01</entry><entry>ASR</entry></row><row><entry>lone</entry></row></tbody></tgroup></table></definition></explanation>
<explanation><symbol>X</symbol><account><intro><para>a</para><para>b</para></intro></account></explanation><explanation><symbol>none</symbol></explanation></explanations></instructionsection>"""


def test_explanation_tables():
    record = xml_archive.parse_file("a.xml", XML)
    assert record["operand_explanations"] == [
        {"symbol": "<shift>", "text": "Is the shift, encoded in shift 00 → LSL, 01 → ASR, lone"},
        {"symbol": "X", "text": "a b"},
    ]


def test_operation_sections(spark):
    docs = ["# A\n## Operation\n```C\nx := y\n```\nend", "# B\nOperation\n\nx := y\nz\n\nOther Exceptions\nn", "# C\nOperation\nq\n## Next\nr", "# D", "## Operation\nno fence"]
    got = spark.createDataFrame([(d,) for d in docs], "d string").select(T.operation_of(F.col("d"), text_files.STOPS).alias("o")).collect()
    assert [r.o for r in got] == ["x := y", "x := y\nz", "q", "", ""]


def test_reports(spark):
    functions = spark.createDataFrame(
        [("arm", "b", "real_ir", "ARM template: b"), ("arm", "a", "real_ir", "r"), ("arm", "x", "exception", "why"), ("arm", "s", "skipped", "no operation pseudocode"), ("arm", "al", "alias", None)], "arch string, mnemonic string, status string, reason string"
    )
    (r,) = reports.generation(functions).collect()
    assert (r.n, r.with_operation, r.n_real_ir, r.n_exception, r.n_todo, r.n_skipped, r.percent_real_ir, r.percent_exception) == (4, 3, 2, 1, 0, 1, 66, 33)
    lines = [x.value for x in reports.generation_lines(functions).orderBy("place").collect()]
    assert lines == ["--- SUCCESSFUL (Real IR): 2 ---", "  a: r", "  b: ARM template: b", "--- EXCEPTION STUBS: 1 ---", "  x: why", "--- SKIPPED (no operation pseudocode): 1 ---", "  s"]
    lines = spark.createDataFrame([("f", "todo!() todo!()"), ("f", "x"), ("g", "y")], "file string, line string")
    assert [tuple(r) for r in reports.todos(lines).collect()] == [("f", 2)]
    checked = spark.createDataFrame([("a", ["x"], []), ("b", [], []), ("c", None, ["y", "z"])], "name string, filename_issues array<string>, content_issues array<string>")
    assert tuple(reports.files(checked).first()) == (3, 2, 1, 2) and tuple(reports.files(checked.limit(0)).first()) == (0, 0, 0, 0)
    judged = spark.createDataFrame([("f", "CORRECT"), ("f", "WRONG"), ("g", "EXCEPTION_STUB")], "file string, verdict string")
    assert {tuple(r) for r in reports.verdict_files(judged).collect()} == {("f", 2, 1, 0, 1, 0), ("g", 1, 0, 0, 0, 1)}
    assert [r.verdict for r in reports.first_errors(judged, ["verdict"], 1).collect()] == ["CORRECT"]


def test_comparison(spark):
    schema = "name string, body string"
    ours = spark.createDataFrame([("std", "jump(o1()) b::add(rax.clone())"), ("mov", "assign(o2(), o1(), o1_size()) zf"), ("only", "x"), ("same", "halt")], schema)
    theirs = spark.createDataFrame([("std_", "jump_by_call(o1())"), ("mov", "assign(u::not(o3()), o1(), o1_size())"), ("same", "halt")], schema)
    got = {r.name: (r.differences, r.severity) for r in validate.compared(ours, theirs).collect()}
    assert got == {
        "std": (["extra operators: b::add", "missing statements: jump_by_call"], "failure"),
        "mov": (["missing operators: u::not", "missing operands: o3()"], "failure"),
        "same": ([], "passed"),
    }
    assert tuple(reports.severities(validate.compared(ours, theirs)).first()) == (3, 1, 2, 0)
    signed = spark.range(1).select(validate.signature(F.lit("rax.clone() xmm12 rbx eaxes tmp64")).alias("s")).first().s
    assert signed.registers == ["rax", "rbx", "tmp64", "xmm12"] and signed.flags == []


def test_function_bodies(spark):
    files = spark.createDataFrame([("a.rs", "pub fn x() -> T { one { two } }\npub(super) fn y() { y1 }"), ("b.rs", "pub fn x() {\n later\n}")], "file string, content string")
    assert {tuple(r) for r in text_files.function_bodies(files).collect()} == {("x", "later"), ("y", "y1")}


def test_generated_files(spark, tmp_path):
    rows = [("jg", "ZF", "real_ir", ["    let cond = x;", "    [jcc(cond)].into()"]), ("jmp", "RIP", "real_ir", ["    [jump(o1())].into()"]), ("add", "  a\n    b", "real_ir", ["    x"]), ("skip", "", "skipped", None)]
    made = spark.createDataFrame(rows, "mnemonic string, operation string, status string, body array<string>")
    needs = {r.first_letter: tuple(r)[1:] for r in render.needed_helpers(made).collect()}
    assert needs == {"j": (True, False, False, True), "a": (False, False, False, False)}
    for _ in range(2):  # what was there before goes
        render.write_generated(made, "x86_64", str(tmp_path / "out"))
    j, a = (spark.read.text(str(tmp_path / f"out/arch=x86_64/first_letter={x}"), wholetext=True).collect() for x in "ja")
    assert len(j) == len(a) == 1
    j, a = j[0].value, a[0].value
    assert j.startswith("use super::{super::static_register::*, shortcuts::*};\nuse crate::utils::Aos;\nuse std::ops::Deref;\n\n#[inline]\nfn jcc(") and "fn sf_eq_of()" in j and j.index("fn jg()") < j.index("fn jmp()")
    assert a.startswith("use super::{super::static_register::*, shortcuts::*};\nuse std::ops::Deref;\n\n/// # Pseudocode\n/// ```text\n/// a\n///   b\n/// ```")


def test_files_by_name(spark, tmp_path):
    files = spark.createDataFrame([("A/B", "x"), ("C", None)], "name string, md string")
    assert {tuple(r) for r in render.write_documents(files, str(tmp_path / "md")).collect()} == {("A/B", None), ("C", None)}
    assert (tmp_path / "md" / "A_B.md").read_text() == "x" and (tmp_path / "md" / "C.md").read_text() == ""


def test_arm_generation(spark, tmp_path):
    enum = "enum Arm {\n" + "".join(f"    /// # {n}\n    /// ## Operation\n    /// ```\n    /// {o}\n    /// ```\n{a}    {n},\n" for n, o, a in (("Frob", "X[d] = X[n];", ""), ("Loopy", "for i = 0 to 3", ""), ("Ubfm", "X[d] = X[n];", "    /// ## Aliases\n    /// - UXTH (x)\n"))) + "}\n"
    (tmp_path / "e.rs").write_text(enum)
    out = {r.mnemonic: r for r in manual.functions_of(spark, str(tmp_path / "e.rs"), "arm").collect()}
    assert out["frob"].reason == "ARM pseudocode translated" and out["frob"].body == ["    let stmt_0 = assign(o2(), o1(), o1_size());", "    [stmt_0].into()"]
    assert out["loopy"].reason == "ARM unsupported: for-loop (SIMD element-wise)" and out["loopy"].status == "exception"
    assert out["ubfm"].reason == "ARM template: ubfm" and out["uxth"].status == "alias" and out["uxth"].body
    branch = spark.createDataFrame([("b.eq", "x")], "mnemonic string, operation string")
    from sparquill.functions import registry

    assert dispatch.generate(branch, registry.templates(spark), "arm").first().reason in ("ARM conditional branch: b.eq", "ARM template: b.eq")


def test_table_without_heading(spark):
    tables = spark.createDataFrame([(1, 0, 50.0)], "page_no int, table_id int, top double")
    lines = spark.createDataFrame([(1, 0, "Low", 10.0, 10.0, 20.0)], "page_no int, seq int, text string, font_scale double, y0 double, y1 double")
    assert sections.table_heading(tables, lines).first().heading is None


@pytest.mark.parametrize(("title", "names"), [("A[b,c]X/YZQ", ["AbX", "YZQ", "AcX"]), ("VF[,N]M[132, 213]PH", ["VFM132PH", "VFM213PH", "VFNM132PH", "VFNM213PH"])])
def test_bracket_names(title, names):
    from sparquill.functions.names import expand

    assert expand(title) == names
