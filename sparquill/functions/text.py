"""Scalar string functions as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters with superscript and subscript forms.
SUPER = ("0123456789+-=()nix", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁼⁽⁾ⁿⁱˣ")
SUB = ("0123456789+-=()", "₀₁₂₃₄₅₆₇₈₉₊₋₌₍₎")

# Text of the bytes outside 20-7E.
BYTE_TEXT = {
    0x02: "≠", 0x03: "≥", 0x04: "≤", 0x05: "*", 0x06: "∞", 0x07: "π", 0x08: "Š", 0x09: "ε", 0x0A: "Σ", 0x0B: "σ", 0x0C: "√",
    0x82: ",", 0x85: "…", 0x87: "⁄", 0x8A: "-", 0x8F: "≠", 0x91: "'", 0x92: "'", 0x93: '"', 0x94: '"', 0x95: "-", 0x96: "-", 0x97: "-", 0x99: "™",
    0xAB: "<<", 0xAE: "®", 0xB1: "±", 0xB2: "²", 0xB3: "³", 0xB5: "μ", 0xBC: "¼", 0xBD: "½", 0xD7: "×", 0xF7: "÷",
}
UNKNOWN = "�"
_DASHES = "[—–\u0097]"


def first_of(*cases: tuple[Column, object], default: object = None) -> Column:
    """The value of the first case that holds."""
    out = F.when(cases[0][0], cases[0][1])
    for condition, value in cases[1:]:
        out = out.when(condition, value)
    return out.otherwise(default)


def byte_to_text(code: Column) -> Column:
    """Text of a single-byte code; U+FFFD if it has none."""
    table = F.create_map(*(F.lit(x) for pair in BYTE_TEXT.items() for x in pair))
    return F.when(code.between(0x20, 0x7E), F.char(code)).otherwise(F.coalesce(F.try_element_at(table, code), F.lit(UNKNOWN)))


def code_point(n: Column) -> Column:
    """The character of a code point of the basic plane."""
    return F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE")


def superscript(s: Column) -> Column:
    return F.translate(s, *SUPER)


def subscript(s: Column) -> Column:
    return F.translate(s, *SUB)


def normalize_whitespace(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def sentences(s: Column) -> Column:
    """Pieces between ". ", each ending with a full stop; none for an empty text."""
    pieces = F.filter(F.split(s, r"\. "), lambda p: F.trim(p) != "")
    return F.transform(pieces, lambda p: F.when(p.endswith("."), p).otherwise(F.concat(p, F.lit("."))))


def scale_class(scale: Column) -> Column:
    return first_of((scale > 11, "Title"), (scale > 9.5, "Heading"), (scale > 8.5, "Body"), default="SmallText")


def title_name(s: Column) -> Column:
    """The part before the first dash, " - " or hyphen."""
    t = F.trim(s)
    return F.trim(
        first_of(
            (t.rlike(_DASHES), F.element_at(F.split(t, _DASHES, 2), 1)),
            (F.contains(t, F.lit(" - ")), F.substring_index(t, " - ", 1)),
            default=F.substring_index(t, "-", 1),
        )
    )


def is_title(s: Column) -> Column:
    """An instruction title: capitals, digits and a few signs, with two capitals in a row; or Jcc."""
    name = title_name(s)
    shaped = F.trim(s).rlike("^[A-Z]") & name.rlike(r"^[A-Z0-9/,\[\] .]+$") & name.rlike("[A-Z]{2}")
    return F.coalesce(shaped | (name == "Jcc"), F.lit(False))


def parse_title(s: Column) -> Column:
    """struct(title, summary): split at the first separator that has text on both sides, else at the first hyphen."""
    cases = []
    for sep in ("—", "–", " - ", "\u0097", "-"):
        left, right = F.trim(F.substring_index(s, sep, 1)), F.trim(F.substring(s, F.locate(sep, s) + F.lit(len(sep)), F.length(s)))
        cases.append((F.contains(s, F.lit(sep)) & (left != "") & (right != ""), F.struct(left.alias("title"), right.alias("summary"))))
    return first_of(*cases, default=F.struct(F.trim(s).alias("title"), F.lit("").alias("summary")))


def detect_section(s: Column) -> Column:
    """The kind of section that a heading opens, or null."""
    t = F.trim(s)
    return first_of(
        (t.startswith("Opcode") | t.isin("Instruction", "Instruction Operand Encoding"), "Instruction"),
        (t == "Description", "Description"),
        (t == "Operation", "Operation"),
        (t.isin("Flags Affected", "FPU Flags Affected"), "FlagsAffected"),
        (F.contains(t, F.lit("Intrinsic")), "Intrinsic"),
        (t.endswith("Exceptions"), "Exceptions"),
        (t.startswith("Table ") | (t == "Effective Operand Size") | (t == "NOTES"), "Other"),
    )


def slug(heading: Column, ident: Column) -> Column:
    """File name of a heading and an id: signs dropped, / and . to _, words joined by _."""
    plain = F.translate(F.regexp_replace(heading, r"[(),]", ""), "/.", "__")
    return F.concat(F.regexp_replace(F.trim(plain), r"\s+", "_"), F.lit("__"), ident)


def identifier(s: Column) -> Column:
    """An identifier: . to _, other signs dropped, first letter upper, rest lower; X before a digit; Unknown if empty."""
    kept = F.regexp_replace(F.replace(s, F.lit("."), F.lit("_")), "[^A-Za-z0-9_]", "")
    cased = F.concat(F.upper(F.substring(kept, 1, 1)), F.lower(F.substring(kept, F.lit(2), F.length(kept))))
    return first_of((kept == "", "Unknown"), (kept.rlike("^[0-9]"), F.concat(F.lit("X"), cased)), default=cased)


def repair_operation(s: Column) -> Column:
    """Undo two known collisions of overlapping lines; the indentation stays."""
    indent = F.regexp_extract(s, r"^\s*", 0)
    return first_of(
        (F.contains(s, F.lit("zerEoLinSg")), F.concat(indent, F.lit("ELSE ; zeroing-masking"))),
        default=F.replace(s, F.lit("THENDEST"), F.lit("THEN DEST")),
    )


def occurrences(s: Column, part: str) -> Column:
    return F.floor((F.length(s) - F.length(F.replace(s, F.lit(part), F.lit("")))) / len(part)).cast("long")


def indent(lines: Column, cap: int = 40) -> Column:
    """The smallest indentation of the non-blank lines, at most cap."""
    blanks = F.transform(F.filter(lines, lambda x: F.trim(x) != ""), lambda x: F.length(x) - F.length(F.ltrim(x)))
    return F.least(F.coalesce(F.array_min(blanks), F.lit(0)), F.lit(cap))


def dedent(lines: Column, by: Column | None = None) -> Column:
    """Lines without their first `by` characters, by default the smallest indentation."""
    by = indent(lines) if by is None else by
    return F.transform(lines, lambda x: F.substring(x, by + 1, F.length(x)))


def operation_of(doc: Column, stops: tuple[str, ...] = ()) -> Column:
    """The fenced block under "## Operation"; else what follows a line "Operation" up to a heading or a line that begins with a stop; else an empty string."""
    fenced = F.regexp_extract(doc, r"(?s)## Operation\n.*?```[^\n]*\n(.*?)\n\s*```[^\S\n]*(?:\n|\z)", 1)
    ends = "|".join(["## ", *(re.escape(x) for x in stops)])
    bare = F.regexp_extract(doc, rf"(?s)(?:\A|\n)[^\S\n]*Operation[^\S\n]*\n(.*?)(?=\n[^\S\n]*(?:{ends})|\z)", 1)
    heads_with_fence = F.regexp_extract(doc, r"(?:\A|\n)[^\S\n]*((?:## )?Operation)[^\S\n]*(?:\n|\z)", 1)
    return F.regexp_replace(F.when(heads_with_fence == "Operation", bare).otherwise(fenced), r"\A\s+|\s+\z", "")


def markdown_row(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def fit_row(cells: Column, width: Column) -> Column:
    """Cells padded with empty ones, or cut, to a width."""
    return F.slice(F.concat(cells, F.array_repeat(F.lit(""), width)), F.lit(1), width)


def markdown_table(headers: Column, rows: Column) -> Column:
    """Header, rule and rows as lines; rows fit the header."""
    rule = markdown_row(F.transform(headers, lambda _: F.lit("---")))
    return F.concat(F.array(markdown_row(headers), rule), F.transform(rows, lambda r: markdown_row(fit_row(r, F.size(headers)))))


def bit_label(hi: Column, width: Column) -> Column:
    """hi for one bit, else hi:lo, lo not below zero."""
    return F.when(width == 1, hi.cast("string")).otherwise(F.concat_ws(":", hi.cast("string"), F.greatest(F.lit(0), hi - (width - 1)).cast("string")))


def variants(headers: Column, rows: Column) -> Column:
    """array<struct(mnemonic, description)> of an opcode table; empty if it lacks a Description or an Instruction column.

    The Instruction column is the one of that name, else the first that speaks
    of instructions but not of operands; where it holds opcodes too, the
    mnemonic is parted from them.  Rows without either text are left out.
    """
    names = F.transform(headers, lambda h: F.trim(h))
    small = F.transform(names, lambda h: F.lower(h))
    place = lambda flags: F.array_position(flags, F.lit(True)).cast("int")
    exact = place(F.transform(names, lambda h: h.isin("Instruction", "1 Instruction")))
    loose = place(F.transform(small, lambda h: F.contains(h, F.lit("instruction")) & ~F.contains(h, F.lit("operand"))))
    described, at = F.array_position(names, "Description").cast("int"), F.when(exact > 0, exact).otherwise(loose)
    cell = lambda r, i: F.trim(F.coalesce(F.get(r, i - 1), F.lit("")))
    merged = F.contains(F.get(small, at - 1), F.lit("opcode"))
    pair = lambda r: F.struct(F.when(merged, merged_mnemonic(cell(r, at))).otherwise(cell(r, at)).alias("mnemonic"), cell(r, described).alias("description"))
    found = F.filter(F.transform(rows, pair), lambda v: (v["mnemonic"] != "") & (v["description"] != ""))
    return F.when((described > 0) & (at > 0), found).otherwise(F.filter(found, lambda _: F.lit(False)))


def merged_mnemonic(cell: Column) -> Column:
    """The instruction part of a merged opcode cell: from the first word that is no encoding and begins with a capital."""
    words = F.filter(F.split(F.trim(cell), r"\s+"), lambda w: w != "")
    encoding = r"^(?:/.*|[0-9A-F]{1,2}|[A-Z0-9]{1,2}|(?:REX|VEX|EVEX).*|NP|\+r[bwdo]|i[bwdo]|c[bwdpot])$"
    starts = F.transform(words, lambda w: w.rlike("^[A-Z]") & ~w.rlike(encoding))
    at = F.array_position(starts, F.lit(True)).cast("int")
    return F.when(at > 0, F.array_join(F.slice(words, F.greatest(at, F.lit(1)), F.size(words)), " ")).otherwise(F.trim(cell))
