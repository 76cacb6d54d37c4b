"""Dimension tables of the code generator: registers, operands, condition codes, templates, patterns.

Tables that follow a rule are built from it.  Templates are data: an engine
user adds rows to the DataFrame that dispatch takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparquill.functions import bodies

# Operand names.
OPERANDS = {"DEST": "o1()", "SRC": "o2()", "SRC1": "o2()", "SRC2": "o3()", "SRC3": "o4()"}
SIZES = {"DEST": "o1_size()", "SRC": "o2_size()", "SRC1": "o2_size()", "SRC2": "o3_size()"}

# x86 condition codes.
X86_CONDITIONS = {
    "a": "b::and(u::not(cf.clone()), u::not(zf.clone()))", "ae": "u::not(cf.clone())", "b": "cf.clone()", "be": "b::or(cf.clone(), zf.clone())",
    "c": "cf.clone()", "e": "zf.clone()", "g": "b::and(u::not(zf.clone()), sf_eq_of())", "ge": "sf_eq_of()", "l": "sf_ne_of()",
    "le": "b::or(zf.clone(), sf_ne_of())", "na": "b::or(cf.clone(), zf.clone())", "nae": "cf.clone()", "nb": "u::not(cf.clone())",
    "nbe": "b::and(u::not(cf.clone()), u::not(zf.clone()))", "nc": "u::not(cf.clone())", "ne": "u::not(zf.clone())", "ng": "b::or(zf.clone(), sf_ne_of())",
    "nge": "sf_ne_of()", "nl": "sf_eq_of()", "nle": "b::and(u::not(zf.clone()), sf_eq_of())", "no": "u::not(of.clone())", "np": "u::not(pf.clone())",
    "ns": "u::not(sf.clone())", "nz": "u::not(zf.clone())", "o": "of.clone()", "p": "pf.clone()", "pe": "pf.clone()", "po": "u::not(pf.clone())",
    "s": "sf.clone()", "z": "zf.clone()",
}

_SAME = "b::equal(pstate_n.clone(), pstate_v.clone(), size_relative(pstate_n.clone()))"
# ARM condition codes.
ARM_CONDITIONS = {
    "eq": "pstate_z.clone()", "ne": "u::not(pstate_z.clone())", "cs": "pstate_c.clone()", "hs": "pstate_c.clone()", "cc": "u::not(pstate_c.clone())",
    "lo": "u::not(pstate_c.clone())", "mi": "pstate_n.clone()", "pl": "u::not(pstate_n.clone())", "vs": "pstate_v.clone()", "vc": "u::not(pstate_v.clone())",
    "hi": "b::and(pstate_c.clone(), u::not(pstate_z.clone()))", "ls": "b::or(u::not(pstate_c.clone()), pstate_z.clone())",
    "ge": _SAME, "lt": f"u::not({_SAME})", "gt": f"b::and(u::not(pstate_z.clone()), {_SAME})", "le": f"b::or(pstate_z.clone(), u::not({_SAME}))", "al": "c(1)",
}

FLAGS = ("CF", "PF", "AF", "ZF", "SF", "TF", "DF", "OF")


def x86_registers() -> dict[str, str]:
    """Register name -> IR, from the naming rules of the register files."""
    names = [f"{p}{r}{s}" for r in "ABCD" for p, s in (("", "L"), ("", "H"), ("", "X"), ("E", "X"), ("R", "X"))]
    names += [f"{p}{r}" for r in ("SP", "BP", "SI", "DI") for p in ("", "E", "R")] + ["SPL", "BPL", "SIL", "DIL", "RIP", *FLAGS]
    names += [f"R{i}{s}" for i in range(8, 16) for s in ("", "B", "W", "D")] + [f"{p}MM{i}" for p in "XYZ" for i in range(32)]
    return {**{n: f"{n.lower()}.clone()" for n in names}, **{f"TMP{w}": f"tmp{w}.clone()" for w in (8, 16, 32, 64, 128, 256, 512)}}


REGISTERS = x86_registers()


def target(name: str) -> str:
    return OPERANDS.get(name) or REGISTERS.get(name) or "o1()"


def target_size(name: str) -> str:
    if name in SIZES:
        return SIZES[name]
    return f"size_relative({name.lower()}.clone())" if name in REGISTERS and not name.startswith(("XMM", "YMM", "ZMM", "TMP")) else "o1_size()"


def builtin_templates() -> list[tuple[str, str, list[str]]]:
    """(arch, mnemonic, body) of all instructions that have a body of their own."""
    return [(arch, name, lines) for arch, table in (("x86_64", bodies.x86()), ("arm", bodies.arm())) for name, lines in table.items()]


def templates(spark: SparkSession, extra: DataFrame | None = None) -> DataFrame:
    """(arch, mnemonic, body ARRAY<STRING>); rows of `extra` come before built-in ones."""
    schema = "arch string, mnemonic string, body array<string>"
    own = spark.createDataFrame(builtin_templates(), schema)
    return own if extra is None else extra.unionByName(own.join(extra.select("arch", "mnemonic"), ["arch", "mnemonic"], "left_anti"))
