"""What the body of a generated ARM function must hold, by mnemonic: a rule table.

A rule holds texts that the body needs (of each clause, any one), texts that it
must not have, and where it applies: only with a flag list, with pseudocode, or
where the pseudocode prefers an alias.  The rules are data that a query joins
by mnemonic; bodies are judged by one expression however many rules there are.
"""

from __future__ import annotations

SCHEMA = (
    "name string, rules array<struct<message:string,needs:array<array<string>>,bans:array<string>,flag:string,alias:string,with_code:boolean,keeps_o1:boolean>>"
)

# Mnemonics that subtract through AddWithCarry, and the operator of those that share a logical pseudocode.
SUBTRACTS = "sub subs sbc sbcs cmp ccmp negs ngcs subp subps".split()
LOGICAL = {"and": "b::and", "ands": "b::and", "bic": "b::and", "bics": "b::and", "orr": "b::or", "orn": "b::or", "eor": "b::xor", "eon": "b::xor"}

# Families of mnemonics.
FLAG_SETTERS = "adds subs adcs sbcs ands bics negs ngcs"
COMPARES = "cmp cmn tst ccmp ccmn"
LOADS_O2 = "ldr ldrb ldrh ldar ldarb ldarh ldur ldurb ldurh"
STORES_O1 = "str strb strh stlr stlrb stlrh stur"
LOADS = (
    "ldr ldrb ldrh ldar ldarb ldarh ldxr ldxrb ldxrh ldaxr ldaxrb ldaxrh ldxp ldaxp ldur ldurb ldurh ldp ldnp"
    " ldapr ldaprb ldaprh ldapur ldapurb ldapurh ldlar ldlarb ldlarh ldtr ldtrb ldtrh"
)
SIGNED_LOADS = "ldrsb ldrsh ldrsw ldursb ldursh ldursw ldapursb ldapursh ldapursw ldtrsb ldtrsh ldtrsw"
STORES = (
    "str strb strh stlr stlrb stlrh stxr stxrb stxrh stlxr stlxrb stlxrh stxp stlxp stur sturb sturh"
    " stllr stllrb stllrh stlur stlurb stlurh stp stnp sttr sttrb sttrh"
)
PSTATE = ("pstate_n", "pstate_z", "pstate_c", "pstate_v")

# Texts of bodies.
_FIELD = "assign(tmp64.clone(), o1(), o1_size())"
_SIGNED_FIELD = "assign(b::sar(b::shl(tmp64.clone(), tmp32.clone()), tmp32.clone()), o1(), o1_size())"
_WRAP = "condition(wrap.clone(), [insert_mask, insert_write_mask, insert_value], [extract_mask, extract_value])"
_LOW_FIELD = "assign(b::and(b::shr(o2(), o3()), tmp32.clone()), tmp64.clone(), o1_size())"


def _rule(names: str, message: str, *needs, bans=(), flag=None, alias=None, with_code=False, keeps_o1=False) -> list[tuple[str, tuple]]:
    """A rule for each of the names; a need is one text or a tuple of alternatives, {} in the message is the name."""
    clauses = [[x] if isinstance(x, str) else list(x) for x in needs]
    return [(n, (message.replace("{}", n), clauses, list(bans), flag, alias, with_code, keeps_o1)) for n in names.split()]


def _branches() -> list:
    out = [
        *_rule("b", "B should use jump()", "jump("),
        *_rule("bl", "BL should save return address to x30 (LR)", "x30"),
        *_rule("bl", "BL should use jump()", "jump("),
        *_rule("ret", "RET should use jump()", "jump("),
        *_rule("ret", "RET should jump to x30 (LR)", "x30"),
    ]
    tests = (
        ("cbz cbnz", "{} should compare against zero", ("c(0)", "equal"), "o2()"),
        ("tbz tbnz", "{} should use shift+mask for bit test", ("b::shr", "b::and"), "o3()"),
    )
    for names, message, either, target in tests:
        out += _rule(names, "{} should use condition() for conditional branch", "condition(")
        out += _rule(names, "{} should use jump()", "jump(")
        out += _rule(names, message, either)
        out += _rule(names, "{} should compute an explicit fallthrough target", "fallthrough", "instruction_byte_size()")
        out += _rule(names, f"{{}} should branch to {target}", f"jump({target})")
    return out


def _moves() -> list:
    return [
        *_rule(LOADS_O2, "{} should assign o2() into o1() using o1_size()", "assign(o2(), o1(), o1_size())"),
        *_rule(STORES_O1, "{} should assign o1() into o2() using o2_size()", "assign(o1(), o2(), o2_size())"),
        *_rule("prfm prfum dgh yield", "{} should remain a no-op template", "[].into()"),
        *_rule(LOADS, "{} should use assign()", "assign("),
        *_rule(LOADS, "{} should move source operand into destination operand", "o2()", "o1()"),
        *_rule(SIGNED_LOADS, "{} should use sign_extend()", "sign_extend("),
        *_rule(STORES, "{} should use assign()", "assign("),
        *_rule(STORES, "{} should store operand1 into operand2", "o1(), o2(), o2_size()"),
    ]


def _bit_moves() -> list:
    out = [
        *_rule("rev", "rev should use byte-swap temporaries", ("tmp32", "tmp64")),
        *_rule("rev", "rev should use shift-based byte reversal", "b::shl", "b::shr"),
        *_rule("rev", "rev should branch on operand width", "condition(", "bit_size_of_o1()"),
        *_rule("rmif", "rmif should materialize the rotated source into tmp64", "tmp64"),
        *_rule("rmif", "rmif should gate flag updates with condition()", "condition("),
        *_rule("rmif", "rmif should use the shift and mask operands", "o2()", "o3()"),
        *_rule("rmif", "rmif should extract rotated low bits with shift-and-mask operations", "b::shr", "b::and"),
    ]
    for flag in PSTATE:
        out += _rule("rmif", f"rmif should conditionally update {flag}", flag)
    return out + [
        *_rule("rmif", "rmif should not write back into the source register", keeps_o1=True),
        *_rule("ubfm sbfm bfm", "{} should branch on wrap vs non-wrap bitfield cases", "b::signed_less(o4(), o3(),"),
        *_rule("ubfm sbfm bfm", "{} should derive both extract and insert widths", "extract_width", "insert_width"),
        *_rule("ubfm sbfm bfm", "{} should model both shifted extract and inserted low-bit cases", "b::shr(o2(), o3())", "b::shl(b::and(o2(),"),
        *_rule("ubfm sbfm bfm", "{} should use temporaries for masks and selected bits", "tmp32", "tmp64"),
        *_rule("bfm", "bfm should preserve and update the destination register", "o1()"),
        *_rule("bfm", "bfm should preserve destination bits instead of fully overwriting o1()", bans=(_FIELD, _SIGNED_FIELD)),
        *_rule("bfm", "bfm should merge selected source bits with preserved destination bits", "b::or(", "b::and(o1(),"),
        *_rule("ubfm sbfm", "{} should write the selected bitfield result into o1()", (_FIELD, _SIGNED_FIELD)),
        *_rule("ubfm", "ubfm should not sign-extend the selected bitfield", bans=("b::sar(",)),
        *_rule("sbfm", "sbfm should sign-extend the selected bitfield", "b::sar("),
    ]


def _preferred_aliases() -> list:
    out = []
    for name, alias, path in (("ubfm", "UBFIZ", "bitfield"), ("sbfm", "SBFIZ", "bitfield"), ("bfm", "BFI", "merge")):
        out += _rule(name, f"{{}} should remap {alias} width from imms into insert_width", "insert_width = b::add(o4(), c(1))", alias=alias)
        out += _rule(name, f"{{}} should remap {alias} lsb from immr into datasize - immr", "insert_shift = b::sub(datasize.clone(), o3())", alias=alias)
        out += _rule(name, f"{{}} should keep {alias} on the wrap/insert {path} path", _WRAP, alias=alias)
    out += _rule("sbfm", "sbfm should gate SBFIZ sign-extension through the wrap-aware path", "wrap.clone()", alias="SBFIZ")
    for name, alias, path, bits in (("ubfm", "UBFX", "bitfield", "non-wrap"), ("sbfm", "SBFX", "bitfield", "non-wrap"), ("bfm", "BFXIL", "merge", "low-bit")):
        out += _rule(name, f"{{}} should remap {alias} width from immr/imms into extract_width", "extract_width = b::add(b::sub(o4(), o3()), c(1))", alias=alias)
        out += _rule(name, f"{{}} should remap {alias} lsb to the {bits} extract path", _LOW_FIELD, alias=alias)
        out += _rule(name, f"{{}} should keep {alias} on the non-wrap/extract {path} path", _WRAP, alias=alias)
    out += _rule("ubfm", "ubfm should not sign-extend the UBFX alias path", bans=("b::sar(",), alias="UBFX")
    return out + _rule("sbfm", "sbfm should sign-extend the SBFX alias path", "b::sar(", alias="SBFX")


def _extensions() -> list:
    out = []
    for name, top, part in (("uxth", 15, "halfword"), ("sxth", 15, "halfword"), ("sxtw", 31, "word")):
        out += _rule(name, f"{{}} should fix immr at zero for the low-{part} alias", "assign(c(0), tmp32.clone(), o1_size())")
        out += _rule(name, f"{{}} should fix imms at {top} for the low-{part} alias", f"assign(c({top}), tmp64.clone(), o1_size())")
        if name == "uxth":
            out += _rule(name, "{} should zero-extend rather than arithmetic-sign-extend", bans=("b::sar(",))
            out += _rule(name, f"{{}} should write the extracted {part} into o1()", _FIELD)
        else:
            out += _rule(name, f"{{}} should arithmetic-sign-extend the extracted {part}", "b::sar(")
            out += _rule(name, f"{{}} should write the sign-extended {part} into o1()", "assign(b::sar(")
    return out


def rules() -> dict[str, list[tuple]]:
    """The rules of each mnemonic that has any, in the order in which their issues are told."""
    out = []
    for name, operator in LOGICAL.items():
        out += _rule(name, f"pseudocode implies {operator} for {{}} but not found in body", operator, with_code=True)
    out += _rule(FLAG_SETTERS, "{} should set NZCV flags (missing calc_flags_automatically)", "calc_flags_automatically")
    for flag in PSTATE:
        out += _rule(FLAG_SETTERS, f"{{}}: missing &{flag} in calc_flags", flag=f"&{flag}")
    out += _rule("adc adcs sbc sbcs", "{} should include pstate_c (carry flag)", "pstate_c")
    out += [*_branches(), *_moves(), *_bit_moves(), *_preferred_aliases(), *_extensions()]
    for flag in PSTATE:
        out += _rule("axflag xaflag", f"{{}} should assign {flag}", flag)
    out += _rule("adrp", "ADRP should mask low 12 bits of PC (page alignment)", ("0xFFF", "0xfff"))
    out += _rule("csel csinc csinv csneg", "{} should use condition() for conditional select", "condition(")
    out += _rule("add sub and orr eor mul", "{} (no S suffix) should NOT set flags", bans=("calc_flags_automatically",))
    out += _rule(COMPARES, "{} should set flags", "calc_flags_automatically")
    out += _rule(COMPARES, "{} should not write to destination register", keeps_o1=True)
    table: dict[str, list[tuple]] = {}
    for name, rule in out:
        table.setdefault(name, []).append(rule)
    return table
