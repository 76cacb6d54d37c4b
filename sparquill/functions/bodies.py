"""Bodies of generated functions: a small notation for statements, and the templates and patterns built with it.

A body is a list of lines: `let` statements and a closing expression.  The
notation names what bodies share (assignments, flags, types), so a template is
its mnemonics and an expression; families that differ by an operator, a size
or a register are made by rule.
"""

from __future__ import annotations

from sparquill.functions import patterns

ALL_FLAGS = "&[&of, &sf, &zf, &af, &cf, &pf]"
NO_CF_FLAGS = "&[&of, &sf, &zf, &af, &pf]"
LOGIC_FLAGS = "&[&sf, &zf, &pf]"
OF_CF_FLAGS = "&[&of, &cf]"
NZCV_FLAGS = "&[&pstate_n, &pstate_z, &pstate_c, &pstate_v]"
MNEMONIC = "{mnemonic}"  # stands for the mnemonic in the text of a pattern's body

Let = tuple[str, str]


def reg(name: str) -> str:
    return f"{name}.clone()"


def width(name: str) -> str:
    return f"size_relative({reg(name)})"


def put(value: str, to: str = "o1()", size: str = "o1_size()") -> str:
    return f"assign({value}, {to}, {size})"


def put_reg(value: str, name: str) -> str:
    return put(value, reg(name), width(name))


def put_bit(source: str, bit: int, name: str) -> str:
    """A register gets one bit of a source."""
    return put_reg(f"b::and({f'b::shr({source}, c({bit}))' if bit else source}, c(1))", name)


def calc(value: str, flags: str = ALL_FLAGS, size: str = "o1_size()") -> str:
    return f"calc_flags_automatically({value}, {size}, {flags})"


def typed(value: str, size: str, kind: str = "Int") -> str:
    return f"type_specified({value}, {size}, DataType::{kind})"


def body(*lets: Let, give: str, undefined: str = "") -> list[str]:
    """Lines of the lets and the closing array; `undefined` lists flags that end undefined."""
    last = f"extend_undefined_flags(&[{give}], &[{undefined}])" if undefined else f"[{give}].into()"
    return [*(f"    let {name} = {value};" for name, value in lets), f"    {last}"]


def assigned(value: str, to: str = "o1()", size: str = "o1_size()") -> list[str]:
    return body(("assignment", put(value, to, size)), give="assignment")


def operated(value: str, undefined: str = "") -> list[str]:
    return body(("op", value), ("assignment", put("op")), give="assignment", undefined=undefined)


def flagged(value: str, flags: str) -> list[str]:
    """Operation, assignment and flags of its result."""
    return body(("op", value), ("assignment", put("op.clone()")), ("calc_flags", calc("op", flags)), give="calc_flags, assignment")


def compared(name: str, value: str, flags: str) -> list[str]:
    """Flags of a value that is not kept."""
    return body((name, value), ("calc_flags", calc(name, flags)), give="calc_flags")


def stub(name: str) -> list[str]:
    return [f'    [exception("{name}")].into()']


NOTHING = ["    [].into()"]
_INTS = [(f"type{i}", typed(f"o{i}()", f"o{i}_size()")) for i in (1, 2)]
_CLEARED = [("set_of", put_reg("c(0)", "of")), ("set_cf", put_reg("c(0)", "cf"))]
_SP, _WORD = reg("rsp"), "architecture_byte_size()"


def _spread(table: dict[str, list[str]]) -> dict[str, list[str]]:
    """One entry for each of the blank-separated names of a key."""
    return {name: lines for names, lines in table.items() for name in names.split()}


# -- shared shapes ------------------------------------------------------------


def _arithmetic(op: str) -> list[str]:
    return body(("op", f"b::{op}(o1(), o2())"), ("assignment", put("op.clone()")), ("calc_flags", calc("op")), *_INTS, give="calc_flags, assignment, type1, type2")


def _with_carry(op: str) -> list[str]:
    lets = [("size", "o1_size()"), (op, f"b::{op}(o1(), o2())"), (op, f"b::{op}({op}, u::zero_extend({reg('cf')}))"), ("assignment", put(f"{op}.clone()", size="&size"))]
    return body(*lets, ("calc_flags", calc(op, size="size")), *_INTS, ("type3", typed(reg("cf"), "o1_size()")), give="calc_flags, assignment, type1, type2, type3")


def _unary(name: str, value: str, flags: str) -> list[str]:
    return body((name, value), ("calc_flags", calc(f"{name}.clone()", flags)), ("assignment", put(name)), give="calc_flags, assignment")


def _logical(op: str) -> list[str]:
    lets = [("op", f"b::{op}(o1(), o2())"), ("assignment", put("op.clone()")), ("calc_flags", calc("op", LOGIC_FLAGS)), *_CLEARED]
    return body(*lets, ("set_af", put_reg("undefined_data()", "af")), *_INTS, give="calc_flags, set_of, set_cf, set_af, assignment, type1, type2")


def _shift(op: str) -> list[str]:
    lets = []
    for i, by in ((1, "o2()"), (2, "c(1)")):
        lets += [(f"{op}_{i}", f"b::{op}(o1(), {by})"), (f"{op}_{i}_flags", calc(f"{op}_{i}.clone()", LOGIC_FLAGS))]
    way = lambda i: f"[{op}_{i}_flags, {put(f'{op}_{i}')}]"
    return body(*lets, ("cond", f"condition(is_o2_exists(), {way(1)}, {way(2)})"), give="cond", undefined="&of, &af, &cf")


def rotation(first: str, then: str, value: str, by: str, rest: str, bits: str) -> str:
    """Bits shifted out on one side come in on the other (from `rest`)."""
    return f"b::or(b::{first}({value}, {by}), b::{then}({rest}, b::sub(bit_size_of_{bits}, {by})))"


def _bit_change(change: str, mask: str, name: str) -> list[str]:
    """The old bit goes to CF, the new value to the operand."""
    return body(
        ("shr", "b::shr(o1(), o2())"), ("save_cf", put_reg("b::and(shr, c(1))", "cf")), ("mask", mask), (name, put(f"b::{change}(o1(), mask)")), give=f"save_cf, {name}"
    )


def _extended(narrow: str, wide: str) -> list[str]:
    types = [(f"type{i}", typed(reg(r), width(r))) for i, r in ((1, narrow), (2, wide))]
    return body(("ext", put_reg(f"u::sign_extend({reg(narrow)})", wide)), *types, give="ext, type1, type2")


def _doubled(low: str, high: str, temp: str) -> list[str]:
    types = [(f"type{i}", typed(reg(r), width(r))) for i, r in ((1, low), (2, high))]
    lets = [("set_tmp", put_reg(f"u::sign_extend({reg(low)})", temp)), ("set_dx", put_reg(f"b::shr({reg(temp)}, c(16))", high)), ("set_ax", put_reg(reg(temp), low))]
    return body(*lets, *types, give="set_tmp, set_dx, set_ax, type1, type2")


def _bit_scan() -> list[str]:
    zf = lambda v: put_reg(f"c({v})", "zf")
    return body(("set_zf", f"condition(b::equal(o2(), c(0), o2_size()), [{zf(1)}], [{zf(0)}, {put('o2()')}])"), give="set_zf")


def _bit_count() -> list[str]:
    cleared = [(f"set_{f}", put_reg("c(0)", f)) for f in ("of", "sf", "af", "cf", "pf")]
    zf = lambda v: put_reg(f"c({v})", "zf")
    zero = ("set_zf", f"condition(b::equal(o1(), c(0), o1_size()), [{zf(1)}], [{zf(0)}])")
    return body(("assignment", put("o2()")), *cleared, zero, give="assignment, set_of, set_sf, set_af, set_cf, set_pf, set_zf")


def _byte_swap(name: str, source: str) -> list[str]:
    """Byte by byte over a temporary, for 32 and for 64 bits."""
    lines = ["    let size = o1_size();"]
    for bits in (32, 64):
        temp = reg(f"tmp{bits}")
        byte = [put(temp, size="size_result_bit(c(8))"), put("b::shl(o1(), c(8))", size="size.clone()"), put(f"b::shr({temp}, c(8))", temp, "size.clone()")]
        steps = [put(source, temp, "size.clone()"), *(byte * (bits // 8))[:-2]]
        lines += [f"    let swap_{bits} = [", *(f"        {s}," for s in steps), "    ];"]
    both = ("condition(b::equal(bit_size_of_o1(), c(32), size_unlimited()), swap_32, swap_64)", typed("o1()", "o1_size()"))
    return lines + body((name, both[0]), ("type1", both[1]), give=f"{name}, type1")


def _by_width(name: str, lets: list[Let], undefined: str, before: list[Let] = ()) -> list[str]:
    """Different statements for eight bits (name_8) and for more (name_etc)."""
    choice = (name, f"condition(b::equal(operand_bit_size, c(8), size_unlimited()), {name}_8, {name}_etc)")
    return body(*before, ("operand_bit_size", "bit_size_of_o1()"), *lets, choice, give=", ".join([*(n for n, _ in before), name]), undefined=undefined)


def _product() -> list[str]:
    low, high = reg("rax"), reg("rdx")
    lets = [
        ("value_8", f"b::mul(sized({reg('al')}, {width('al')}), o1())"),
        ("mul_8", f"[{calc('value_8.clone()', OF_CF_FLAGS)}, {put_reg('value_8', 'ax')}]"),
        ("value", f"b::mul(sized({low}, o1_size()), o1())"),
        ("mul_etc", f"[{calc('value.clone()', OF_CF_FLAGS)}, {put('value.clone()', low)}, {put('b::shr(u::zero_extend(value), operand_bit_size.clone())', high)}]"),
    ]
    return _by_width("mul", lets, "&sf, &zf, &af, &pf", [("assertion", "assertion(u::not(is_o2_exists()))")])


def _quotient(name: str, sign: str) -> list[str]:
    low, high, wide = reg("rax"), reg("rdx"), (lambda x: f"u::sign_extend({x})") if sign == "signed" else (lambda x: x)
    part = lambda op, x: f"b::{sign}_{op}({wide(x)}, {wide('o1()')})"
    lets = [
        (f"{name}_8", f"[{put(part('div', reg('ax')), reg('al'))}, {put(part('rem', reg('ax')), reg('ah'))}]"),
        ("value", f"b::add(b::shl(sized({high}, o1_size()), operand_bit_size.clone()), sized({low}, o1_size()))"),
        (f"{name}_etc", f"[{put(part('div', 'value.clone()'), low)}, {put(part('rem', 'value'), high)}]"),
    ]
    return _by_width(name, lets, "&of, &sf, &zf, &af, &cf, &pf")


def _string_operations() -> dict[str, list[str]]:
    """movs, cmps, stos, lods and scas, for each element size and for that of the machine."""
    source, target, out = "d(rsi.clone())", "d(rdi.clone())", {}
    for letter, size in (("", "size_architecture()"), *((x, f"size_result_byte(c({n}))") for x, n in (("b", 1), ("w", 2), ("d", 4), ("q", 8)))):
        for name, value, to in (("movs", source, target), ("stos", reg("rax"), target), ("lods", source, reg("rax"))):
            out[name + letter] = body((name[:3] if name == "movs" else name, put(value, to, size)), give=name[:3] if name == "movs" else name)
        types = [("source", "Int"), ("destination", "Int"), (reg("rsi"), "Address"), (reg("rdi"), "Address")]
        lets = [("source", source), ("destination", target), ("sub", "b::sub(source.clone(), u::sign_extend(destination.clone()))"), ("calc_flags", calc("sub", size=size))]
        kinds = [(f"type{i}", typed(x, "size_architecture()", k)) for i, (x, k) in enumerate(types, 1)]
        out["cmps" + letter] = body(*lets, *kinds, give="calc_flags, type1, type2, type3, type4")
        out["scas" + letter] = body(("sub", f"b::sub({reg('rax')}, {target})"), ("calc_flags", calc("sub", size=size)), give="calc_flags")
    return out


# -- x86 ----------------------------------------------------------------------

# Instructions that end in an exception named in capitals, and named as they are.
TRAPS = """int int1 int3 into syscall sysenter sysexit sysret cpuid rdtsc rdtscp rdmsr wrmsr rdpmc lgdt sgdt lidt sidt lldt sldt ltr str
invd wbinvd invlpg clflush clflushopt clwb""".split()
STUBS = """addsubpd addsubps pclmulqdq ins insb insd insw outs outsb outsd outsw
arpl bound clac stac cldemote clts clrssbsy encodekey128 encodekey256 endbr32 endbr64 enqcmd hreset incsspd incsspq invpcid lar lds les lfs
lgs lss loadiwkey monitor mwait pconfig ptwrite rdrand rdseed rdsspd rdsspq rsm rstorssp saveprevssp senduipi serialize setssbsy swapgs
tpause ud uiret umonitor umwait wbnoinvd wrfsbase wrgsbase wrpkru wrssd wrssq wrussd wrussq xabort xacquire xbegin xend xgetbv xrelease
xresldtrk xsusldtrk xtest xrstor xrstors xsave xsavec xsaveopt xsaves
ldtilecfg sttilecfg tileloadd tileloaddt1 tilestored tilezero tdpbf16ps tdpbssd tdpbsud tdpbusd tdpbuud
aesdec aesdec128kl aesdec256kl aesdeclast aesdecwide128kl aesdecwide256kl aesenc aesenc128kl aesenc256kl aesenclast aesencwide128kl
aesencwide256kl aesimc aeskeygenassist sha1msg1 sha1msg2 sha1nexte sha1rnds4 sha256msg1 sha256msg2 sha256rnds2
gf2p8affineinvqb gf2p8affineqb gf2p8mulb bndcl bndcn bndcu bndldx bndmk bndmov bndstx""".split()
IDLE = "nop lfence sfence mfence pause prefetch prefetchw prefetchnta prefetcht0 prefetcht1 prefetcht2 wait fwait lock rep repe repne repnz repz".split()

_PUSHED = put(f"b::sub({_SP}, {_WORD})", _SP, "size_architecture()")
_POPPED = put(f"b::add({_SP}, {_WORD})", _SP, "size_architecture()")


def x86() -> dict[str, list[str]]:
    """Mnemonic -> body lines."""
    flag = lambda value, f: body(("set", put_reg(value, f)), give="set")
    zero = [put_reg(f"c({v})", f) for v, f in ((1, "zf"), (0, "sf"), (0, "pf"))]
    cmpxchg = body(
        ("cond", f"b::equal({reg('rax')}, d(o1()), o1_size())"),
        ("true_b", f"[{put('o2()', 'd(o1())')}]"),
        ("false_b", f"[{put('d(o1())', reg('rax'))}]"),
        ("cmpxchg", "condition(cond.clone(), true_b, false_b)"),
        ("calc_flags", calc("cond", size="size_result_byte(c(1))")),
        *_INTS,
        ("type3", typed(reg("rax"), width("rax"))),
        give="calc_flags, cmpxchg, type1, type2, type3",
    )
    bits = (("sf", 7), ("zf", 6), ("af", 4), ("pf", 2), ("cf", 0))
    saved = reg("cf")
    for i, (f, bit) in enumerate(bits[:-1]):
        saved = f"b::shl({reg(f)}, c({bit}))" if i == 0 else f"b::or({saved}, b::shl({reg(f)}, c({bit})))"
    returned = body(
        ("jmp", f"jump(d({_SP}))"),
        ("set_sp", _POPPED),
        ("operand_condition", f"condition(is_o1_exists(), [{put(f'b::add({_SP}, u::zero_extend(o1()))', _SP, 'size_architecture()')}], [])"),
        ("halt", "halt()"),
        give="set_sp, operand_condition, jmp, halt",
    )
    double = lambda first, then: operated(rotation(first, then, "o1()", "o3()", "o2()", "o1()"), "&of, &sf, &zf, &af, &cf, &pf")
    turned = lambda first, then: operated(rotation(first, then, "o1()", "o2()", "o1()", "o1()"), "&of, &cf")
    return {
        **_spread(
            {
                "add": _arithmetic("add"),
                "sub": _arithmetic("sub"),
                "adc adcx adox": _with_carry("add"),
                "sbb": _with_carry("sub"),
                "inc": _unary("add", "b::add(o1(), c(1))", NO_CF_FLAGS),
                "dec": _unary("sub", "b::sub(o1(), c(1))", NO_CF_FLAGS),
                "neg": _unary("neg", "u::neg(o1())", ALL_FLAGS),
                "and": _logical("and"),
                "or": _logical("or"),
                "xor": [
                    "    let cond = b::equal(o1(), o2(), o1_size());",
                    "    let true_b = [",
                    *(f"        {x}," for x in (put("c(0)"), *zero)),
                    "    ];",
                    "    let false_b = b::xor(o1(), o2());",
                    "    let false_b = [",
                    *(f"        {x}," for x in (put("false_b.clone()"), put_reg("c(0)", "zf"), calc("false_b", "&[&sf, &pf]"))),
                    "    ];",
                    *body(("xor", "condition(cond, true_b, false_b)"), *_CLEARED, give="xor, set_of, set_cf", undefined="&af"),
                ],
                "not": body(("not_val", "u::not(o1())"), ("assignment", put("not_val")), give="assignment"),
                "test": body(("and_val", "b::and(o1(), o2())"), ("sf_zf_pf", calc("and_val", LOGIC_FLAGS)), *_CLEARED, give="sf_zf_pf, set_of, set_cf", undefined="&af"),
                "andn": body(
                    ("op", "b::and(u::not(o2()), o3())"), ("assignment", put("op.clone()")), ("calc_flags", calc("op", LOGIC_FLAGS)), *_CLEARED,
                    give="calc_flags, set_of, set_cf, assignment",
                ),
                "mov movzx movddup movshdup movsldup movdq16 movdq32 movdq64": assigned("u::zero_extend(o2())"),
                "movsx movsxd": assigned("u::sign_extend(o2())"),
                "lea": body(("address", "u::zero_extend(d(o2()))"), ("assignment", put("address")), give="assignment"),
                "xchg": body(
                    ("set_tmp", put("o1()", reg("tmp64"))), ("set_o1", put("o2()")), ("set_o2", put(reg("tmp64"), "o2()", "o2_size()")), give="set_tmp, set_o1, set_o2"
                ),
                "bswap": _byte_swap("bswap", "o1()"),
                "push pusha pushad pushf pushfd pushfq": body(("set_sp", _PUSHED), ("push", put("o1()", f"d({_SP})")), give="set_sp, push"),
                "pop popa popad popf popfd popfq": body(("pop", put(f"d({_SP})")), ("set_sp", _POPPED), give="pop, set_sp"),
                "enter": body(
                    ("push_bp", put(reg("rbp"), f"d(b::sub({_SP}, {_WORD}))", "size_architecture()")),
                    ("set_sp1", _PUSHED),
                    ("set_bp", put(_SP, reg("rbp"), "size_architecture()")),
                    ("set_sp2", put(f"b::sub({_SP}, u::zero_extend(o1()))", _SP, "size_architecture()")),
                    give="push_bp, set_sp1, set_bp, set_sp2",
                ),
                "leave": body(
                    ("restore_sp", put(reg("rbp"), _SP, "size_architecture()")),
                    ("pop_rbp", put(f"d({_SP})", reg("rbp"), "size_architecture()")),
                    ("inc_sp", _POPPED),
                    give="restore_sp, pop_rbp, inc_sp",
                ),
                "jmp": ["    [jump(o1())].into()"],
                "call": body(
                    ("set_sp", _PUSHED),
                    ("ret_address", f"b::add({reg('rip')}, instruction_byte_size())"),
                    ("save_ret", put("ret_address", f"d({_SP})", "size_architecture()")),
                    ("call", "jump_by_call(o1())"),
                    ("type1", typed("o1()", "o1_size()", "Address")),
                    *((f"type{i}", typed(reg(r), "size_architecture()", "Address")) for i, r in ((2, "rsp"), (3, "rip"))),
                    give="set_sp, save_ret, call, type1, type2, type3",
                ),
                "ret iret iretd iretq": returned,
                "hlt": ["    [halt()].into()"],
                "ud2": stub("#UD"),
                "cmp": body(("sub", "b::sub(o1(), u::sign_extend(o2()))"), ("calc_flags", calc("sub")), *_INTS, give="calc_flags, type1, type2"),
                "cmpxchg cmpxchg8b cmpxchg16b": cmpxchg,
                "xadd": body(
                    ("sum", "b::add(o1(), o2())"), ("save_o1", put("o1()", "o2()", "o2_size()")), ("set_o1", put("sum.clone()")), ("calc_flags", calc("sum")),
                    give="save_o1, set_o1, calc_flags",
                ),
                "clc": flag("c(0)", "cf"),
                "stc": flag("c(1)", "cf"),
                "cld": flag("c(0)", "df"),
                "std": flag("c(1)", "df"),
                "cli": flag("c(0)", "if_"),
                "sti": flag("c(1)", "if_"),
                "cmc": flag(f"u::not({reg('cf')})", "cf"),
                "sahf": body(*((f"{f}_a", put_bit(reg("ah"), bit, f)) for f, bit in bits), give="sf_a, zf_a, af_a, pf_a, cf_a"),
                "lahf": body(("val", f"b::or({saved}, {reg('cf')})"), ("assignment", put_reg("val", "ah")), give="assignment"),
                "cbw": _extended("al", "ax"),
                "cwde": _extended("ax", "eax"),
                "cdqe": _extended("eax", "rax"),
                "cwd": _doubled("ax", "dx", "tmp32"),
                "cdq": _doubled("eax", "edx", "tmp64"),
                "cqo": _doubled("rax", "rdx", "tmp128"),
                "bt": body(
                    ("size", width("cf")), ("shr", "b::shr(o1(), o2())"), ("assignment", put("shr.clone()", reg("cf"), "&size")), *_INTS,
                    give="assignment, type1, type2", undefined="&of, &sf, &af, &pf",
                ),
                "bts": _bit_change("or", "b::shl(c(1), o2())", "set_bit"),
                "btr": _bit_change("and", "u::not(b::shl(c(1), o2()))", "clear_bit"),
                "btc": _bit_change("xor", "b::shl(c(1), o2())", "flip_bit"),
                "bsf bsr": _bit_scan(),
                "popcnt lzcnt tzcnt": _bit_count(),
                "shl sal": _shift("shl"),
                "shr": _shift("shr"),
                "sar psraq": _shift("sar"),
                "rol rcl": turned("shl", "shr"),
                "ror rcr": turned("shr", "shl"),
                "shld": double("shl", "shr"),
                "shrd": double("shr", "shl"),
                "mul": _product(),
                "imul": [
                    "    // IMUL: handles 1, 2, and 3-operand forms",
                    *body(
                        ("result", "b::mul(o1(), o2())"), ("assignment", put("result.clone()")), ("calc_flags", calc("result", OF_CF_FLAGS)),
                        give="calc_flags, assignment", undefined="&sf, &zf, &af, &pf",
                    ),
                ],
                "div": _quotient("div", "unsigned"),
                "idiv": _quotient("idiv", "signed"),
                "blsi": operated("b::and(u::neg(o2()), o2())"),
                "blsmsk": operated("b::xor(b::sub(o2(), c(1)), o2())"),
                "blsr": operated("b::and(b::sub(o2(), c(1)), o2())"),
                "bzhi": body(("mask", "b::sub(b::shl(c(1), o3()), c(1))"), ("op", "b::and(o2(), mask)"), ("assignment", put("op")), give="assignment"),
                "bextr": body(
                    ("start", "b::and(o3(), c(0xFF))"), ("len", "b::and(b::shr(o3(), c(8)), c(0xFF))"), ("shifted", "b::shr(o2(), start)"),
                    ("mask", "b::sub(b::shl(c(1), len), c(1))"), ("op", "b::and(shifted, mask)"), ("assignment", put("op")), give="assignment",
                ),
                "pdep pext": assigned("b::and(o2(), o3())"),
                "rorx": operated(rotation("shr", "shl", "o2()", "o3()", "o2()", "o2()")),
                "mulx": body(("product", f"b::mul(o2(), {reg('rdx')})"), ("assignment", put("product")), give="assignment"),
                "pabsq phminposuw": assigned("o1()"),
                "pavgb pavgw": assigned("b::add(o1(), o2())"),
                "pmulhrsw": assigned("b::mul(o1(), o2())"),
                "pmovmskb pmaxsq pmaxuq pminsq pminuq psignb psignd psignw": assigned("o2()"),
            }
        ),
        **{f"{op}x": assigned(f"b::{op}(o2(), o3())") for op in ("sar", "shl", "shr")},
        **_string_operations(),
        **{n: NOTHING for n in IDLE},
        **{n: stub(n.upper()) for n in TRAPS},
        **{n: stub(n) for n in STUBS},
    }


# -- ARM ----------------------------------------------------------------------

# Instructions that end in an exception, and those without effect.
ARM_STUBS = """smulh umulh cls clz rbit rev16 rev32 rev64 ubfx sbfx ubfiz sbfiz bfi bfxil svc hvc smc brk hlt dcps1 dcps2 dcps3 drps eret
mrs msr sys sysl at dc ic tlbi cas casa casl casal casb cash casp swp swpa swpl swpal swpb swph ldsmax ldsmin ldumax ldumin addg subg""".split()
ARM_STUBS += [f"ld{op}{order}" for op in ("add", "clr", "eor", "set") for order in ("", "a", "l", "al")]
ARM_STUBS += [f"st{op}{order}" for op in ("add", "clr", "eor", "set") for order in ("", "l")]
ARM_IDLE = "nop hint dgh yield dmb dsb isb csdb yield_ wfe wfi sev sevl clrex pssbb ssbb esb psb tsb prfm prfum".split()


def _memory() -> dict[str, list[str]]:
    """Loads pass the second operand, signed ones extend it; stores pass the first."""
    load, signed, store = assigned("o2()"), _arm_extend(), assigned("o1()", "o2()", "o2_size()")
    out = {f"{n}{size}": load for n in ("ldr", "ldur", "ldtr", "ldapur", "ldar", "ldaxr", "ldxr", "ldapr", "ldlar") for size in ("", "b", "h")}
    out |= {f"{n}{size}": signed for n in ("ldr", "ldur", "ldtr", "ldapur") for size in ("sb", "sh", "sw")}
    out |= {f"{n}{size}": store for n in ("str", "stur", "sttr", "stlur", "stlr", "stxr", "stlxr", "stllr") for size in ("", "b", "h")}
    return out | {n: load for n in ("ldp", "ldnp", "ldxp", "ldaxp")} | {n: store for n in ("stp", "stnp", "stxp", "stlxp")}


def _arm_extend() -> list[str]:
    return body(("assignment", "sign_extend(o2(), o1(), o1_size())"), give="assignment")


def bitfield_move(immr: str = "o3()", imms: str = "o4()", *, signed: bool = False, keep: bool = False) -> list[Let]:
    """Statements of a bit field move, which extracts or inserts by the order of its two positions.

    signed extends the field's sign; keep leaves the other bits of the target.
    The last let is named `give` and lists what the body returns.
    """
    mask, field = reg("tmp32"), reg("tmp64")
    ones = lambda n: f"b::sub(b::shl(c(1), {n}.clone()), c(1))"
    choice = lambda test, yes, no: f"condition(\n        {test},\n        [{put(yes, mask)}],\n        [{put(no, mask)}],\n    )"
    lets = [
        ("wrap", f"b::signed_less({imms}, {immr}, o1_size())"),
        ("extract_width", f"b::add(b::sub({imms}, {immr}), c(1))"),
        ("insert_width", f"b::add({imms}, c(1))"),
        ("extract_mask", choice("b::equal(extract_width.clone(), datasize.clone(), size_unlimited())", "u::not(c(0))", ones("extract_width"))),
        ("extract_value", put(f"b::and(b::shr(o2(), {immr}), {mask})", field)),
        ("insert_mask", put(ones("insert_width"), mask)),
        ("insert_shift", f"b::sub(datasize.clone(), {immr})"),
        ("insert_write_mask", put(f"b::shl({mask}, insert_shift.clone())", mask)),
        ("insert_value", put(f"b::shl(b::and(o2(), {mask}), insert_shift)", field)),
        ("select", "condition(wrap.clone(), [insert_mask, insert_write_mask, insert_value], [extract_mask, extract_value])"),
    ]
    if signed:
        lets.append(("extend_shift", choice("wrap.clone()", f"b::sub(b::sub({immr}, {imms}), c(1))", "b::sub(datasize.clone(), extract_width.clone())")))
        return [*lets, ("assignment", put(f"b::sar(b::shl({field}, {mask}), {mask})")), ("give", "select, extend_shift, assignment")]
    if keep:
        lets += [("preserved", f"b::and(o1(), u::not({mask}))"), ("assignment", put(f"b::or(preserved, b::and({field}, {mask}))"))]
    else:
        lets.append(("assignment", put(field)))
    return [*lets, ("give", "select, assignment")]


def _given(lets: list[Let]) -> list[str]:
    *lets, (_, give) = lets
    return [line for text in body(*lets, give=give) for line in text.split("\n")]


_DATASIZE = ("datasize", "bit_size_of_o1()")


def arm_aliases() -> dict[str, list[str]]:
    """Bodies of aliases of the bit field moves: their operands become the two positions, held in temporaries."""
    put_both = lambda immr, imms: [("remap_immr", put(immr, reg("tmp32"))), ("remap_imms", put(imms, reg("tmp64")))]
    first, size = ("alias_lsb", "o3()"), ("alias_width", "o4()")
    insert = [first, size, _DATASIZE, ("canonical_immr", "b::sub(datasize.clone(), alias_lsb)"), ("canonical_imms", "b::sub(alias_width, c(1))"), *put_both("canonical_immr", "canonical_imms")]
    extract = [first, size, ("canonical_imms", "b::add(b::sub(alias_width, c(1)), alias_lsb.clone())"), *put_both("alias_lsb", "canonical_imms")]
    table = {
        "ubfx": (extract, {}),
        "sbfx": (extract, {"signed": True}),
        "ubfiz": (insert, {}),
        "sbfiz": (insert, {"signed": True}),
        "bfi": (insert, {"keep": True}),
        "bfxil": (extract, {"keep": True}),
        "uxth": (put_both("c(0)", "c(15)"), {}),
        "sxth": (put_both("c(0)", "c(15)"), {"signed": True}),
        "sxtw": (put_both("c(0)", "c(31)"), {"signed": True}),
    }
    return {name: _given([*before, *bitfield_move(reg("tmp32"), reg("tmp64"), **kind)]) for name, (before, kind) in table.items()}


def arm() -> dict[str, list[str]]:
    """Mnemonic -> body lines."""
    state = {f: f"pstate_{f}" for f in "nzcv"}
    carry = reg(state["c"])
    adc, sbc = f"b::add(b::add(o2(), o3()), {carry})", f"b::sub(b::sub(o2(), o3()), u::not({carry}))"
    choose = lambda test, yes, no: [f"    [condition({test}, [{put(yes)}], [{put(no)}])].into()"]
    onward = ("fallthrough", f"b::add({reg('pc')}, instruction_byte_size())")
    bit = ("bit", "b::and(b::shr(o1(), o2()), c(1))")
    branch = lambda test, to: f"condition({test}, [jump({to})], [jump(fallthrough)])"
    sets = lambda **values: [(f"set_{f}", put_reg(v, state[f])) for f, v in values.items()]
    old = lambda names: [(f"old_{f}", reg(state[f])) for f in names]
    turned = rotation("shr", "shl", "o1()", "o2()", "o1()", "o1()")
    temp = reg("tmp64")
    rmif = body(
        ("rotated_value", turned),
        ("rotate", f"condition(b::equal(o2(), c(0), size_unlimited()), [{put('o1()', temp)}], [{put('rotated_value', temp)}])"),
        *((f"set_{f}", f"condition(b::and(o3(), c({1 << i})), [{put_bit(temp, i, state[f])}], [])") for i, f in zip((3, 2, 1, 0), "nzcv")),
        give="rotate, set_n, set_z, set_c, set_v",
    )
    link = body(("save_lr", put_reg(f"b::add({reg('pc')}, instruction_byte_size())", "x30")), ("do_jump", "jump(o1())"), give="save_lr, do_jump")
    return {
        **_spread(
            {
                "add": assigned("b::add(o2(), o3())"),
                "sub subp": assigned("b::sub(o2(), o3())"),
                "neg fneg": assigned("u::neg(o2())"),
                "mul smull umull fmul": assigned("b::mul(o2(), o3())"),
                "madd smaddl umaddl": assigned("b::add(o4(), b::mul(o2(), o3()))"),
                "msub smsubl umsubl fnmsub": assigned("b::sub(o4(), b::mul(o2(), o3()))"),
                "mneg smnegl umnegl": assigned("u::neg(b::mul(o2(), o3()))"),
                "udiv fdiv": assigned("b::unsigned_div(o2(), o3())"),
                "sdiv": assigned("b::signed_div(o2(), o3())"),
                "adc": operated(adc),
                "sbc ngc": operated(sbc),
                "adds": flagged("b::add(o2(), o3())", NZCV_FLAGS),
                "subs subps": flagged("b::sub(o2(), o3())", NZCV_FLAGS),
                "adcs": flagged(adc, NZCV_FLAGS),
                "sbcs ngcs": flagged(sbc, NZCV_FLAGS),
                "negs": flagged("u::neg(o2())", NZCV_FLAGS),
                "and": assigned("b::and(o2(), o3())"),
                "orr": assigned("b::or(o2(), o3())"),
                "eor": assigned("b::xor(o2(), o3())"),
                "eon": assigned("b::xor(o2(), u::not(o3()))"),
                "orn": assigned("b::or(o2(), u::not(o3()))"),
                "bic": assigned("b::and(o2(), u::not(o3()))"),
                "bics": flagged("b::and(o2(), u::not(o3()))", NZCV_FLAGS),
                "ands": flagged("b::and(o2(), o3())", NZCV_FLAGS),
                "mvn movn": assigned("u::not(o2())"),
                "tst": compared("op", "b::and(o1(), o2())", NZCV_FLAGS),
                "lsl lslv": assigned("b::shl(o2(), o3())"),
                "lsr lsrv": assigned("b::shr(o2(), o3())"),
                "asr asrv": assigned("b::sar(o2(), o3())"),
                "ror rorv": operated(rotation("shr", "shl", "o2()", "o3()", "o2()", "o2()")),
                "mov movz movk uxtb uxth fmov fcsel fcvt fcvtzs fcvtzu scvtf ucvtf fabs fsqrt": assigned("o2()"),
                "sxtb sxth sxtw": _arm_extend(),
                "cmp ccmp fcmp fccmp": compared("sub", "b::sub(o1(), o2())", NZCV_FLAGS),
                "cmn ccmn": compared("add", "b::add(o1(), o2())", NZCV_FLAGS),
                "csel": choose("o3()", "o1()", "o2()"),
                "csinc cinc": choose("o3()", "o1()", "b::add(o2(), c(1))"),
                "csinv cinv": choose("o3()", "o1()", "u::not(o2())"),
                "csneg cneg": choose("o3()", "o1()", "u::neg(o2())"),
                "cset": choose("o2()", "c(1)", "c(0)"),
                "csetm": choose("o2()", "u::not(c(0))", "c(0)"),
                "rmif": rmif,
                "rev": _byte_swap("rev", "o2()"),
                "extr": assigned("o3()"),
                "b br": ["    [jump(o1())].into()"],
                "bl blr": link,
                "ret": [f"    [jump({reg('x30')})].into()"],
                "cbz": body(onward, give=branch("b::equal(o1(), c(0), o1_size())", "o2()")),
                "cbnz": body(onward, ("is_zero", "b::equal(o1(), c(0), o1_size())"), give=branch("u::not(is_zero)", "o2()")),
                "tbz": body(onward, bit, give=branch("b::equal(bit, c(0), o1_size())", "o3()")),
                "tbnz": body(onward, bit, give=branch("bit", "o3()")),
                "axflag": body(
                    *old("zcv"), *sets(n="c(0)", z="b::or(old_z.clone(), old_v.clone())", c="b::and(old_c, u::not(old_v))", v="c(0)"), give="set_n, set_z, set_c, set_v"
                ),
                "xaflag": body(
                    *old("cz"),
                    *sets(
                        n="b::and(u::not(old_c.clone()), u::not(old_z.clone()))", z="b::and(old_z.clone(), old_c.clone())",
                        c="b::or(old_c.clone(), old_z.clone())", v="b::and(u::not(old_c.clone()), old_z.clone())",
                    ),
                    give="set_n, set_z, set_c, set_v",
                ),
                "adr": assigned(f"b::add({reg('pc')}, o2())"),
                "adrp": body(("page_base", f"b::and({reg('pc')}, u::not(c(0xFFF)))"), ("assignment", put("b::add(page_base, o2())")), give="assignment"),
                "fadd fmin fmax fminnm fmaxnm": assigned("b::add(o2(), o3())"),
                "fsub": assigned("b::sub(o2(), o3())"),
                "fmadd": assigned("b::add(b::mul(o2(), o3()), o4())"),
                "fmsub": assigned("b::sub(b::mul(o2(), o3()), o4())"),
                "fnmadd": assigned("u::neg(b::add(b::mul(o2(), o3()), o4()))"),
            }
        ),
        **{n: _given([_DATASIZE, *bitfield_move(**kind)]) for n, kind in (("ubfm", {}), ("sbfm", {"signed": True}), ("bfm", {"keep": True}))},
        **{f"frint{mode}": assigned("o2()") for mode in "aimnpxz"},
        **_memory(),
        **{n: NOTHING for n in ARM_IDLE},
        **{n: stub(n) for n in ARM_STUBS},
    }


# -- patterns over x86 mnemonics ------------------------------------------------


def _words(names: str) -> str:
    return "|".join(names.split())


def _x87() -> list[tuple[str, list[str]]]:
    """What begins with f, but not fma."""
    arithmetic = (("add", "f(addp?|iadd)"), ("sub", "f(subr?p?|isubr?)"), ("mul", "f(mulp?|imul)"), ("signed_div", "f(divr?p?|idivr?)"))
    # Loads, stores and functions that pass the first operand, and control instructions.
    kept = """fld fild fbld fld1 fldl2t fldl2e fldpi fldlg2 fldln2 fldz fst fstp fist fistp fisttp fbstp fabs fchs frndint fsqrt fprem fprem1
    f2xm1 fyl2x fyl2xp1 fptan fpatan fsin fcos fsincos fxtract fscale fxam"""
    control = """finit fninit fclex fnclex fwait fnop fdecstp fincstp ffree ffreep fstcw fnstcw fldcw fstsw fnstsw fstenv fnstenv fldenv fsave
    fnsave frstor fxsave fxrstor fxsave64 fxrstor64"""
    return [
        *((p, operated(f"b::{op}(o1(), o2())")) for op, p in arithmetic),
        ("fu?com(p|pp|i|ip)?|ficomp?|ftst", compared("sub", "b::sub(o1(), o2())", ALL_FLAGS)),
        (_words(kept), assigned("o1()")),
        (_words(control), NOTHING),
        ("fcmov.*", assigned("o2()")),
        ("f(?!ma).*", stub(MNEMONIC)),
    ]


def _masks() -> list[tuple[str, list[str]]]:
    """What begins with k."""
    two = lambda op: assigned(f"b::{op}(o2(), o3())")
    return [
        ("kand.*n.*", assigned("b::and(u::not(o2()), o3())")),
        ("kand.*", two("and")),
        ("kor.*", two("or")),
        ("kxor.*", two("xor")),
        ("kxnor.*", assigned("u::not(b::xor(o2(), o3()))")),
        ("knot.*", assigned("u::not(o2())")),
        ("kadd.*", two("add")),
        ("kshift.*l.*", two("shl")),
        ("kshift.*", two("shr")),
        ("ktest.*", compared("and_val", "b::and(o1(), o2())", LOGIC_FLAGS)),
        ("k.+", assigned("o2()")),
    ]


def _vectors() -> list[tuple[str, list[str]]]:
    """What begins with v and no narrower pattern knows."""
    two = lambda op: assigned(f"b::{op}(o2(), o3())")
    # Beginnings of names that pass the second operand.
    passed = "mov|broadcast|compress|expand|pmov|extract|insert|gather|scatter|align[dq]|pblendm|palign"
    return [
        ("vadd.*", two("add")),
        ("vsub.*", two("sub")),
        ("vmul(?!tishiftqb).*", two("mul")),
        ("vdiv.*", two("unsigned_div")),
        ("v(?=.*andn)p?and.*", assigned("b::and(u::not(o2()), o3())")),
        *((f"vp?{op}.*", two(op)) for op in ("and", "or", "xor")),
        ("v(cmp|pcmp|u?comis).*", compared("sub", "b::sub(o1(), o2())", ALL_FLAGS)),
        ("vps(ll|hld).*", two("shl")),
        ("vps(rl|hrd).*", two("shr")),
        ("vpsra.*", two("sar")),
        ("vpro[lr].*", assigned(rotation("shl", "shr", "o2()", "o3()", "o2()", "o2()"))),
        (f"v.*blend.*|v({passed}).*", assigned("o2()")),
        ("vfmadd.*", assigned("b::add(b::mul(o1(), o2()), o3())")),
        ("vfmsub.*", assigned("b::sub(b::mul(o1(), o2()), o3())")),
        ("vfnmadd.*", assigned("b::sub(o3(), b::mul(o1(), o2()))")),
        ("vfnmsub.*", assigned("u::neg(b::add(b::mul(o1(), o2()), o3()))")),
        ("v(fcmadd|fcmulc|fmulc|dp).*", two("mul")),
        ("v(rcp|rsqrt|sqrt|reduce|range|scalef|getexp|getmant|fixup|fpclass|round|rndscale).*", assigned("o2()")),
        ("v.*sad.*", two("sub")),
        ("v.*cnt.*", assigned("o2()")),
        ("v.*test.*", compared("and_val", "b::and(o1(), o2())", LOGIC_FLAGS)),
        ("vzero(all|upper)", NOTHING),
        ("ver[rw]", stub(MNEMONIC)),
        ("v.*", assigned("o2()")),
    ]


def packed() -> dict[str, list[dict]]:
    """The ranked patterns of packed instructions with their bodies, by the letters that a mnemonic begins with."""
    return patterns.buckets(lambda x: stub(MNEMONIC) if x == "exception" else assigned(x))


def families() -> list[tuple[str, str]]:
    """Ranked (anchored pattern, body text) of the families f, k and v, for what no pattern of packed instructions fits."""
    return [(f"^(?:{p})$", "\n".join(lines)) for p, lines in (*_x87(), *_masks(), *_vectors())]
