"""The pseudocode compilers as columns: everything here is an expression that the JVM evaluates.

An expression is folded over its tokens with an explicit stack.  As the IR is
in prefix form, an operator that waits for its right side is text that is
already written, such as `b::add(o1(), `; the only thing left is how many
parentheses close.  A frame holds one such text for each binding power; a new
operator takes what binds at least as tightly into its left side.

The other grammar has no precedence: it is a ranked table of rewrite rules,
applied to the open pieces of a worklist until none is open.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparquill.functions.registry import ARM_CONDITIONS, OPERANDS, REGISTERS, SIZES, X86_CONDITIONS, target_size

UNKNOWN = "unknown_data()"

# Spelling -> (binding power, IR); higher binds tighter, so shifts bind tighter than products.
BINARY = {
    "OR": (1, "b::or"), "or": (1, "b::or"), "bitwiseOR": (1, "b::or"),
    "XOR": (2, "b::xor"), "xor": (2, "b::xor"), "bitwiseXOR": (2, "b::xor"),
    "AND": (3, "b::and"), "and": (3, "b::and"), "bitwiseAND": (3, "b::and"),
    "+": (4, "b::add"), "-": (4, "b::sub"),
    "*": (5, "b::mul"), "/": (5, "b::unsigned_div"), "MOD": (5, "b::unsigned_rem"), "mod": (5, "b::unsigned_rem"),
    "<<": (6, "b::shl"), "SHL": (6, "b::shl"), ">>": (6, "b::shr"), "SHR": (6, "b::shr"),
}
UNARY = {"NOT": "u::not(", "not": "u::not(", "-": "u::neg("}
# Functions and what stands before their first argument; others are unknown.
CALLS = {"SignExtend": "u::sign_extend(", "ZeroExtend": "u::zero_extend(", "ZERO_EXTEND": "u::zero_extend(", "ZERO_EXTEND_TO_512": "u::zero_extend(", "Abs": "", "Neg": "u::neg("}
POWERS = 6

_COMMENT = r"(?s)\(\*.*?(?:\*\)|\z)"
_TOKEN = r"(?U)(:=|<<|>>|[-+*/;,()\[\]:#{}]|\d\w*|[^\W\d]\w*)"
_BINDING = "array<struct<name:string,ir:string>>"
_FRAME = "struct<slots:array<string>,pre:string,call:string,arg:string>"


def _map(table: dict[str, object]) -> Column:
    """A constant map of strings: one literal, however many rows."""
    return F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in table.items())), F.lit("\x01"), F.lit("\x02"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+\z", "")


def _none(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def tokens(text: Column) -> Column:
    """The tokens; comments, blanks and signs that the language lacks are dropped."""
    return F.regexp_extract_all(F.regexp_replace(text, _COMMENT, " "), F.lit(_TOKEN), 1)


def digits(token: Column) -> Column:
    """A decimal without leading zeros, or a hexadecimal with suffix H as 0x...; anything else is zero."""
    high = F.upper(token)
    return (
        F.when(high.rlike(r"^[0-9A-F]+H\z"), F.concat(F.lit("0x"), F.regexp_replace(high, r"H\z", "")))
        .when(high.rlike(r"^[0-9]+\z"), F.regexp_replace(high, r"^0+(?=[0-9])", ""))
        .otherwise("0")
    )


def number(token: Column) -> Column:
    """c(...) of a number."""
    return F.concat(F.lit("c("), digits(token), F.lit(")"))


def lookup(names: Column | None, name: Column) -> Column:
    """The latest binding of a name in an array of (name, ir), or null."""
    if names is None:
        return _none()
    return let(F.filter(names, lambda n: n["name"] == name), lambda found: F.try_element_at(found, F.lit(-1))["ir"])


def atom(name: Column, temps: Column | None) -> Column:
    known = _map({**REGISTERS, **OPERANDS})
    sized = F.when(name.startswith("imm"), "o2()").when(name.isin("OperandSize", "AddressSize"), "architecture_bit_size()")
    return F.coalesce(F.try_element_at(known, name), lookup(temps, name), sized, F.lit(UNKNOWN))


# -- the fold over tokens ------------------------------------------------------


def _frame(call: Column, slots: Column | None = None, pre: Column | None = None, arg: Column | None = None) -> Column:
    slots = F.array_repeat(F.lit(""), POWERS) if slots is None else slots
    return F.struct(slots.alias("slots"), (F.lit("") if pre is None else pre).alias("pre"), call.alias("call"), (_none() if arg is None else arg).alias("arg"))


def _closed(text: Column, value: Column) -> Column:
    """text + value, with what text leaves open closed: each of its pieces opens one parenthesis more than it closes."""
    opened = lambda t: F.length(F.replace(t, F.lit(")"))) - F.length(F.replace(t, F.lit("(")))
    return let(text, lambda t: F.when(t == "", value).otherwise(F.concat(t, value, F.repeat(F.lit(")"), opened(t)))))


def _all(frame: Column, value: Column) -> Column:
    """The value of a frame whose last operand is `value` (null: missing)."""
    return _closed(F.concat(F.array_join(frame["slots"], ""), frame["pre"]), F.coalesce(value, F.lit(UNKNOWN)))


def _idle(frame: Column) -> Column:
    return (F.array_join(frame["slots"], "") == "") & (frame["pre"] == "")


def _left(frame: Column, value: Column) -> Column:
    """What a frame stands for in the frame around it: its value, or that of its call, which takes the first argument only."""
    argument = F.coalesce(frame["arg"], F.when(value.isNull() & _idle(frame), F.lit("o1()")).otherwise(_all(frame, value)))
    called = let(F.try_element_at(_map(CALLS), frame["call"]), lambda head: F.when(head.isNull(), UNKNOWN).otherwise(_closed(head, argument)))
    return F.when(frame["call"].isNull(), _all(frame, value)).otherwise(called)


def _state(s: Column, **new: Column) -> Column:
    return F.struct(*(new.get(k, s[k]).alias(k) for k in ("stack", "top", "value", "name", "skip", "slice", "done", "eaten")))


def _top(s: Column, **new: Column) -> Column:
    return _frame(*(new.get(k, s["top"][k]) for k in ("call", "slots", "pre", "arg")))


def _operand(s: Column, value: Column, slice_: bool) -> Column:
    """The state after an operand: pending unary operators take it."""
    return _state(s, value=_closed(s["top"]["pre"], value), top=_top(s, pre=F.lit("")), slice=F.lit(slice_), name=_none())


def _closing(s: Column) -> Column:
    """The state after the top frame ended: its value is an operand of the frame below."""
    below = _state(s, stack=F.slice(s["stack"], 1, F.size(s["stack"]) - 1), top=F.element_at(s["stack"], -1))
    return let(F.struct(_left(s["top"], s["value"]).alias("v"), below.alias("s")), lambda b: _operand(b["s"], b["v"], False))


def _prepared(s: Column, token: Column, power: Column) -> Column:
    """What a token that cannot continue a value ends: an argument of the nearest call, or else the expression.

    Parentheses that it leaves open are taken as closed.
    """
    continues = power.isNotNull() | ((token == "[") & s["slice"]) | ((token == ")") & (F.size(s["stack"]) > 0))
    frames = F.concat(s["stack"], F.array(s["top"]))
    calls = F.filter(F.transform(frames, lambda f, i: F.when(f["call"].isNotNull(), i)), lambda i: i.isNotNull())

    def ended(at: Column) -> Column:
        inner = F.reverse(F.slice(frames, at + 2, F.size(frames)))
        value = F.aggregate(inner, s["value"], lambda v, f: _all(f, v))
        call = F.element_at(frames, at + 1)
        top = _frame(call["call"], arg=F.coalesce(call["arg"], _all(call, value)))
        return _state(s, stack=F.slice(frames, 1, at), top=top, value=_none(), slice=F.lit(False), eaten=token == ",")

    stops = s["value"].isNotNull() & (s["skip"] == 0) & ~s["done"] & ~continues
    return F.when(~stops, s).otherwise(let(F.try_element_at(calls, F.lit(-1)), lambda at: F.when(at.isNull(), _state(s, done=F.lit(True))).otherwise(ended(at))))


def _advance(s: Column, token: Column, following: Column, power: Column, temps: Column | None) -> Column:
    deeper = _state(s, stack=F.concat(s["stack"], F.array(s["top"])), top=_frame(s["name"]), name=_none())
    waiting = (
        F.when(token.isin(*UNARY), _state(s, top=_top(s, pre=F.concat(s["top"]["pre"], F.element_at(_map(UNARY), token)))))
        .when(token == "(", deeper)
        .when(token.rlike(r"(?U)^\d"), _operand(s, number(token), False))
        .when(token.rlike(r"(?U)^\w") & following.eqNullSafe("("), _state(s, name=token))
        .when(token.rlike(r"(?U)^\w"), _operand(s, atom(token, temps), True))
        .when(s["top"]["call"].isNotNull() & _idle(s["top"]) & (token == ")"), _closing(s))
        .when(s["top"]["call"].isNotNull() & _idle(s["top"]) & (token == ","), s)
        .otherwise(_operand(s, F.lit(UNKNOWN), False))
    )
    slots, at = s["top"]["slots"], power - 1
    tight = _closed(F.array_join(F.slice(slots, power, POWERS), ""), s["value"])  # what binds at least as tightly
    pending = F.concat(F.element_at(_map({k: f"{ir}(" for k, (_, ir) in BINARY.items()}), token), tight, F.lit(", "))
    joined = _state(s, value=_none(), slice=F.lit(False), top=_top(s, slots=F.concat(F.slice(slots, 1, at), F.array(pending), F.array_repeat(F.lit(""), POWERS - power))))
    return (
        F.when(s["done"], s)
        .when(s["eaten"], _state(s, eaten=F.lit(False)))
        .when(s["skip"] > 0, _state(s, skip=s["skip"] + F.when(token == "[", 1).when(token == "]", -1).otherwise(0)))
        .when(s["value"].isNull(), waiting)
        .when(power.isNotNull(), joined)
        .when(token == "[", _state(s, skip=F.lit(1), slice=F.lit(False)))  # bit slices have no IR
        .otherwise(_closing(s))
    )


def expression(text: Column, temps: Column | None = None) -> Column:
    """IR of an expression; unknown_data() if there is none, null for null.  temps: an array of (name, ir).

    Text after the expression is left aside, and a missing operand is unknown.
    """
    pairs = lambda seen: F.transform(seen, lambda t, i: F.struct(t.alias("t"), F.get(seen, i + 1).alias("next"), F.try_element_at(_map({k: p for k, (p, _) in BINARY.items()}), t).cast("int").alias("power")))
    start = F.struct(
        F.array().cast(f"array<{_FRAME}>").alias("stack"), _frame(_none()).cast(_FRAME).alias("top"), _none().alias("value"), _none().alias("name"),
        F.lit(0).alias("skip"), F.lit(False).alias("slice"), F.lit(False).alias("done"), F.lit(False).alias("eaten"),
    )
    step = lambda s, p: let(_prepared(s, p["t"], p["power"]), lambda ready: _advance(ready, p["t"], p["next"], p["power"], temps))
    end = lambda s: F.aggregate(F.reverse(F.concat(s["stack"], F.array(s["top"]))), s["value"], lambda v, f: _left(f, v))
    return F.when(text.isNotNull(), F.aggregate(let(tokens(text), pairs), start, step, end))


def condition(text: Column, compat: bool = True) -> Column:
    """IR of a comparison, or null.  With compat, >= and <= count as equality, their sign being dropped."""
    shapes = {} if compat else {">=": "u::not(b::signed_less(%1$s, %2$s, o1_size()))", "<=": "u::not(b::signed_less(%2$s, %1$s, o1_size()))"}
    shapes |= {"=": "b::equal(%1$s, %2$s, o1_size())", ">": "b::signed_less(%2$s, %1$s, o1_size())", "<": "b::signed_less(%1$s, %2$s, o1_size())"}
    sides = lambda sign: rf"(?s)^\s*(\S.*?)\s*{sign}\s*(\S.*)\z"
    fits = [(sign, text.rlike(sides(sign)) & (~F.contains(text, F.lit(":=")) if sign == "=" else F.lit(True))) for sign in shapes]
    pick = lambda of: F.coalesce(*(F.when(fit, of(sign)) for sign, fit in fits))
    both = F.array(*(pick(lambda sign, i=i: F.regexp_extract(text, sides(sign), i)) for i in (1, 2)))
    made = lambda ir: pick(lambda sign: F.format_string(shapes[sign], F.element_at(ir, 1), F.element_at(ir, 2)))
    return let(F.transform(both, lambda side: expression(side)), made)


# -- statements ---------------------------------------------------------------

# Headings that end an operation.
STOPS = (
    "Intel C/C++ Compiler Intrinsic Equivalent", "Flags Affected", "SIMD Floating-Point Exceptions", "Other Exceptions", "Protected Mode Exceptions",
    "Real-Address Mode Exceptions", "Virtual-8086 Mode Exceptions", "Virtual 8086 Mode Exceptions", "Floating-Point Exceptions", "Numeric Exceptions",
    "Compatibility Mode Exceptions", "64-Bit Mode Exceptions",
)

def clean_lines(operation: Column) -> Column:
    lines = F.transform(F.split(operation, "\n"), lambda x: _strip(F.regexp_replace(x, r"\(\*.*?\*\)", "")))
    prose = "^(?:" + "|".join(map(re.escape, ("The ", "This ", "Note", *STOPS))) + ")"
    return F.filter(lines, lambda x: (x != "") & ~x.rlike(prose))


def _begins(word: str) -> Callable[[Column], Column]:
    return lambda line: F.upper(line).startswith(f"{word} ")


def _numbered(head: str, lets: Column) -> Column:
    return F.concat(F.lit(head), F.size(lets).cast("string"))


def _made(s: Column, *, let: Column | None = None, name: Column | None = None, known: Column | None = None) -> Column:
    more = lambda column, x: column if x is None else F.concat(column, F.array(x))
    return F.struct(more(s["lets"], let).alias("lets"), more(s["names"], name).alias("names"), (s["known"] if known is None else F.concat(s["known"], known)).alias("known"))


def _fresh_body() -> Column:
    return F.struct(F.array().cast("array<string>").alias("lets"), F.array().cast("array<string>").alias("names"), F.array().cast(_BINDING).alias("known"))


def _bound(name: Column, ir: Column) -> Column:
    return F.struct(name.alias("name"), ir.alias("ir"))


def assignments(lines: Column) -> Column:
    """struct(lets, names, known) of flat assignments; temporaries become bindings."""
    shape = r"^(\w+)(?:\[.*?\])?\s*:=\s*(.+)"
    places = {**REGISTERS, **OPERANDS}
    sizes = {n: target_size(n) for n in {**REGISTERS, **SIZES}}

    def line(s: Column, raw: Column) -> Column:
        parts = lambda text: F.struct(text.alias("text"), F.regexp_extract(text, shape, 1).alias("name"), F.regexp_extract(text, shape, 2).alias("value"))
        return let(let(F.regexp_replace(raw, r"[;\s]+\z", ""), parts), lambda p: read(s, p["text"], p["name"], p["value"]))

    def read(s: Column, text: Column, name: Column, value: Column) -> Column:
        n = s["lets"]

        def assigned(value: Column) -> Column:
            temp, stmt = _numbered("v_", n), _numbered("stmt_", n)
            held = _made(s, let=F.concat(F.lit("    let "), temp, F.lit(" = "), value, F.lit(";")), known=F.array(_bound(name, temp)))
            place = [F.coalesce(F.try_element_at(_map(table), name), F.lit(default)) for table, default in ((places, "o1()"), (sizes, "o1_size()"))]
            put = _made(s, let=F.concat(F.lit("    let "), stmt, F.lit(" = assign("), value, F.lit(", "), place[0], F.lit(", "), place[1], F.lit(");")), name=stmt)
            return F.when(name.rlike("^(?:temp|tmp)"), held).otherwise(put)

        raised = _made(s, name=F.concat(F.lit('exception("'), text, F.lit('")')))
        return F.when(text.startswith("#"), raised).when(name == "", s).otherwise(let(expression(value, s["known"]), assigned))

    return F.aggregate(lines, _fresh_body(), line)


def _body(made: Column) -> Column:
    """Body lines of what assignments() made, or null if it makes no statement."""
    last = F.concat(F.lit("    ["), F.array_join(made["names"], ", "), F.lit("].into()"))
    return F.when(F.size(made["names"]) > 0, F.concat(made["lets"], F.array(last)))


def branches(lines: Column) -> Column:
    """struct(head, parts) of the first IF block: its condition, and its THEN and ELSE lines, by nesting depth."""
    words = F.split(F.regexp_replace(F.array_join(lines, "\n"), r"\b(THEN|ELSE|FI)\b;?", "\n$1\n"), "\n")
    start = F.struct(_none().alias("head"), F.lit(0).alias("depth"), F.lit(1).alias("side"), F.lit(False).alias("over"), F.array().cast("array<struct<side:int,line:string>>").alias("held"))

    def step(s: Column, word: Column) -> Column:
        opens, closes = _begins("IF")(word), word == "FI"
        depth = s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        first = opens & (depth == 1)
        turns = word.isin("THEN", "ELSE") & (depth == 1)
        held = (word != "") & (depth > 0) & ~first & ~closes & ~turns
        now = F.struct(
            F.when(first & s["head"].isNull(), F.substring(word, 4, 1 << 30)).otherwise(s["head"]).alias("head"), depth.alias("depth"),
            F.when(turns, F.when(word == "THEN", 1).otherwise(2)).otherwise(s["side"]).alias("side"), (closes & (depth == 0)).alias("over"),
            F.when(held, F.concat(s["held"], F.array(F.struct(s["side"].alias("side"), word.alias("line"))))).otherwise(s["held"]).alias("held"),
        )
        return F.when(s["over"], s).otherwise(now)

    part = lambda s, side: F.transform(F.filter(s["held"], lambda h: h["side"] == side), lambda h: h["line"])
    return F.aggregate(F.transform(words, _strip), start, step, lambda s: F.struct(s["head"].alias("head"), F.array(part(s, 1), part(s, 2)).alias("parts")))


FLAT, BLOCK = 5, 30  # the most lines of an operation without and with IF that is translated


def translate(operation: Column) -> Column:
    """Body lines of an operation of a few assignments or one IF block; null if it is not that simple."""

    def of(lines: Column) -> Column:
        blocks = F.exists(lines, _begins("IF"))
        fits = (F.size(lines) > 0) & ~F.exists(lines, _begins("FOR")) & (F.size(lines) <= F.when(blocks, BLOCK).otherwise(FLAT))
        flat = F.struct(_none().alias("head"), F.array(lines, F.array().cast("array<string>")).alias("parts"))
        return F.when(fits, let(F.when(blocks, branches(lines)).otherwise(flat), lambda found: chosen(found, blocks)))

    def chosen(found: Column, blocks: Column) -> Column:
        head = F.coalesce(found["head"], F.lit(""))
        made = F.transform(found["parts"], assignments)

        def pick(both: Column) -> Column:
            then, other = F.element_at(both, 1), F.element_at(both, 2)
            has_other = F.size(F.element_at(found["parts"], 2)) > 0
            line = lambda test: F.concat(F.lit("    let cond = condition("), test, F.lit(", ["), F.array_join(then["names"], ", "), F.lit("], []);"))
            simple = lambda test: F.when(test.isNotNull() & (F.size(then["names"]) > 0) & (F.size(other["names"]) == 0), F.concat(then["lets"], F.array(line(test), F.lit("    [cond].into()"))))
            general = F.coalesce(let(condition(head), simple), F.when(has_other, _body(other)))
            return F.when(~blocks, _body(then)).when(F.contains(F.lower(head), F.lit("64-bit")), _body(other)).when(F.contains(head, F.lit("OperandSize")), _body(then)).otherwise(general)

        return let(made, pick)

    return let(clean_lines(operation), of)


# -- the other grammar: ranked rewriting ---------------------------------------

# Registers of the pseudocode and the operands that they name.
ARM_REGISTERS = {
    "X[d]": "o1", "W[d]": "o1", "V[d]": "o1",
    "X[n]": "o2", "W[n]": "o2", "V[n]": "o2",
    "X[m]": "o3", "W[m]": "o3", "V[m]": "o3",
    "X[t]": "o1", "W[t]": "o1", "V[t]": "o1",
    "X[s]": "o2", "W[s]": "o2",
    "X[a]": "o3", "V[a]": "o3",
}

#: (pattern of the whole text, template).  The lowest rank that fits answers; what stands in braces is rewritten in turn.
#: The order of the rows is the language's: operators part a text by their row, not by precedence.
ARM_RULES = [
    *((re.escape(name), f"{operand}()") for name, operand in ARM_REGISTERS.items()),
    ("PSTATE[.]N", "pstate_n.clone()"),
    ("PSTATE[.]Z", "pstate_z.clone()"),
    ("PSTATE[.]C", "pstate_c.clone()"),
    ("PSTATE[.]V", "pstate_v.clone()"),
    (r"NOT\((.+)\)", "u::not({$1})"),
    (r"(?:Zero|Sign)Extend\((.+?)(?:,\s*\w+)?\)", "{$1}"),
    (r"Abs\((.+)\)", "{$1}"),
    (r"[SU]Int\((.+)\)", "{$1}"),
    (r"([0-9]+|0x[0-9A-Fa-f]+)", "c($1)"),
    (r"(.+)<[0-9]+:[0-9]+>", "{$1}"),
    (r"(.*?) EOR (.*)", "b::xor({$1}, {$2})"),
    (r"(.*?) AND (.*)", "b::and({$1}, {$2})"),
    (r"(.*?) OR (.*)", "b::or({$1}, {$2})"),
    (r"(.*?) \+ (.*)", "b::add({$1}, {$2})"),
    (r"(.*?) - (.*)", "b::sub({$1}, {$2})"),
    (r"(.*?) \* (.*)", "b::mul({$1}, {$2})"),
    (r"(.*?) DIV (.*)", "b::unsigned_div({$1}, {$2})"),
    (r"(.*?) MOD (.*)", "b::unsigned_mod({$1}, {$2})"),
    (r"AddWithCarry\((.+?),\s*(.+?),\s*(.+?)\)", "b::add(b::add({$1}, {$2}), {$3})"),
    (r"ShiftReg\(\s*([A-Za-z]+)\s*,.+?,.+?\)", "{X[$1]}"),
    (r"ShiftReg\(.+?,.+?,.+?\)", "o2()"),
    (r"\((.*)\)", "{$1}"),
    (r".*", UNKNOWN),
]


def rewritten(text: Column, rules: list[tuple[str, str]], names: Column | None = None) -> Column:
    """The text rewritten by ranked rules until no piece is open; a name that is bound is its IR before any rule.

    A rule's open pieces are shorter than its text, so there are at most as
    many rounds as characters.
    """
    piece = lambda open_, x: F.struct(F.lit(open_).alias("open"), x.alias("text"))

    def answer(s: Column) -> Column:
        ranked = [let(lookup(names, s), lambda ir: F.when(ir.isNotNull(), F.array(piece(False, ir))))] if names is not None else []
        for pattern, template in rules:
            whole = rf"(?s)\A(?:{pattern})\z"
            parts = [(i % 2 == 1, x) for i, x in enumerate(re.split(r"\{(.*?)\}", template)) if x]
            ranked.append(F.when(s.rlike(whole), F.array(*(piece(o, F.regexp_replace(s, whole, x) if "$" in x else F.lit(x)) for o, x in parts))))
        return F.coalesce(*ranked)

    bare = lambda x: F.regexp_replace(x, r"^\s+|[;\s]+\z", "")
    once = lambda items: F.flatten(F.transform(items, lambda i: F.when(i["open"], let(bare(i["text"]), answer)).otherwise(F.array(i))))
    turn = lambda items, _: F.when(F.exists(items, lambda i: i["open"]), once(items)).otherwise(items)
    rounds = F.sequence(F.lit(1), F.length(text) + 1)
    return F.aggregate(rounds, F.array(piece(True, text)), turn, lambda items: F.array_join(F.transform(items, lambda i: i["text"]), ""))


def arm_expression(text: Column, names: Column | None = None) -> Column:
    """IR of an ARM expression; null for null."""
    return F.when(text.isNotNull(), rewritten(text, ARM_RULES, names))


# Functions that an operation may not call, and beginnings of lines that compute nothing.
ARM_COMPLEX = (
    "AArch64.", "Poly", "CRC", "SHA", "AES", "SM3", "SM4", "FPToFixed", "FixedToFP", "FPCompare", "FPRound", "SatQ", "UnsignedSatQ", "SignedSatQ",
    "ConditionHolds", "BigEndianReverse", "Hint_", "System", "ExclusiveMonitors",
)
ARM_SKIPPED = (
    "CheckFPAdvSIMDEnabled64", "CheckFPEnabled64", "CheckSVEEnabled", "CheckSVEAndSMEnabled", "CheckSMEEnabled", "CheckSMEAndZAEnabled",
    "AArch64.CheckFPAdvSIMDEnabled", "SetTagCheckedInstruction", "boolean", "integer d =", "integer n =", "integer m =", "integer t =", "integer s =",
    "integer a =", "integer datasize", "integer esize", "integer elements", "integer regsize", "integer pairs", "integer part", "constant integer",
    "bits(datasize) result;", "bits(datasize) operand", "bits(esize)", "bits(4) nzcv", "boolean sub_op", "boolean setflags", "boolean unsigned",
    "boolean neg ", "boolean pair", "boolean replicate", "boolean is_neg", "ShiftType shift_type", "LogicalOp op ", "MoveWideOp opcode", "CountOp opcode",
    "ReduceOp op", "CompareOp op ", "FPMaxMinOp op", "FPUnaryOp fpop", "FPConvOp fpop", "BranchType branch_type", "AccType acctype", "bit carry_in", "bit sub_op",
)
# Reasons to leave an operation alone, in order.
ARM_UNSUPPORTED = (
    ("unsupported: for-loop (SIMD element-wise)", r"(?m)^\s*(?:for|FOR) "), ("unsupported: while-loop", r"(?m)^\s*(?:while|WHILE) "),
    ("unsupported: Elem[] vector element access", r"Elem\["), ("unsupported: memory access Mem[]", r"Mem[\[(]"),
    ("unsupported: complex function call", "|".join(map(re.escape, ARM_COMPLEX))),
)
FLAT_LINES, BRANCHED_LINES = 10, 15  # the most lines of an ARM operation that is translated


def arm_unsupported(operation: Column) -> Column:
    """Why an ARM operation is not translated, or null."""
    return F.coalesce(*(F.when(operation.rlike(p), F.lit(reason)) for reason, p in ARM_UNSUPPORTED))


def arm_lines(operation: Column) -> Column:
    """The lines that compute something, without their semicolons."""
    idle = "^(?:// )?(?:" + "|".join(map(re.escape, ARM_SKIPPED)) + r")|^(?:bits\(\w+\)|integer|bit)\s+\w+\z"
    lines = F.transform(F.split(operation, "\n"), lambda x: F.regexp_replace(x, r"^\s+|[;\s]+\z", ""))
    return F.filter(lines, lambda x: (x != "") & ~x.rlike(idle))


#: Kinds of lines, the first that fits, and where a line of a kind leads from outside (`out`) and inside (`in`) of a branch.
ARM_LINES = [("single", r"^(?:if|IF)\s+.+\s+(?:then|THEN)\s+."), ("if", "^(?:if|IF) "), ("else", "^(?:else|ELSE)"), ("end", r"^(?:(?:end|END)|(?:fi|FI)\z)")]
ARM_TURNS = {"out if": "in", "out else": "in", "in else": "out", "in end": "out"}
ARM_KEPT = ("out end", "out other")


def unconditional(lines: Column) -> Column:
    """The lines outside of IF branches, by the automaton of ARM_TURNS."""
    kind = lambda x: F.coalesce(*(F.when(x.rlike(p), F.lit(k)) for k, p in ARM_LINES), F.lit("other"))
    start = F.struct(F.lit("out").alias("at"), F.array().cast("array<string>").alias("kept"))

    def step(s: Column, x: Column) -> Column:
        met = F.concat(s["at"], F.lit(" "), kind(x))
        kept = F.when(met.isin(*ARM_KEPT), F.concat(s["kept"], F.array(x))).otherwise(s["kept"])
        return F.struct(F.coalesce(F.try_element_at(_map(ARM_TURNS), met), s["at"]).alias("at"), kept.alias("kept"))

    return F.aggregate(lines, start, step, lambda s: s["kept"])


#: Ranked statements: the place's pattern, and IR and size of what it assigns to (None: a binding of the names in it).
ARM_PLACES = [
    (r"\((\w+),\s*(\w+)\)", None),
    *((re.escape(name) + "(?:<[^>]+>)?", (f"{o}()", f"{o}_size()")) for name, o in ARM_REGISTERS.items()),
    *((f"PSTATE[.]{f.upper()}(?:<[^>]+>)?", (f"pstate_{f}.clone()", f"size_relative(pstate_{f}.clone())")) for f in "nzcv"),
    (r"([a-z_]\w*)(?:<[^>]+>)?", None),
]


def arm_assignments(lines: Column) -> Column:
    """struct(lets, names, known) of ARM assignments by the ranked places; other lines are left aside."""

    def line(s: Column, text: Column) -> Column:
        def assigned(value: Column) -> Column:
            temp, stmt, ranked = _numbered("v_", s["lets"]), _numbered("stmt_", s["lets"]), []
            for pattern, place in ARM_PLACES:
                whole = rf"\A{pattern}\s*=\s*.+\z"
                if place:
                    out = _made(s, let=F.concat(F.lit("    let "), stmt, F.lit(" = assign("), value, F.lit(f", {place[0]}, {place[1]});")), name=stmt)
                else:
                    groups = re.compile(pattern).groups
                    ir = F.concat(temp, F.lit(".clone()")) if groups == 2 else temp
                    names = F.array(*(_bound(F.regexp_extract(text, whole, g + 1), ir) for g in range(groups)))
                    out = _made(s, let=F.concat(F.lit("    let "), temp, F.lit(" = "), value, F.lit(";")), known=names)
                ranked.append(F.when(text.rlike(whole), out))
            return F.coalesce(*ranked, s)

        value = F.regexp_extract(text, r"^(?:\(\w+,\s*\w+\)|\S+?(?:\[.*?\])?(?:<[^>]+>)?)\s*=\s*(.+)\z", 1)
        return let(value, lambda v: F.when(v == "", s).otherwise(let(arm_expression(v, s["known"]), assigned)))

    return F.aggregate(lines, _fresh_body(), line)


def arm_translate(operation: Column) -> Column:
    """Body lines of the assignments of a short ARM operation; conditional statements are dropped, longer operations left alone."""

    def of(lines: Column) -> Column:
        branched = F.exists(lines, lambda x: x.rlike("^(?:if|IF) "))
        fits = F.size(lines) <= F.when(branched, BRANCHED_LINES).otherwise(FLAT_LINES)
        return F.when(fits, _body(arm_assignments(F.when(branched, unconditional(lines)).otherwise(lines))))

    return F.when(arm_unsupported(operation).isNull(), let(arm_lines(operation), of))


def compile_expression(text: Column) -> Column:
    """IR of expressions; null for null."""
    return expression(text)


def compile_operation(operation: Column, arch: str) -> Column:
    """Body lines of operations, or null."""
    return translate(operation) if arch == "x86_64" else arm_translate(operation)


class Grammar(NamedTuple):
    """A compiler, and the numbers that it copies without reading them.

    numeral: their pattern.  alike: (pattern, name) of names that it does not
    tell apart.  whole: texts whose numbers it does read.  written: how it
    writes a number.
    """

    compiler: Callable[[Column], Column]
    numeral: str
    alike: tuple[tuple[str, str], ...] = ()
    whole: str = ""
    written: Callable[[Column], Column] = lambda token: token


#: Without bindings no number and no name is copied but by number(), and no name of small letters and a digit is known.
EXPRESSION = Grammar(compile_expression, r"(?U)(?=\d)(?<!\w)\w+", alike=((r"(?U)(?=[a-z])(?<!\w)([a-z]++)\d\w*", "$1_"),), written=digits)

# Decimals that stand alone.  Left as they are: those of the headings and conditions that are compared (64-bit, 8086, bits(4)), and
# those beside a comment, which it may have parted from others.
_PLAIN = r"(?U)(?=[0-9])(?<!\w|\*\)|bits\()(?!(?:64|8086)(?!\w))(?:0|[1-9][0-9]*+)(?!\w|-[bB]|\(\*)"
OPERATIONS = {
    "x86_64": Grammar(lambda text: F.array_join(compile_operation(text, "x86_64"), "\n"), _PLAIN),
    "arm": Grammar(lambda text: F.array_join(compile_operation(text, "arm"), "\n"), _PLAIN, whole=r"\((?:[0-9]+,\s*\w+|\w+,\s*[0-9]+)\)\s*="),  # a number as a name
}


def condition_of(mnemonic: Column, prefix: str, arch: str = "x86_64") -> Column:
    """The condition expression of a mnemonic that is the prefix and a condition code, or null."""
    table = X86_CONDITIONS if arch == "x86_64" else ARM_CONDITIONS
    pairs = F.create_map(*(F.lit(x) for k, v in table.items() for x in (prefix + k, v)))
    return F.try_element_at(pairs, mnemonic)
