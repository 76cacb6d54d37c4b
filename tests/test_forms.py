"""Texts compiled by their forms: the same results as compiled one by one, and a fold for each form only."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sparquill import catalogue
from sparquill.functions import pseudocode
from sparquill.operators import forms

NUMBERS = ["0", "7", "12", "007", "64", "8086", "0FFH", "1FH", "0x1F", "5é", "9z", "100000000", "100000001", "123456789", "٣", "4"]
EXPRESSIONS = ["DEST", "SRC2", "XMM#", "imm#", "tmp#", "or#", "é#", "#", "#", "#", "(* # *)", "(*", "*)", "(", ")", "[#:#]", "+", "-", "<<", "*", "OR", "MOD", "NOT", "SignExtend(", "Foo(#, #)", ",", ";", "~", ".", "\n", "", " "]
VALUES, SIGNS = ["DEST", "SRC2", "XMM#", "imm#", "tmp#", " #", " #", "(SRC + #)", "Abs(#)", "- #", "(*a*)#"], ["+", "-", "*", "<<", "OR", "MOD", "(*x*)", ""]
LINES = {
    "x86_64": [
        "DEST := SRC + #;", "tmp# := #", "DEST := tmp7 - tmp12 * #", "# := #", "EAX[#:#] := #(* # *)#", "DEST := #(**)-bit#", "#UD # c(#) #-bit", "#GP(#)", "(* # *)", "#-Bit Mode Exceptions", "Virtual-# Mode Exceptions",
        "Virtual # Mode Exceptions", "The #", "IF #-bit mode THEN #UD #; ELSE DEST := SRC - #; FI;", "IF DEST = # THEN DEST := #; FI;", "IF SRC > #(*x*)# THEN DEST := #; ELSE DEST := #; FI;", "IF OperandSize = # THEN DEST := #; FI;", "FOR j := # TO #",
    ],
    "arm": [
        "X[d] = #", "X[d] = X[n] + #;", "X[d] = X[n]<#:#> EOR #", "(#, x) = X[n] - #", "(x, #) = X[n] - #", "x = #", "X[d] = x + #", "PSTATE.C = nzcv<#:#>", "(a, nzcv) = AddWithCarry(X[n], #, #)", "bits(#) nzcv = #", "bits(#) x", "integer #",
        "integer d = #", "X[d] = ZeroExtend(#, #)", "X[d] = ShiftReg(#, LSL, #)", "X[d]<#:#> = NOT(#) OR Foo(#)", "if a == # then X[d] = #;", "if a then", "else", "fi", "X[d] = Mem[#, #]",
    ],
}


def _filled(rng, text):
    """The text with a number for each # that does not begin an exception's name."""
    return re.sub("#(?![UG])", lambda _: rng.choice(NUMBERS), text)


def _both(spark, texts, grammar):
    """What the grammar's compiler makes of texts one by one, and by their forms."""
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, s string").repartition(4).cache()
    single = {r.id: r.x for r in rows.select("id", grammar.compiler(F.col("s")).alias("x")).collect()}
    got = forms.compiled(rows, "s", "x", grammar)
    assert got.columns == ["id", "s", "x"]
    formed = {r.id: r.x for r in got.collect()}
    assert len(formed) == len(texts)
    return [(texts[i], single[i], formed[i]) for i in range(len(texts)) if single[i] != formed[i]], single


def test_expressions_by_form(spark):
    rng = random.Random(3)
    odd = ["".join(rng.choice(EXPRESSIONS) + rng.choice(["", " "]) for _ in range(rng.randrange(1, 9))) for _ in range(1500)]
    usual = ["".join(f"{rng.choice(VALUES)} {rng.choice(SIGNS)} " for _ in range(rng.randrange(1, 5))) + rng.choice(VALUES) for _ in range(1500)]
    texts = [None, "", *(_filled(rng, text) for text in odd + usual)]
    wrong, single = _both(spark, texts, pseudocode.EXPRESSION)
    assert wrong == [] and len(set(single.values())) > 300


@pytest.mark.parametrize("arch", ["x86_64", "arm"])
def test_operations_by_form(spark, arch):
    rng = random.Random(4)
    texts = [None, "", *LINES[arch], *(_filled(rng, "\n".join(rng.choice(LINES[arch]) for _ in range(rng.choice([1, 1, 2, 3, 5])))) for _ in range(2000))]
    wrong, single = _both(spark, texts, pseudocode.OPERATIONS[arch])
    assert wrong == [] and len(set(single.values())) > 300


@pytest.mark.parametrize("name", ["expr_compile", "operation_compile"])
def test_rows_are_not_folded(spark, name):
    """The fold over tokens runs for forms, and not in the plan of the rows."""
    plan = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and "Join" in plan
