"""Texts that differ in their numbers alone have one form, which is compiled once.

The compilers copy numbers and do not read them, so what they make of a form,
with its numbers numbered, is what they make of every text of it once the
text's own numbers are put in.  A form is compiled by the JVM's higher-order
functions, which is slow; a text only meets patterns and a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.functions.pseudocode import Grammar, let
from sparquill.stages import stored

_FIRST = 100_000_000  # the first number's mark; marks have nine digits
_MARK = r"(?U)(?<!\w)1[0-9]{8}(?!\w)"
_TAKEN = "1[0-9]{8}"  # a number that is no part of the form's gaps could be taken for a mark


def _whole(form: Column, grammar: Grammar) -> Column:
    """Whether a text is a form of its own."""
    return form.rlike("|".join(filter(None, (_TAKEN, grammar.whole))))


def _short(text: Column, grammar: Grammar) -> Column:
    """The text with 0 for each number, and one name for names that are alike."""
    short = F.regexp_replace(text, grammar.numeral, "0")
    for pattern, name in grammar.alike:
        short = F.regexp_replace(short, pattern, name)
    return short


def _numbered(form: Column, grammar: Grammar) -> Column:
    """A form with the marks of its first, second, ... number in their places."""
    gaps = F.split(form, grammar.numeral, -1)
    return F.array_join(F.transform(gaps, lambda gap, i: F.when(i == 0, gap).otherwise(F.concat((i - 1 + _FIRST).cast("string"), gap))), "")


def compiled(rows: DataFrame, text: str, name: str, grammar: Grammar) -> DataFrame:
    """rows with the column `name`: what the grammar's compiler makes of the column `text` (null for null).

    The forms are a stage, so that their size is known when they are joined: a
    few are broadcast, and many are not.
    """
    short = rows.withColumn("_short", _short(F.col(text), grammar))
    formed = short.withColumn("_form", F.when(_whole(F.col("_short"), grammar), F.col(text)).otherwise(F.col("_short"))).drop("_short")
    own = _whole(F.col("_form"), grammar)
    made = formed.select("_form").where("_form is not null").distinct().withColumn("_ir", grammar.compiler(F.when(own, F.col("_form")).otherwise(_numbered(F.col("_form"), grammar))))
    places = F.transform(F.regexp_extract_all("_ir", F.lit(_MARK), F.lit(0)), lambda mark: (mark.cast("long") - _FIRST).cast("int"))
    parted = made.select(  # no filter on _ir: it would pass below the distinct and be compiled for each row
        "_form",
        F.when(own & F.col("_ir").isNotNull(), F.array("_ir")).otherwise(F.split("_ir", _MARK, -1)).alias("_texts"),
        F.when(own, F.array().cast("array<int>")).otherwise(places).alias("_places"),
    )
    forms = stored(parted, "forms")
    numbers = F.regexp_extract_all(text, F.lit(grammar.numeral), F.lit(0))
    filled = lambda found: F.zip_with("_texts", "_places", lambda t, i: F.when(i.isNull(), t).otherwise(F.concat(t, grammar.written(F.get(found, i)))))
    joined = formed.join(forms, "_form", "left")
    return joined.withColumn(name, let(numbers, lambda found: F.array_join(filled(found), ""))).select(*rows.columns, name)
