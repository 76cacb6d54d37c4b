"""Filter interaction audit: what every order of five filters keeps, removes and spares, as one matrix product.

A document's failures are a mask of five bits.  Per part, the documents of each
of the 32 masks are counted: all, the good and the toxic ones.  These
histograms are the rows of an integer matrix; the columns of the 32 x 600
outcome matrices are the five steps of the 120 orders.  So the texts are read
once, whatever the number of orders.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.llm.common import text_or_empty

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
_BLANKS = " \t\n\x0b\x0c\r"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@cache
def outcomes() -> tuple[list[str], dict[str, np.ndarray]]:
    """The orders, and by outcome a 0/1 matrix of masks by (order, step)."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    masks, columns = np.arange(MASKS), {name: [] for name in COUNTS[:4]}
    for order in orders:
        before = 0
        for letter in order:
            own = 1 << FILTERS.index(letter)
            fails, earlier = masks & own > 0, masks & before > 0
            columns["kept"].append(~fails & ~earlier)
            columns["removed"].append(fails & ~earlier)
            columns["redundant"].append(fails & earlier)
            columns["unique_fails"].append(masks == own)
            before |= own
    return orders, {name: np.array(c, np.int64).T.copy() for name, c in columns.items()}


def text_failures(text: Column) -> Column:
    """The mask of A to D: few words, few distinct words, many capitals, marks.  Words are parted by ASCII blanks."""
    bare = F.btrim(text, F.lit(_BLANKS))
    words = F.split(bare, r"[\x20\x09-\x0D]+", -1)
    n = F.when(bare == "", 0).otherwise(F.size(words)).cast("long")
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    tests = (n < 100, 100 * F.size(F.array_distinct(words)).cast("long") < 80 * n, 100 * capitals.cast("long") > 10 * F.char_length(text), text.rlike(r"[#$%&*|]"))
    return sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))


def histograms(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic), one row per part and mask that occurs.

    Only ids, masks and SHA-256 digests are shuffled, never texts.  Repeated
    rows and copies meet pre-aggregated, so a text that a third of the rows
    share is a row per task, part and label.
    """
    text = text_or_empty(text_col)
    rows = (
        docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
        .select("id", "part", text_failures(F.col("text")).alias("mask"), F.unhex(F.sha2(F.col("text"), 256)).alias("digest"))
        .groupBy("id", "part", "mask", "digest")
        .agg(F.count("*").alias("n"))
        .withColumn("salt", F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)))  # null ids match no label; spread them
    )
    marks = (
        labels.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"), F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"))
        .withColumn("salt", F.lit(0).cast("long"))
    )
    # of the documents with one text, the smallest id passes E; the rest fail, rows without id excepted
    known = F.col("id").isNotNull()
    groups = (
        rows.join(marks, ["id", "salt"], "left")
        .fillna(0, ["good", "toxic"])
        .groupBy("digest", "part", "mask", "good", "toxic")
        .agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("spared"), F.min(F.when(known, F.struct("id", "n"))).alias("least"))
        .withColumn("first", F.min("least.id").over(Window.partitionBy("digest")))
        .withColumn("passes", F.col("spared") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0))
    )
    last = MASKS >> 1
    both = F.array(F.struct(F.col("mask"), F.col("passes").alias("n")), F.struct((F.col("mask") + last).alias("mask"), (F.col("n") - F.col("passes")).alias("n")))
    return (
        groups.select("part", "good", "toxic", F.explode(both).alias("b"))
        .where("b.n > 0")
        .groupBy("part", F.col("b.mask").alias("mask"))
        .agg(F.sum("b.n").alias("n"), F.sum(F.col("b.n") * F.col("good")).alias("good"), F.sum(F.col("b.n") * F.col("toxic")).alias("toxic"))
    )


def audit(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Null texts are empty and null parts the empty string.  Repeated rows count
    each; those of the smallest id all pass E, and rows without id neither fail
    E nor make others fail it.  Repeated labels count once, as their maximum.
    Texts are equal if their SHA-256 digests are.  An empty table gives no rows.
    """
    found = histograms(docs, labels, **options).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    names = ["part", "filter_order", "step", *COUNTS]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, matrix = outcomes()
        width, steps = len(FILTERS), len(orders) * len(FILTERS)
        own = np.array([[FILTERS.index(x) for x in o] for o in orders])
        for whole in batches:
            for at in range(0, whole.num_rows, 64):  # 600 rows a part
                batch = whole.slice(at, 64)
                rows = np.zeros((3, batch.num_rows, MASKS), np.int64)
                for i, cells in enumerate(batch.column(1).to_pylist()):
                    for c in cells:
                        rows[:, i, c["mask"]] = c["n"], c["good"], c["toxic"]
                out = {name: rows[0] @ m for name, m in matrix.items()}
                out["good_lost"], out["toxic_lost"] = rows[1] @ matrix["removed"], rows[2] @ matrix["removed"]
                removed = out["removed"].reshape(-1, len(orders), width)
                by_filter = np.stack([np.where(own == f, removed, 0).sum((1, 2)) for f in range(width)], 1)
                out["shapley"] = by_filter[:, own.ravel()]
                parts = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), steps)))
                keys = [parts, pa.array(np.repeat(orders, width).tolist() * batch.num_rows), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(orders) * batch.num_rows))]
                yield pa.RecordBatch.from_arrays([*keys, *(pa.array(out[name].ravel()) for name in COUNTS)], names)

    return found.mapInArrow(multiply, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))
