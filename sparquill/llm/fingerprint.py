"""Canonical exact digests of documents, in DataFrame functions only.

Canonical form: Unicode compatibility composition (NFKC), full case folding,
NFKC again, runs of white space folded to one blank, ends trimmed.  The
fingerprint is 128 bits of XXH64 (two seeds) of its UTF-8 bytes, as 32 hex
digits.  Groups are formed by hash and, inside equal hashes, by comparing the
bytes.  The digest is exact, so the likeness of two fingerprints is 1 or 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.llm.common import fresh, text_or_empty


def canonical(text: Column) -> Column:
    """The canonical form of a non-null text; ASCII texts need only lower case."""
    compose = lambda x: F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), x, F.lit(True))
    folded = compose(F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), compose(text), F.lit(True)))
    plain = F.octet_length(text) == F.char_length(text)
    return F.trim(F.regexp_replace(F.when(plain, F.lower(text)).otherwise(folded), r"[\s\p{Z}\x{85}]+", " "))


def wide_hash(canon: Column) -> Column:
    """128 bits of XXH64 as 32 lower-case hex digits."""
    part = lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")
    return F.concat(part(F.xxhash64(canon)), part(F.xxhash64(F.lit("second"), canon)))


def digests(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with text (never null), canon and fingerprint; an existing column of these names is replaced."""
    return docs.withColumn("text", text_or_empty(text_col)).withColumn("canon", canonical(F.col("text"))).withColumn("fingerprint", wide_hash(F.col("canon")))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per distinct canonical text: fingerprint, check (SHA-256 of it), group_id (smallest doc_id), group_size (rows).

    Rows are counted before the shuffle, so a group of many copies arrives as
    one row per task.  The grouping key holds the bytes themselves: texts that
    differ stay apart even if their hashes are equal.  group_id is null if all
    doc_ids of the group are.
    """
    return (
        digests(docs.select("doc_id", "text"))
        .groupBy("fingerprint", "canon")
        .agg(F.min("doc_id").alias("group_id"), F.count("*").alias("group_size"))
        .select("fingerprint", F.unhex(F.sha2("canon", 256)).alias("check"), "group_id", "group_size")
    )


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One row of each group, that with the smallest doc_id; rows without doc_id stay.

    A doc_id with several texts is kept where its text's group has no smaller
    one.  Of rows that repeat doc_id and text one stays.  Null texts count as
    empty; other columns are left as they are; an empty table gives no rows.
    """
    mark, check, canon, g_mark, g_check, g_id = fresh(docs, "mark", "check", "canon", "g_mark", "g_check", "g_id")
    marked = docs.withColumn(canon, canonical(text_or_empty()))
    marked = marked.withColumn(mark, wide_hash(F.col(canon))).withColumn(check, F.unhex(F.sha2(canon, 256))).drop(canon)
    kept = exact_groups(docs).where("group_id is not null").select(F.col("fingerprint").alias(g_mark), F.col("check").alias(g_check), F.col("group_id").alias(g_id))
    same = (F.col(mark) == F.col(g_mark)) & (F.col(check) == F.col(g_check)) & (F.col("doc_id") == F.col(g_id))
    found = marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", mark, check])
    return docs.where("doc_id is null").unionByName(found.select(docs.columns))


def _bucket(key: Column, bounds: list) -> Column:
    """How many of the sorted bounds are <= key, looked up in two levels."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    under = lambda array: F.size(F.filter(array, lambda b: b <= key))
    part = under(F.array(*(F.lit(p[0]) for p in parts)))
    inner = F.element_at(F.array(*(F.array(*map(F.lit, p)) for p in parts)), part)
    return F.when(part == 0, 0).otherwise((part - 1) * step + under(inner))


def with_next(docs: DataFrame, *, carry: list[str], bucket_bytes: int = 4 << 20, max_buckets: int = 1 << 16) -> DataFrame:
    """(doc_id, text, *carry) with next_<column> of the next document in descending doc_id, the first after the last.

    Equal ids are ordered by a hash of the text, null ids come last.  No task
    holds the whole order: documents are dealt into ranges of doc_id, those
    without one into ranges of the hash, and each range gets a copy of the
    first document of the range after it.  One copy per range is all that is
    broadcast: at most 2 * max_buckets + 1 keys.
    """
    spark = docs.sparkSession
    rows = docs.withColumn("h", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(min(max_buckets, size // bucket_bytes))
    bounds = []
    if n > 1:
        bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0] or []))
    unnamed = F.shiftrightunsigned("h", 40).cast("int") if n > 1 else F.lit(0)  # the upper 24 bits; the sign bit goes first below
    place = F.floor(F.pmod(unnamed + F.lit(1 << 23), F.lit(1 << 24)) * max(1, n) / (1 << 24)).cast("int") if n > 1 else F.lit(0)
    rows = rows.withColumn("b", F.when(F.col("doc_id").isNull(), place - max(1, n)).otherwise(_bucket(F.col("doc_id"), bounds)))
    heads = sorted(((r.b, r.m.doc_id, r.m.h) for r in rows.groupBy("b").agg(F.max(F.struct("doc_id", "h")).alias("m")).collect()), reverse=True, key=lambda r: r[0])
    guests = [(d, h, heads[i - 1][0]) for i, (_, d, h) in enumerate(heads)]
    sent = spark.createDataFrame(guests, "g_id bigint, g_h bigint, g_b int")
    both = rows.join(F.broadcast(sent), rows["doc_id"].eqNullSafe(sent["g_id"]) & (rows["h"] == sent["g_h"]), "left")
    own, guest = F.struct(F.col("b").alias("b"), F.lit(False).alias("guest")), F.struct(F.col("g_b").alias("b"), F.lit(True).alias("guest"))
    dealt = both.withColumn("at", F.explode(F.when(F.col("g_b").isNull(), F.array(own)).otherwise(F.array(own, guest))))
    order = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("h"))
    names = ["doc_id", "text", *carry]
    return (
        dealt.select(*names, "h", F.col("at.b").alias("range"), F.col("at.guest").alias("guest"))
        .select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in names))
        .where(~F.col("guest"))
        .drop("h", "range", "guest")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, fingerprint, edited_sha256, edited_fingerprint, near_edited, near_next, group_id, group_size.

    Null texts count as empty, whose canonical form is empty.  Repeated rows
    are reported each; an empty table gives no rows.  A likeness is 1 only if
    the canonical bytes are equal, which are compared where hashes are.
    """
    base = digests(docs.select("doc_id", "text")).withColumn("check", F.unhex(F.sha2("canon", 256))).drop("canon")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    paired = with_next(base, carry=["fingerprint", "check"])
    edited = (
        paired.withColumn("n_chars", n.cast("long"))
        .withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
        .withColumn("edited_canon", canonical(F.col("edited")))
        .withColumn("edited_fingerprint", wide_hash(F.col("edited_canon")))
    )
    alike = lambda equal, same: F.when(equal & same, F.lit(1.0)).otherwise(F.lit(0.0))
    told = edited.select(
        "doc_id",
        "n_chars",
        "fingerprint",
        "check",
        F.sha2("edited", 256).alias("edited_sha256"),
        "edited_fingerprint",
        alike(F.col("fingerprint") == F.col("edited_fingerprint"), canonical(F.col("text")) == F.col("edited_canon")).alias("near_edited"),
        alike(F.col("fingerprint") == F.col("next_fingerprint"), canonical(F.col("text")) == canonical(F.col("next_text"))).alias("near_next"),
    )
    groups = exact_groups(docs)
    return told.join(groups, ["fingerprint", "check"], "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "group_id", "group_size"
    )
