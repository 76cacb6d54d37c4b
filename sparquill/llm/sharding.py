"""Byte-balanced shards by histogram sort, in DataFrame functions only.

Rows are ordered by (hash of the text, hash of doc_id): equal texts are
neighbours, and only a splitter that has to cut a large group parts them.
Each pass counts the exact bytes and rows below candidate boundaries over all
partitions; the interval around every wanted quantile is refined until its
boundary is near enough; then the rows are exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparquill.llm.common import cut, fresh, text_or_empty

TOP = 12  # bits of the first histogram
_SPAN = 1 << 63


def keyed(docs: DataFrame) -> DataFrame:
    """docs with size (UTF-8 bytes of the text plus 8), text_crc32 and the two sort keys h and t, each of 63 bits."""
    return (
        docs.withColumn("size", (F.octet_length(text_or_empty()) + 8).cast("long"))
        .withColumn("text_crc32", F.crc32(text_or_empty().cast("binary")))
        .withColumn("h", F.shiftrightunsigned(F.xxhash64(text_or_empty()), 1))
        .withColumn("t", F.shiftrightunsigned(F.xxhash64("doc_id"), 1))
    )


@dataclass
class _Probe:
    """An interval of keys that still holds a wanted quantile; below: bytes and rows before it."""

    want: float
    slack: float
    below: tuple[int, int]
    h: tuple[int, int]
    t: tuple[int, int] = (0, _SPAN)

    @property
    def on_t(self) -> bool:
        return self.h[1] - self.h[0] == 1

    def interval(self) -> tuple[int, int]:
        return self.t if self.on_t else self.h


@dataclass(frozen=True)
class Plan:
    """Splitters (h, t), the rows before each, and how many ranges make a shard."""

    splitters: list[tuple[int, int]]
    rows_before: list[int]
    per_shard: int
    shards: int


def _refine(rows: DataFrame, open_: list[_Probe], probes: int) -> list[_Probe | tuple[tuple[int, int], int]]:
    """One counting pass: each interval becomes smaller, or a splitter with the rows before it."""
    spark = rows.sparkSession
    asked = sorted({(p.h, p.t) for p in open_})
    number = {x: i for i, x in enumerate(asked)}
    table = []
    for (h, t), i in number.items():
        on_t = h[1] - h[0] == 1
        lo, hi = t if on_t else h
        table.append((h[0] >> (63 - TOP), i, h[0], h[1] - 1, t[0], t[1] - 1, on_t, lo, max(1, -(-(hi - lo) // probes))))
    sent = spark.createDataFrame(table, "top long, i int, h0 long, h1 long, t0 long, t1 long, on_t boolean, lo long, width long")
    inside = rows.join(F.broadcast(sent), "top").where("h between h0 and h1 and t between t0 and t1")
    counts: dict[int, list] = {}
    for r in (
        inside.groupBy("i", F.expr("((case when on_t then t else h end) - lo) div width").alias("at"))
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("h").alias("hmin"), F.max("h").alias("hmax"))
        .collect()
    ):
        counts.setdefault(r.i, []).append(r)
    width, out = {x[1]: x[8] for x in table}, []
    for p in open_:
        i, (lo, hi) = number[p.h, p.t], p.interval()
        bytes_, rows_ = p.below
        for r in sorted(counts.get(i, []), key=lambda r: r.at):
            if bytes_ + r.bytes >= p.want:
                break
            bytes_, rows_ = bytes_ + r.bytes, rows_ + r.rows
        else:  # every byte of the interval lies below the wanted quantile
            out.append(((p.h[1], 0) if not p.on_t else _after(p, hi), rows_))
            continue
        start, stop = lo + r.at * width[i], min(hi, lo + (r.at + 1) * width[i])
        before, after = p.want - bytes_, bytes_ + r.bytes - p.want
        single = r.rows == 1 or (p.on_t and stop - start == 1)
        edge = (lambda x: (p.h[0], x) if p.on_t and x < _SPAN else (x, 0) if not p.on_t else (p.h[0] + 1, 0))
        if min(before, after) <= p.slack or single:
            out.append((edge(start), rows_) if before <= after else (edge(stop), rows_ + r.rows))
        elif not p.on_t:
            h = (r.hmin, r.hmin + 1) if r.hmin == r.hmax else (start, stop)
            out.append(_Probe(p.want, p.slack, (bytes_, rows_), h))
        else:
            out.append(_Probe(p.want, p.slack, (bytes_, rows_), p.h, (start, stop)))
    return out


def _after(p: _Probe, x: int) -> tuple[int, int]:
    return (p.h[0], x) if x < _SPAN else (p.h[0] + 1, 0)


def plan(rows: DataFrame, shards: int = 24, *, tolerance: float = 0.001, range_bytes: int = 1 << 30, max_ranges: int = 512, probes: int = 128) -> Plan:
    """Splitters that cut the rows of keyed() into shards of equal bytes.

    A boundary is off by at most `tolerance` of a shard, or half a row's bytes
    where rows are larger.  A shard is cut further into up to max_ranges ranges
    of about range_bytes, so that a task's share is bounded.  The driver holds
    the first histogram (4,096 counts) and `probes` counts for each interval.
    Rows alike in both keys (repeated rows) cannot be parted and stay together.
    """
    rows = rows.select("h", "t", "size", F.shiftright("h", 63 - TOP).alias("top"))
    first = sorted(rows.groupBy("top").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect(), key=lambda r: r.top)
    total = sum(r.bytes for r in first)
    per = max(1, min(max_ranges, round(total / shards / range_bytes)))
    done: dict[int, tuple] = {}
    open_: dict[int, _Probe] = {}
    for k in range(1, shards * per):
        want, below = total * k / (shards * per), (0, 0)
        slack = total / shards * (tolerance if k % per == 0 else 0.1 / per)
        for r in first:
            if below[0] + r.bytes >= want:
                open_[k] = _Probe(want, slack, below, (r.top << (63 - TOP), (r.top + 1) << (63 - TOP)))
                break
            below = (below[0] + r.bytes, below[1] + r.rows)
        else:
            done[k] = ((_SPAN - 1, _SPAN - 1), below[1])
    while open_:
        for k, x in zip(list(open_), _refine(rows, list(open_.values()), probes)):
            if isinstance(x, _Probe):
                open_[k] = x
            else:
                done[k] = x
                del open_[k]
    at = sorted(done.items())
    return Plan([s for _, (s, _) in at], [n for _, (_, n) in at], per, shards)


def assign(rows: DataFrame, how: Plan) -> DataFrame:
    """rows of keyed() with shard and slot (gapless from 0 in each shard), after the one exchange."""
    spark = rows.sparkSession
    tops: dict[int, list[tuple[int, int]]] = {}
    for h, t in how.splitters:
        tops.setdefault(min(h >> (63 - TOP), (1 << TOP) - 1), []).append((min(h, _SPAN - 1), min(t, _SPAN - 1)))
    table, before = [], 0
    for top in range(1 << TOP):
        table.append((top, before, tops.get(top, [])))
        before += len(tops.get(top, []))
    sent = spark.createDataFrame(table, "top long, before int, bounds array<struct<h:bigint,t:bigint>>")  # 4,096 rows and the splitters
    here = F.struct(F.col("h").alias("h"), F.col("t").alias("t"))
    starts = [0, *how.rows_before]
    base = [starts[r] - starts[r - r % how.per_shard] for r in range(len(starts))]
    ranged = (
        rows.withColumn("top", F.shiftright("h", 63 - TOP))
        .join(F.broadcast(sent), "top")
        .withColumn("range", F.col("before") + F.size(F.filter("bounds", lambda b: b <= here)))
        .drop("top", "before", "bounds")
    )
    order = Window.partitionBy("range").orderBy("h", "t", "doc_id", "text_crc32", "size")
    return (
        ranged.withColumn("slot", F.row_number().over(order) - 1 + F.element_at(F.array(*(F.lit(b).cast("long") for b in base)), F.col("range") + 1))
        .withColumn("shard", F.floor(F.col("range") / how.per_shard).cast("int"))
        .drop("range")
    )


def byte_shards(docs: DataFrame, shards: int = 24, **options) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Null texts have no bytes (size 8) and null ids a hash of their own.
    Repeated rows each have a slot.  An empty table gives no rows.
    """
    rows = cut(keyed(docs.select("doc_id", "text")).select("doc_id", "size", "text_crc32", "h", "t"))
    placed = assign(rows, plan(rows, shards, **options))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 24, **options) -> None:
    """Write the rows of docs, ordered by slot, in one folder per shard, with all their columns.

    The columns added are shard and slot, with underscores before them where
    docs has such columns itself.  Null texts have no bytes; repeated rows each
    have a slot; an empty table writes no rows.
    """
    shard, slot = fresh(docs, "shard", "slot")
    rows = keyed(docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))).drop("text")
    placed = assign(rows, plan(rows, shards, **options)).select("row.*", F.col("shard").alias(shard), F.col("slot").alias(slot))
    placed.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
