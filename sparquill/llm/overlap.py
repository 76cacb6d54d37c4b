"""SimHash near copies on five-word shingles, completed to all of similarity 0.8.

Two texts are near copies if the Jaccard similarity of their sets of shingles
is at least 0.8.  SimHash fingerprints of the sets come first: each gives the
keys of the codewords that its segments decode to, the sets that share a key are compared with one of them,
and every pair is verified on the whole sets.  This cannot find all: at a
similarity of 0.8 about ten of 64 bits differ.

What it leaves comes from prefixes, which lose no pair.  In any fixed order of
all shingles, let p and q be the places of the first shingle that two sets of
n >= m shingles share, counted from 0.  They share at most n - p and m - q, and
have to share 4 (n + m) / 9, where m is at least 0.8 n.  So q is at most m / 9,
and p at most n / 5.  Each set is listed under its first shingles up to a
fifth; those up to a ninth let it be the smaller partner.

A shingle in the prefixes of many sets would still pair them all, so the order
puts shingles that are common in a sample last; the sample changes the work,
never the result.  Sets under a shingle are first compared with one of them,
and then only pairs that are still in different components: the components are
those of all pairs.  Shingles and whole sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import fresh, mapped, remove, scratch, stored, values
from sparquill.llm.simhash import _LOWER, components, keys_of

SIZE = 5  # words of a shingle
BINS = 256  # bytes of a sketch


_ODD = [np.uint64(0x9E3779B97F4A7C15 ** (2 * k + 1) & (1 << 64) - 1) for k in range(SIZE)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of SIZE words, made of the words' hashes; a shorter text is one shingle, a text without words none."""
    from xxhash import xxh64_intdigest as digest

    words = text.encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SIZE:
        return np.array([digest(b" ".join(words))], np.uint64)
    each = np.fromiter(map(digest, words), np.uint64, len(words))
    n = len(words) - SIZE + 1
    total = each[:n] * _ODD[0]
    for k in range(1, SIZE):
        total += each[k : k + n] * _ODD[k]
    return np.unique(_mixed(total))


def is_near(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity of two sorted sets of at least 0.8, in whole numbers."""
    return 9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b))


def mark(s: np.ndarray, block: int = 1 << 15) -> int:
    """The SimHash fingerprint of a set of shingles, signed: a bit is 1 if set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(s), block):
        ones += np.unpackbits(s[at : at + block].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(s), bitorder="little").view("<i8")[0])


class Order:
    """The hashes of common shingles, sorted, and how often each was seen; all others count as never seen."""

    def __init__(self, hashes=(), seen=()):
        hashes, seen = np.asarray(hashes, np.int64).view(np.uint64), np.asarray(seen, np.int32)
        by = np.argsort(hashes)
        self.hashes, self.seen = hashes[by], seen[by]

    def first(self, s: np.ndarray, n: int) -> np.ndarray:
        """The first n shingles of a sorted set in this order."""
        if not len(self.hashes):
            return s[:n]
        at = np.minimum(np.searchsorted(self.hashes, s), len(self.hashes) - 1)
        return s[np.argsort(np.where(self.hashes[at] == s, self.seen[at], 0), kind="stable")[:n]]

    def listed(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, places): under which shingles a set is listed; a place below zero is -1 - place of a larger partner only."""
        n = len(s)
        keys = self.first(s, n - -(-4 * n // 5) + 1 if n else 0)
        place = np.arange(len(keys), dtype=np.int32)
        return keys, np.where(place <= n - -(-8 * n // 9), place, -1 - place)


WORDS = ("w0", "w1", "w2", "w3")


def parities(s: np.ndarray) -> list[int]:
    """Which of 256 bins hold an odd number of shingles, as four longs; sets differ in at least as many shingles as in these bits."""
    odd = np.bincount((s >> np.uint64(8) & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def _common(docs: DataFrame, sample: int, share: int, most: int) -> Order:
    """The shingles that several documents of a sample have, at most `most` of them: 12 bytes each, which the driver holds."""
    n = docs.count()

    @F.arrow_udf("array<bigint>")
    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield mapped(batch, lambda x: shingles(x or "").view(np.int64), pa.list_(pa.int64()))

    part = min(1, max(sample / max(1, n), 1 / share))
    some = docs.where(F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("order")), 1) < int(part * ((1 << 63) - 1)))
    counts = some.select(F.explode(look.asNondeterministic()("text")).alias("key")).groupBy("key").agg(F.count("*").alias("seen")).where("seen > 2")
    rows = counts.orderBy(F.desc("seen"), "key").limit(most).toArrow()
    return Order(rows["key"].to_numpy(), np.minimum(rows["seen"].to_numpy(), 1 << 30))


def _prefixed(docs: DataFrame, order: Order) -> DataFrame:
    """(doc_id, print, n, mark, keys, places, sketch, w0 .. w3): hash, size and fingerprint of the set of shingles, where it is listed, and its sketches."""
    sent = docs.sparkSession.sparkContext.broadcast(order)

    def coded(text: str) -> dict:
        s = shingles(text)
        keys, places = sent.value.listed(s)
        return {"print": _print(s), "n": len(s), "mark": mark(s), "keys": keys.view(np.int64), "places": places, "sketch": sketch(s), **dict(zip(WORDS, parities(s)))}

    kind = pa.struct([("print", pa.int64()), ("n", pa.int64()), ("mark", pa.int64()), ("keys", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())), ("sketch", pa.binary()), *((w, pa.int64()) for w in WORDS)])

    @F.arrow_udf("struct<print:bigint,n:bigint,mark:bigint,keys:array<bigint>,places:array<int>,sketch:binary,w0:bigint,w1:bigint,w2:bigint,w3:bigint>")
    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield mapped(batch, lambda x: coded(x or ""), kind)

    return docs.select("doc_id", look.asNondeterministic()("text").alias("x")).select("doc_id", "x.*")


def sketch(s: np.ndarray) -> bytes:
    """How many shingles fall into each of BINS bins, up to 255; sets differ in at least as many shingles as their sketches in all."""
    return np.minimum(np.bincount((s % np.uint64(BINS)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes()


def _print(s: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), 42)).view(np.int64))


def _close(x: str, y: str) -> Column:
    """Whether parities let two sets be near."""
    bits = " + ".join(f"bit_count({x}.{w} ^ {y}.{w})" for w in WORDS)
    return F.expr(f"9 * ({bits}) <= {x}.n + {y}.n")


def _possible(x: str, y: str) -> Column:
    """Whether sizes and places in the order let the first shared shingle be this one; true for some shingle of every near pair."""
    place = lambda r: f"({r}.n - if({r}.pos < 0, -1 - {r}.pos, {r}.pos))"
    return F.expr(f"9 * least({place(x)}, {place(y)}) >= 4 * ({x}.n + {y}.n)") & _close(x, y)


def _sketched(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of prints whose sketches let them be near: at J 0.8, a ninth of both sizes may differ."""

    @F.arrow_udf("boolean")
    def close(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b, n in batches:
            x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16) for c in (a, b))
            yield pa.array(9 * np.abs(x - y).sum(axis=1, dtype=np.int64) <= n.to_numpy())

    side = lambda name: sets.select(F.col("print").alias(name), F.col("n").alias(f"{name}_n"), F.col("sketch").alias(f"{name}_sketch"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(close.asNondeterministic()("a_sketch", "b_sketch", F.col("a_n") + F.col("b_n"))).select("a", "b")


def _verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of prints whose sets are near; sets has print and node."""

    @F.arrow_udf("struct<print:bigint,s:binary>")
    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield mapped(batch, lambda x: {"print": _print(s := shingles(x or "")), "s": s.tobytes()}, pa.struct([("print", pa.int64()), ("s", pa.binary())]))

    @F.arrow_udf("boolean")
    def near(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            yield pa.array([is_near(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(values(a, 64), values(b, 64))], pa.bool_())

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("print")).distinct()
    whole = stored(_texts_of(docs, sets, wanted).select(look.asNondeterministic()("text").alias("x")).select("x.print", "x.s"))
    whole = whole.groupBy("print").agg(F.first("s").alias("s"))  # rows may repeat both id and text
    both = pairs.join(whole.toDF("a", "s"), "a").join(whole.toDF("b", "t"), "b")
    return both.where(near.asNondeterministic()("s", "t")).select("a", "b")


def _texts_of(docs: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of docs that stand for the wanted prints; an id with several texts brings them all."""
    ids = sets.select("print", "node").join(wanted, "print", "left_semi").select("node").distinct()
    return docs.join(ids, F.col("doc_id") == F.col("node"), "left_semi")


def _sharing(rows: DataFrame) -> DataFrame:
    """The keys of (key, print, n, pos, root) under which sets of different components are, one of them as a smaller partner."""
    shared = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("pos").alias("pos"))
    return shared.where("low != high and pos >= 0").select("key")


def _stars(rows: DataFrame, seed: int, possible: Column | None = None) -> DataFrame:
    """Pairs (a, b): each row of (key, print, n, pos, root) with one row of its key that may be a smaller partner, where roots differ."""
    whole = F.struct(*(c for c in rows.columns if c != "key"))
    lead = F.min_by(whole, F.when(F.col("pos") >= 0, F.xxhash64("print", "key", F.lit(seed)))).alias("y")
    both = rows.join(rows.groupBy("key").agg(lead), "key").select(whole.alias("x"), "y").where("x.root != y.root")
    return (both if possible is None else both.where(possible)).select(*_edge()).distinct()


def _edge() -> tuple[Column, Column]:
    return F.least("x.print", "y.print").alias("a"), F.greatest("x.print", "y.print").alias("b")


def _golay(sets: DataFrame) -> DataFrame:
    """(key, print, n, pos, root): the Golay keys of every set's fingerprint, those that its segments decode to, which Hamming neighbours mostly share."""
    names = ["key", "print", "root"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, prints, roots = (batch.column(i).to_numpy() for i in range(3))
            rows, keys = keys_of(marks, False)
            for at in range(0, len(rows), 1 << 16):
                r = rows[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + (1 << 16)]), pa.array(prints[r]), pa.array(roots[r])], names)

    keyed = sets.select("mark", "print", "root").mapInArrow(emit, "key bigint, print bigint, root bigint")
    return keyed.select("key", "print", F.lit(0).alias("n"), F.lit(0).alias("pos"), "root")


def _keyed(sets: DataFrame) -> DataFrame:
    """The other columns of sets with a row (key, pos) for each place in its list."""
    rest = [c for c in sets.columns if c not in ("keys", "places")]
    each = F.explode(F.arrays_zip(F.col("keys").alias("key"), F.col("places").alias("pos"))).alias("k")
    return sets.select(each, *rest).select("k.key", "k.pos", *rest)


class _Links:
    """Verified pairs of prints so far, and the components that they make."""

    def __init__(self, docs: DataFrame, sets: DataFrame):
        self.docs, self.sets, self.found, self.roots = docs, sets, None, None

    def ask(self, pairs: DataFrame) -> None:
        pairs = stored(_sketched(self.sets, pairs))
        new = stored(_verified(self.docs, self.sets, pairs))
        if self.found is not None and new.isEmpty():
            return
        self.found = new if self.found is None else self.found.unionByName(new)
        self.roots = components(self.found)

    def rooted(self, rows: DataFrame) -> DataFrame:
        """rows with the root of each print, which is the print itself where nothing links it."""
        if self.roots is None:
            return rows.withColumn("root", F.col("print"))
        return rows.drop("root").join(self.roots.toDF("print", "root"), "print", "left").withColumn("root", F.coalesce("root", "print"))


def linked(docs: DataFrame, sets: DataFrame, stars: int = 2) -> _Links:
    """What connects all that near pairs connect; sets is _prefixed with node, a row a print."""
    known = _Links(docs, sets)
    known.ask(_stars(_golay(known.rooted(sets)), 0))
    # what is not needed to find shared keys joins only the rows that have them
    shared = _sharing(_keyed(known.rooted(sets.select("print", "keys", "places")).drop("print")))
    left = _keyed(sets.select("print", "keys", "places")).join(shared, "key")
    left = stored(known.rooted(left.join(sets.select("print", "n", *WORDS), "print")))
    for seed in range(1, stars + 1):
        if left.isEmpty():
            return known
        known.ask(_stars(left, seed, _close("x", "y")))
        rows = known.rooted(left)
        left = stored(rows.join(_sharing(rows), "key"))
    if not left.isEmpty():
        larger = F.expr("(x.n > y.n or x.n = y.n and x.print > y.print) and x.root != y.root")
        known.ask(left.alias("x").join(left.where("pos >= 0").alias("y"), "key").where(larger & _possible("x", "y")).select(*_edge()).distinct())
    return known


def near_components(docs: DataFrame, *, sample: int = 4000, share: int = 12, most: int = 1 << 19, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row with a doc_id: doc_id and component_id, the smallest doc_id reachable over near copies.

    Equal sets are one node.  Rows that share a doc_id count as one document.
    Null texts count as empty.  An empty table gives no rows.  The order is
    that of at most `most` shingles, common in one document of `share` or in
    `sample` documents, if these are more; neither changes a result.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    spark, path = docs.sparkSession, scratch(docs.sparkSession, "sets")
    _prefixed(docs, _common(docs, sample, share, most)).write.parquet(path)
    sets = spark.read.parquet(path)
    own = stored(sets.select("doc_id", "print"))
    one = stored(sets.groupBy("print").agg(F.min("doc_id").alias("node"), *(F.first(c).alias(c) for c in ("n", "mark", "keys", "places", "sketch", *WORDS))))
    remove(spark, path)
    nodes, found = one.select("print", "node"), linked(docs, one)
    # ids with several texts: the id itself joins its sets
    several = own.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low != high").select("doc_id")
    if several.isEmpty():
        rooted = found.rooted(nodes)
        known = rooted.join(rooted.groupBy("root").agg(F.min("node").alias("component_id")), "root").select("print", "component_id")
        return own.join(known, "print").select("doc_id", "component_id")
    at = lambda name: one.select(F.col("print").alias(name), F.col("node").alias(f"{name}_node"))
    near = found.found.join(at("a"), "a").join(at("b"), "b").select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))
    bridges = own.join(several, "doc_id").join(nodes, "print").select(F.least("node", "doc_id").alias("a"), F.greatest("node", "doc_id").alias("b"))
    roots = components(near.union(bridges).where("a < b"))
    known = nodes.join(roots, "node", "left").select("print", F.coalesce("root", "node").alias("component_id"))
    return own.join(known, "print").select("doc_id", "component_id")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of its component; rows without doc_id stay."""
    (mine,) = fresh(docs, "kept_id")
    kept = near_components(docs, **options).where("component_id = doc_id").select(F.col("doc_id").alias(mine)).distinct()
    return docs.join(kept, docs["doc_id"] == kept[mine], "left_semi").unionByName(docs.where(docs["doc_id"].isNull()))
