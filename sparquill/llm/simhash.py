"""SimHash near-duplicates through Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits, each padded
with zeros to a word of the perfect (23, 12) Golay code.  A segment's own key
is the index of the codeword that it decodes to; its nearby keys are those
that it decodes to after a flip of at most one of its bits: one, or up to six.
So if x and y differ in at most one bit of a segment, y's own key is among x's
nearby ones.  Three differing bits over three segments leave two cases:

* some segment i is equal and some other segment j differs in at most one bit:
  join on (i's bits, j's key), for the six ordered pairs (i, j);
* each segment differs in exactly one bit: then all three parities change, and
  so does the parity of the whole; join on the keys of two segments and the
  three parities, asking only from even fingerprints for odd ones.

Every joined pair is verified on the whole fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import cut, fresh, stored, values

SEGMENTS = ((42, 22), (21, 21), (0, 21))  # (shift, bits)
PAIRS = [(i, j) for i in range(3) for j in range(3) if i != j]
_GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


# -- fingerprints -----------------------------------------------------------


def fingerprint(text: str, size: int = 3, block: int = 1 << 15) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles, repeats included, as an unsigned integer."""
    import xxhash

    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), max(1, len(words) - size + 1)
    for at in range(0, n, block):
        part = words[at : min(at + block, n) + size - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(size)))) if len(words) >= size else [b" ".join(words)]
        hashes = np.fromiter((digest(s, 42) for s in shingles), np.uint64)
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(b) for b in np.flatnonzero(2 * ones > n)))


_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def with_fingerprint(docs: DataFrame, into: str, text_col: str = "text") -> DataFrame:
    """docs with the 64-bit fingerprint as a (signed) long; null texts count as empty, which have fingerprint zero."""

    @F.arrow_udf("bigint")
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.fromiter((fingerprint(x or "") for x in values(batch)), np.uint64, len(batch)).view(np.int64))

    return docs.withColumn(into, hashed.asNondeterministic()(F.col(text_col)))


# -- Golay keys -------------------------------------------------------------


def _remainder(x: int) -> int:
    for bit in range(22, 10, -1):
        if x >> bit & 1:
            x ^= _GENERATOR << (bit - 11)
    return x


@cache
def golay_tables():
    """Syndromes of 12-bit halves, the error of each syndrome, and by width the offsets of the nearby keys of each syndrome."""
    low = np.array([_remainder(i) for i in range(1 << 12)], np.int64)
    high = np.array([_remainder(i << 12) for i in range(1 << 11)], np.int64)
    error = np.zeros(1 << 11, np.int64)
    for weight in range(1, 4):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            error[_remainder(e)] = e
    near = {}
    for width in {w for _, w in SEGMENTS}:
        # x = c ^ e; after the flip f it decodes to c ^ w with w = e ^ f ^ error(syndrome(e ^ f))
        sets = [sorted({int(v ^ error[_remainder(int(v))]) >> 11 for v in [e, *(e ^ 1 << b for b in range(width))]}) for e in map(int, error)]
        near[width] = np.array([len(s) for s in sets]), np.array([s + [0] * (6 - len(s)) for s in sets], np.int64)
    return low, high, error, near


def own_key(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest codeword, syndrome) of 23-bit words."""
    low, high, error, _ = golay_tables()
    syndrome = low[segment & 0xFFF] ^ high[segment >> 12]
    return (segment ^ error[syndrome]) >> 11, syndrome


def near_keys(segment: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, keys): every row's nearby keys."""
    own, syndrome = own_key(segment)
    counts, offsets = golay_tables()[3][width]
    n = counts[syndrome]
    rows = np.repeat(np.arange(len(segment)), n)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    return rows, own[rows] ^ offsets[syndrome[rows], nth]


def _parity(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64) & 1


def keys_of(prints: np.ndarray, probe: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, join keys) of signed fingerprints: the few stored keys, or the nearby ones to ask for."""
    u = prints.view(np.uint64)
    seg = [((u >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in SEGMENTS]
    own, every = [own_key(s)[0] for s in seg], np.arange(len(u))
    near = [near_keys(s, w) for s, (_, w) in zip(seg, SEGMENTS)] if probe else [(every, k) for k in own]
    rows, keys = [], []
    for k, (i, j) in enumerate(PAIRS):
        at, key = near[j]
        rows.append(at)
        keys.append((k << 34) | (seg[i][at] << 12) | key)
    parities = [_parity(s) ^ probe for s in seg]
    odd = _parity(u) == 1
    side = np.flatnonzero(~odd if probe else odd)
    if probe:
        (at0, key0), (counts, offsets) = near_keys(seg[0][side], SEGMENTS[0][1]), golay_tables()[3][SEGMENTS[1][1]]
        own1, syndrome = own_key(seg[1][side])
        n = counts[syndrome[at0]]
        pick = np.repeat(np.arange(len(at0)), n)
        nth = np.arange(len(pick)) - np.repeat(np.cumsum(n) - n, n)
        at, key = at0[pick], (key0[pick] << 12) | (own1[at0[pick]] ^ offsets[syndrome[at0[pick]], nth])
        at = side[at]
    else:
        at, key = side, (own[0][side] << 12) | own[1][side]
    rows.append(at)
    keys.append((len(PAIRS) << 34) | (key << 3) | (parities[0][at] << 2) | (parities[1][at] << 1) | parities[2][at])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(nodes: DataFrame, probe: bool, prefix: str) -> DataFrame:
    names = ["key", f"{prefix}_print", f"{prefix}_node"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            rows, keys = keys_of(prints, probe)
            for at in range(0, len(rows), 1 << 18):
                r = rows[at : at + (1 << 18)]
                yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + (1 << 18)]), pa.array(prints[r]), pa.array(node[r])], names)

    return nodes.select("print", "node").mapInArrow(emit, f"key bigint, {names[1]} bigint, {names[2]} bigint")


def links(nodes: DataFrame, distance: int = 3) -> DataFrame:
    """Pairs (a, b) of nodes whose prints differ in 1 to `distance` (at most 3) bits; nodes has distinct `print`s and their `node`s."""
    if not 0 <= distance <= 3:
        raise ValueError("the keys cover at most three differing bits")
    both = _keyed(nodes, True, "x").join(_keyed(nodes, False, "y"), "key").where(
        (F.bit_count(F.col("x_print").bitwiseXOR(F.col("y_print"))) <= distance)
        & ((F.col("key") >= len(PAIRS) << 34) | (F.col("x_print") < F.col("y_print")))
        & (F.col("x_print") != F.col("y_print"))
    )
    return both.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).where("a < b")


# -- connected components ---------------------------------------------------


def _forest(edges: DataFrame) -> DataFrame:
    """A spanning forest of each partition's edges, as stars: at most one edge for each node met."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[p]
            return x

        def flush() -> pa.RecordBatch:
            kept = [(root(x), x) for x in list(parent)]
            kept = [(a, b) for a, b in kept if a != b]
            parent.clear()
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in kept], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (r := root(a)) != (s := root(b)):
                    parent[max(r, s)] = min(r, s)
            if len(parent) > 500_000:  # bounds memory; the rest starts a forest of its own
                yield flush()
        yield flush()

    return edges.select("a", "b").mapInArrow(contract, "a bigint, b bigint")


def components(edges: DataFrame, rounds: int = 50, room: int = 200_000) -> DataFrame:
    """(node, root): the smallest node reachable from every node of the undirected edges (a, b), a < b.

    First every task keeps a spanning forest of its edges.  If these are at
    most `room` together, one task joins them.  Otherwise there are large-star
    and small-star rounds; each cuts the lineage in the shared folder.  A node
    with very many edges costs one partly aggregated minimum and a join that
    adaptive execution can split.
    """
    now = cut(_forest(edges).distinct())
    if now.count() <= room:
        return cut(_forest(now.coalesce(1))).select(F.col("b").alias("node"), F.col("a").alias("root"))
    state = None
    for _ in range(rounds):
        both = now.union(now.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u and v != m").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b")
        down = large.distinct()
        small = down.groupBy("b").agg(F.min("a").alias("m"))
        stars = down.join(small, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a < b").distinct()
        now = cut(stars)
        said = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(said) == state:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        state = tuple(said)
    raise RuntimeError(f"the components did not settle in {rounds} rounds")


# -- operators --------------------------------------------------------------


def near_groups(docs: DataFrame, *, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links).

    Equal fingerprints are one node, so copies are never paired.  Rows that
    share a doc_id count as one document.  A row without doc_id has a
    fingerprint but no component, and links nothing.  An empty table gives no rows.
    """
    prints = stored(with_fingerprint(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "print").select("doc_id", "print"))
    known_ids = prints.where("doc_id is not null")
    nodes = cut(known_ids.groupBy("print").agg(F.min("doc_id").alias("node")))
    # ids with several texts: the id itself joins its prints
    several = known_ids.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low != high").select("doc_id")
    bridges = known_ids.join(several, "doc_id").join(nodes, "print").select(F.least("node", "doc_id").alias("a"), F.greatest("node", "doc_id").alias("b"))
    roots = components(links(nodes, distance).union(bridges.where("a < b")))
    known = nodes.join(roots, "node", "left").select("print", F.coalesce("root", "node").alias("component_id"))
    return prints.join(known, "print", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of its component; rows without doc_id stay."""
    (mine,) = fresh(docs, "kept_id")
    kept = near_groups(docs, **options).where("component_id = doc_id").select(F.col("doc_id").alias(mine)).distinct()
    return docs.join(kept, docs["doc_id"] == kept[mine], "left_semi").unionByName(docs.where(docs["doc_id"].isNull()))
