"""Benchmark decontamination with one Aho-Corasick automaton.

The normalised windows of all benchmark items are compiled into one automaton
over word symbols: every word that an item has is one symbol, all others are
one more.  Each document is normalised once, written in symbols and scanned
once; a match's end is a word number, which the word offsets of the original
text turn into a span there.  A window of ten words costs at most ten nodes,
whatever its letters.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm.common import fresh, mapped, stored, text_or_empty, values

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))

NODE_BYTES = 100  # with the windows' owners, as measured
SINGLES, LEADS, TRAILS = 1_000_000, 50_000, 60_000  # words of one symbol; symbols that begin and end the two of any other word
_RUN = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("items", pa.list_(pa.string())), ("runs", pa.list_(_RUN))])
FOUND = "struct<n_words:bigint,items:array<string>,runs:array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>>"


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) words; bytes above 7F are word characters."""
    return text.encode().translate(_TABLE).split()


def pieces(text: str, width: int, windows: int = 1000) -> list[str]:
    """The words of an item, joined by spaces, in pieces that hold each of its windows exactly once, `windows` at most in a piece."""
    words = words_of(text)
    at = range(0, max(1, len(words) - width + 1), windows) if words else ()
    return [b" ".join(words[i : i + windows + width - 1]).decode() for i in at]


class _Automaton:
    """One automaton over the windows of (item_id, words joined by spaces) pairs."""

    def __init__(self, items: list[tuple[str | None, str]], width: int):
        import ahocorasick

        self.symbols: dict[bytes, str] = {}
        owners: dict[str, tuple[int, set[str]]] = {}
        for item, text in items:
            coded = [self.symbols.setdefault(w, self._symbol(len(self.symbols) + 1)) for w in words_of(text)]
            size = min(width, len(coded))
            for i in range(len(coded) - size + 1 if coded else 0):
                owners.setdefault("".join(coded[i : i + size]), (size, set()))[1].update(() if item is None else (item,))
        self.found = ahocorasick.Automaton()
        for window, (size, ids) in owners.items():
            self.found.add_word(window, (size, tuple(ids)))
        if owners:
            self.found.make_automaton()

    @staticmethod
    def _symbol(i: int) -> str:
        """What the i-th word, from 1, is written as.  There are 1.1 million characters, so the words after the
        first SINGLES take two; as no such first or second symbol has another use, a window is only met at words."""
        if i <= SINGLES:
            return chr(i if i < 0xD800 else i + 0x800)
        lead, trail = divmod(i - SINGLES - 1, TRAILS)
        if lead >= LEADS:
            raise ValueError(f"more than {SINGLES + LEADS * TRAILS} distinct words in a block")
        return chr(SINGLES + 0x801 + lead) + chr(SINGLES + 0x801 + LEADS + trail)

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, tuple[int, tuple[str, ...]]]]:
        """(number of the last word, (words, item ids)) of every window met."""
        if not self.symbols:
            return iter(())
        symbol = self.symbols.get
        coded = [symbol(w, "\0") for w in words]
        text = "".join(coded)
        if len(text) == len(coded):
            return self.found.iter(text)
        word = np.repeat(np.arange(len(coded)), [len(c) for c in coded])
        return ((int(word[end]), found) for end, found in self.found.iter(text))


def automaton(items: list[tuple[str | None, str]], width: int) -> _Automaton:
    """The automaton of (item_id, text) pairs; all windows of a text belong to it."""
    return _Automaton(items, width)


def scan(text: str, found: _Automaton) -> tuple[int, set[str], list[tuple[int, int, int, int]]]:
    """Number of words, items met, and runs of hit words (first, last, start, end) of one text."""
    words = words_of(text)
    ends, sizes, items = [], [], set()
    for end, (size, ids) in found.matches(words):
        ends.append(end + 1)
        sizes.append(size)
        items.update(ids)
    if not ends:
        return len(words), set(), []
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, np.asarray(ends) - np.asarray(sizes), 1)
    np.add.at(depth, ends, -1)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(depth) > 0, [0])).astype(np.int8)))
    offsets = [m.span() for m in WORD.finditer(text)]
    return len(words), items, [(int(a), int(b) - 1, offsets[a][0], offsets[b - 1][1]) for a, b in zip(edge[::2], edge[1::2])]


def merge_runs(runs: list[dict]) -> list[dict]:
    """The union of runs that several automata found."""
    out: list[dict] = []
    for r in sorted(runs, key=lambda r: (r["first"], r["last"])):
        if out and r["first"] <= out[-1]["last"] + 1:
            if r["last"] > out[-1]["last"]:
                out[-1] |= {"last": r["last"], "end": r["end"]}
        else:
            out.append(dict(r))
    return out


_built: dict[str, _Automaton] = {}


def _built_once(name: str, sent, width: int) -> _Automaton:
    """The automaton of a block, built once in a worker process, which holds one at a time."""
    if name not in _built:
        _built.clear()
        _built[name] = automaton(sent.value, width)
    return _built[name]


def _looking(spark: SparkSession, block: DataFrame, width: int):
    """A function of texts that finds the items of one block."""
    sent, name = spark.sparkContext.broadcast([(r.id, r.piece) for r in block.select("id", "piece").collect()]), uuid.uuid4().hex

    @F.arrow_udf(FOUND)
    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = _built_once(name, sent, width)
        for batch in batches:
            rows = [scan(x or "", found) for x in values(batch)]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([sorted(r[1]) for r in rows], pa.list_(pa.string())),
                    pa.array([[dict(zip(("first", "last", "start", "end"), x)) for x in r[2]] for r in rows], pa.list_(_RUN)),
                ],
                fields=list(_FOUND),
            )

    return look.asNondeterministic()


def find_items(docs: DataFrame, items: DataFrame, *, into: str, width: int = 10, text_col: str = "text", block_bytes: int = 256 << 20) -> DataFrame:
    """docs with a struct column `into`: n_words, items (ids as strings, sorted) and runs of hit words.

    A run has the numbers of its first and last word and the span of code
    points of the original text.  Null and empty texts have no words; an item
    with a null id marks words but is not listed; repeated items count once.

    A worker holds one automaton of about block_bytes at most, built once in
    its process.  Its nodes are counted first: a window has at most as many as
    words, or twice as many where there may be more than SINGLES distinct words.  Items that need more are dealt, in pieces of whole windows, into
    blocks; each block is broadcast and looked
    for in a scan of its own, of which only the texts with findings are kept,
    under the SHA-256 of the text.
    """
    spark = docs.sparkSession
    cut_up = F.arrow_udf(lambda batch: mapped(batch, lambda x: pieces(x, width), pa.list_(pa.string())), "array<string>")
    cells = items.select(F.col("item_id").cast("string").alias("id"), F.explode(cut_up(text_or_empty())).alias("piece")).distinct()
    cells = stored(cells.withColumn("words", F.size(F.split("piece", " "))))
    nodes, n = cells.agg(F.coalesce(F.sum(F.expr(f"least(words, {width}) * greatest(words - {width - 1}, 1)")), F.lit(0)), F.count("*")).first()
    room, nodes = max(1, block_bytes // NODE_BYTES), 2 * nodes if nodes > SINGLES else nodes
    blocks = 1 if nodes <= room else min(n, -(-5 * nodes // (4 * room)))  # hashing deals unevenly
    block = lambda b: cells.where(F.pmod(F.xxhash64("id", "piece"), F.lit(blocks)) == b) if blocks > 1 else cells
    first = _looking(spark, block(0), width)
    if blocks == 1:
        return docs.withColumn(into, first(F.col(text_col)))

    sha, own, sha_right, runs, ids = fresh(docs, "sha", "own", "sha_right", "runs", "ids")
    digest = F.unhex(F.sha2(F.col(text_col), 256))
    met = None
    for b in range(1, blocks):
        rows = docs.select(digest.alias("sha"), _looking(spark, block(b), width)(F.col(text_col)).alias("found"))
        rows = stored(rows.where(F.size("found.runs") > 0).select("sha", "found.items", "found.runs").dropDuplicates(["sha"]))
        met = rows if met is None else met.unionByName(rows)

    @F.arrow_udf(f"array<{FOUND[FOUND.index('struct<first') : -2]}>")
    def union(runs: pa.Array) -> pa.Array:
        return pa.array([merge_runs(x) for x in runs.to_pylist()], pa.list_(_RUN))

    met = met.groupBy(F.col("sha").alias(sha_right)).agg(F.flatten(F.collect_list("items")).alias(ids), F.flatten(F.collect_list("runs")).alias(runs))  # of one text
    none = lambda name: F.coalesce(F.col(name), F.array())
    both = docs.withColumn(own, first(F.col(text_col))).withColumn(sha, digest).join(met, F.col(sha) == F.col(sha_right), "left")
    found = F.struct(
        F.col(own).n_words.alias("n_words"),
        F.array_sort(F.array_distinct(F.concat(F.col(own)["items"], none(ids)))).alias("items"),
        union(F.concat(F.col(own).runs, none(runs))).alias("runs"),
    )
    return both.withColumn(into, found).drop(own, sha, sha_right, runs, ids)


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, item_ids, spans.

    Repeated rows are reported each on its own; an empty table gives none.
    """
    found = find_items(docs.select("doc_id", "text"), items, into="found", **options).select("doc_id", "found.*")
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
        F.col("items").alias("item_ids"),
        F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))).alias("spans"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of docs that hold no window of any item, with all their columns.

    Null and empty texts hold none and stay, as do repeated rows and null ids;
    an empty table gives no rows, and without items all rows stay.
    """
    (into,) = fresh(docs, "found")
    return find_items(docs, items, into=into, **options).where(F.size(F.col(into).runs) == 0).drop(into)
