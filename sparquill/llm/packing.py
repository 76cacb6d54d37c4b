"""Harmonic packing of tokenised documents into sequences of fixed capacity.

A length n belongs to class k if k pieces of it, and not k + 1, fit the
capacity C; a bin of class k takes exactly k pieces, so a bin needs no search
and every worker fills its own.  Documents are cut so that pieces fit their
class exactly: whole sequences first, then pieces of the reciprocal lengths
C // k, until what is left is small.  A worker's unfilled bins are the only
rows that meet others: they are ranked per class, filled with k pieces again,
and the last bin of each class is joined with those of other classes.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparquill.llm.common import stored, values

END = 2
SMALL = 64  # the largest piece that is not cut further

# -- tokens -----------------------------------------------------------------

_L1_LETTERS = bytes(c for c in range(256) if chr(c).isalpha())
_L1_NUMBERS = bytes(c for c in range(256) if chr(c).isnumeric())
_LOWER = bytes(ord(x) if len(x := chr(c).lower()) == 1 and ord(x) < 256 else c for c in range(256))
_SPLIT = re.compile(
    rb"'s|'t|'re|'ve|'m|'ll|'d|[" + re.escape(_L1_LETTERS) + rb"]+|[" + re.escape(_L1_NUMBERS) + rb"]|[^\s" + re.escape(_L1_LETTERS + _L1_NUMBERS) + rb"]+"
)
_PLAIN = re.compile("[\t\n\r -~¡-¬®-ÿ]*")


class WordTokens:
    """Ids of a word-end BPE vocabulary file, with a cache of words.

    For texts of printable Latin-1 characters the file's normaliser and
    splitter are a byte table and one pattern, and only words that are new to
    the cache go to the BPE model.  Any other text, and one that may hold the
    file's special tokens, goes through the library's whole tokenizer.  The cache is emptied when full, so memory is bounded.
    """

    def __init__(self, path: str, room: int = 300_000):
        from tokenizers import Tokenizer, models

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.bpe = models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=model["end_of_word_suffix"])
        self.room = room
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spare = [b for b in range(256) if b not in seen]
        self.shown = {**{b: chr(b) for b in seen}, **{b: chr(256 + i) for i, b in enumerate(spare)}}
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.start, self.size, self.flat = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _add(self, word: bytes) -> int:
        ids = [t.id for t in self.bpe.tokenize("".join(map(self.shown.__getitem__, word.decode("latin-1").encode())))]
        n = len(self.number)
        if n == len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[n], self.size[n] = self.used, len(ids)
        self.used += len(ids)
        self.number[word] = n
        return n

    def ids(self, text: str) -> np.ndarray:
        if "<|" in text or not _PLAIN.fullmatch(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        if len(self.number) > self.room:
            self.clear()
        words = _SPLIT.findall(text.encode("latin-1").translate(_LOWER))
        number, add = self.number, self._add
        at = np.fromiter((number[w] if w in number else add(w) for w in words), np.int64, len(words))
        size = self.size[at]
        where = np.repeat(self.start[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.flat[where]


_tokens: dict[str, WordTokens] = {}


def tokens(path: str | None) -> WordTokens:
    """The tokenizer of this worker process; by default the public vocabulary file that the machine has."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    if path not in _tokens:
        _tokens[path] = WordTokens(path)
    return _tokens[path]


# -- cuts and classes -------------------------------------------------------


def classes(capacity: int) -> list[int]:
    """The fixed document counts: every k while capacity // k is over SMALL, then growing by an eighth."""
    out = list(range(1, max(1, capacity // (SMALL + 1)) + 1))
    while out[-1] < capacity:
        out.append(min(capacity, max(out[-1] + 1, out[-1] * 9 // 8)))
    return out


def class_of(capacity: int) -> list[int]:
    """By length (0 to capacity): the largest class whose pieces may be that long."""
    out = [0] * (capacity + 1)
    for k in classes(capacity):
        for n in range(1, capacity // k + 1):
            out[n] = k
    return out


def cuts(length: int, capacity: int, reciprocal: list[int]) -> list[int]:
    """Piece lengths of a document: whole sequences, then the largest reciprocal lengths, then a small rest."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest > SMALL:
        piece = reciprocal[rest]
        out.append(piece)
        rest -= piece
    return [*out, rest] if rest else out


def reciprocals(capacity: int) -> list[int]:
    """By length: the largest capacity // k that is at most it."""
    sizes, out, i = sorted({capacity // k for k in range(1, capacity + 1)}), [0] * (capacity + 1), -1
    for n in range(1, capacity + 1):
        if i + 1 < len(sizes) and sizes[i + 1] == n:
            i += 1
        out[n] = sizes[i]
    return out


# -- packing ----------------------------------------------------------------

_COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class", "part", "rank")
_SCHEMA = ", ".join(f"{c} bigint" for c in _COLUMNS)
PART = 1 << 32  # sequences of one worker at most


def _fill(docs: DataFrame, capacity: int, tokenizer: str | None) -> DataFrame:
    """Pieces with sequence and offset for every bin that a worker fills; the rest with class, part and rank only."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, klass, reciprocal = tokens(tokenizer), class_of(capacity), reciprocals(capacity)
        open_: dict[int, list] = {}
        out: list[list] = []
        sequences = 0

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * len(_COLUMNS))], list(_COLUMNS))
            out.clear()
            return batch

        for batch in batches:
            for doc, text in zip(values(batch.column(0)), values(batch.column(1))):
                ids = np.append(encoder.ids(text or ""), np.uint32(END)).astype("<u4")
                raw, start = memoryview(ids.tobytes()), 0
                for n in cuts(len(ids), capacity, reciprocal):
                    k = klass[n]
                    pieces = open_.setdefault(k, [])
                    pieces.append((doc, start, n, zlib.crc32(raw[4 * start : 4 * (start + n)]), len(ids)))
                    start += n
                    if len(pieces) == k:
                        offset = 0
                        for p in pieces:
                            out.append([*p, part * PART + sequences, offset, k, part, None])
                            offset += p[2]
                        sequences += 1
                        pieces.clear()
                if len(out) > 50_000:
                    yield flush()
        for k, pieces in open_.items():
            out.extend([*p, None, None, k, part, i] for i, p in enumerate(pieces))
        yield flush()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(work, _SCHEMA)


def _merge(bins: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int, int, int]]:
    """First fit, decreasing, of (class, bin, tokens) into sequences: (class, bin, sequence, offset)."""
    used, out = [], []
    for k, b, n in sorted(bins, key=lambda x: (-x[2], x)):
        at = next((i for i, u in enumerate(used) if u + n <= capacity), len(used))
        if at == len(used):
            used.append(0)
        out.append((k, b, at, used[at]))
        used[at] += n
    return out


def pack(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is the end id alone.  Repeated rows and null ids are
    packed like any other; an empty table gives no rows.  `tokenizer` is the
    path of a word-end BPE file on the executors.

    Sequences of a worker have ids part * 2**32 + n; those of the rest follow
    with negative ids.  The rest has fewer pieces per worker than the classes'
    counts together; it is ranked over counts per (class, worker).  What comes
    to the driver is one unfilled bin for each class.
    """
    spark = docs.sparkSession
    pieces = stored(_fill(docs, capacity, tokenizer))
    rest = pieces.where("sequence_id is null")
    counts = rest.groupBy("class", "part").agg(F.count("*").alias("n"))
    before = counts.select("class", "part", (F.sum("n").over(Window.partitionBy("class").orderBy("part")) - F.col("n")).alias("before"))
    ranked = rest.join(before, ["class", "part"]).withColumn("place", F.col("before") + F.col("rank")).withColumn("bin", F.expr("place div class"))
    placed = stored(
        ranked.withColumn("offset", F.sum("length").over(Window.partitionBy("class", "bin").orderBy("place")) - F.col("length")).withColumn(
            "full", F.count("*").over(Window.partitionBy("class", "bin")) == F.col("class")
        )
    )
    last = [(r["class"], r.bin, r.n) for r in placed.where("not full").groupBy("class", "bin").agg(F.sum("length").alias("n")).collect()]  # one for each class
    moved = spark.createDataFrame(_merge(last, capacity), "class bigint, bin bigint, at bigint, shift bigint")
    tail = placed.join(F.broadcast(moved), ["class", "bin"], "left").select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.when(F.col("at").isNotNull(), -1 - F.col("at")).otherwise(-1 - (F.col("class") * PART + F.col("bin"))).alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )
    return pieces.where("sequence_id is not null").select(*_COLUMNS[:7]).unionByName(tail)
