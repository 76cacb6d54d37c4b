"""Quality classifier: gated-attention multiple-instance learning.

A document is a bag of passages.  Each passage is encoded as a vector of
surface statistics; the model learns from document labels alone how much each
passage counts (gated attention: w . (tanh(V h) * sigmoid(U h)), softmax over
the passages) and scores the weighted sum.  See Ilse, Tomczak and Welling,
"Attention-based Deep Multiple Instance Learning" (2018).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import fold, fresh, labelled, mapped, stored

PASSAGE = 2048  # bytes of UTF-8
_SEEN = b".,;:!?'\"()-|*#$%&/<>=_@[]{}\n\t\\+~^0123456789"
_LETTER, _UPPER, _LOWER, _DIGIT, _HIGH, _SPACE, _OTHER = range(7)
_CLASS = np.array(
    [
        _UPPER if 65 <= c <= 90 else _LOWER if 97 <= c <= 122 else _DIGIT if 48 <= c <= 57 else _HIGH if c >= 128 else _SPACE if c in b" \t\n\r\v\f" else _OTHER
        for c in range(256)
    ],
    np.int64,
)
WIDTH = 7 + len(_SEEN) + 8


def passages(text: str, size: int = PASSAGE) -> list[bytes]:
    """The whole text in pieces of about `size` bytes, cut at white space where there is any; at least one piece."""
    raw, out, at = text.encode(), [], 0
    while len(raw) - at > size * 3 // 2:
        end = raw.rfind(b" ", at + size // 2, at + size)
        end = end + 1 if end >= 0 else at + size
        out.append(raw[at:end])
        at = end
    return [*out, raw[at:]]


def encode(passage: bytes) -> np.ndarray:
    """Shares of character classes and of single characters, and statistics of words, of one passage."""
    n = max(1, len(passage))
    counts = np.bincount(np.frombuffer(passage, np.uint8), minlength=256)
    classes = np.bincount(_CLASS, weights=counts, minlength=7) / n
    words = passage.split()
    k = max(1, len(words))
    once = len(set(words)) / k
    twins = sum(a == b for a, b in zip(words, words[1:])) / k
    triples = len(set(zip(words, words[1:], words[2:]))) / max(1, k - 2) if k > 2 else 1.0
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    shares = counts[np.frombuffer(_SEEN, np.uint8)] / n
    tail = [once, twins, triples, lengths.mean() / 10, lengths.std() / 10, min(1.0, lengths.max() / 100), np.log1p(len(passage)) / 8, 1.0 if not words else 0.0]
    return np.concatenate([classes, np.sqrt(shares), tail]).astype(np.float32)


def bag(text: str, most: int | None = None) -> np.ndarray:
    """The vectors of all passages, or of `most` of them, spread evenly."""
    found = passages(text)
    if most is not None and len(found) > most:
        found = [found[(2 * i + 1) * len(found) // (2 * most)] for i in range(most)]
    return np.stack([encode(p) for p in found])


def passage_bound(counts: list[tuple[int, int]], room: int) -> int:
    """The most passages a document may give so that all fit into room, 1 at least; counts has (passages, documents)."""
    total = lambda bound: sum(min(n, bound) * k for n, k in counts)
    low, high = 1, max([1, *(n for n, _ in counts)])
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if total(mid) <= room else (low, mid - 1)
    return low


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Attention:
    """V and U (gates), w (attention), c and b (score of the weighted passage), mean and scale of the inputs."""

    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    c: np.ndarray
    b: float
    mean: np.ndarray
    scale: np.ndarray

    def attention(self, x: np.ndarray) -> np.ndarray:
        h = (x - self.mean) / self.scale
        a = (np.tanh(h @ self.v) * _sigmoid(h @ self.u)) @ self.w
        e = np.exp(a - a.max())
        return e / e.sum()

    def score(self, text: str) -> float:
        x = bag(text)
        z = self.attention(x) @ ((x - self.mean) / self.scale)
        return float(_sigmoid(z @ self.c + self.b))


def fit(bags: list[np.ndarray], y: np.ndarray, *, hidden: int = 16, rounds: int = 300, rate: float = 0.02, shrink: float = 1e-3, seed: int = 0) -> Attention:
    """Full-batch Adam on the mean log loss; the same result for the same bags in the same order."""
    rows, owner = np.concatenate(bags).astype(np.float64), np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-2
    h, rng, d = (rows - mean) / scale, np.random.default_rng(seed), rows.shape[1]
    p = {"v": rng.normal(0, 0.1, (d, hidden)), "u": rng.normal(0, 0.1, (d, hidden)), "w": rng.normal(0, 0.1, hidden), "c": np.zeros(d), "b": np.zeros(1)}
    m, s = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    for t in range(1, rounds + 1):
        tanh, gate = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        a = (tanh * gate) @ p["w"]
        e = np.exp(a - np.maximum.reduceat(a, starts)[owner])
        alpha = e / np.add.reduceat(e, starts)[owner]
        value = h @ p["c"]
        out = np.add.reduceat(alpha * value, starts)
        err = (_sigmoid(out + p["b"]) - y) / len(y)
        da = alpha * (value - out[owner]) * err[owner]
        dg = da[:, None] * p["w"]
        g = {
            "v": h.T @ (dg * gate * (1 - tanh**2)) + shrink * p["v"] / 10,
            "u": h.T @ (dg * tanh * gate * (1 - gate)) + shrink * p["u"] / 10,
            "w": (tanh * gate).T @ da + shrink * p["w"] / 10,
            "c": h.T @ (alpha * err[owner]) + shrink * p["c"],
            "b": np.array([err.sum()]),
        }
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    return Attention(p["v"], p["u"], p["w"], p["c"], float(p["b"][0]), mean, scale)


def train(docs: DataFrame, labels: DataFrame, *, max_rows: int = 4000, max_passages: int = 40_000, **options) -> Attention:
    """Fit on at most about max_rows labelled documents outside the held-out fold.

    The driver gets their passage vectors and nothing else, at most
    max_passages, which at four bytes a number is 12 MB.  If they have more,
    the longest documents give fewer, spread evenly over their text: all give
    as many as the largest bound that fits, or all of theirs.  This is for the
    fit only; scores read every passage.  Only rows beyond max_passages, as
    repeated ids may give, are left out, by hash.  Without both labels every
    text scores the share of label 1 (0.5 without any label).
    """
    sample = stored(labelled(docs, labels, "quality", fold("id", 4) != 2, max_rows=max_rows))

    @F.arrow_udf("bigint")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield mapped(batch, lambda x: len(passages(x or "")), pa.int64())

    most = passage_bound(sample.groupBy(lengths.asNondeterministic()("text").alias("n")).count().collect(), max_passages)

    @F.arrow_udf("binary")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield mapped(batch, lambda x: bag(x or "", most).tobytes(), pa.binary())

    coded = sample.select("id", "y", vectors.asNondeterministic()("text").alias("x")).orderBy(F.xxhash64("id", "x"), "id")
    bags, y, room = [], [], max_passages
    for r in coded.toLocalIterator():
        x = np.frombuffer(r.x, np.float32).reshape(-1, WIDTH)
        room -= len(x)
        if room < 0 and bags:  # only where there are more rows than max_passages, one passage each
            break
        bags.append(x)
        y.append(r.y)
    share = min(0.999, max(0.001, float(np.mean(y)))) if y else 0.5
    if not 0 < sum(y) < len(y):
        zero = np.zeros((WIDTH, 1))
        return Attention(zero, zero, np.zeros(1), np.zeros(WIDTH), float(np.log(share / (1 - share))), np.zeros(WIDTH), np.ones(WIDTH))
    return fit(bags, np.array(y, float), **options)


def with_score(docs: DataFrame, model: Attention, into: str, text_col: str = "text") -> DataFrame:
    """docs with the quality score (0 to 1) of every whole text; null texts count as empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = sent.value
        for batch in batches:
            yield mapped(batch, lambda x: own.score(x or ""), pa.float64())

    return docs.withColumn(into, score.asNondeterministic()(F.col(text_col)))


def quality(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, **options) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.  Null ids are in no fold: held_out is false for them."""
    scored = with_score(docs.select("doc_id", "text"), train(docs, labels, **options), "score")
    return scored.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, **options) -> DataFrame:
    """The rows of docs that score at least the threshold, with all their columns."""
    (into,) = fresh(docs, "score")
    return with_score(docs, train(docs, labels, **options), into).where(F.col(into) >= threshold).drop(into)
