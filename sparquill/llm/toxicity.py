"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer maps the words of a clause to symbols: insult, threat,
target, negation, report or other.  Its insult arcs are learned from labelled
documents: whole words, and stems (word beginnings) of inflected or compounded
insults, each with its log-odds as weight.  Four small transducers (negation,
reported speech, targeting, threat) each rewrite the symbol string of a clause
and multiply or drop weights; they are composed once into one deterministic
machine.  A clause's score is the weight of its path; a document's score is a
logistic function of its clauses' scores.  The factors of the four rules and
the weights of that function are fitted on the same sample.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import fold, labelled, mapped, stored

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:\n\r…]+")

# Symbols: Other, Target, Negation, Report, tHreat, Insult; and what the machines make of insults and threats.
OTHER, TARGET, NEGATION, REPORT, THREAT, INSULT = "OTNRHI"

# Fixed function words of the grammar (English, German, French, Spanish).
TARGETS = "you your youre ur u they them he she him her du dich dir euch ihr ihn tu te toi vous ils elle usted ustedes tú ti ellos".split()
NEGATIONS = "not no never isnt arent wasnt dont doesnt without nicht kein keine keinen nie ne pas jamais nunca sin".split()
REPORTS = "said says say told wrote writes called quoted quote reported claimed according sagte sagt schrieb dit disait écrit dijo dice escribió".split()
THREATS = "kill hurt destroy punch stab beat shoot töten schlagen tuer frapper matar golpear".split()
_FIXED = {w: s for s, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)) for w in ws}


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer: (state, symbol) -> (state, symbol, factor); missing arcs copy the symbol and stay."""

    arcs: dict = field(hash=False)
    symbols: str = "OTNRHI"

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol, 1.0))

    def then(self, other: Transducer) -> Transducer:
        """Composition: the other reads what this one writes; only reachable pairs of states are built."""
        arcs, todo, seen = {}, [(0, 0)], {(0, 0): 0}
        while todo:
            pair = todo.pop()
            for symbol in self.symbols:
                p, middle, f = self.step(pair[0], symbol)
                q, out, g = other.step(pair[1], middle)
                if (p, q) not in seen:
                    seen[p, q] = len(seen)
                    todo.append((p, q))
                arcs[seen[pair], symbol] = (seen[p, q], out, f * g)
        return Transducer(arcs)

    def run(self, symbols, weights) -> float:
        """The weight of the path of one clause.  Symbols before the first that is not OTHER leave the start state, and those after the last weight add nothing."""
        state, total = 0, 0.0
        for symbol, weight in zip(symbols, weights):
            state, out, factor = self.step(state, symbol)
            total += weight * factor
        return total


def _window(opens: str, hits: str, reach: int, factor: float, eat: bool = False, idle: str = "") -> Transducer:
    """After a symbol of `opens`, those of `hits` within `reach` symbols are multiplied by factor (only the next, if eat).

    Elsewhere the symbols of `idle` have no weight.
    """
    arcs = {}
    for state in range(reach + 1):
        for symbol in "OTNRHI":
            left = reach if symbol in opens else max(0, state - 1)
            if state and symbol in hits:
                arcs[state, symbol] = (0 if eat else left, symbol, factor)
            else:
                arcs[state, symbol] = (left, symbol, 0.0 if symbol in idle else 1.0)
    return Transducer(arcs)


FACTORS = (0.3, 0.6, 1.5, 1.5)  # of negated, reported, targeted and threatened parts, before they are fitted
CHOICES = (0.0, 0.3, 0.6, 1.0, 1.5, 2.0)
SHORT = 20


def grammar(negated: float = FACTORS[0], reported: float = FACTORS[1], targeted: float = FACTORS[2], threatened: float = FACTORS[3]) -> Transducer:
    """Negation, then reported speech, then targets, then threats, composed into one machine."""
    return (
        _window(NEGATION, INSULT + THREAT, 3, negated, eat=True)
        .then(_window(REPORT, INSULT + THREAT, 12, reported))
        .then(_window(TARGET, INSULT, 4, targeted))
        .then(_window(THREAT, TARGET + INSULT, 4, threatened, idle=TARGET))
    )


@dataclass
class Model:
    """What scoring needs: words and stems with weights, the composed grammar, the document weights."""

    words: dict[str, float]
    stems: dict[str, float]
    document: tuple[float, ...] = (-3.0, 1.0, 0.0, 0.0)
    threat: float = 1.0
    factors: tuple[float, ...] = FACTORS

    def __post_init__(self):
        self.machine = grammar(*self.factors)
        self.lengths = sorted({len(s) for s in self.stems})
        self.memo: dict[str, tuple[str, float]] = {}
        self.scored: dict[tuple, list[float]] = {}

    def lexical(self, word: str) -> tuple[str, float]:
        """The lexical transducer's arc for a word."""
        got = self.memo.get(word)
        if got is None:
            weight = max([self.words.get(word, 0.0), *(self.stems.get(word[:n], 0.0) for n in self.lengths)])
            symbol = INSULT if weight else _FIXED.get(word, OTHER)
            got = (symbol, weight or (self.threat if symbol == THREAT else 0.0))
            if len(self.memo) > 400_000:
                self.memo.clear()
            self.memo[word] = got
        return got

    def paths(self, text: str) -> Iterator[tuple[int, int, tuple[str, ...], tuple[float, ...]]]:
        """(start, end, symbols, weights) of every clause that has a weight, over the whole text; without the symbols at its ends that change nothing."""
        start = 0
        for m in [*CLAUSE.finditer(text), None]:
            end = m.start() if m else len(text)
            path = [self.lexical(w) for w in WORD.findall(text[start:end].lower())]
            if any(w for _, w in path):
                # a target weighs like a threat, but the grammar lets it count only after one
                weights = [self.threat if s == TARGET else w for s, w in path]
                at, to = next(i for i, (s, _) in enumerate(path) if s != OTHER), max(i for i, w in enumerate(weights) if w) + 1
                yield start, end, tuple(s for s, _ in path[at:to]), tuple(weights[at:to])
            start = m.end() if m else end

    def clauses(self, text: str) -> Iterator[tuple[int, int, float]]:
        """(start, end, score) of every clause with a positive score, over the whole text."""
        for start, end, symbols, weights in self.paths(text):
            if (score := self.machine.run(symbols, weights)) > 0:
                yield start, end, score

    def features(self, text: str, machines: list[Transducer] | None = None) -> list[float]:
        """For each machine, the log of 1 + the sum of the clauses' scores, their maximum, and the log of 1 + their sum in a thousand words; zero without any.

        One stray word in a long text weighs less than in a short one; a text counts as SHORT words at least.
        """
        machines = machines or [self.machine]
        lexical = self.lexical
        words = WORD.findall(text.lower())
        if not any(lexical(w)[1] for w in words):
            return [0.0, 0.0, 0.0] * len(machines)
        scores, out = [self._scores(p[2:], machines) for p in self.paths(text)], []
        for own in zip(*scores):
            out += [math.log1p(sum(own)), max(own), math.log1p(1000 * sum(own) / max(SHORT, len(words)))]
        return out

    def _scores(self, path: tuple, machines: list[Transducer]) -> list[float]:
        """What each machine makes of a path; most clauses come down to one of a few short paths, which are kept."""
        key = (len(machines), path)
        got = self.scored.get(key)
        if got is None:
            got = [m.run(*path) for m in machines]
            if len(self.scored) > 50_000:
                self.scored.clear()
            self.scored[key] = got
        return got

    def score(self, text: str) -> float:
        bias, *factors = self.document
        total = bias + sum(f * x for f, x in zip(factors, self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("words", "stems", "document", "threat", "factors")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()


def _sketch(text: str) -> tuple[int, list[str]]:
    """A family number that near copies mostly share (the smallest hash of word triples), and the distinct words."""
    import xxhash

    words = WORD.findall(text.lower())
    family = min((xxhash.xxh64_intdigest(" ".join(t)) for t in zip(words, words[1:], words[2:])), default=len(words))
    return family & (1 << 62) - 1, list(set(words))


STEMS = (3, 8)  # letters of the shortest and the longest stem


def sketched(sample: DataFrame) -> DataFrame:
    """sample with the family and the distinct words of each text."""
    kind = pa.struct([("family", pa.int64()), ("words", pa.list_(pa.string()))])

    @F.arrow_udf("struct<family:bigint,words:array<string>>")
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield mapped(batch, lambda x: dict(zip(("family", "words"), _sketch(x or ""))), kind)

    return sample.withColumn("s", sketch.asNondeterministic()("text")).select(*sample.columns, "s.family", "s.words")


def learn_lexicon(sample: DataFrame, *, min_support: int = 5, purity: float = 0.9) -> tuple[dict, dict]:
    """Insult words and stems of the sketched sample (family, words, y), with log-odds as weights.

    Support counts families of near copies, not documents, so that a copied
    document does not make its neutral words look like insults.  What comes to
    the driver is bounded by the sample: words that min_support of its families
    have, nearly all of them toxic.
    """
    least, most = STEMS

    def judged(pairs: DataFrame, key: str) -> DataFrame:
        """Families and toxic families of each key of (key, family, y)."""
        return pairs.groupBy(key, "family").agg(F.max("y").alias("y")).groupBy(key).agg(F.count("*").alias("n"), F.sum("y").alias("t"))

    def pick(df: DataFrame, support: int) -> list:
        return df.where((F.col("t") >= support) & (F.col("t") >= purity * F.col("n"))).collect()

    weight = lambda r: math.log((r.t + 0.5) / (r.n - r.t + 0.5))
    seen = stored(judged(sample.select("family", "y", F.explode("words").alias("word")), "word"))
    words = {r.word: weight(r) for r in pick(seen, min_support)}
    # stems that may do, by the sums over all words that begin with them; then these are counted exactly
    stems_of = f"transform(sequence({least}, least({most}, length(word))), k -> substring(word, 1, k))"
    cuts = seen.where(f"length(word) >= {least}").select("n", "t", F.explode(F.expr(stems_of)).alias("stem"))
    sums = cuts.groupBy("stem").agg(F.sum("n").alias("n"), F.sum("t").alias("t"), F.count("*").alias("forms"))
    likely = {r.stem for r in pick(sums.where("forms >= 3"), 2 * min_support)}
    begins = F.expr(f"array_distinct(flatten(transform(filter(words, word -> length(word) >= {least}), word -> {stems_of})))")
    found = judged(sample.select("family", "y", F.explode(F.array_intersect(begins, F.lit(sorted(likely)))).alias("stem")), "stem") if likely else None
    exact = {r.stem: r for r in pick(found, 2 * min_support)} if likely else {}
    longer = {s[:-1] for s, r in exact.items() if s[:-1] in exact and r.t >= 0.9 * exact[s[:-1]].t}
    stems = {s: weight(r) for s, r in exact.items() if s not in longer}
    return {w: x for w, x in words.items() if not any(w[:n] in stems for n in range(least, most + 1))}, stems


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the bias is not shrunk."""
    x = np.column_stack([np.ones(len(x)), x])
    shrink, w = np.diag([1e-6, *[ridge * max(1, len(x)) ** 0.5] * (x.shape[1] - 1)]), np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink + 1e-9 * np.eye(len(w)), x.T @ (p - y) + shrink @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _loss(w: np.ndarray, x: np.ndarray, y: np.ndarray) -> float:
    z = np.clip(np.column_stack([np.ones(len(x)), x]) @ w, -30, 30)
    return float(np.mean(np.log1p(np.exp(-np.where(y > 0, z, -z)))))


def _fitted(sample: DataFrame, model: Model, tried: list[tuple[float, ...]]) -> list[tuple[float, np.ndarray]]:
    """(log loss, document weights) of each of the tried factors on the sample; nothing without both labels.

    Near copies with the same features count once: their number says nothing of the next text.
    """

    @F.arrow_udf("array<double>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machines = [grammar(*f) for f in tried]
        for batch in batches:
            yield mapped(batch, lambda x: model.features(x or "", machines), pa.list_(pa.float64()))

    # three numbers for each tried grammar and each kind of sampled row
    rows = sample.select(features.asNondeterministic()("text").alias("x"), "y", "family").distinct().groupBy("x", "y").count().collect()
    y = np.repeat([float(r.y) for r in rows], [r["count"] for r in rows])
    if not 0 < y.sum() < len(y):
        return []
    order = np.argsort([str((r.x, r.y)) for r in rows])  # the same sums whatever order the rows come in
    x = np.repeat(np.array([rows[i].x for i in order]), [rows[i]["count"] for i in order], axis=0)
    y = np.repeat([float(rows[i].y) for i in order], [rows[i]["count"] for i in order])
    fits = [(_logistic(x[:, 3 * k : 3 * k + 3], y), x[:, 3 * k : 3 * k + 3]) for k in range(len(tried))]
    return [(_loss(w, part, y), w) for w, part in fits]


def train(docs: DataFrame, labels: DataFrame, *, max_rows: int = 20_000, **lexicon) -> Model:
    """Fit lexicon, factors and document weights on at most about max_rows labelled documents outside the held-out fold.

    Each factor is that of CHOICES with the least log loss while the others
    keep their first values; the weights are then fitted with all of them.
    Without any labelled row the lexicon is empty and only threats score.
    """
    sample = stored(sketched(labelled(docs, labels, "toxic", fold("id", 5) != 0, max_rows=max_rows)))
    words, stems = learn_lexicon(sample, **lexicon)
    model = Model(words, stems)
    tried = [(i, c) for i in range(len(FACTORS)) for c in CHOICES]
    losses = [x for x, _ in _fitted(sample, model, [tuple(c if k == i else f for k, f in enumerate(FACTORS)) for i, c in tried])]
    if losses:
        first = lambda i, c, x: (round(x, 9), abs(c - FACTORS[i]))
        best = [min(((i, c, x) for (i, c), x in zip(tried, losses) if i == k), key=lambda t: first(*t))[1] for k in range(len(FACTORS))]
        (_, weights), *_ = _fitted(sample, model, [tuple(best)])
        model = Model(words, stems, tuple(map(float, weights)), factors=tuple(best))
    return model


def with_score(docs: DataFrame, model: Model, into: str, text_col: str = "text") -> DataFrame:
    """docs with the toxicity score (0 to 1) of every whole text; null texts count as empty and get the base score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # words and stems of the bounded sample

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = sent.value
        for batch in batches:
            yield mapped(batch, lambda x: own.score(x or ""), pa.float64())

    return docs.withColumn(into, score.asNondeterministic()(F.col(text_col)))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.  Null ids are in no fold: held_out is false for them."""
    scored = with_score(docs.select("doc_id", "text"), train(docs, labels, **options), "score")
    return scored.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
