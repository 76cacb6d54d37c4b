"""Secret scans with multipart credential linking.

Strong findings stand alone: assignments to secret-like names, access keys and
long hexadecimal strings.  Weak candidates (identifiers, endpoints, random
tokens) mean nothing by themselves; they are reported only where complementary
parts meet: an interval join within each document links parts whose scopes
overlap, a scope being the text around a part, ended by a blank line.  The
join sweeps the parts in order of position and asks, for each role, for the
furthest end before a part and the nearest start after it, so its work grows
with the number of parts.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import mapped

# Fixed strong patterns: (kind, pattern, group and least length that a match needs).
STRONG = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),  # maximal runs, so the same as [0-9a-f]+ of 16 or more
)
# Weak parts: what names an account, where it is used, and what looks random.  Runs are open-ended: a part is the whole token.
WEAK = (
    ("identifier", re.compile(r"""\b(?:access|account|client|consumer|user|login|tenant|project)[_-]?(?:key)?[_-]?(?:id|name)?["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", re.I | re.A), 1),
    ("endpoint", re.compile(r"""\b(?:https?|wss?|ftp|jdbc:[a-z]{2,16}|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>|]{3,}""", re.A), 0),
    ("endpoint", re.compile(r"""\b(?:endpoint|host|hostname|server|base_?url)["']?\x20*[:=]\x20*["']?([A-Za-z0-9.-]{3,}(?::[0-9]{2,5})?)""", re.I | re.A), 1),
    ("random", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])"), 0),
)
ORDER = {k: i for i, k in enumerate(("assign", "access", "hex", "identifier", "endpoint", "random"))}
# What each kind can complete: a secret needs an identifier or an endpoint, and the reverse.
ROLE = {"assign": "secret", "hex": "secret", "random": "secret", "access": "identifier", "identifier": "identifier", "endpoint": "endpoint"}


def _looks_random(s: str) -> bool:
    if not (any(c.isdigit() for c in s) and any(c.islower() for c in s) and any(c.isupper() for c in s)):
        return False
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) >= 3.5


def strong_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the strong findings, leftmost and non-overlapping per kind, too short ones dropped."""
    return [(k, *m.span()) for k, p, g, least in STRONG for m in p.finditer(text) if m.end(g) - m.start(g) >= least]


def weak_parts(text: str) -> list[tuple[str, int, int]]:
    return [(k, *m.span(g)) for k, p, g in WEAK for m in p.finditer(text) if k != "random" or _looks_random(m[0])]


def linked(text: str, strong: list, weak: list, reach: int) -> list[tuple[str, int, int]]:
    """The weak parts that a complementary part completes: roles differ, one of the two is a secret, scopes overlap."""
    taken = {(s, e) for _, s, e in strong}
    weak = [p for p in weak if not any(s <= p[1] and p[2] <= e for s, e in taken)] if len(taken) < 50 else _outside(weak, sorted(taken))
    if not weak:
        return []
    breaks = [m.start() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    scope = lambda part: bisect_left(breaks, part[1])
    roles: dict[tuple[int, str], list] = {}
    for part in sorted([*strong, *weak], key=lambda p: p[1]):
        roles.setdefault((scope(part), ROLE[part[0]]), []).append(part)
    starts = {k: [p[1] for p in v] for k, v in roles.items()}
    ends = {k: list(accumulate((p[2] for p in v), max)) for k, v in roles.items()}  # the furthest end so far, as parts nest

    def meets(part, role: str) -> bool:
        key = scope(part), role
        if key not in roles:
            return False
        at = bisect_left(starts[key], part[1])
        return at > 0 and part[1] - ends[key][at - 1] <= reach or at < len(starts[key]) and starts[key][at] - part[2] <= reach

    return [p for p in weak if (meets(p, "identifier") or meets(p, "endpoint") if ROLE[p[0]] == "secret" else meets(p, "secret"))]


def _outside(parts: list, taken: list) -> list:
    """Parts that no taken span contains; by the furthest end so far."""
    starts, ends, far = [s for s, _ in taken], [], -1
    for _, e in taken:
        far = max(far, e)
        ends.append(far)
    return [p for p in parts if not ((i := bisect_left(starts, p[1] + 1)) and ends[i - 1] >= p[2])]


def find(text: str, reach: int = 200) -> list[tuple[str, int, int]]:
    """All findings of a text by start, then kind: the strong ones, and the weak ones that link."""
    strong = strong_spans(text)
    return sorted([*strong, *linked(text, strong, weak_parts(text), reach)], key=lambda s: (s[1], ORDER[s[0]]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def with_findings(docs: DataFrame, into: str, *, reach: int = 200, text_col: str = "text") -> DataFrame:
    """docs with an array `into` of findings (kind, start, end in code points); null texts have none."""

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield mapped(batch, lambda x: [dict(zip(("kind", "start", "end"), s)) for s in find(x or "", reach)], pa.list_(_SPAN))

    return docs.withColumn(into, look.asNondeterministic()(F.col(text_col)))


def scan(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, findings.  An empty table gives no rows."""
    found = with_findings(docs.select("doc_id", "text"), "findings", **options)
    base = F.filter("findings", lambda s: s["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"), "findings")


def redacted(text: str, mark: str, reach: int = 200) -> str:
    """The text with every finding replaced by the mark, in one pass; overlapping findings are replaced once."""
    out, at = [], 0
    for _, start, end in find(text, reach):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, *, mark: str = "[SECRET]", text_col: str = "text", reach: int = 200) -> DataFrame:
    """docs with every finding replaced by the mark; overlapping findings are replaced once; other rows are unchanged.

    The work grows with the text's length, however many findings it has.
    Null texts stay null.
    """

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield mapped(batch, lambda x: None if x is None else redacted(x, mark, reach), pa.string())

    return docs.withColumn(text_col, clean.asNondeterministic()(F.col(text_col)))
