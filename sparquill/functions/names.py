"""Expansion of instruction titles to names."""

from __future__ import annotations

import re
from itertools import product

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from sparquill.operators.validate import JCC


def _alternatives(title: str) -> list[str]:
    """Names between slashes; short forms replace the first name's tail.  Commas part names only where there is a slash."""
    if "/" not in title:
        return [title]
    out: list[str] = []
    for item in title.split("/"):
        for name in (x.strip() for x in item.split(",")):
            if len(name) <= 2 and out:
                out.append(out[0][: len(out[0]) - len(name)] + name if "," not in title else out[0][:-1] + name)
            elif name:
                out.append(name)
    return out


def expand(title: str, compat: bool = False) -> list[str]:
    """Names of a title: Jcc, every choice of its bracket groups, and then alternatives by slash.

    Choices are trimmed.  With compat, text from the second group on is lost.
    """
    title = title.strip()
    if title == "Jcc":
        return list(JCC)
    pieces = re.split(r"\[([^\]]*)\]", title)
    choices = [[x.strip() for x in p.split(",")] if i % 2 else [p] for i, p in enumerate(pieces)]
    whole = product(*(choices[:3] if compat else choices))
    return list(dict.fromkeys(name for x in whole for name in _alternatives("".join(x))))


def names(title: Column) -> Column:
    """The names of a title; null for null."""

    @F.arrow_udf("array<string>")
    def every(titles: pa.Array) -> pa.Array:
        return pa.array([None if t is None else expand(t) for t in titles.to_pylist()], pa.list_(pa.string()))

    return every(title)
