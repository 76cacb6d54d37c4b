"""The older reader of a manual: texts of a page by position, footers that name the record, and lines by section."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.functions import text as T
from sparquill.operators.glyphs import _operand

GAP = "\x01"  # stands for a wide gap between shown strings
# Line height, glyph width, the widest step that is no gap, and how near texts are.
LINE, GLYPH, STEP, NEAR = 1.35, 0.43, 800, 10.0
# Replacements in order; the forms with a backslash come before the single characters.
REPLACED = (
    ("\x92", "'"), ("\\\x93", '"'), ("\\\x94", '"'), ("\\\x95", " - "), ("\x93", '"'), ("\x94", '"'), ("\x95", " - "), ("\x96", "-"), ("\x97", "-"), ("\x8a", "-"),
)
TEXTS = "page_no int, place int, text string, x float, y float"


def shown(operand) -> str:
    """Text of an operand: bytes as they are, line feeds as blanks, steps of more than 800 as a gap, arrays joined."""
    if isinstance(operand, (int, float)):
        return GAP if abs(operand) > STEP else ""
    if isinstance(operand, bytes):
        return operand.decode("latin-1").replace("\n", " ")
    return "".join(map(shown, operand))


def cleaned(text: str) -> str:
    for old, new in REPLACED:
        text = text.replace(old, new)
    return text


def texts(operations: list[tuple[str, list]]) -> list[list]:
    """[text, x, y, width, height] of every showing operation, in order."""
    x = y = width = height = np.float32(0)
    out = []
    for operator, args in operations:
        if operator == "T*":
            y = y - height * np.float32(LINE)
        elif operator in ("Td", "TD"):
            x, y = x + np.float32(args[0]) * width, y + np.float32(args[1]) * height
        elif operator in ("Tm", "Tlm"):
            a, b, c, d, e, f = map(np.float32, args)
            if a == d and b == 0 and c == 0:
                x, y = e, f
            width, height = a, d
        elif operator in ("Tj", "TJ"):
            out.append([cleaned("".join(map(shown, args))), x, y, width, height])
    return out


def _together(a: list, b: list) -> bool:
    """Whether two texts are on one line and near each other."""
    high, low = (a, b) if a[2] > b[2] else (b, a)
    left, right = (a, b) if a[1] <= b[1] else (b, a)
    end = left[1] + np.float32(len(left[0].encode())) * left[3] * np.float32(GLYPH)
    return bool((a[2] == b[2] or high[2] <= low[2] + low[4] * np.float32(2) / np.float32(3)) and right[1] <= end + np.float32(NEAR))


def merged(found: list[list]) -> list[list]:
    """Texts joined with all that are near, in order: a text takes the first near one, and then what is near to both.

    Texts are looked for in bands of the page that are as high as two texts on
    one line can be apart; those joined before come first, then the others by
    their places.  So work grows with the texts and with those of a line.
    """
    step = max((float(t[4]) for t in found), default=0.0) * 2 / 3 * 1.001 or 1.0
    bands: dict[int, dict[tuple[int, int], list]] = {}
    band = lambda t: int(float(t[2]) // step)
    for i, t in enumerate(found):
        bands.setdefault(band(t), {})[1, i] = list(t)
    where = [band(t) for t in found]
    done: dict[tuple[int, int], list] = {}
    for i, at in enumerate(where):
        now = bands[at].pop((1, i), None)
        if now is None:  # taken by an earlier one
            continue
        while True:
            here = band(now)
            near = [(key, b) for b in (here - 1, here, here + 1) for key, o in bands.get(b, {}).items() if _together(now, o)]
            if not near:
                break
            key, b = min(near)
            other = bands[b].pop(key)
            done.pop(key, None)
            a, b = (now, other) if now[1] < other[1] else (other, now)
            now = [a[0] + b[0], a[1], a[2], max(a[3], b[3]), max(a[4], b[4])]
        done[0, i] = bands.setdefault(band(now), {})[0, i] = now
    return list(done.values())


def page_texts(ops: DataFrame) -> DataFrame:
    """(page_no, place, text, x, y): the texts of every page from top to bottom, equal heights from left to right."""

    def page(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(o.operator, [_operand(a) for a in o.operands]) for o in pdf.sort_values("op_idx").itertuples()]
        found = sorted(merged(texts(rows)), key=lambda t: (-t[2], t[1]))
        return pd.DataFrame([(int(pdf.page_no.iloc[0]), i, t[0], t[1], t[2]) for i, t in enumerate(found)], columns=["page_no", "place", "text", "x", "y"])

    return ops.groupBy("page_no").applyInPandas(page, TEXTS)


# Footers.  A page's mark, texts that begin with a title, and texts that only look like one.
MARK = r"^(?:Vol\. \d[A-Z]\d-\d+|\d-\d+Vol\. \d[A-Z])$"
TITLED = (
    r"^[A-Z](?:[A-Z0-9()/]|cc|, ?|x\d{1,2})+-", "^INT n/INTO/INT3/INT1-", "^ADOX -", "^FCOMI/FCOMIP/ FUCOMI/FUCOMIP-", "^PREFETCHh-", "^RORX -",
    r"^VF\[,N\]M(?:ADD|SUB)\[132,213,231\][PS]H-", "^INT n/INTO/INT3/IN$", "^KSHIFTLW/KSHIFTLB/KSHIFTLQ/KSHIF$", "^PUNPCKLBW/PUNPCKLWD/PUNPCKLD$",
    "^VEXTRACTI128/VEXTRACTI32x4/VEXTRACTI64x2/VEXTRACTI$", "^VFMADDSUB132PD/VFMADDSUB213PD/VFMADDSUB231P$", "^VFMADDSUB132PH/VFMADDSUB213PH/$",
    "^VFMSUBADD132PD/VFMSUBADD213PD/VFMSUBADD$", "^VFMSUBADD132PH/VFMSUBADD213P$", "^VFMSUBADD132PS/VFMSUBADD213PS/VFMSUBADD$",
    "^VFNMADD132PD/VFNMADD213PD/$", "^VFNMADD132SD/VFNMADD213SD/$", "^VFNMSUB132SD/VFNMSUB213SD/VFNMSU$", "^VFNMSUB132SS/VFNMSUB213SS/VFNMSU$",
    "^VINSERTF128/VINSERTF32x4/VINSERTF64x$", "^VINSERTI128/VINSERTI32x4/VINSERTI$", "^VINSERTI128/VINSERTI32x4/$", "^VPRORD/VPRORVD/VPRORQ/VP$",
    "^VSHUFF32x4/VSHUFF64x2/VSHUFI32x$",
)
UNTITLED = ("^T1-", "^TLD-", "^Q/PUNPCKLQDQ-", "^VFMADDSUB231PH-", "^H/VFMSUBADD231PH-", "^VFNMADD231PD-", "^VFNMADD231SD-", "^B231SD-", "^B231SS-", "^RORVQ-")


def is_mark(line: Column) -> Column:
    return line.rlike(MARK)


def is_titled(line: Column) -> Column:
    """Whether a footer line begins the record's title: any of TITLED and none of UNTITLED."""
    return line.rlike("|".join(TITLED)) & ~line.rlike("|".join(UNTITLED))


def footers(pages: DataFrame) -> DataFrame:
    """(page_no, last, title, summary) of page_texts(): scanned from the last line up to where mark and title are both seen.

    A title goes on over the lines below it, down to the mark or the end.  The
    body ends before the higher of the two; pages without both have none.
    Title and summary part at the first hyphen.
    """
    up = Window.partitionBy("page_no").orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, -1)
    kind = T.first_of((is_mark(F.col("text")), "mark"), (is_titled(F.col("text")), "title"), default="rest")
    seen = lambda k: F.coalesce(F.max((F.col("kind") == k).cast("int")).over(up), F.lit(0))
    scanned = pages.withColumn("kind", kind).withColumn("done", seen("mark") * seen("title") == 1).where("not done")
    events = scanned.withColumn("run", F.coalesce(F.sum((F.col("kind") != "rest").cast("int")).over(up), F.lit(0)))
    # the rest lines below an event, up to the event before it, belong to the event if it is a title
    texts_of = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]), "")
    runs = events.groupBy("page_no", "run").agg(texts_of.alias("told"), F.min("place").alias("top"), F.min_by("kind", "place").alias("kind"))
    ends = runs.groupBy("page_no").agg(
        F.max_by(F.when(F.col("kind") == "title", F.col("told")), F.when(F.col("kind") == "title", F.col("run"))).alias("footer"),
        F.min(F.when(F.col("kind") != "rest", F.col("top"))).alias("top"),
        F.count_if(F.col("kind") == "mark").alias("marks"),
    )
    both = ends.where("footer is not null and marks > 0")
    summary = F.expr("substring(footer, instr(footer, '-') + 1)")
    title = F.trim(F.substring_index("footer", "-", 1))
    told = F.when(title == "F2XM1", "Compute (2^x)-1").otherwise(F.trim(summary))  # Fixed value: one summary that is set
    return both.select("page_no", (F.col("top") - 1).alias("last"), title.alias("title"), told.alias("summary"))


def line_section(line: Column) -> Column:
    """The section that a line opens, or null."""
    t = F.trim(line)
    return T.first_of(
        (line.rlike(r"^Opcode(?:\x01|/| /|\*\x01|\*/)") | line.isin("Opcode", "Opcode1"), "InstructionsStart"),
        (t == "Description", "Description"),
        (t == "Operation", "Operation"),
        (t == "Flags Affected", "FlagsAffected"),
        (F.rtrim(line).endswith(" Exceptions"), "Exceptions"),
        (line.rlike(r"\d\.\x01"), "FootNote"),
    )


def records(pages: DataFrame) -> DataFrame:
    """(record, title, summary, description, operation, flag_affected, exceptions) of page_texts().

    A record lasts while the footers' title stays the same.  The first line of
    a page is its header.  On a record's first page, lines before the one that
    begins with Opcode are its title; lines of its opcode table are left out,
    and footnotes too.  Lines of a section join without a separator, but those
    of the description and of exceptions stay apart.
    """
    feet = footers(pages)
    order = Window.orderBy("page_no")  # a row for each page
    changed = feet.withColumn("new", F.coalesce((F.col("title") != F.lag("title").over(order)).cast("int"), F.lit(1)))
    kept = changed.withColumn("record", F.sum("new").over(order))
    lines = pages.join(kept.select("page_no", "last", "title", "summary", "record", "new"), "page_no").where("place >= 1 and place < last + 1")
    upto = Window.partitionBy("page_no").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = F.max(F.col("text").startswith("Opcode").cast("int")).over(upto)
    body = lines.withColumn("begun", begun).where("new = 0 or begun = 1").withColumn("heading", line_section(F.col("text")))
    over = Window.partitionBy("record").orderBy("page_no", "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    routed = body.withColumn("section", F.last("heading", ignorenulls=True).over(over)).withColumn(
        "name", F.last(F.when(F.col("heading") == "Exceptions", F.trim("text")), ignorenulls=True).over(over)
    )
    content = routed.where("heading is null")
    at = F.struct("page_no", "place", "text")
    of = lambda kind: F.transform(F.array_sort(F.collect_list(F.when(F.col("section") == kind, at))), lambda x: x["text"])
    told = content.groupBy("record").agg(of("Description").alias("description"), F.array_join(of("Operation"), "").alias("operation"), F.array_join(of("FlagsAffected"), "").alias("flag_affected"))
    raised = routed.where("section = 'Exceptions'").groupBy("record", "name").agg(F.min(at).alias("first"), F.transform(F.array_sort(F.collect_list(F.when(F.col("heading").isNull(), at))), lambda x: x["text"]).alias("lines"))
    raised = raised.groupBy("record").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "name", "lines"))), lambda x: F.struct(x["name"].alias("name"), x["lines"].alias("lines"))).alias("exceptions"))
    heads = kept.groupBy("record").agg(F.min_by("title", "page_no").alias("title"), F.min_by("summary", "page_no").alias("summary"))
    return heads.join(told, "record", "left").join(raised, "record", "left")
