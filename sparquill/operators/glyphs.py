"""From content operations to lines of text, page by page."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.functions.geometry import bounding_box
from sparquill.functions.text import BYTE_TEXT, SUB, SUPER, UNKNOWN

GLYPHS = "page_no int, glyph_idx int, raw int, cid int, text string, x0 float, y0 float, x1 float, y1 float, font_scale float"
LETTERS = "page_no int, seq int, pos int, text string, x0 float, y0 float, x1 float, y1 float, font_scale float"
_F = np.float32


def _codes(data: bytes, wide: bool) -> list[int]:
    if not wide:
        return list(data)
    data = data + b"\0" * (len(data) % 2)
    return [data[i] << 8 | data[i + 1] for i in range(0, len(data), 2)]


def decode_text(code: int) -> str:
    return chr(code) if 0x20 <= code <= 0x7E else BYTE_TEXT.get(code, UNKNOWN)


def replay(ops: list[tuple[str, list]], width_of, text_of) -> list[tuple]:
    """Glyphs (raw, cid, text, x0, y0, x1, y1, scale) of one page's operations in order.

    The pen is set by Tm (unless skewed) and moved by Td, TD and T*; showing
    text does not move it.  width_of(font, code) and text_of(font, code) are
    lookups; a font name of a two-byte font begins with "cid:".
    """
    font, size, tw, tc = "", _F(0), _F(0), _F(0)
    x, y, wide, high = _F(0), _F(0), _F(1), _F(1)
    out = []

    def show(items, x_now):
        for item in items:
            if isinstance(item, (int, float)):
                x_now = x_now - _F(item) / _F(1000) * wide
                continue
            for code in _codes(item, font.startswith("cid:")):
                advance = _F(width_of(font, code)) * wide * size
                out.append((code, code if font.startswith("cid:") else None, text_of(font, code), x_now, y, x_now + advance, y + high * size, wide))
                x_now = x_now + advance + tc
            x_now = x_now + tw

    for operator, args in ops:
        if operator == "Tf":
            font, size = args[0], _F(args[1])
        elif operator == "Tc":
            tc = _F(args[0])
        elif operator == "Tw":
            tw = _F(args[0])
        elif operator == "T*":
            y = y - high * _F(1.35)
        elif operator in ("Td", "TD"):
            x, y = x + _F(args[0]) * wide, y + _F(args[1]) * high
        elif operator in ("Tm", "Tlm"):
            a, b, c, d, e, f = map(_F, args)
            if a == d and b == 0 and c == 0:
                x, y = e, f
            wide, high = a, d
        elif operator == "Tj":
            show([args[0]], x)
        elif operator == "TJ":
            show(args[0], x)
    return out


def _operand(o) -> object:
    if o["kind"] == "array":
        return [_operand(i) for i in o["items"]]
    return o["num"] if o["kind"] == "num" else bytes(o["bytes"]) if o["kind"] == "string" else bytes(o["bytes"]).decode("latin-1")


def glyphs(ops: DataFrame, widths: DataFrame, cmap: DataFrame) -> DataFrame:
    """Glyphs of every page; widths and maps come with the page's own rows, so nothing is broadcast."""

    def page(key, operations: pd.DataFrame, fonts: pd.DataFrame) -> pd.DataFrame:
        width = {(f, c): w for f, c, w in zip(fonts.font, fonts.code, fonts.width) if w == w}
        text = {(f, c): chr(int(p)) for f, c, p in zip(fonts.font, fonts.code, fonts.codepoint) if p == p and p is not None}
        rows = [(o.operator, [_operand(a) for a in o.operands]) for o in operations.sort_values("op_idx").itertuples()]
        found = replay(rows, lambda f, c: width.get((f, c), 0.5 if f.startswith("cid:") else 0.0), lambda f, c: text.get((f, c)) or (UNKNOWN if f.startswith("cid:") else decode_text(c)))
        out = pd.DataFrame(found, columns=["raw", "cid", "text", "x0", "y0", "x1", "y1", "font_scale"])
        out.insert(0, "glyph_idx", range(len(out)))
        out.insert(0, "page_no", int(key[0]))
        return out.astype({"cid": "Int32"})

    fonts = widths.join(cmap.withColumnRenamed("cid", "code"), ["page_no", "font", "code"], "full")
    return ops.groupBy("page_no").cogroup(fonts.groupBy("page_no")).applyInPandas(page, GLYPHS)


def attach(rects: np.ndarray) -> list[list[int]]:
    """Strings as lists of glyph numbers: taken from the end, each joins the first string that it is near, in order of centre x."""
    strings, boxes = [], []
    cx, cy, w = (rects[:, 0] + rects[:, 2]) / _F(2), (rects[:, 1] + rects[:, 3]) / _F(2), rects[:, 2] - rects[:, 0]
    for g in range(len(rects) - 1, -1, -1):
        for s, b in zip(strings, boxes):
            near_x = abs((b[0] + b[2]) / _F(2) - cx[g]) <= ((b[2] - b[0]) + w[g]) / _F(2) + _F(20)
            if near_x and abs((b[1] + b[3]) / _F(2) - cy[g]) <= (b[3] - b[1]) / _F(3):
                at = next((i for i, o in enumerate(s) if cx[o] > cx[g]), len(s))
                s.insert(at, g)
                b[:2], b[2:] = np.minimum(b[:2], rects[g, :2]), np.maximum(b[2:], rects[g, 2:])
                break
        else:
            strings.append([g])
            boxes.append(rects[g].copy())
    return strings


def dominant(scales: list) -> np.float32:
    """The most frequent scale, within half a unit of the first seen; the last of equal buckets."""
    buckets: list[list] = []
    for s in scales:
        hit = next((b for b in buckets if abs(b[0] - s) < _F(0.5)), None)
        if hit:
            hit[1] += 1
        else:
            buckets.append([s, 1])
    return max(enumerate(buckets), key=lambda b: (b[1][1], b[0]))[1][0]


def raised(scales: np.ndarray, middles: np.ndarray) -> np.ndarray:
    """1 for superscripts, -1 for subscripts, 0 for others: smaller than the dominant scale and off its baseline."""
    main = dominant(list(scales))
    usual = np.sort(middles[np.abs(scales - main) < _F(0.5)])
    off = middles - usual[len(usual) // 2]
    small = (scales < main - _F(0.5)) & (np.abs(off) > _F(0.2) * main)
    return np.where(small, np.sign(off), 0).astype(int)


_UP, _DOWN = str.maketrans(*SUPER), str.maketrans(*SUB)


def _assembled(pdf: pd.DataFrame) -> list[pd.DataFrame]:
    """The strings of a page from top to bottom and left to right, each as its glyphs in order, scripts written with their own characters."""
    pdf = pdf.sort_values("glyph_idx").reset_index(drop=True)
    rects, scale = pdf[["x0", "y0", "x1", "y1"]].to_numpy(_F), pdf.font_scale.to_numpy(_F)
    found = []
    for members in attach(rects):
        r = rects[members]
        shift = raised(scale[members], (r[:, 1] + r[:, 3]) / _F(2))
        part = pdf.loc[members, ["text", "x0", "y0", "x1", "y1", "font_scale"]].copy()
        part["text"] = [t.translate(_UP) if s > 0 else t.translate(_DOWN) if s < 0 else t for t, s in zip(part.text, shift)]
        low, high = r[:, :2].min(axis=0), r[:, 2:].max(axis=0)
        found.append((-(low[1] + high[1]) / 2, (low[0] + high[0]) / 2, part))
    return [part for _, _, part in sorted(found, key=lambda f: f[:2])]


def letters(glyph_table: DataFrame) -> DataFrame:
    """Glyphs of every page with the number of their string (seq, in reading order) and their place in it (pos)."""

    def page(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [p.assign(seq=i, pos=range(len(p))) for i, p in enumerate(_assembled(pdf))]
        return pd.concat(parts).assign(page_no=int(pdf.page_no.iloc[0]))[["page_no", "seq", "pos", "text", "x0", "y0", "x1", "y1", "font_scale"]]

    return glyph_table.groupBy("page_no").applyInPandas(page, LETTERS)


def joined(letter_table: DataFrame) -> DataFrame:
    """The strings of letters(): text, bounding box, and the scale of the first glyph."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "")
    return letter_table.groupBy("page_no", "seq").agg(text.alias("text"), *bounding_box(), F.min_by("font_scale", "pos").alias("font_scale"))


def strings(glyph_table: DataFrame) -> DataFrame:
    """Strings of every page, from top to bottom and left to right; scripts are written with their own characters."""
    return joined(letters(glyph_table))
