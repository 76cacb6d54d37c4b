"""A PDF data source: content operations and fonts of pages.

A partition is a slice of a page range.  Its task finds the slice's objects
through the cross-reference table and the page tree's counts, and reads these
byte ranges alone; filters on page_no and operator are pushed into the source.
Objects, object streams and Flate streams with predictors are read; a file
without a usable cross-reference table is searched for its objects instead.  A
row is one operation, so pages are never held together.  What the codes of a
font mean is derived from its raw parts by sources/fonts.py.
"""

from __future__ import annotations

import io
import json
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from sparquill.sources import fonts

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.S)
_TOKEN = re.compile(
    rb"\s*(?:%[^\r\n]*|(?P<name>/[^\s/<>\[\]()]*)|(?P<num>[-+]?(?:\d+\.?\d*|\.\d+))(?![\w.])|(?P<hex><[0-9A-Fa-f\s]*>)|(?P<open>\()|(?P<mark>\[|\]|<<|>>)|(?P<word>[A-Za-z'\"*][\w'\"*]*))"
)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _string(data: bytes, at: int) -> tuple[bytes, int]:
    """A literal string from behind its bracket."""
    out, depth = bytearray(), 1
    while at < len(data):
        c = data[at : at + 1]
        at += 1
        if c == b"\\":
            if m := re.compile(rb"[0-7]{1,3}").match(data, at):
                out.append(int(m[0], 8) & 255)
                at = m.end()
            else:
                out += _ESCAPES.get(data[at : at + 1], data[at : at + 1].strip(b"\r\n"))
                at += 1
            continue
        depth += (c == b"(") - (c == b")")
        if not depth:
            break
        out += c
    return bytes(out), at


def operations(content: bytes) -> Iterator[tuple[str, list]]:
    """(operator, operands) of a content stream; operands are ("num", x), ("string", b), ("name", b) or ("array", [...])."""
    stack: list[list] = [[]]
    at = 0
    while m := _TOKEN.match(content, at):
        at = m.end()
        kind = m.lastgroup
        if kind == "num":
            stack[-1].append(("num", float(m["num"])))
        elif kind == "name":
            stack[-1].append(("name", m["name"][1:]))
        elif kind == "hex":
            digits = re.sub(rb"\s", b"", m["hex"][1:-1])
            stack[-1].append(("string", bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())))
        elif kind == "open":
            value, at = _string(content, at)
            stack[-1].append(("string", value))
        elif kind == "mark":
            if m["mark"] == b"[":
                stack.append([])
            elif m["mark"] == b"]" and len(stack) > 1:
                items = stack.pop()
                stack[-1].append(("array", items))
        elif kind == "word":
            yield m["word"].decode(), stack[0]
            stack = [[]]


def unpredicted(data: bytes, predictor: int, columns: int, colors: int = 1, bits: int = 8) -> bytes:
    """Bytes before a TIFF (2, eight bits only) or PNG (10 and more) predictor."""
    step, width = max(1, colors * bits // 8), (columns * colors * bits + 7) // 8
    if predictor < 2 or (predictor == 2 and bits != 8):
        return data
    png = predictor >= 10
    out, above = bytearray(), bytearray(width)
    for at in range(0, len(data), width + png):
        kind = data[at] if png else 1
        row = bytearray(data[at + png : at + png + width])
        for i in range(len(row)):
            left = row[i - step] if i >= step else 0
            up, corner = above[i], above[i - step] if i >= step else 0
            guess = left + up - corner
            paeth = min((abs(guess - x), k, x) for k, x in enumerate((left, up, corner)))[2]
            row[i] = (row[i] + (0, left, up, (left + up) // 2, paeth)[kind]) & 255
        out += row
        above = row + bytearray(width - len(row))
    return bytes(out)


class TrueType:
    """Advances and character map of an embedded font program."""

    def __init__(self, data: bytes):
        count = struct.unpack_from(">H", data, 4)[0]
        self.tables = {}
        for i in range(count):
            tag, _, at, length = struct.unpack_from(">4sLLL", data, 12 + 16 * i)
            self.tables[tag] = data[at : at + length]
        hhea, hmtx = self.tables.get(b"hhea", b""), self.tables.get(b"hmtx", b"")
        n = struct.unpack_from(">H", hhea, 34)[0] if len(hhea) >= 36 else 0
        self.advances = [struct.unpack_from(">H", hmtx, 4 * i)[0] for i in range(min(n, len(hmtx) // 4))]
        self.glyphs = self._characters(self.tables.get(b"cmap", b""))

    def advance(self, glyph: int) -> int:
        return self.advances[min(glyph, len(self.advances) - 1)] if self.advances else 0

    @staticmethod
    def _characters(cmap: bytes) -> dict[int, int]:
        """Code point -> glyph of the subtables of formats 4 and 12."""
        out: dict[int, int] = {}
        for i in range(struct.unpack_from(">H", cmap, 2)[0] if len(cmap) >= 4 else 0):
            table = cmap[struct.unpack_from(">L", cmap, 8 + 8 * i)[0] :]
            kind = struct.unpack_from(">H", table)[0]
            if kind == 4:
                half = struct.unpack_from(">H", table, 6)[0] // 2
                read = lambda at, code="H": struct.unpack_from(f">{half}{code}", table, at)
                for k, (last, first, delta, offset) in enumerate(zip(read(14), read(16 + 2 * half), read(16 + 4 * half), read(16 + 6 * half))):
                    for c in range(first, min(last, 0xFFFE) + 1):
                        at = 16 + 6 * half + 2 * k + offset + 2 * (c - first)
                        glyph = (c + delta) & 0xFFFF if not offset else struct.unpack_from(">H", table, at)[0] if at + 2 <= len(table) else 0
                        if offset and glyph:
                            glyph = (glyph + delta) & 0xFFFF
                        if glyph:
                            out.setdefault(c, glyph)
            elif kind == 12:
                for k in range(struct.unpack_from(">L", table, 12)[0]):
                    first, last, glyph = struct.unpack_from(">LLL", table, 16 + 12 * k)
                    for c in range(first, min(last, 0x10FFFF) + 1):
                        out.setdefault(c, glyph + c - first)
        return out


class Objects:
    """The objects of a file by number, read by byte range.  `raw` is a file of bytes that can be sought."""

    KEPT = 256  # objects in memory

    def __init__(self, raw):
        self.raw, self.size = raw, raw.seek(0, 2)
        self.places: dict[int, tuple[int, int]] = {}  # (0, offset) or (container, index in it)
        self.starts: list[int] = []
        self.kept: dict[int, bytes] = {}
        self.trailer = b""
        if not self._listed():
            self._searched()

    def _bytes(self, start: int, end: int) -> bytes:
        self.raw.seek(start)
        return self.raw.read(max(0, min(end, self.size) - start))

    def _listed(self) -> bool:
        """Read the cross-reference tables and streams, the latest first; whether they lead to the page tree."""
        found = re.findall(rb"startxref\s+(\d+)", self._bytes(max(0, self.size - 2048), self.size))
        todo, seen = [int(x) for x in found[-1:]], set()
        self.starts = [self.size]
        while todo:
            at = todo.pop(0)
            if at in seen or at >= self.size:
                continue
            seen.add(at)
            table, head = self._table(at), b""
            if table is not None:
                for number, offset in table[0].items():
                    self.places.setdefault(number, (0, offset))
                head = table[1]
            else:
                head = self._stream_table(at)
            self.trailer = self.trailer or head
            todo += [int(x) for key in (b"XRefStm", b"Prev") for x in re.findall(rb"/" + key + rb"\s+(\d+)", head)]
        if b"/Encrypt" in self.trailer:
            raise ValueError("the file is encrypted")
        self.starts = sorted({o for c, o in self.places.values() if not c} | seen | {self.size})
        root = re.search(rb"/Root\s+(\d+)", self.trailer)
        return bool(root) and b"/Pages" in self.get(int(root[1]))

    def _table(self, at: int) -> tuple[dict[int, int], bytes] | None:
        """(offsets by number, trailer) of a classic table; None if there is none."""
        if not self._bytes(at, at + 16).lstrip().startswith(b"xref"):
            return None
        step, data = 1 << 16, b""
        while not re.search(rb"trailer.*?>>\s*startxref", data, re.S) and at + len(data) < self.size:
            step, data = 2 * step, self._bytes(at, at + step)
        body, _, rest = data.partition(b"trailer")
        out: dict[int, int] = {}
        number = 0
        for line in body.split(b"xref", 1)[1].splitlines():
            parts = line.split()
            if len(parts) == 2:
                number = int(parts[0])
            elif len(parts) == 3:
                if parts[2] == b"n":
                    out[number] = int(parts[0])
                number += 1
        return out, rest.split(b"startxref")[0]

    def _stream_table(self, at: int) -> bytes:
        """Take in a cross-reference stream; its dictionary is the trailer."""
        step, data = 1 << 16, self._bytes(at, at + (1 << 16))
        while b"endstream" not in data and at + len(data) < self.size:
            step, data = 2 * step, self._bytes(at, at + 2 * step)
        body = data.partition(b"obj")[2]
        head, widths = body.partition(b"stream")[0], re.search(rb"/W\s*\[\s*(\d+)\s+(\d+)\s+(\d+)", body)
        if not widths:
            return b""
        w, inner = [int(x) for x in widths.groups()], inflated(body)
        index = re.search(rb"/Index\s*\[([\d\s]*)\]", head)
        runs = [int(x) for x in index[1].split()] if index else [0, number(head, b"Size")]
        fields = (tuple(int.from_bytes(inner[at + sum(w[:k]) : at + sum(w[: k + 1])], "big") for k in range(3)) for at in range(0, len(inner) - sum(w) + 1, sum(w)))
        for first, count in zip(runs[::2], runs[1::2]):
            for n, (kind, a, b) in zip(range(first, first + count), fields):
                kind = kind if w[0] else 1
                if kind in (1, 2):
                    self.places.setdefault(n, (0, a) if kind == 1 else (a, b))
        return head

    def _searched(self) -> None:
        """Find the objects of a file whose table is missing or wrong; the last of a number stays."""
        data = self._bytes(0, self.size)
        found = {int(m[1]): m[2] for m in _OBJECT.finditer(data)}
        for n, body in list(found.items()):
            if re.search(rb"/Type\s*/ObjStm\b", body):
                for k, inner in unpacked(body).items():
                    found.setdefault(k, inner)
        self.places, self.kept, self.KEPT = {}, found, len(found) + 1
        root = next((n for n, b in found.items() if re.search(rb"/Type\s*/Catalog\b", b)), None)
        self.trailer = b"/Root %d 0 R" % root if root is not None else b""

    def get(self, number: int | None) -> bytes:
        """The body of an object; empty if there is none."""
        if number in self.kept:
            return self.kept[number]
        if number not in self.places:
            return b""
        container, at = self.places[number]
        if container:
            found = unpacked(self.get(container))
        else:
            data = self._bytes(at, self.starts[bisect_right(self.starts, at)])
            head = re.match(rb"\s*(\d+)\s+\d+\s+obj\b", data)
            found = {number: data[head.end() : data.rfind(b"endobj")] if head and int(head[1]) == number else b""}
        if len(self.kept) + len(found) > self.KEPT:
            self.kept.clear()
        self.kept.update(found)
        return found.get(number, b"")


def number(body: bytes, key: bytes, default: int = 0) -> int:
    m = re.search(rb"/" + key + rb"\s+(-?\d+)(?!\s+\d+\s+R)", body)
    return int(m[1]) if m else default


def ref(body: bytes, key: bytes) -> int | None:
    m = re.search(rb"/" + key + rb"\s*\[?\s*(\d+)\s+\d+\s+R", body)
    return int(m[1]) if m else None


def inflated(body: bytes) -> bytes:
    """The data of a stream object: of its Length, where that is a number and right, else up to endstream."""
    m = re.search(rb"stream\r?\n", body)
    if not m:
        return b""
    head, length = body[: m.start()], number(body[: m.start()], b"Length", -1)
    data = body[m.end() : m.end() + length] if length >= 0 else b""
    if length < 0 or not body[m.end() + length :].lstrip().startswith(b"endstream"):
        data = re.sub(rb"\r?\n\Z", b"", body[m.end() :].rpartition(b"endstream")[0])
    if b"/FlateDecode" not in head:
        return data
    return unpredicted(zlib.decompressobj().decompress(data), number(head, b"Predictor", 1), number(head, b"Columns", 1), number(head, b"Colors", 1), number(head, b"BitsPerComponent", 8))


def unpacked(body: bytes) -> dict[int, bytes]:
    """The objects of an object stream."""
    first, inner = number(body, b"First"), inflated(body)
    heads = [int(x) for x in inner[:first].split()]
    places = [*heads[1::2], len(inner) - first]
    return {n: inner[first + start : first + end] for n, start, end in zip(heads[::2], places, places[1:])}


class Document:
    """Pages, contents and fonts of a file (bytes, or a file that can be sought)."""

    def __init__(self, data):
        self.objects = Objects(io.BytesIO(data) if isinstance(data, bytes) else data)
        root = re.search(rb"/Root\s+(\d+)", self.objects.trailer)
        self.root = ref(self.objects.get(int(root[1])), b"Pages") if root else None

    def _kids(self, body: bytes) -> list[int]:
        listed = re.search(rb"/Kids\s*\[(.*?)\]", body, re.S)
        if not listed and (at := ref(body, b"Kids")) is not None:
            listed = re.search(rb"\[(.*?)\]", self.objects.get(at), re.S)
        return [int(k) for k in re.findall(rb"(\d+)\s+\d+\s+R", listed[1])] if listed else []

    def count(self) -> int:
        return number(self.objects.get(self.root), b"Count") if self.root is not None else 0

    def pages(self, first: int = 1, end: int = 1 << 31) -> list[tuple[int, int]]:
        """(page number, object) of the pages from first up to end; branches of the tree outside are not read."""
        out: list[tuple[int, int]] = []

        def walk(n: int, start: int) -> int:
            body = self.objects.get(n)
            kids = self._kids(body)
            if not kids:
                if first <= start < end:
                    out.append((start, n))
                return 1
            count = number(body, b"Count", -1)
            if count >= 0 and (start + count <= first or start >= end):
                return count
            at = start
            for k in kids:
                if count == len(kids) and not first <= at < end:  # every kid is a page
                    at += 1
                else:
                    at += walk(k, at)
            return at - start

        if self.root is not None:
            walk(self.root, 1)
        return out

    def contents(self, page: int) -> bytes:
        body = self.objects.get(page)
        many = re.search(rb"/Contents\s*\[(.*?)\]", body, re.S)
        numbers = [int(n) for n in re.findall(rb"(\d+)\s+\d+\s+R", many[1])] if many else [n for n in [ref(body, b"Contents")] if n is not None]
        return b"\n".join(inflated(self.objects.get(n)) for n in numbers)

    def fonts(self, page: int) -> dict[str, int]:
        """Font objects of a page by name, from its own or an inherited resource dictionary; names of two-byte fonts begin with cid:."""
        body, deep = self.objects.get(page), 0
        while b"/Resources" not in body and deep < 64 and (up := self.objects.get(ref(body, b"Parent"))):
            body, deep = up, deep + 1
        resources = self.objects.get(ref(body, b"Resources")) or body
        listed = re.search(rb"/Font\s*<<(.*?)>>", resources, re.S) or re.search(rb"<<(.*?)>>", self.objects.get(ref(resources, b"Font")), re.S)
        found = re.findall(rb"/([\w+.-]+)\s+(\d+)\s+\d+\s+R", listed[1] if listed else b"")
        return {("cid:" if self.wide(int(n)) else "") + name.decode(): int(n) for name, n in found}

    def wide(self, font: int) -> bool:
        return bool(re.search(rb"/Subtype\s*/Type0\b", self.objects.get(font)))

    def font(self, n: int) -> dict:
        """The raw parts of a font, as fonts.RAW has them: dictionaries as text, and the program's tables as rows."""
        body, text = self.objects.get(n), lambda b: b.decode("latin-1")
        to = ref(body, b"ToUnicode")
        out = {"object": n, "wide": self.wide(n), "to_unicode": text(inflated(self.objects.get(to))) if to else "", "first_char": number(body, b"FirstChar", -1), "default_width": 1000.0, "widths": "", "advances": None, "glyphs": None}
        if not out["wide"]:
            listed = re.search(rb"/Widths\s*\[(.*?)\]", body, re.S) or re.search(rb"\[(.*?)\]", self.objects.get(ref(body, b"Widths")), re.S)
            return out | {"widths": text(listed[1]) if listed else ""}
        inner = self.objects.get(ref(body, b"DescendantFonts"))
        if re.match(rb"\s*\[\s*\d+\s+\d+\s+R", inner):  # the array is an object of its own
            inner = self.objects.get(int(re.search(rb"\d+", inner)[0]))
        out["default_width"] = float(number(inner, b"DW", 1000))
        at = re.search(rb"/W\s*(?:(\d+)\s+\d+\s+R|\[)", inner)
        out["widths"] = text((self.objects.get(int(at[1])) if at[1] else inner[at.end() - 1 :]).split(b"/")[0]) if at else ""
        program = ref(self.objects.get(ref(inner, b"FontDescriptor")), rb"FontFile\d?")
        data = inflated(self.objects.get(program)) if program else b""
        if len(data) > 12 and data[:4] in (b"\0\1\0\0", b"true", b"OTTO"):
            face = TrueType(data)
            out["advances"], out["glyphs"] = face.advances, [{"codepoint": c, "glyph": g} for c, g in face.glyphs.items()]
        return out


_VALUE = [("kind", pa.string()), ("num", pa.float32()), ("bytes", pa.binary())]
_OPERAND = pa.struct([*_VALUE, ("items", pa.list_(pa.struct(_VALUE)))])
OPS = "range_id int, page_no int, op_idx int, operator string, operands array<struct<kind:string,num:float,bytes:binary,items:array<struct<kind:string,num:float,bytes:binary>>>>"
PAGE_FONTS = "range_id int, page_no int, font string, object int"


def _value(kind, v, nested=True) -> dict:
    out = {"kind": kind, "num": v if kind == "num" else None, "bytes": v if kind in ("string", "name") else None}
    return out | ({"items": [_value(k, x, False) for k, x in v] if kind == "array" else None} if nested else {})


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def opened(uri: str):
    """A file under any URI that pyarrow opens, to be read by byte ranges."""
    from pyarrow import fs

    files, place = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    return files.open_input_file(place)


# -- the data source ------------------------------------------------------------


@dataclass
class Slice(InputPartition):
    """Pages first up to end of a range of the file."""

    range_id: int
    first: int
    end: int


class _Reader(DataSourceReader):
    """Pages of half-open ranges (from 1), a partition for every `slice` pages; filters narrow pages and operators."""

    def __init__(self, options):
        self.path, self.slice = options["path"], int(options.get("slice", 16))
        self.ranges = [tuple(r) for r in json.loads(options.get("ranges", "[[1, 2147483647]]"))]
        self.low, self.high, self.operators = 1, 1 << 31, None

    def pushFilters(self, filters):
        """Takes comparisons of page_no and equalities of operator; all others are left to Spark."""
        for f in filters:
            name, value = ".".join(f.attribute) if hasattr(f, "attribute") else "", getattr(f, "value", None)
            if name == "page_no" and isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual) and value is not None:
                if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                    self.low = max(self.low, value + isinstance(f, GreaterThan))
                if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                    self.high = min(self.high, value + (not isinstance(f, LessThan)))
            elif name == "operator" and isinstance(f, EqualTo | In):
                kept = {value} if isinstance(f, EqualTo) else set(value)
                self.operators = kept if self.operators is None else self.operators & kept
            else:
                yield f

    def partitions(self):
        with opened(self.path) as raw:
            count = Document(raw).count()
        out = []
        for i, (start, end) in enumerate(self.ranges):
            start, end = max(start, self.low), min(end, self.high, count + 1)
            out += [Slice(i, at, min(at + self.slice, end)) for at in range(start, end, self.slice)]
        return out or [Slice(0, 1, 1)]

    def read(self, part):
        with opened(self.path) as raw:
            doc = Document(raw)
            for page, n in doc.pages(part.first, part.end) if part.first < part.end else ():
                yield self.batch(doc, part.range_id, page, n)


class _Operations(_Reader):
    def batch(self, doc: Document, range_id: int, page: int, n: int) -> pa.RecordBatch:
        found = ((k, op, args) for k, (op, args) in enumerate(operations(doc.contents(n))) if self.operators is None or op in self.operators)
        rows = [(range_id, page, k, op, [_value(*a) for a in args]) for k, op, args in found]
        return _batch(rows, ["range_id", "page_no", "op_idx", "operator", "operands"], [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(_OPERAND)])


class _PageFonts(_Reader):
    def batch(self, doc: Document, range_id: int, page: int, n: int) -> pa.RecordBatch:
        return _batch([(range_id, page, name, o) for name, o in doc.fonts(n).items()], ["range_id", "page_no", "font", "object"], [pa.int32(), pa.int32(), pa.string(), pa.int32()])


class PdfOperations(DataSource):
    """format("pdf_operations"): a row per content operation.  Options: path, ranges (JSON pairs), slice (pages of a partition)."""

    @classmethod
    def name(cls):
        return "pdf_operations"

    def schema(self):
        return OPS

    def reader(self, schema):
        return _Operations(self.options)


class PdfPageFonts(PdfOperations):
    """format("pdf_page_fonts"): a row per page and font name, with the font's object number."""

    @classmethod
    def name(cls):
        return "pdf_page_fonts"

    def schema(self):
        return PAGE_FONTS

    def reader(self, schema):
        return _PageFonts(self.options)


def _load(spark: SparkSession, kind: type[DataSource], path: str, ranges: list[tuple[int, int]] | None) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(kind)
    reader = spark.read.format(kind.name()).option("path", path)
    return (reader if ranges is None else reader.option("ranges", json.dumps(ranges))).load()


def pdf_ops(spark: SparkSession, path: str, ranges: list[tuple[int, int]] | None = None) -> DataFrame:
    """Operations of the pages of one file, or of half-open page ranges (from 1) of it."""
    return _load(spark, PdfOperations, path, ranges)


def raw_fonts(spark: SparkSession, path: str, objects: DataFrame) -> DataFrame:
    """The raw parts (fonts.RAW) of the fonts with the object numbers of `objects`, each read once, by its own byte ranges."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with opened(path) as raw:
            doc = Document(raw)
            for batch in batches:
                for n in batch.column(0).to_pylist():
                    yield pa.RecordBatch.from_pylist([doc.font(n)], fonts.ARROW)

    return objects.select("object").distinct().mapInArrow(work, fonts.RAW)


def pdf_fonts(spark: SparkSession, path: str, ranges: list[tuple[int, int]] | None = None) -> DataFrame:
    """(page_no, font, code, width, codepoint) of the pages' fonts; a font that many pages share is read once."""
    used = _load(spark, PdfPageFonts, path, ranges).select("page_no", "font", "object").distinct()
    return used.join(fonts.codes(raw_fonts(spark, path, used)), "object").select("page_no", "font", "code", "width", "codepoint")
