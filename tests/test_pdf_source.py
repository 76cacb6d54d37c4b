"""The PDF data source: cross-reference tables and streams, byte ranges, partitions and pushed filters."""

import io
import struct
import zlib

import pytest

from sparquill.sources import pdf

BIG = b"% " + bytes(range(97, 123)) * 400 + b"\n"


def _body(n: int) -> bytes:
    return BIG + b"BT /F1 1 Tf 9 0 0 9 50 %d Tm (page %d) Tj 1 0 0 1 0 0 cm ET" % (700 - n, n)


def _objects(pages: int) -> dict[int, bytes]:
    """A page tree of two levels, ten pages a node; contents are stored as they are, so that they take room."""
    nodes = [list(range(at, min(at + 10, pages))) for at in range(0, pages, 10)]
    out = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [%s] /Count %d >>" % (b" ".join(b"%d 0 R" % (10 + i) for i in range(len(nodes))), pages)}
    for i, node in enumerate(nodes):
        out[10 + i] = b"<< /Type /Pages /Parent 2 0 R /Kids [%s] /Count %d >>" % (b" ".join(b"%d 0 R" % (100 + n) for n in node), len(node))
    for n in range(pages):
        out[100 + n] = b"<< /Type /Page /Parent %d 0 R /Contents %d 0 R /Resources << /Font << /F1 5 0 R >> >> >>" % (10 + n // 10, 1000 + n)
        out[1000 + n] = b"<< /Length %d >>\nstream\n" % len(_body(n + 1)) + _body(n + 1) + b"\nendstream"
    out[5] = b"<< /Type /Font /Subtype /TrueType /FirstChar 32 /Widths [" + b" 500" * 95 + b" ] >>"
    return out


def _written(objects: dict[int, bytes], start: bytes = b"%PDF-1.5\n") -> tuple[bytes, dict[int, int]]:
    out, places = start, {}
    for n, body in objects.items():
        places[n] = len(out)
        out += b"%d 0 obj\n%s\nendobj\n" % (n, body)
    return out, places


def _classic(objects: dict[int, bytes], stray: int = 0) -> bytes:
    data, places = _written(objects)
    table = b"xref\n0 1\n0000000000 65535 f \n" + b"".join(b"%d 1\n%010d 00000 n \n" % (n, at + stray) for n, at in places.items())
    return data + table + b"trailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (max(places) + 1, len(data))


def _streamed(objects: dict[int, bytes]) -> bytes:
    """Dictionaries in an object stream, everything listed in a cross-reference stream with a predictor."""
    inner = {n: b for n, b in objects.items() if b"stream" not in b and n != 1}
    places, at = [], 0
    for n, body in inner.items():
        places.append(b"%d %d" % (n, at))
        at += len(body) + 1
    head = b" ".join(places) + b" "
    packed = zlib.compress(head + b"\n".join(inner.values()))
    outer = {n: b for n, b in objects.items() if n not in inner}
    outer[7] = b"<< /Type /ObjStm /N %d /First %d /Length %d /Filter /FlateDecode >>\nstream\n" % (len(inner), len(head), len(packed)) + packed + b"\nendstream"
    data, where = _written(outer)
    size = max(objects) + 1
    rows = [struct.pack(">BIH", 1, where[n], 0) if n in where else struct.pack(">BIH", 2, 7, list(inner).index(n)) if n in inner else bytes(7) for n in range(size)]
    coded, above = b"", bytes(7)
    for row in rows:
        coded += b"\2" + bytes((x - y) & 255 for x, y in zip(row, above))
        above = row
    table = zlib.compress(coded)
    head = b"<< /Type /XRef /Size %d /W [1 4 2] /Root 1 0 R /Length %d /Filter /FlateDecode /DecodeParms << /Predictor 12 /Columns 7 >> >>" % (size, len(table))
    return data + b"8 0 obj\n%s\nstream\n" % head + table + b"\nendstream\nendobj\nstartxref\n%d\n%%%%EOF\n" % len(data)


class Counted(io.BytesIO):
    """A file that counts the bytes that are read from it."""

    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out


@pytest.mark.parametrize("form", [_classic, _streamed])
def test_pages_are_read_by_byte_ranges(form):
    raw = Counted(form(_objects(40)))
    doc = pdf.Document(raw)
    found = doc.pages(21, 23)
    assert [n for n, _ in found] == [21, 22] and doc.count() == 40 and doc.objects.places
    assert [doc.contents(o) for _, o in found] == [_body(21), _body(22)] and doc.fonts(found[0][1]) == {"F1": 5}
    assert raw.taken < len(raw.getvalue()) / 4
    assert [n for n, _ in pdf.Document(raw).pages()] == list(range(1, 41))


def test_wrong_tables_and_updates():
    objects = _objects(3)
    for data in (_classic(objects, stray=3), _written(objects)[0], _classic(objects)[:-40]):
        doc = pdf.Document(data)
        assert [doc.contents(o) for _, o in doc.pages()] == [_body(1), _body(2), _body(3)]
    # an update that replaces a page's contents, and points to the table before it
    data = _classic(objects)
    new = b"1001 0 obj\n<< /Length 3 >>\nstream\nnew\nendstream\nendobj\n"
    table = b"xref\n1001 1\n%010d 00000 n \ntrailer\n<< /Size 1003 /Root 1 0 R /Prev %d >>\nstartxref\n%d\n%%%%EOF\n" % (len(data), data.index(b"xref\n0 1"), len(data) + len(new))
    doc = pdf.Document(data + new + table)
    assert [doc.contents(o) for _, o in doc.pages()] == [_body(1), b"new", _body(3)]
    assert pdf.Document(b"").pages() == [] and pdf.Document(b"no pdf").count() == 0
    with pytest.raises(ValueError, match="encrypted"):
        pdf.Document(_classic(objects).replace(b"/Root 1 0 R >>", b"/Root 1 0 R /Encrypt 9 0 R >>"))


def test_data_source(spark, tmp_path):
    path = tmp_path / "m.pdf"
    path.write_bytes(_streamed(_objects(40)))
    two = pdf.pdf_ops(spark, str(path), [(2, 5), (30, 60)])
    assert two.rdd.getNumPartitions() == 2
    rows = two.select("range_id", "page_no", "op_idx", "operator").collect()
    assert {(r.range_id, r.page_no) for r in rows} == {(0, n) for n in (2, 3, 4)} | {(1, n) for n in range(30, 41)}
    assert [r.operator for r in sorted(rows, key=lambda r: r.op_idx) if r.page_no == 2] == ["BT", "Tf", "Tm", "Tj", "cm", "ET"]
    shown = pdf.pdf_ops(spark, str(path)).where("page_no >= 11 and page_no < 14 and operator in ('Tj', 'Tm')")
    assert shown.rdd.getNumPartitions() == 1 and [r.operator for r in shown.orderBy("page_no", "op_idx").collect()] == ["Tm", "Tj"] * 3
    assert sorted(r.op_idx for r in shown.where("page_no = 12").collect()) == [2, 3]
    # ranges beyond the file have no rows
    assert pdf.pdf_ops(spark, str(path), [(50, 60)]).count() == 0 and pdf.pdf_ops(spark, str(path)).where("page_no > 39").select("page_no").distinct().count() == 1
    rows = pdf.pdf_fonts(spark, str(path), [(1, 3)]).collect()
    assert {(r.page_no, r.font, r.code) for r in rows} == {(p, "F1", c) for p in (1, 2) for c in range(32, 127)} and {r.width for r in rows} == {0.5}
