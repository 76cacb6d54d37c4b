"""Instruction-set XML: an archive source and a per-file event reader.

Mixed text (templates, pseudocode, explanations) needs the order of events,
which a row-tag reader loses; so each file is read by a SAX handler inside
mapInArrow, one file at a time.
"""

from __future__ import annotations

import io
import re
import tarfile
import xml.sax
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.sources.pdf import opened

_TEXT, _LIST = pa.string(), pa.list_(pa.string())


def _rows(**fields) -> pa.DataType:
    return pa.list_(pa.struct(list(fields.items())))


SCHEMA = pa.schema(
    [
        ("filename", _TEXT), ("id", _TEXT), ("heading", _TEXT), ("mnemonic", _TEXT), ("instr_class", _TEXT), ("brief", _TEXT), ("description", _LIST),
        ("encodings", _rows(name=_TEXT, label=_TEXT, asm_template=_TEXT)),
        ("bitfields", _rows(hibit=pa.int16(), width=pa.int16(), name=_TEXT, constants=_LIST)),
        ("operand_explanations", _rows(symbol=_TEXT, text=_TEXT)), ("decode_pseudocode", _TEXT), ("operation", _TEXT),
        ("aliases", _rows(name=_TEXT, preferred_conditions=_LIST)), ("operational_notes", _LIST), ("error", _TEXT),
    ]
)
DDL = (
    "filename string, id string, heading string, mnemonic string, instr_class string, brief string, description array<string>, "
    "encodings array<struct<name:string,label:string,asm_template:string>>, bitfields array<struct<hibit:smallint,width:smallint,name:string,constants:array<string>>>, "
    "operand_explanations array<struct<symbol:string,text:string>>, decode_pseudocode string, operation string, "
    "aliases array<struct<name:string,preferred_conditions:array<string>>>, operational_notes array<string>, error string"
)


def tidy(s: str) -> str:
    return " ".join(s.split())


class _Handler(xml.sax.ContentHandler):
    """Collects the fields of one file; `path` is the stack of open elements."""

    CAPTURED = ("heading", "para", "content", "pstext", "asmtemplate", "symbol", "entry", "alias_name", "aliaspref")

    def __init__(self):
        self.path: list[tuple[str, dict]] = []
        self.text: list[list[str]] = []
        self.out = {n: ([] if isinstance(t, pa.ListType) else "") for n, t in zip(SCHEMA.names, SCHEMA.types)}
        self.decodes: list[tuple[str, str]] = []
        self.common: list[str] = []
        self.symbol, self.alias, self.diagram_done, self.in_diagram, self.klass = "", None, False, [], ""
        self.is_alias = False
        self.told: list[str] = []  # of one explanation
        self.rows: list[list[str]] = []  # of one table of definitions

    def within(self, name: str) -> bool:
        return any(n == name for n, _ in self.path)

    def startElement(self, name, attrs):
        a = dict(attrs.items())
        o = self.out
        if name == "instructionsection":
            o["id"], self.is_alias = a.get("id", ""), a.get("type") == "alias"
        elif name == "docvar" and not self.within("classes"):
            if a.get("key") == "mnemonic" and not o["mnemonic"]:
                o["mnemonic"] = a.get("value", "")
            elif a.get("key") == "instr-class" and not o["instr_class"]:
                o["instr_class"] = a.get("value", "")
        elif name == "iclass":
            self.klass = a.get("name", "")
        elif name == "encoding":
            o["encodings"].append({"name": a.get("name", ""), "label": a.get("label", ""), "asm_template": ""})
        elif name == "regdiagram":
            self.in_diagram = []
        elif name == "box" and self.within("regdiagram"):
            self.in_diagram.append({"hibit": int(a.get("hibit", 0)), "width": int(a.get("width", 1)), "name": a.get("name", ""), "constants": []})
        elif name == "explanation":
            self.symbol, self.told = "", []
        elif name == "table":
            self.rows = []
        elif name == "row":
            self.rows.append([])
        elif name == "aliasref":
            o["aliases"].append({"name": "", "preferred_conditions": []})
            self.labels = a.get("labels", "")
        self.path.append((name, a))
        if name in self.CAPTURED:
            self.text.append([])

    def characters(self, content):
        for t in self.text:
            t.append(content)
        if self.within("explanation") and (self.within("intro") or self.within("definition")) and not self.within("table"):
            self.told.append(content)

    def endElement(self, name):
        _, a = self.path.pop()
        o = self.out
        if name == "regdiagram" and self.in_diagram and not self.diagram_done:
            o["bitfields"], self.diagram_done = self.in_diagram, True
        if name == "iclass":
            self.klass = ""
        self.explain(name)
        if name not in self.CAPTURED:
            return
        raw = "".join(self.text.pop())
        text = tidy(raw)
        if name == "heading" and text and not self.within("classes"):
            o["heading"] = text
        elif name == "para" and text:
            if self.within("brief"):
                o["brief"] = text
            elif self.within("operationalnotes"):
                if not self.within("listitem"):
                    o["operational_notes"].append(text)
            elif self.within("authored"):
                o["description"].append(text)
        elif name == "content" and text and self.within("operationalnotes") and self.within("listitem"):
            o["operational_notes"].append(text)
        elif name == "asmtemplate" and o["encodings"]:
            o["encodings"][-1]["asm_template"] = text
        elif name == "symbol" and self.within("explanation"):
            self.symbol = text
        elif name == "entry" and self.rows:
            self.rows[-1].append(text)
        elif name == "alias_name" and o["aliases"]:
            o["aliases"][-1]["name"] = text
        elif name == "aliaspref" and text and o["aliases"]:
            label = a.get("labels") or self.labels
            o["aliases"][-1]["preferred_conditions"].append(f"[{label}] {text}" if label else text)
        elif name == "pstext":
            code, kind = raw.strip("\n").rstrip(), a.get("section", "")
            inside = self.within("classes")
            if kind == "Decode" and inside:
                self.decodes.append((self.klass, code))
            elif kind == "Execute" or (kind != "Decode" and not inside):
                o["operation"] = code
            else:
                self.common.append(code)

    def explain(self, name: str) -> None:
        """At the end of an element: the parts of an explanation, one row for all of its texts and tables."""
        if name == "row" and self.within("thead") and self.rows:
            self.rows.pop()
        elif name == "table" and self.within("definition"):
            self.told.append(" " + ", ".join(" → ".join(row[:2]) for row in self.rows if row))
        elif name in ("para", "intro", "definition"):
            self.told.append(" ")
        elif name == "explanation" and self.symbol and (text := tidy("".join(self.told))):
            self.out["operand_explanations"].append({"symbol": self.symbol, "text": text})

    def record(self) -> dict:
        o = self.out
        blocks = [c for _, c in self.decodes]
        o["decode_pseudocode"] = "\n\n".join([*self.common, *(blocks if len(blocks) < 2 else (f"// {n}\n{c}" for n, c in self.decodes))])
        o["operational_notes"] = list(dict.fromkeys(o["operational_notes"]))
        if not o["mnemonic"]:
            o["mnemonic"] = re.split("[ ,/]", o["heading"])[0]
        return o


def parse_file(filename: str, data: bytes) -> dict | None:
    """The record of one file; None for alias pages and files without heading.

    A malformed file keeps what was read before the error, which `error` tells.
    """
    handler, error = _Handler(), None
    parser = xml.sax.make_parser()
    parser.setFeature(xml.sax.handler.feature_external_ges, False)
    parser.setContentHandler(handler)
    try:
        parser.parse(io.BytesIO(data))
    except xml.sax.SAXParseException as e:
        error = str(e)
    record = handler.record() | {"filename": filename, "error": error}
    return None if handler.is_alias or not record["heading"] else record


def xml_files(spark: SparkSession, path: str) -> DataFrame:
    """(filename, data) of the XML members of tar archives, compressed or not, or of plain XML files.

    An archive passes as a stream, a member at a time, so it may be larger than
    any memory; its members are then dealt to as many tasks as the shuffle has.
    Equal base names are an error, raised when the rows are read.
    """

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column(0).to_pylist():
                base = place.rsplit("/", 1)[-1]
                with opened(place) as raw:
                    if base.endswith(".xml"):
                        yield pa.RecordBatch.from_pydict({"filename": [base], "data": [raw.read()]})
                        continue
                    with tarfile.open(fileobj=raw, mode="r|*") as tar:
                        for m in tar:
                            if m.isfile() and m.name.endswith(".xml"):
                                yield pa.RecordBatch.from_pydict({"filename": [m.name.rsplit("/", 1)[-1]], "data": [tar.extractfile(m).read()]})

    files = spark.read.format("binaryFile").load(path).select("path").mapInArrow(members, "filename string, data binary")
    return files.groupBy("filename").agg(
        F.when(F.count("*") == 1, F.first("data")).otherwise(F.raise_error(F.concat(F.lit("two files are called "), F.first("filename"))).cast("binary")).alias("data")
    )


def instructions(files: DataFrame) -> DataFrame:
    """Records of XML files (filename, data)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [parse_file(n, d) for n, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_pylist([r for r in rows if r], SCHEMA)

    return files.select("filename", "data").mapInArrow(parse, DDL)
