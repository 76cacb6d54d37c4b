"""WARC archives: writing, normalising monolithic gzip, reading by offset.

write_warc stores records with Spark's text writer, so a file is one gzip
stream over all its records.  normalise inflates each such file once, as a
stream, rewrites every record as a gzip member of its own and writes a sidecar
index of (offset, length, ...) beside it.  read_warc then reads members by
offset, in splits of about equal bytes.

Archives live in a folder that driver and executors share, under any URI that
pyarrow opens.  A task writes to a name of its own and renames it at the end,
so a task that runs again replaces its file by an equal one.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm.common import remove, scratch, stored

CHUNK = 1 << 20
BUCKETS = 1 << 18
_DIGITS32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "offset bigint, length bigint, record_id string, type string, payload_bytes bigint, digest string, refers_to string"


def sha1_base32(text: Column) -> Column:
    """Bare upper-case base32 SHA-1 of the UTF-8 bytes: 160 bits are four times 40, and 40 bits are eight digits."""
    digest = F.sha1(text.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _DIGITS32, _BASE32)


def records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Per row of pages: page_id, url, html (never null), bytes, digest, refers_to.

    Of rows with equal payloads of at least min_bytes, those with the largest
    page_id are responses (several only if rows are repeated) and the others
    refer to it.  Without any page_id in a group all are responses; otherwise a
    row without page_id refers to the largest.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("bytes", F.octet_length("html").cast("long")).withColumn("hash", F.xxhash64("html"))
    # a cheap hash says which payloads may occur twice; only these are digested to be grouped.  At most BUCKETS
    # numbers: a payload in none of them is alone, and is not shuffled
    bucket = F.pmod(F.xxhash64("hash", "bytes"), F.lit(BUCKETS))
    twice = rows.where(F.col("bytes") >= min_bytes).groupBy("hash", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    buckets = F.broadcast(stored(twice.select(bucket.alias("bucket")).distinct()))
    rows, digest = rows.withColumn("bucket", bucket).drop("hash"), sha1_base32(F.col("html"))
    alone = rows.join(buckets, "bucket", "left_anti").withColumn("digest", digest).withColumn("first", F.col("page_id"))
    shared = rows.join(buckets, "bucket", "left_semi").withColumn("digest", digest)
    groups = shared.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = alone.unionByName(shared.join(stored(groups), ["digest", "bytes"], "left")).drop("bucket")
    return joined.withColumn("refers_to", F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))).drop("first")


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def rendered(rows: DataFrame) -> Column:
    """The text of a WARC record of records(), up to its closing blank lines."""
    crlf = "\r\n"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{crlf}Content-Type: text/html; charset=utf-8{crlf}Content-Length: "), F.col("bytes").cast("string"), F.lit(crlf * 2))
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    url = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.lit(""))
    return F.concat_ws(
        crlf,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _urn(F.col("page_id"))),
        F.when(url != "", F.concat(F.lit("WARC-Target-URI: "), url)),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _urn(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(crlf), F.lit(crlf), block),
    )


def write_warc(pages: DataFrame, path: str, *, min_bytes: int = 0, file_bytes: int = 128 << 20, file_rows: int | None = None) -> None:
    """Write one record per row of pages; every file is one gzip stream of at most file_rows records, by default as many as have file_bytes on average.

    These archives are read once and go, so they are compressed for speed.

    Null html is an empty payload, a null url has no target URI, a null page_id
    is `none` in the record's id; repeated rows each have a record, other
    columns are left out, and an empty table writes no record.
    """
    lines = (rows := records(pages, min_bytes)).select(rendered(rows).alias("value"))
    if file_rows is None:
        mean = pages.agg(F.avg(F.coalesce(F.octet_length("html"), F.lit(0)))).first()[0] or 0
        file_rows = max(1, int(file_bytes / (mean + 600)))  # a header has some 600 bytes
    fast = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "lineSep": "\r\n\r\n", "maxRecordsPerFile": file_rows}
    lines.write.options(**fast).text(path)


# -- streams ----------------------------------------------------------------


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class _Inflated:
    """Bytes of a gzip stream of any number of members, in bounded chunks."""

    def __init__(self, raw):
        self.raw, self.held, self.inflater, self.pending = raw, bytearray(), zlib.decompressobj(31), b""

    def _more(self) -> bool:
        while True:
            if not self.pending:
                self.pending = self.raw.read(CHUNK)
                if not self.pending:
                    if not self.inflater.eof and self.started:
                        raise EOFError("the gzip stream ends early")
                    return False
            if self.inflater.eof:
                self.inflater = zlib.decompressobj(31)
            self.started = True
            got = self.inflater.decompress(self.pending, CHUNK)
            self.pending = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
            if got:
                self.held += got
                return True

    started = False

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes:
        """Bytes up to and with the mark; empty at the end."""
        at = 0
        while (i := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark) + 1)
            if len(self.held) > most:
                raise ValueError("a record's header is too long")
            if not self._more():
                if bytes(self.held).strip():
                    raise ValueError("the archive ends within a record")
                return b""
        out = bytes(self.held[: i + len(mark)])
        del self.held[: i + len(mark)]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self._more():
                raise EOFError("the archive ends within a record")
            part = bytes(self.held[: min(n, CHUNK)])
            del self.held[: len(part)]
            n -= len(part)
            yield part


def parse_header(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").strip().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


class _Counted:
    def __init__(self, raw):
        self.raw, self.at = raw, 0

    def write(self, data: bytes) -> None:
        if data:
            self.raw.write(data)
            self.at += len(data)


def rewrite(source, sink) -> Iterator[dict]:
    """Copy records from an inflated stream to members of their own; yields the index row of each.

    A record passes in chunks, so memory does not grow with its length.
    """
    out = _Counted(sink)
    stream = _Inflated(source)
    while head := stream.until(b"\r\n\r\n"):
        fields = parse_header(head.lstrip(b"\r\n"))
        start, member = out.at, zlib.compressobj(6, zlib.DEFLATED, 31)
        out.write(member.compress(head.lstrip(b"\r\n")))
        for part in stream.take(int(fields["content-length"])):
            out.write(member.compress(part))
        for _ in stream.take(4):  # the record's own blank lines
            pass
        out.write(member.compress(b"\r\n\r\n") + member.flush())
        yield {"offset": start, "length": out.at - start, "id": fields.get("warc-record-id", ""), "type": fields.get("warc-type", "")}


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every monolithic *.gz archive under source; returns one row per archive: path, records, bytes.

    Each archive part-x.gz becomes target/part-x.warc.gz with the sidecar
    part-x.warc.idx, a JSON line per record.  An archive without records gives
    empty files and a row of zeros; one that ends within a record is an error.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(source).select("path", "length")
    n = max(1, min(100_000, files.count()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                name = path.rsplit("/", 1)[-1].removesuffix(".gz").removesuffix(".txt").removesuffix(".warc")
                fs, place = _open(path)
                to, folder = _open(target)
                to.create_dir(folder, recursive=True)
                own = f"{folder}/.{name}.{uuid.uuid4().hex}"
                count = 0
                with fs.open_input_stream(place, compression=None) as raw, to.open_output_stream(f"{own}.gz", compression=None) as sink, to.open_output_stream(f"{own}.idx", compression=None) as index:
                    for row in rewrite(raw, sink):
                        index.write(json.dumps(row).encode() + b"\n")
                        count += 1
                size = to.get_file_info(f"{own}.gz").size
                to.move(f"{own}.gz", f"{folder}/{name}.warc.gz")
                to.move(f"{own}.idx", f"{folder}/{name}.warc.idx")
                yield pa.RecordBatch.from_arrays([pa.array([f"{target}/{name}.warc.gz"]), pa.array([count], pa.int64()), pa.array([size], pa.int64())], ["path", "records", "bytes"])

    return stored(files.select("path").repartition(n).mapInArrow(work, "path string, records bigint, bytes bigint"))


def parse_record(data: bytes) -> dict:
    """A record's fields and payload from its inflated bytes; the digest is checked where there is a payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = parse_header(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields.get("warc-type", "")
    if kind == "response":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"the payload of {fields.get('warc-record-id')} has another digest")
        size = len(payload)
    else:
        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    number = lambda name: int(v) if (v := fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")).lstrip("-").isdigit() else None
    return {
        "page_id": number("warc-record-id"),
        "url": fields.get("warc-target-uri"),
        "payload": payload.decode() if kind == "response" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("warc-refers-to"),
    }


_READ = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def read_warc(spark: SparkSession, path: str, *, split_bytes: int = 4 << 20, payloads: bool = True) -> DataFrame:
    """Records of normalised archives, by their sidecar indexes: runs of neighbouring members of about split_bytes are read at once.

    Revisits have no payload, and no payload is read as an empty text only
    where the record has zero bytes.  Ids that are not numbers are null.
    Without records there are no rows.
    """
    index = (
        spark.read.schema("offset bigint, length bigint, id string, type string")
        .option("pathGlobFilter", "*.idx")
        .json(path)
        .select("offset", "length", F.regexp_replace(F.input_file_name(), r"\.idx$", ".gz").alias("path"))
    )
    runs = index.groupBy("path", F.expr(f"offset div {split_bytes}").alias("run")).agg(F.min("offset").alias("first"), F.max(F.col("offset") + F.col("length")).alias("last"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, place = _open(row["path"])
                got, room = [], 8 << 20
                with fs.open_input_file(place) as raw:
                    raw.seek(row["first"])
                    left = row["last"] - row["first"]
                    inflater, data = zlib.decompressobj(31), bytearray()
                    while left:
                        part = raw.read(min(left, CHUNK))
                        left -= len(part)
                        while part:
                            data += inflater.decompress(part)
                            part = inflater.unused_data
                            if inflater.eof:
                                record = parse_record(bytes(data))
                                if not payloads:
                                    record["payload"] = None
                                got.append(record)
                                room -= len(data)
                                inflater, data = zlib.decompressobj(31), bytearray()
                                if room < 0:
                                    yield pa.RecordBatch.from_pylist(got, _READ)
                                    got, room = [], 8 << 20
                if data:
                    raise EOFError(f"a record of {row['path']} ends early")
                yield pa.RecordBatch.from_pylist(got, _READ)

    schema = "page_id bigint, url string, payload string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(1, min(100_000, -(-total // split_bytes)))  # a number, as adaptive execution would join these few rows into one task
    return runs.repartition(tasks).mapInArrow(work, schema)


def archived(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """Write pages as monolithic archives, normalise them, read them back.

    Per row: page_id, payload_bytes, payload_digest, record_type, refers_to.
    Null html is an empty payload; a null url has no target URI; repeated rows
    each have a record; an empty table gives none.
    """
    spark = pages.sparkSession
    whole, members = scratch(spark, "monolithic"), scratch(spark, "members")
    write_warc(pages, whole, min_bytes=min_bytes)
    normalise(spark, whole, members)
    remove(spark, whole)
    return read_warc(spark, members, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
