"""Web archives: ARC files read by their version's header lines, and converted to WARC.

An ARC record is one header line (five fields in version 1, ten in version 2; the last is the declared length) and so
many bytes. Each becomes a WARC record with an identifier, a timestamp, a type and digests made from what the ARC
record holds: `response`, or `revisit` without payload where an equal payload of `SMALLEST` bytes or more is already
stored by a record with a smaller page number.

Spark's text writer writes both formats, with a record separator in place of line ends, so archives go to any file
system that Spark reaches; a file has `RECORDS` records at most. Files are read as a stream, one record at a time.

Cases: a null page is empty and a null url is "-" in the archive; payloads may hold any bytes, also ones that look
like record borders; repeated pages are records of their own, and of those with the same number the first in the
archive is the response; a null page number is larger than any other; what is no record is skipped up to the next
header line; an empty table gives no records.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import scratch, stored

SMALLEST = 100
RECORDS = 1000
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Archives are compressed at the fastest level: half the time for some more bytes.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
NAME = r"[^/]+$"
WARC_END = "\r\n\r\n"
_HEAD = re.compile(rb"\S[^\n]* \d{14} [^\n]*\d+$")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


# ---- ARC ----

def arc_header(version: int, url: str | None, ip: str, date: str, kind: str, length: int) -> str:
    """The header line of a record."""
    safe = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or "") or "-"
    middle = "200 - - 0 - " if version == 2 else ""
    return f"{safe} {ip} {date} {kind} {middle}{length}"


def version_block(version: int, date: str) -> str:
    """The first record of a file: its version and its header fields."""
    body = f"{version} 0 Tillstream\n{FIELDS[version]}\n"
    return f"{arc_header(version, 'filedesc://pages.arc', '0.0.0.0', date, 'text/plain', len(body))}\n{body}"


def write_arc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "20200101000000") -> None:
    """Write pages as ARC records, with HTTP headers that name the page; versions alternate from file to file."""
    own = pages.select(F.col(page_id).alias("_id"), F.col(url).alias("_url"), F.col(html).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                out = []
                for number, address, body in zip(*(c.to_pylist() for c in batch.slice(at, 200).columns), strict=True):
                    version = 1 + count // RECORDS % 2
                    if count % RECORDS == 0:
                        out.append(version_block(version, date))
                        count += 1
                    body = body or ""
                    name = "" if number is None else f"X-Page-Id: {number}\r\n"
                    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body.encode())}\r\n{name}\r\n{body}"
                    out.append(f"{arc_header(version, address, '0.0.0.0', date, 'text/html', len(block.encode()))}\n{block}")
                    count += 1
                yield pa.record_batch({"value": pa.array(out, pa.string())})

    own.mapInArrow(run, "value string").write.option("maxRecordsPerFile", RECORDS).option("lineSep", "\n").options(**GZIP).text(path)


def arc_records(stream: io.BufferedIOBase) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header fields and block of each record of an ARC file, version blocks left out."""
    names, at = FIELDS[1].split(), 0
    while line := stream.readline():
        offset, at = at, at + len(line)
        line = line.rstrip(b"\r\n")
        if not _HEAD.match(line):
            continue
        if line.startswith(b"filedesc:"):
            body = stream.read(int(line.rsplit(b" ", 1)[1]))
            at += len(body)
            lines = body.decode("latin-1").split("\n")
            version = int(lines[0].split(" ")[0]) if lines[0][:1].isdigit() else 1
            names = lines[1].split() if len(lines) > 1 and lines[1].startswith("URL ") else FIELDS.get(version, FIELDS[1]).split()
            continue
        values = line.decode("utf-8", "replace").rsplit(" ", len(names) - 1)
        if len(values) < len(names):
            continue
        block = stream.read(int(values[-1]))
        at += len(block)
        yield offset, dict(zip(names, values, strict=True)), block


# ---- HTTP ----

def http_parts(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (lower-case names), the header's bytes with its empty line, and the payload of a response."""
    if not block.startswith(b"HTTP/"):
        return {}, b"", block
    end = block.find(b"\r\n\r\n")
    cut = len(block) if end < 0 else end + 4
    fields = {}
    for line in block[:cut].split(b"\r\n")[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return fields, block[:cut], block[cut:]


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d+", text) else None


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[str, io.BufferedIOBase]]:
    for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
        data = io.BytesIO(content.as_buffer())
        yield path, gzip.GzipFile(fileobj=data) if path.endswith(".gz") else data


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Batches of rows, closed after about `size` bytes of the last column."""
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += len(row[-1] or b"") + 200
        if held > size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def read_arc(spark: SparkSession, path: str, blocks: bool = True, revisits: DataFrame | None = None) -> DataFrame:
    """`file`, `offset`, `page_id`, `url`, `ip`, `date`, `bytes`, `digest` of each record's payload, `refers`, and `head`, `payload`.

    revisits: `name` (of a file), `offset` and `refers` (another record's identifier) of records whose payload is left out. They
    go to the reader of their file, so what moves to meet them are files as they are, and no payloads.
    """
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()),
                        ("bytes", pa.int64()), ("digest", pa.string()), ("refers", pa.string()), ("head", pa.binary()), ("payload", pa.binary())])

    marked = revisits is not None

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        marks = batch.column("marks").to_pylist() if marked else [None] * batch.num_rows
        for (file, stream), own in zip(_opened(batch), marks, strict=True):
            known = {m["offset"]: m["refers"] for m in own or ()}
            for offset, fields, block in arc_records(stream):
                http, head, payload = http_parts(block)
                yield (file, offset, _number(http.get("x-page-id")), fields["URL"], fields["IP-address"], fields["Archive-date"], len(payload),
                       hashlib.sha256(payload).hexdigest(), known.get(offset), head if blocks else None, payload if blocks and offset not in known else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batched(rows(batch), schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    if marked:
        marks = revisits.groupBy("name").agg(F.collect_list(F.struct("offset", "refers")).alias("marks"))  # a file's records at most
        files = files.withColumn("name", F.regexp_extract("path", NAME, 0)).join(marks, "name", "left").select("path", "content", "marks")
    return files.mapInArrow(run, "file string, offset long, page_id long, url string, ip string, date string, bytes long, digest string, refers string, head binary, payload binary")


# ---- WARC ----

def _identifier(*parts) -> F.Column:
    """An urn:uuid made of a hash of the parts."""
    h = F.sha2(F.concat_ws("\x00", *parts), 256)
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-8"), F.substring(h, 14, 3), F.lit("-8"),
                    F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def convert(spark: SparkSession, arc: str, warc: str) -> None:
    """Read ARC files and write what they hold as WARC records."""
    own = F.col("bytes"), F.col("digest")
    name = F.regexp_extract("file", NAME, 0)
    keys = stored(read_arc(spark, arc, blocks=False).select(name.alias("file"), "offset", "page_id", "bytes", "digest"), "keys")
    first = F.min(F.struct(F.col("page_id").isNull().alias("null"), "page_id", "file", "offset")).alias("first")
    groups = keys.where(own[0] >= SMALLEST).groupBy("bytes", "digest").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    revisits = keys.join(groups, ["bytes", "digest"]).where("file != first.file OR offset != first.offset").select(
        F.col("file").alias("name"), "offset", _identifier("first.file", F.col("first.offset").cast("string")).alias("refers"))
    full = read_arc(spark, arc, revisits=revisits).withColumn("file", name)
    again = F.col("refers").isNotNull()
    body = F.concat(F.col("head").cast("string"), F.when(again, F.lit("")).otherwise(F.col("payload").cast("string")))
    date = F.regexp_replace("date", r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d).*$", "$1-$2-$3T$4:$5:$6Z")
    line = lambda field, value: F.concat(F.lit(f"\r\n{field}: "), value)
    record = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")), line("WARC-Target-URI", F.col("url")), line("WARC-Date", date),
        line("WARC-Record-ID", _identifier("file", F.col("offset").cast("string"))), line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(again, F.concat(line("WARC-Refers-To", F.col("refers")), F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response"), line("Content-Length", F.octet_length(body).cast("string")), F.lit("\r\n\r\n"), body)
    full.select(record.alias("value")).write.option("maxRecordsPerFile", RECORDS).option("lineSep", WARC_END).options(**GZIP).text(warc)


def warc_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of a WARC file."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, stream.read(_number(fields.get("content-length")) or 0)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record: `record_id`, `record_type`, `refers_to_id`, `page_id`, `url`, `date`, `payload_bytes`, `payload_digest`, `payload`.

    Bytes and digest are those of the whole payload: counted where it is stored, as declared in a revisit.
    """
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("refers_to_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                        ("date", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for _, stream in _opened(batch):
            for fields, block in warc_records(stream):
                http, _, payload = http_parts(block)
                again = fields.get("warc-type") == "revisit"
                size = _number(http.get("content-length")) if again else len(payload)
                digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") if again else hashlib.sha256(payload).hexdigest()
                yield (fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-refers-to"), _number(http.get("x-page-id")), fields.get("warc-target-uri"),
                       fields.get("warc-date"), size, digest, payload if payloads and not again else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batched(rows(batch), schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "record_id string, record_type string, refers_to_id string, page_id long, url string, date string, "
                                 "payload_bytes long, payload_digest string, payload binary")


def archived(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages written as ARC, converted to WARC and read back: `page_id`, `payload_bytes`, `payload_digest`, `record_type`, `refers_to`."""
    spark = pages.sparkSession
    arc, warc = scratch(spark, "arc"), scratch(spark, "warc")
    write_arc(pages, arc, page_id, url, html)
    convert(spark, arc, warc)
    found = stored(read_warc(spark, warc, payloads=False).drop("payload"), "records")
    targets = found.where("record_type = 'response'").select(F.col("record_id").alias("_id"), F.col("page_id").alias("refers_to"))
    asked = found.where("record_type = 'revisit'").select("refers_to_id").distinct()
    named = targets.join(asked, F.col("_id") == F.col("refers_to_id"), "left_semi")
    return found.join(named, F.col("refers_to_id") == F.col("_id"), "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
