"""Legacy web archives (ARC, versions 1 and 2) written, read and converted to WARC.

``write_arc`` lays pages down as ARC files, ``read_arc`` parses them by the header line of their version and the declared
length, ``convert`` writes the same records as WARC with identifiers, timestamps, types and digests made from the ARC fields, and
``read_warc`` parses those. Files are written by Spark's text writer (its line separator ends each record) and read
as binary files, so they live in any store Spark knows, and a lost task is written again. Each task writes one file; a
file is read as one row, unpacked record by record.

Of records with equal payloads of at least ``least`` bytes the one with the smallest key is a response and the others with
larger keys revisit it. A record identifier holds its key, so a revisit names the response it refers to. NULL html is an
empty payload. Rows with a NULL key are responses that nothing refers to; rows that repeat the smallest key are all
responses. NULL urls are written as ``unknown:``, white space in urls as %20. An empty table gives no records. Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.llm.common import PIECE_BYTES, scratch

ARC_END = "\n"
WARC_END = "\r\n\r\n"
ORIGIN = "shelfscope"
# Fixed values of the two ARC versions: the field names of a header line.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_FAST = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _first_of_task() -> Column:
    """True on the first row a task writes: the row number within a task is the low 33 bits of this id."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0


def arc_records(pages: DataFrame, date: str = "20240101000000", version: Column | None = None) -> DataFrame:
    """One ARC record per page as text without its last line feed; pages: (key, url, html)."""
    version = F.lit(1) + F.spark_partition_id() % 2 if version is None else version
    html = F.coalesce("html", F.lit(""))
    key = F.when(F.col("key").isNotNull(), F.concat(F.lit("X-Record-Key: "), F.col("key").cast("string"), F.lit("\r\n"))).otherwise("")
    block = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"), key,
        F.lit("Content-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html,
    )
    url = F.regexp_replace(F.coalesce("url", F.lit("unknown:")), r"[\x00-\x20\x7F]", "%20")
    rows = pages.select(url.alias("url"), block.alias("block"), version.alias("version"), _first_of_task().alias("first"), F.spark_partition_id().alias("task"))
    start = F.concat(F.col("url"), F.lit(f" 0.0.0.0 {date} text/html "))
    length = F.octet_length("block").cast("string")
    name = F.concat(F.lit("pages-"), F.col("task").cast("string"), F.lit(".arc"))
    line = F.when(F.col("version") == 1, F.concat(start, length)).otherwise(F.concat(start, F.lit("200 - - 0 "), name, F.lit(" "), length))

    def opening(number: int) -> Column:
        body = f"{number} 0 {ORIGIN}\n{' '.join(ARC_FIELDS[number])}\n"
        rest = "" if number == 1 else "200 - - 0 - "
        return F.concat(F.lit("filedesc://"), name, F.lit(f" 0.0.0.0 {date} text/plain {rest}{len(body)}\n{body}\n"))

    prefix = F.when(~F.col("first"), "").otherwise(F.when(F.col("version") == 1, opening(1)).otherwise(opening(2)))
    return rows.select(F.concat(prefix, line, F.lit("\n"), F.col("block")).alias("value"))


def write_arc(pages: DataFrame, path: str, **options) -> str:
    arc_records(pages, **options).write.options(lineSep=ARC_END, **_FAST).text(path)
    return path


def _exactly(stream: io.BufferedIOBase, size: int) -> bytes:
    data = stream.read(size)
    if len(data) != size:
        raise ValueError(f"archive ends after {len(data)} of {size} declared bytes")
    return data


def arc_entries(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, content) of each record after the version block, by the field list of the file's version."""
    fields: tuple[str, ...] = ()
    while line := stream.readline():
        if line in (b"\n", b"\r\n"):
            continue
        values = line.decode("utf-8", "surrogateescape").rstrip("\r\n").split(" ")
        if line.startswith(b"filedesc://"):
            body = _exactly(stream, int(values[-1]))
            version = int(body.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            fields = ARC_FIELDS[version]
            continue
        if len(values) != len(fields):
            raise ValueError(f"header line of {len(values)} fields where {len(fields)} are due")
        header = dict(zip(fields, values))
        yield header, _exactly(stream, int(header["Archive-length"]))


def http_parts(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """(head with its blank line, header fields, payload) of a response."""
    head, blank, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")[1:]
    return head + blank, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _key(fields: dict[str, str]) -> int | None:
    text = fields.get("x-record-key")
    return int(text) if text else None


def _opened(content: bytes) -> io.BufferedIOBase:
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("content")


def _parsed(spark: SparkSession, path: str, entries, schema: str) -> DataFrame:
    """Rows of ``entries(stream)`` for all files, given on in batches of bounded size."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for content in batch.column("content"):
                for row, weight in entries(_opened(content.as_py())):
                    rows.append(row)
                    size += weight + 200
                    if size >= PIECE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], arrow.names)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], arrow.names)

    return _files(spark, path).mapInArrow(run, schema)


def _arc_time(digits: str) -> str:
    """A 14-digit (or shorter, as old archives have) date as a WARC date."""
    full = digits + "00000101000000"[len(digits) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Each ARC record: key, url, ip, date (as WARC writes it), digest of the payload, HTTP head and payload."""

    def entries(stream):
        for header, content in arc_entries(stream):
            head, fields, payload = http_parts(content)
            row = (_key(fields), header["URL"], header["IP-address"], _arc_time(header["Archive-date"]), payload_digest(payload), head, payload)
            yield row, len(content)

    return _parsed(spark, path, entries, "key long, url string, ip string, date string, digest string, head binary, payload binary")


def read_arc_digests(spark: SparkSession, path: str) -> DataFrame:
    """(key, digest, payload_bytes) of each ARC record, for deciding without moving payloads."""

    def entries(stream):
        for _, content in arc_entries(stream):
            _, fields, payload = http_parts(content)
            yield (_key(fields), payload_digest(payload), len(payload)), 0

    return _parsed(spark, path, entries, "key long, digest string, payload_bytes long")


def record_id(digest: Column, key: Column, url: Column) -> Column:
    """A custom (version 8) UUID: 48 bits of the digest's hash, then the 64 bits of the key; without a key, of the url."""
    named = F.lower(F.hex(F.xxhash64(digest)))
    spread = F.lpad(F.lower(F.hex(F.coalesce(key, F.xxhash64(url, digest)))), 16, "0")
    mark = F.when(key.isNull(), "9").otherwise("8")
    front = F.lpad(named, 16, "0")
    return F.concat(
        F.lit("<urn:uuid:"), F.substring(front, 1, 8), F.lit("-"), F.substring(front, 9, 4), F.lit("-80"), F.substring(spread, 1, 2),
        F.lit("-"), mark, F.lit("0"), F.substring(spread, 3, 2), F.lit("-"), F.substring(spread, 5, 12), F.lit(">"),
    )


def key_of_record_id(text: str) -> int | None:
    """The key that a record identifier holds."""
    parts = text.strip("<>").removeprefix("urn:uuid:").split("-")
    if len(parts) != 5 or not parts[2].startswith("8") or not parts[3].startswith("8"):
        return None
    value = int(parts[2][2:] + parts[3][2:] + parts[4], 16)
    return value - (1 << 64) if value >> 63 else value


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = 0) -> str:
    """Write the records of ARC files as WARC files.

    Digests are grouped first (each task sends one row per digest), so a payload that fills a third of all records meets in
    one small row; the records then join those rows, a join whose large partitions Spark splits.
    """
    digests = read_arc_digests(spark, arc_path).where(F.col("payload_bytes") >= least)
    firsts = digests.groupBy("digest").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("last > first").select("digest", "first")
    records = read_arc(spark, arc_path).join(firsts, "digest", "left")
    revisit = F.coalesce(F.col("key") > F.col("first"), F.lit(False))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def line(name: str, value: str) -> Column:
        return F.lit(f"{name}: {value}\r\n")

    block = F.when(revisit, F.col("head")).otherwise(F.concat("head", "payload"))
    first_id = record_id(F.col("digest"), F.col("first"), F.col("url"))
    head = F.concat(
        F.lit("WARC/1.0\r\n"),
        F.when(revisit, F.concat(line("WARC-Type", "revisit"), line("WARC-Profile", REVISIT_PROFILE), field("WARC-Refers-To", first_id))).otherwise(line("WARC-Type", "response")),
        field("WARC-Target-URI", F.col("url")), field("WARC-Date", F.col("date")), field("WARC-IP-Address", F.col("ip")),
        field("WARC-Record-ID", record_id(F.col("digest"), F.col("key"), F.col("url"))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("Content-Type", "application/http; msgtype=response"),
        field("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"),
    )
    body = f"software: {ORIGIN}\r\nformat: WARC File Format 1.0\r\n"
    info = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Date: "), F.col("date"), F.lit("\r\nWARC-Record-ID: <urn:uuid:"), F.uuid(),
        F.lit(f">\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n{body}{WARC_END}"),
    )
    opening = F.when(_first_of_task(), info).otherwise("")
    # The text writer writes the bytes of a string as they are, whatever their encoding.
    text = F.concat(opening.cast("binary"), head.cast("binary"), block).cast("string")
    records.select(text.alias("value")).write.options(lineSep=WARC_END, **_FAST).text(warc_path)
    return warc_path


def warc_entries(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record, by declared lengths."""
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"record starts with {line[:20]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, _exactly(stream, int(fields["content-length"]))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Each response and revisit: key, url, payload_bytes, payload_digest, record_type, refers_to, date.

    A response is measured and digested anew and compared with its header; a revisit states both in its headers.
    """

    def entries(stream):
        for fields, block in warc_entries(stream):
            kind = fields["warc-type"]
            if kind == "warcinfo":
                continue
            _, http, payload = http_parts(block)
            digest, size, refers = fields["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"]), None
            if kind == "response":
                if payload_digest(payload) != digest or len(payload) != size:
                    raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
            else:
                refers = key_of_record_id(fields["warc-refers-to"])
            yield (_key(http), fields["warc-target-uri"], size, digest, kind, refers, fields["warc-date"]), 0

    schema = "key long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, date string"
    return _parsed(spark, path, entries, schema)


def through_archives(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages (key, url, html) written as ARC, converted to WARC, and read back."""
    spark = pages.sparkSession
    arc = write_arc(pages, scratch(spark, "arc"))
    return read_warc(spark, convert(spark, arc, scratch(spark, "warc"), least))
