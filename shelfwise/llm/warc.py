"""Legacy archive converter: ARC archives to WARC archives.

``write_arc`` lands pages as ARC archives (version 1 or 2 header lines, gzip)
in the tasks that read them, with no shuffle; ``read_arc`` parses them back: the
version block at the head of the file names the fields of every record's header
line, whose declared length frames the payload. ``convert`` synthesises the WARC side of
each record: identifier (a name-based UUID of address, date and digest),
timestamp, type and SHA-1 payload digest; of the records with equal payloads of
at least ``min_bytes``, the one with the smallest page id is the response and
the others revisit it. Which ones do is found from the digests alone; the payloads
then go from ARC to WARC in one task, and at most the zipped archives meet their
lists of revisits in a shuffle. ``write_warc`` and ``read_warc`` write and parse the WARC
files. Spark's own text writer and binary reader move the bytes, so any store
Spark can reach will do, and a lost executor's files are written again by the
task's rerun.

Archive lines are framed by lengths only, so payloads may hold anything. A page
id travels as the fragment of its address (``#page-id=7``); white space and
control characters in addresses are percent-encoded.

Memory: an archive file is read whole. A task that writes ARC files goes on to a
further file after ``FILE_BYTES`` of records (more only when a single one is
larger); a WARC file holds the records of the ARC files that its task reads.

Defined cases: NULL or empty html is a payload of 0 bytes (taking part in
revisits when ``min_bytes`` is 0); NULL url is ``about:blank``; rows that share
the smallest page id of a payload are all responses; a NULL page id is never the
smallest while another is there; repeated rows give a record each; an empty
table gives no records; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import shared_path, slices, utf8

cloudpickle.register_pickle_by_value(common)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_BYTES = 8 << 20
PAGE_MARK = "#page-id="
# The header fields of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
NO_IP = "0.0.0.0"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _address(url: str | None, page_id: int | None) -> str:
    plain = "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass"))
                    for c in (url or "about:blank"))
    return f"{plain}{PAGE_MARK}{'' if page_id is None else page_id}"


def _page_id(address: str) -> int | None:
    tail = address.rpartition(PAGE_MARK)[2]
    return int(tail) if tail else None


def _arc_head(version: int, date: str) -> bytes:
    block = f"{version} 0 converter\n{ARC_FIELDS[version]}\n".encode()
    line = {1: f"filedesc://pages.arc {NO_IP} {date} text/plain {len(block)}\n",
            2: f"filedesc://pages.arc {NO_IP} {date} text/plain 200 - - 0 pages.arc {len(block)}\n"}[version]
    return line.encode() + block


def _arc_record(version: int, address: str, date: str, payload: bytes) -> bytes:
    line = {1: f"{address} {NO_IP} {date} text/html {len(payload)}\n",
            2: f"{address} {NO_IP} {date} text/html 200 {sha1_base32(payload)} - 0 pages.arc {len(payload)}\n"}[version]
    return line.encode() + payload


def _members(df: DataFrame, end: str) -> DataFrameWriter:
    """A writer of archive members as they are, each followed by ``end``, to gzip files."""
    return df.write.option("lineSep", end).option("compression", "gzip")


def write_arc(pages: DataFrame, path: str, version: int = 1, date: str = "20240101000000",
              id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """The pages as ARC archives under ``path``."""
    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
        held, size = [], 0
        for part in slices(batches, 64):
            for page, url, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), utf8(part.column(2)), strict=True):
                record = _arc_record(version, _address(url, page), date, html)
                if held and size + len(record) > FILE_BYTES:
                    yield held
                    held, size = [], 0
                held.append(record)
                size += len(record)
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in files(batches):
            whole = b"\n".join([_arc_head(version, date), *held])
            yield pa.RecordBatch.from_arrays([pa.array([whole], pa.binary()).cast(pa.string(), safe=False)], names=["value"])

    rows = pages.select(F.col(id_col).cast("bigint"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    # a row is a whole archive
    _members(rows.mapInArrow(run, "value string"), "\n").option("maxRecordsPerFile", 1).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")


def _unzipped(content: bytes) -> bytes:
    """All gzip members of a file."""
    out = []
    while content:
        d = zlib.decompressobj(31)
        out.append(d.decompress(content) + d.flush())
        content = d.unused_data
    return b"".join(out)


def parse_arc(data: bytes) -> Iterator[tuple[str, str, bytes]]:
    """(address, date, payload) of the records of an ARC file, by its own version's header line."""
    at, fields = 0, None
    while at < len(data):
        end = data.index(b"\n", at)
        parts = data[at:end].decode().split(" ")
        length = int(parts[-1])
        body = data[end + 1:end + 1 + length]
        at = end + 1 + length + 1
        if fields is None:
            head = body.decode().split("\n")
            fields = head[1].split(" ")
            if head[0].split(" ")[0] not in "12" or fields[-1] != "Archive-length":
                raise ValueError(f"unknown ARC version block: {head[0]!r}")
            continue
        record = dict(zip(fields, parts, strict=True))
        yield record["URL"], record["Archive-date"], body


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """(address, date, payload BINARY) of all archives under ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in slices(batches, 1):
            records = list(parse_arc(_unzipped(one.column(0)[0].as_py())))
            for lo in range(0, len(records), 64):
                a, d, p = zip(*records[lo:lo + 64], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(d), pa.array(p, pa.binary())],
                                                 names=["address", "date", "payload"])

    return _files(spark, path).select("content").mapInArrow(run, "address string, date string, payload binary")


def _record_id(address: str, date: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join((address, date, digest)))}>"


def _digests(files: DataFrame) -> DataFrame:
    """(path, place, page_id, payload_bytes, payload_digest) of every record of ARC files; place: its number in the file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in slices(batches, 1):
            found = [(_page_id(address), len(payload), sha1_base32(payload))
                     for address, _, payload in parse_arc(_unzipped(one.column(1)[0].as_py()))]
            pages, sizes, digests = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(one.column(0)[0], len(found)), pa.array(range(len(found)), pa.int32()), pa.array(pages, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                names=["path", "place", "page_id", "payload_bytes", "payload_digest"])

    return files.mapInArrow(run, "path string, place int, page_id bigint, payload_bytes bigint, payload_digest string")


def _revisits(files: DataFrame, min_bytes: int) -> DataFrame:
    """(path, revisits): the places in an ARC file of the records that revisit another, with that one's page id; written."""
    d = common.written(_digests(files), "arc-digests").filter(F.col("payload_bytes") >= min_bytes)
    first = d.groupBy("payload_digest").agg(F.min("page_id").alias("low_id"), F.count("*").alias("copies")) \
        .filter((F.col("copies") > 1) & F.col("low_id").isNotNull())
    return common.written(
        d.join(first, "payload_digest").filter(~F.col("page_id").eqNullSafe(F.col("low_id")))
        .groupBy("path").agg(F.collect_list(F.struct("place", "low_id")).alias("revisits")), "arc-revisits")


def convert(spark: SparkSession, path: str, min_bytes: int = 0) -> DataFrame:
    """(value STRING, size): the WARC records of the ARC archives under ``path``, responses and revisits."""
    files = _files(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in slices(batches, 1):
            low = {r["place"]: r["low_id"] for r in one.column(1)[0].as_py() or ()}
            out = [_warc_record(address, date, payload, len(payload), sha1_base32(payload), low.get(place))
                   for place, (address, date, payload) in enumerate(parse_arc(_unzipped(one.column(0)[0].as_py())))]
            for lo in range(0, len(out), 64):
                part = out[lo:lo + 64]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()).cast(pa.string(), safe=False),
                                                  pa.array([len(o) for o in part], pa.int64())], names=["value", "size"])

    return files.join(_revisits(files, min_bytes), "path", "left").select("content", "revisits") \
        .mapInArrow(run, "value string, size bigint")


def _warc_record(address: str, date: str, payload: bytes, size: int, digest: str, low: int | None) -> bytes:
    body = b"" if low is not None else payload
    stamp = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
    lines = ["WARC/1.1", f"WARC-Type: {'response' if low is None else 'revisit'}",
             f"WARC-Record-ID: {_record_id(address, date, digest)}", f"WARC-Date: {stamp}",
             f"WARC-Target-URI: {address}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if low is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{low}>"]
    lines += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body


def write_warc(records: DataFrame, path: str) -> None:
    """WARC members as gzip archives under ``path``."""
    _members(records.select("value"), "\r\n\r\n").text(path)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of the records of a WARC file, framed by Content-Length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines)
        length = int(headers["Content-Length"])
        yield headers, data[end + 4:end + 4 + length]
        at = end + 4 + length + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, record_id, date, url, payload_bytes, payload_digest, record_type,
    refers_to, payload (BINARY, NULL for revisits). The digest of every response is checked."""
    names = ["page_id", "record_id", "date", "url", "payload_bytes", "payload_digest", "record_type", "refers_to",
             "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(),
             pa.binary()]

    def row(h: dict[str, str], body: bytes) -> tuple:
        digest, kind = h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"]
        if kind == "response" and (sha1_base32(body) != digest or len(body) != int(h["X-Payload-Length"])):
            raise ValueError(f"payload of {h['WARC-Record-ID']} does not match its digest")
        refers = h.get("WARC-Refers-To")
        return (_page_id(h["WARC-Target-URI"]), h["WARC-Record-ID"], h["WARC-Date"],
                h["WARC-Target-URI"].rpartition(PAGE_MARK)[0], int(h["X-Payload-Length"]), digest, kind,
                int(refers[len("<urn:page:"):-1]) if refers else None, body if kind == "response" else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in slices(batches, 1):
            rows = [row(h, b) for h, b in parse_warc(_unzipped(one.column(0)[0].as_py()))]
            for lo in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows[lo:lo + 64], strict=True), kinds, strict=True)], names=names)

    return _files(spark, path).select("content").mapInArrow(run, "page_id bigint, record_id string, date string, url string, "
                                               "payload_bytes bigint, payload_digest string, record_type string, "
                                               "refers_to bigint, payload binary")


def round_trip(pages: DataFrame, version: int = 1, min_bytes: int = 0, html_col: str = "html") -> DataFrame:
    """Pages to ARC, ARC to WARC, and the WARC archives read back."""
    spark = pages.sparkSession
    arc, out = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(pages, arc, version, html_col=html_col)
    write_warc(convert(spark, arc, min_bytes), out)
    return read_warc(spark, out)
