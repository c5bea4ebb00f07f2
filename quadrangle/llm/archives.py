"""Legacy web archives: writing ARC files, and converting them to WARC.

Spark's own text writer makes the files (gzip), so every executor writes to the
shared folder and a lost task is written again. A written row is a segment: some
megabytes of records behind a header record of its own. The converter reads
each file's version block, takes the names of the header fields from it, and
goes from record to record by declared lengths; what stands between is never
searched for marks. It then makes up what WARC wants and ARC lacks: record ids
(from file and position), ISO timestamps, record types and digests. Of equal
payloads one record is the response; the others become revisits without payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrangle.llm.common import lean, materialize, shared_dir

#: Fixed values of the format: the header fields of ARC versions 1 and 2, in order.
ARC_FIELDS = {
    "1": ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    "2": ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
SEGMENT_BYTES, SEGMENTS_PER_FILE = 8_000_000, 4
ARC_RECORD = "record_id string, page_id long, uri string, ip string, date string, mime string, head string, payload string, digest string, size long"
WARC_RECORD = "record_id string, type string, page_id long, uri string, date string, digest string, size long, refers_to_record string, payload string"


def _target(url: str | None) -> str:
    return quote(url, safe="%/:=&?~#+!$,;'@()*[]|^`{}<>\"\\") if url else "unknown:"


def _arc_segments(version: str | None, date: str):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, parts = 0, 0, []

        def whole() -> pa.RecordBatch:
            v = version or "12"[number % 2]
            body = f"{v} 0 quadrangle\n{' '.join(ARC_FIELDS[v])}\n"
            fill = " 200 - - 0 segment" if v == "2" else ""
            head = f"filedesc://segment-{number}.arc 0.0.0.0 {date} text/plain{fill} {len(body)}\n{body}"
            lines = [f"{uri} 0.0.0.0 {date} text/html{' 200 - - 0 segment' if v == '2' else ''} {n}\n{block}" for uri, n, block in parts]
            return pa.RecordBatch.from_arrays([pa.array(["\n".join([head, *lines])])], names=["value"])

        for batch in batches:
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = len((html or "").encode())
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {n}\r\n" + (f"X-Page-Id: {page}\r\n" if page is not None else "") + "\r\n"
                parts.append((_target(url), len(head) + n, head + (html or "")))
                size += n + 500
                if size >= SEGMENT_BYTES:
                    yield whole()
                    number, size, parts = number + 1, 0, []
        if parts:
            yield whole()

    return build


def _inflated(data: bytes) -> bytes:
    """One or many gzip members, or plain bytes."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join(out) + data


def parse_arc(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(position, header fields, content) of each record, by the version block that stands before it."""
    at, fields = 0, None
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.index(b"\n", at)
        line = data[at:end].decode().rstrip("\r")
        length = int(line.rsplit(" ", 1)[1])
        content, start = data[end + 1 : end + 1 + length], at
        if len(content) < length:
            raise ValueError(f"record at {at} is cut off")
        at = end + 1 + length
        if line.startswith("filedesc:"):
            lines = content.decode().split("\n")
            version = lines[0].split(" ")[0]
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version}")
            fields = lines[1].split() if len(lines) > 1 and lines[1].strip() else ARC_FIELDS[version]
            continue
        if fields is None:
            raise ValueError("no version block")
        # The URL has no spaces; a content type may: what comes after it is counted from the right.
        mime = fields.index("Content-type")
        left, right = line.split(" ", mime), fields[mime + 1 :]
        rest = left[-1].rsplit(" ", len(right))
        yield start, dict(zip(fields, [*left[:-1], *rest], strict=True)), content


def parse_http(block: bytes) -> tuple[bytes, bytes]:
    """Head with its blank line, and payload, of an HTTP response; other blocks are all payload."""
    if block.startswith(b"HTTP/"):
        cut = re.search(rb"\r?\n\r?\n", block)
        if cut:
            return block[: cut.end()], block[cut.end() :]
    return b"", block


def _page_of(head: bytes) -> int | None:
    found = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head)
    return int(found[1]) if found else None


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], weight) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row) + 200
        if size >= SEGMENT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)


def _kinds(schema: str) -> tuple[list[str], list[pa.DataType]]:
    pairs = [x.split() for x in schema.split(", ")]
    return [n for n, _ in pairs], [{"string": pa.string(), "long": pa.int64()}[k] for _, k in pairs]


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            yield path.as_py(), _inflated(content.as_py())


def _arc_rows(payloads: bool):
    names, kinds = _kinds(ARC_RECORD)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for path, data in _files(batches):
            for at, header, content in parse_arc(data):
                head, payload = parse_http(content)
                name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{at}')}>"
                text = payload.decode("utf-8", "replace") if payloads else None
                yield name, _page_of(head), header["URL"], header["IP-address"], header["Archive-date"], header["Content-type"], head.decode("latin-1"), text, hashlib.sha1(payload).hexdigest(), len(payload)

    return lambda batches: _batches(rows(batches), names, kinds, lambda r: len(r[7] or ""))


def _warc_segments(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def record(fields: list[tuple[str, str | None]], block: str) -> str:
        lines = [f"{k}: {v}" for k, v in [*fields, ("Content-Length", str(len(block.encode())))] if v is not None]
        return "WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n" + block

    def sha(hexed: str) -> str:
        return "sha1:" + base64.b32encode(bytes.fromhex(hexed)).decode()

    parts, size = [], 0
    info = "software: quadrangle\r\nformat: WARC File Format 1.1\r\n"
    for batch in frames:
        for r in batch.to_pylist():
            d = r["date"]
            date = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
            if not parts:
                name = uuid.uuid5(uuid.NAMESPACE_URL, r["record_id"] + "#info")
                parts.append(record([("WARC-Type", "warcinfo"), ("WARC-Date", date), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("Content-Type", "application/warc-fields")], info))
            http = r["head"] != ""
            again = r["refers_to_record"] is not None
            block = r["head"] + ("" if again else r["payload"])
            fields = [
                ("WARC-Type", "revisit" if again else "response" if http else "resource"),
                ("WARC-Target-URI", r["uri"]),
                ("WARC-Date", date),
                ("WARC-Record-ID", r["record_id"]),
                ("WARC-IP-Address", r["ip"]),
                ("WARC-Refers-To", r["refers_to_record"]),
                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if again else None),
                ("WARC-Payload-Digest", sha(r["digest"])),
                ("WARC-Block-Digest", sha(hashlib.sha1(block.encode()).hexdigest())),
                ("Content-Type", "application/http; msgtype=response" if http else r["mime"]),
            ]
            parts.append(record(fields, block))
            size += len(parts[-1])
            if size >= SEGMENT_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(["\r\n\r\n".join(parts)])], names=["value"])
                parts, size = [], 0
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(["\r\n\r\n".join(parts)])], names=["value"])


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record, by declared lengths."""
    at = 0
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        fields = dict(x.split(": ", 1) for x in lines)
        length = int(fields["Content-Length"])
        block = data[end + 4 : end + 4 + length]
        if len(block) < length:
            raise ValueError(f"record at {at} is cut off")
        yield fields, block
        at = end + 4 + length


def _warc_rows(payloads: bool):
    names, kinds = _kinds(WARC_RECORD)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, data in _files(batches):
            for f, block in parse_warc(data):
                if f["WARC-Type"] == "warcinfo":
                    continue
                head, payload = parse_http(block)
                declared = base64.b32decode(f["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                again = f["WARC-Type"] == "revisit"
                if not again and declared != hashlib.sha1(payload).hexdigest():
                    raise ValueError(f"digest of {f['WARC-Record-ID']} does not match")
                text = payload.decode("utf-8", "replace") if payloads and not again else None
                yield f["WARC-Record-ID"], f["WARC-Type"], _page_of(head), f["WARC-Target-URI"], f["WARC-Date"], declared, None if again else len(payload), f.get("WARC-Refers-To"), text

    return lambda batches: _batches(rows(batches), names, kinds, lambda r: len(r[8] or ""))


def _binary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def write_arc(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", version: str | None = None, date: str = "20000101000000") -> None:
    """Write pages as ARC files of this version (None: segments of either in turn). Null html is an empty payload; null urls are "unknown:"."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    rows.mapInArrow(lean(_arc_segments(version, date)), "value string").write.option("maxRecordsPerFile", SEGMENTS_PER_FILE).option("compression", "gzip").text(path)


def read_arc(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """Rows of ARC_RECORD of all ARC files at path."""
    return _binary(spark, path).mapInArrow(lean(_arc_rows(payloads)), ARC_RECORD)


def convert_arc(spark: SparkSession, arc: str, warc: str, *, revisit_bytes: int = 1000) -> None:
    """Write the records of ARC files as WARC files.

    Of records with equal payloads of at least revisit_bytes, that with the
    largest page id (null: smallest; then by record id) is the response, the
    others revisit it.
    """
    index = materialize(read_arc(spark, arc, payloads=False).select("record_id", "page_id", "digest", "size"), "arc-index")
    large = index.where(F.col("size") >= revisit_bytes)
    groups = large.groupBy("digest", "size").agg(F.max(F.struct("page_id", "record_id")).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = large.join(groups, ["digest", "size"]).where("record_id <> first.record_id").select("record_id", F.col("first.record_id").alias("refers_to_record"))
    records = read_arc(spark, arc).join(again, "record_id", "left")
    records.mapInArrow(lean(_warc_segments), "value string").write.option("maxRecordsPerFile", SEGMENTS_PER_FILE).option("compression", "gzip").option("lineSep", "\r\n\r\n").text(warc)


def read_warc(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """Rows of WARC_RECORD of all WARC files at path; digests of payloads are checked, revisits have neither size nor payload."""
    return _binary(spark, path).mapInArrow(lean(_warc_rows(payloads)), WARC_RECORD)


def archive_round_trip(pages: DataFrame, **parameters) -> DataFrame:
    """Pages to ARC to WARC and back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    One row per page. A revisit's length and the page it refers to come from the
    response that its WARC-Refers-To names.
    """
    spark = pages.sparkSession
    base = f"{shared_dir(spark)}/quadrangle/archives-{uuid.uuid4().hex}"
    write_arc(pages, f"{base}/arc", **parameters)
    convert_arc(spark, f"{base}/arc", f"{base}/warc")
    found = materialize(read_warc(spark, f"{base}/warc", payloads=False).drop("payload"), "warc-index")
    first, again = found.where("type <> 'revisit'"), found.where("type = 'revisit'")
    # Only the few responses that are referred to; a large group of revisits is a skewed equi-join, which Spark splits.
    of = first.select(F.col("record_id").alias("refers_to_record"), F.col("size").alias("of_size"), F.col("page_id").alias("of_page"))
    revisits = again.drop("size").join(of, "refers_to_record").select("page_id", F.col("of_size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), F.col("of_page").alias("refers_to"))
    responses = first.select("page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    return responses.unionByName(revisits)
