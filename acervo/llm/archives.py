"""Legacy archives to WARC: ARC version 1 and 2 records in, equivalent WARC records out, and readers of both.

Archives are text files written by Spark, one record after the other, so any file system Spark reaches will do.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.llm.common import arrow_pass, shared_folder, staged

# The field lists of the two published versions of the header line.
ARC_FIELDS = {
    1: ["url", "ip", "date", "type", "length"],
    2: ["url", "ip", "date", "type", "code", "checksum", "location", "offset", "file", "length"],
}
CRLF = b"\r\n"
FILE_RECORDS = 4_000
CLUE = "X-Archive-Page"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_records(records: DataFrame, folder: str, end: str) -> None:
    """Write one column of records where they lie, each ended by `end`, in files of a bounded number of records."""
    records.write.option("lineSep", end).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(folder)


def write_arc(pages: DataFrame, folder: str, version: int = 1, day: str = "20200101000000") -> None:
    """Pages (page_id, url, html) as ARC files of the given version.

    A URL's blanks and line ends are percent-encoded, and the colon after a leading "filedesc", which would make the record
    a file description; a null or empty one is "-"; the content is an HTTP response whose
    body is the html in UTF-8 (null: empty) and whose header carries the page id (null: no such header).
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n"),
        F.coalesce(F.concat(F.lit(f"{CLUE}: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("")), F.lit("\r\n"))
    content = F.concat(head, body)
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), " ", "%20"),
                                            "[\\r\\n]+", "%0A"), "\\t", "%09")
    url = F.regexp_replace(url, "^filedesc:", "filedesc%3A")
    fields = {"url": F.when(url == "", "-").otherwise(url), "ip": F.lit("0.0.0.0"), "date": F.lit(day),
              "type": F.lit("text/html"), "code": F.lit("200"), "checksum": F.lit("-"), "location": F.lit("-"),
              "offset": F.lit("0"), "file": F.lit("pages.arc"), "length": F.octet_length(content).cast("string")}
    line = F.concat_ws(" ", *[fields[f] for f in ARC_FIELDS[version]])
    records = pages.select(F.concat(line, F.lit("\n"), content).alias("value"))
    write_records(records, folder, "\n")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Whole files, each of a bounded number of records, one row each."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.col("content"))


def opened(raw: bytes) -> bytes:
    """Contents of a file of one or more gzip members, or of a plain one."""
    out = []
    while raw[:2] == b"\x1f\x8b":
        reader = zlib.decompressobj(31)
        out.append(reader.decompress(raw))
        raw = reader.unused_data
    return b"".join(out) if out else raw


def arc_records(raw: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header fields and content of each record; the version follows from the number of fields.

    Content ends where the declared length says, whatever it holds. A file description ("filedesc:") is no record.
    """
    at = 0
    while at < len(raw):
        if raw[at:at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = raw.index(b"\n", at)
        parts = raw[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        names = next((f for f in ARC_FIELDS.values() if len(f) == len(parts)), None)
        if names is None or not parts[-1].isdigit():
            raise ValueError(f"no ARC header line at {at}: {parts[:3]}")
        header = dict(zip(names, parts))
        size = int(header["length"])
        if end + 1 + size > len(raw):
            raise ValueError(f"ARC record at {at} is cut short")
        if not header["url"].startswith("filedesc:"):
            yield at, header, raw[end + 1:end + 1 + size]
        at = end + 1 + size


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP header block (with its blank line) and body; content that is no HTTP response is all body."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    at = content.find(CRLF * 2)
    return (content, b"") if at < 0 else (content[:at + 4], content[at + 4:])


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"^" + name.encode() + rb":[ \t]*([^\r\n]*)", head, re.I | re.M)
    return found.group(1).decode("utf-8", "replace") if found else None


def record_id(file: str, at: int) -> str:
    """Name-based, so a repeated read of the same archives gives the same identifiers."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{at}')}>"


def iso_date(date: str) -> str:
    """A 14-digit date as ISO 8601; a shorter one is filled up with the first month, day or hour."""
    day = (date + "00000101000000"[len(date):])[:14]
    return f"{day[:4]}-{day[4:6]}-{day[6:8]}T{day[8:10]}:{day[10:12]}:{day[12:14]}Z"


def read_arc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of ARC files without their contents: file, at, page_id, url, payload_bytes, payload_digest, record_id."""
    def run(batches) -> Iterator[dict[str, list]]:
        names = "file at page_id url payload_bytes payload_digest record_id".split()
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for at, header, body in arc_records(opened(content.as_buffer().to_pybytes())):
                    http, payload = split_http(body)
                    page = http_field(http, CLUE)
                    rows.append((file, at, None if page is None else int(page), header["url"], len(payload), digest32(payload),
                                 record_id(file, at)))
                if rows:
                    yield dict(zip(names, map(list, zip(*rows))))

    return arrow_pass(_files(spark, folder), run, "file string, at bigint, page_id bigint, url string, payload_bytes bigint, "
                      "payload_digest string, record_id string", rows=1)


def with_types(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds record_type and refers_to (page) with refers_id (record).

    Of records with equal payloads of at least `least_bytes`, the one with the smallest page_id (null ids last; then
    file and offset, so of rows that repeat one only) is the response, the others revisit it; smaller ones are responses.
    """
    order = F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("file"), F.col("at"))
    first = records.groupBy(F.col("payload_digest").alias("_d"), F.col("payload_bytes").alias("_b")).agg(
        F.min(F.struct(order.alias("o"), F.col("record_id").alias("id"))).alias("_first"))
    joined = records.join(first, (F.col("payload_digest") == F.col("_d")) & (F.col("payload_bytes") == F.col("_b")))
    again = (F.col("payload_bytes") >= least_bytes) & (F.col("record_id") != F.col("_first.id"))
    return joined.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(again, F.col("_first.o.page_id"))).withColumn(
        "refers_id", F.when(again, F.col("_first.id"))).drop("_d", "_b", "_first")


def warc_record(header: dict[str, str], body: bytes, name: str, kind: str, to_id: str | None, to_page: int | None) -> bytes:
    """An ARC record's equivalent: a response carries HTTP header and payload, a revisit the HTTP header alone."""
    http, payload = split_http(body)
    block = http if kind == "revisit" else body
    lines = [b"WARC/1.1", f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: {name}".encode(),
             f"WARC-Date: {iso_date(header['date'])}".encode(), f"WARC-Target-URI: {header['url']}".encode(),
             f"WARC-Payload-Digest: sha1:{digest32(payload)}".encode(), f"WARC-Identified-Payload-Type: {header['type']}".encode()]
    if header["ip"] != "0.0.0.0":
        lines.append(f"WARC-IP-Address: {header['ip']}".encode())
    if kind == "revisit":
        lines += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {to_id}".encode()]
        lines += [] if to_page is None else [f"WARC-Refers-To-Page: {to_page}".encode()]
    lines += [b"Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}".encode(), b"", b""]
    return CRLF.join(lines) + block


def write_warc(arc_folder: str, types: DataFrame, folder: str) -> None:
    """WARC 1.1 files of ARC files; `types` says for each record (file, at) its record_type, refers_id and refers_to.

    The types of a file's records meet the file as it is, compressed; contents are never shuffled record by record.
    Spark's text writer takes UTF-8 only, so a record that is not is an error.
    """
    spark = types.sparkSession
    by_file = types.groupBy(F.col("file").alias("_file")).agg(F.collect_list(F.struct("at", "record_type", "refers_id", "refers_to")).alias("said"))
    held = _files(spark, arc_folder).join(by_file, F.col("file") == F.col("_file")).select("file", "content", "said")

    def run(batches) -> Iterator[dict[str, list]]:
        for batch in batches:
            said = {s["at"]: s for s in batch.column(2).to_pylist()[0]}
            file, content = batch.column(0)[0].as_py(), batch.column(1)[0].as_buffer().to_pybytes()
            yield {"value": [
                warc_record(header, body, record_id(file, at), said[at]["record_type"], said[at]["refers_id"], said[at]["refers_to"]).decode()
                for at, header, body in arc_records(opened(content))]}

    write_records(arrow_pass(held, run, "value string", rows=1), folder, "\r\n\r\n")


def warc_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-cased names) and block of each record, by declared length."""
    at = 0
    while at < len(raw):
        end = raw.index(CRLF * 2, at)
        lines = raw[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        header = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = end + 4
        stop = start + int(header["content-length"])
        if stop > len(raw):
            raise ValueError(f"WARC record at {at} is cut short")
        yield header, raw[start:stop]
        at = stop + 4


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of WARC files: page_id, record_type, payload_bytes, payload_digest (checked where the payload is there), refers_to."""
    def run(batches) -> Iterator[dict[str, list]]:
        names = "page_id url record_type payload_bytes payload_digest refers_to".split()
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for header, block in warc_records(opened(content.as_buffer().to_pybytes())):
                    http, payload = split_http(block)
                    said = header["warc-payload-digest"].partition(":")[2]
                    if header["warc-type"] == "response":
                        size, found = len(payload), digest32(payload)
                        if found != said:
                            raise ValueError(f"payload of {header['warc-record-id']} does not match its digest")
                    else:
                        size, found = int(http_field(http, "Content-Length") or 0), said
                    page, to = http_field(http, CLUE), header.get("warc-refers-to-page")
                    rows.append((None if page is None else int(page), header.get("warc-target-uri"), header["warc-type"],
                                 size, found, None if to is None else int(to)))
                if rows:
                    yield dict(zip(names, map(list, zip(*rows))))

    return arrow_pass(_files(spark, folder).select("content"), run, "page_id bigint, url string, record_type string, "
                      "payload_bytes bigint, payload_digest string, refers_to bigint", rows=1)


def converted(pages: DataFrame, version: int = 1, least_bytes: int = 0) -> DataFrame:
    """Pages to ARC files, those to WARC files, and the WARC files read back.

    Files of at most 4000 records each lie in the shared folder. An empty table gives no record. Further columns of `pages`
    play no part.
    """
    spark = pages.sparkSession
    arc, warc = shared_folder(spark, "arc"), shared_folder(spark, "warc")
    write_arc(pages.select("page_id", "url", "html"), arc, version)
    types = with_types(staged(read_arc(spark, arc), "arc-records"), least_bytes)
    write_warc(arc, types.select("file", "at", "record_type", "refers_id", "refers_to"), warc)
    return read_warc(spark, warc)
