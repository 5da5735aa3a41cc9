"""Legacy ARC archives to WARC, and both formats' readers and writers.

An ARC file starts with a version block that names the header fields of its records: five in
version 1, ten in version 2.  A record is a header line and as many bytes as it declares.  The
converter turns each into a WARC record with an identifier, a date, a type and digests; of
records with equal payloads one is the response and the others revisit it.

Archives are files of some megabytes, a row of bytes each while they are read, so a task's
memory does not depend on how many records there are.  What is said about equal payloads
crosses the network once per file and payload, however often the payload occurs there.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.storage import materialise, new_folder
from eventloom.llm.base import ship_package

#: Bytes of records after which an archive is closed.
ARCHIVE_BYTES = 8 << 20
#: Payloads of fewer bytes are never revisited.
LEAST_BYTES = 0

# Header fields of the two ARC versions and of WARC.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL",
        "IP-address",
        "Archive-date",
        "Content-type",
        "Result-code",
        "Checksum",
        "Location",
        "Offset",
        "Filename",
        "Archive-length",
    ),
}
WARC_VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

_FIRST_FETCH = datetime(2001, 1, 1, tzinfo=UTC)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_word(text: str | None) -> str:
    """A header value without blanks or control characters, which are percent-encoded."""
    safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text or "")
    return safe or "-"


# --- Files of whole records ---------------------------------------------------------


def _write_files(archives: DataFrame, folder: str, end: str) -> None:
    """Each row's bytes, followed by ``end``, become one gzip file."""
    archives.select(F.col("archive").cast("string")).write.option("lineSep", end).option("compression", "gzip").option(
        "maxRecordsPerFile", 1
    ).text(folder)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """``name, content`` of the archives of a folder, as they lie on disk."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def _archives(
    items: Iterable, opening: Callable[[int], bytes], record: Callable[[int, object], bytes], end: bytes
) -> Iterator[pa.RecordBatch]:
    """Archives of about ``ARCHIVE_BYTES``: an opening and one record an item, given the
    archive's number.  The last ``end`` is left to the writer."""
    held, size, number = [], 0, 0
    for item in items:
        held = held or [opening(number)]
        held.append(record(number, item))
        size += len(held[-1])
        if size >= ARCHIVE_BYTES:
            yield _row(held, end)
            held, size, number = [], 0, number + 1
    if held:
        yield _row(held, end)


def _row(parts: list[bytes], end: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(parts).removesuffix(end)], pa.binary())})


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time as Python values, so that a batch is never held twice."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


# --- ARC ----------------------------------------------------------------------------


def arc_opening(version: int, name: str) -> bytes:
    """The version block: its own header line, the version, and the names of the fields."""
    body = f"{version} 0 eventloom\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    head = [f"filedesc://{name}.arc", "0.0.0.0", f"{_FIRST_FETCH:%Y%m%d%H%M%S}", "text/plain"]
    if version == 2:
        head += ["200", "-", "-", "0", f"{name}.arc"]
    return " ".join([*head, str(len(body))]).encode() + b"\n" + body + b"\n"


def arc_record(version: int, name: str, url: str | None, date: datetime, block: bytes) -> bytes:
    head = [_one_word(url), "0.0.0.0", f"{date:%Y%m%d%H%M%S}", "text/html"]
    if version == 2:
        head += ["200", hashlib.md5(block).hexdigest(), "-", "0", f"{name}.arc"]
    return " ".join([*head, str(len(block))]).encode() + b"\n" + block + b"\n"


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record but the version block.

    The version block's second line says which version it is; its third line names the
    fields, which must be those of the version.  A task without rows leaves an empty file.
    """
    if not data:
        return
    line, at = _line(data, 0)
    length = int(line.rsplit(" ", 1)[1])
    said = data[at : at + length].decode().split("\n")
    version = int(said[0].split(" ")[0])
    fields = tuple(said[1].split(" "))
    if not line.startswith("filedesc://") or ARC_FIELDS.get(version) != fields:
        raise ValueError(f"not a version block of a known ARC version: {line!r}, {said[:2]}")
    at += length + 1
    while at < len(data):
        line, at = _line(data, at)
        values = line.rsplit(" ", len(fields) - 1)  # a legacy URL may hold blanks
        if len(values) != len(fields):
            raise ValueError(f"{len(values)} header fields instead of {len(fields)}: {line!r}")
        head = dict(zip(fields, values, strict=True))
        length = int(head["Archive-length"])
        block = data[at : at + length]
        if len(block) != length or data[at + length : at + length + 1] != b"\n":
            raise ValueError(f"the record is not as long as declared: {line!r}")
        yield head, block
        at += length + 1


def _line(data: bytes, at: int) -> tuple[str, int]:
    end = data.index(b"\n", at)
    return data[at:end].decode(), end + 1


def http_block(page_id: int | None, payload: bytes) -> bytes:
    """What the server sent: status line, header fields and the payload.  The page's id is
    kept in a field of its own."""
    page = "" if page_id is None else str(page_id)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\nX-Page-Id: {page}"
    return head.encode() + END + payload


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Header fields up to and with the empty line, and the payload."""
    at = block.index(END) + len(END)
    return block[:at], block[at:]


def page_of(http_head: bytes) -> int | None:
    found = re.search(rb"(?m)^X-Page-Id: (-?\d+)\r$", http_head)
    return int(found[1]) if found else None


def write_arcs(pages: DataFrame, folder: str) -> None:
    """ARC archives of ``page_id, url, html``; a task's archives alternate between the two
    versions.  Pages have no date, so the date follows from the id."""

    def archives(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()

        def named(number: int) -> tuple[int, str]:
            return 1 + (task + number) % 2, f"pages-{task}-{number}"

        def record(number: int, row: dict) -> bytes:
            date = _FIRST_FETCH + timedelta(seconds=(row["page_id"] or 0) % (20 * 365 * 86_400))
            block = http_block(row["page_id"], (row["html"] or "").encode())
            return arc_record(*named(number), row["url"], date, block)

        yield from _archives(_rows(batches), lambda number: arc_opening(*named(number)), record, b"\n")

    ship_package(pages.sparkSession)
    columns = [F.col(c).cast(kind).alias(c) for c, kind in (("page_id", "long"), ("url", "string"), ("html", "string"))]
    _write_files(pages.select(*columns).mapInArrow(archives, "archive binary"), folder, "\n")


# --- ARC to WARC --------------------------------------------------------------------


@dataclass(frozen=True)
class Converted:
    """An ARC record with what WARC wants to know of it."""

    place: int
    head: dict[str, str]
    http: bytes
    payload: bytes

    @property
    def date(self) -> str:
        return f"{datetime.strptime(self.head['Archive-date'], '%Y%m%d%H%M%S'):%Y-%m-%dT%H:%M:%SZ}"

    def identifier(self, name: str) -> str:
        """The same whenever the same archive is converted."""
        seed = f"{name} {self.place} {' '.join(self.head.values())}"
        return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(seed.encode()).digest()[:16], version=5)}>"


def _converted(content: bytes) -> Iterator[Converted]:
    for place, (head, block) in enumerate(parse_arc(gzip.decompress(content))):
        yield Converted(place, head, *split_http(block))


def _payloads(files: DataFrame, least: int) -> DataFrame:
    """One row per archive and payload: how often it is there, and its first record.

    Records go by page_id, nulls last, then by archive and place.
    """

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            seen: dict[str, list] = {}
            for record in _converted(row["content"]):
                if len(record.payload) < least:
                    continue
                page = page_of(record.http)
                new = (page is None, page or 0, record.place, record.identifier(row["name"]), record.head["URL"], record.date)
                held = seen.setdefault(payload_digest(record.payload), [0, new])
                held[0] += 1
                held[1] = min(held[1], new)
            rows = [
                {"name": row["name"], "digest": d, "n": n, "no_id": no_id, "page_id": None if no_id else page}
                | {"place": place, "record_id": record_id, "url": url, "date": date}
                for d, (n, (no_id, page, place, record_id, url, date)) in seen.items()
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=_PAYLOADS)

    return files.mapInArrow(
        found, "name string, digest string, n long, no_id boolean, page_id long, place int, record_id string, url string, date string"
    )


_PAYLOADS = pa.schema(
    [("name", pa.string()), ("digest", pa.string()), ("n", pa.int64()), ("no_id", pa.bool_()), ("page_id", pa.int64())]
    + [("place", pa.int32()), ("record_id", pa.string()), ("url", pa.string()), ("date", pa.string())]
)


def warc_record(fields: dict[str, object], block: bytes) -> bytes:
    """Fields without a value are left out; block digest and length are added."""
    lines = [WARC_VERSION.decode(), *[f"{k}: {v}" for k, v in fields.items() if v is not None]]
    lines += [f"WARC-Block-Digest: sha1:{payload_digest(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def _as_warc(name: str, record: Converted, first: dict | None) -> bytes:
    """A response, or a revisit of ``first`` that holds the header fields only."""
    fields = {
        "WARC-Record-ID": record.identifier(name),
        "WARC-Date": record.date,
        "WARC-Target-URI": None if record.head["URL"] == "-" else record.head["URL"],
        "WARC-IP-Address": record.head["IP-address"],
        "WARC-Payload-Digest": f"sha1:{payload_digest(record.payload)}",
        "X-Payload-Length": len(record.payload),
    }
    if first is None or (first["name"], first["place"]) == (name, record.place):
        fields = {"WARC-Type": "response"} | fields | {"Content-Type": "application/http; msgtype=response"}
        return warc_record(fields, record.http + record.payload)
    fields = {"WARC-Type": "revisit"} | fields
    fields |= {
        "WARC-Profile": REVISIT_PROFILE,
        "WARC-Refers-To": first["record_id"],
        "WARC-Refers-To-Target-URI": None if first["url"] == "-" else first["url"],
        "WARC-Refers-To-Date": first["date"],
        "X-Refers-To-Page-Id": first["page_id"],
        "Content-Type": "application/http; msgtype=response",
    }
    return warc_record(fields, record.http)


def convert(spark: SparkSession, arcs: str, warcs: str, least: int = LEAST_BYTES) -> None:
    """WARC archives in the folder ``warcs`` of the ARC archives in ``arcs``, one for each.

    Of records with equal payloads of at least ``least`` bytes, the one with the smallest
    page_id is the response (nulls last, equal ones by archive and place), the others
    revisit it.  Shorter payloads are all responses.  An empty folder gives no archive.
    """

    def archives(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            name, firsts = row["name"], {f["digest"]: f["first"] for f in row["firsts"] or ()}
            info = {
                "WARC-Type": "warcinfo",
                "WARC-Record-ID": f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(name.encode()).digest()[:16], version=5)}>",
                "WARC-Date": f"{_FIRST_FETCH:%Y-%m-%dT%H:%M:%SZ}",
                "WARC-Filename": name,
                "Content-Type": "application/warc-fields",
            }
            parts = [warc_record(info, b"software: eventloom\r\nformat: WARC File Format 1.1\r\n")]
            for record in _converted(row["content"]):
                parts.append(_as_warc(name, record, firsts.get(payload_digest(record.payload)) if firsts else None))
            yield _row(parts, END)

    ship_package(spark)
    files = read_files(spark, arcs)
    payloads = materialise(_payloads(files, least), "payloads")
    ordered = F.struct("no_id", "page_id", "name", "place", "record_id", "url", "date")
    shared = payloads.groupBy("digest").agg(F.min(ordered).alias("first"), F.sum("n").alias("all")).where("all > 1")
    said = payloads.join(shared, "digest").groupBy("name").agg(F.collect_list(F.struct("digest", "first")).alias("firsts"))
    _write_files(files.join(said, "name", "left").mapInArrow(archives, "archive binary"), warcs, END.decode())


# --- WARC ---------------------------------------------------------------------------


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of every record, by the lengths they declare."""
    at = 0
    while at < len(data):
        end = data.index(END, at)
        version, *lines = data[at:end].split(b"\r\n")
        if version != WARC_VERSION:
            raise ValueError(f"not a WARC record: {version[:80]!r}")
        head = dict(line.decode().split(": ", 1) for line in lines)
        start = end + len(END)
        stop = start + int(head["Content-Length"])
        if data[stop : stop + len(END)] != END:
            raise ValueError(f"the record is not as long as declared: {head.get('WARC-Record-ID')}")
        yield head, data[start:stop]
        at = stop + len(END)


def _checked(head: dict[str, str], block: bytes) -> dict:
    """A record's row; digests and lengths are computed anew where the bytes are there."""
    if head["WARC-Block-Digest"] != f"sha1:{payload_digest(block)}":
        raise ValueError(f"block digest of {head['WARC-Record-ID']}")
    kind, digest, size = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"])
    http, payload = split_http(block)
    if kind == "response" and (digest, size) != (payload_digest(payload), len(payload)):
        raise ValueError(f"payload of {head['WARC-Record-ID']}")
    page = head.get("X-Refers-To-Page-Id")
    return {
        "page_id": page_of(http),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": None if page is None else int(page),
        "record_id": head["WARC-Record-ID"],
        "refers_to_id": head.get("WARC-Refers-To"),
        "target_uri": head.get("WARC-Target-URI"),
        "warc_date": head["WARC-Date"],
    }


_RECORDS = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string())]
    + [("refers_to", pa.int64()), ("record_id", pa.string()), ("refers_to_id", pa.string()), ("target_uri", pa.string())]
    + [("warc_date", pa.string())]
)


def read_warcs(spark: SparkSession, folder: str) -> DataFrame:
    """One row per response or revisit of the archives in ``folder``."""

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            found = parse_warc(gzip.decompress(row["content"]))
            rows = [_checked(head, block) for head, block in found if head["WARC-Type"] != "warcinfo"]
            yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)

    ship_package(spark)
    return read_files(spark, folder).mapInArrow(
        records,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "record_id string, refers_to_id string, target_uri string, warc_date string",
    )


def archive_pages(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Pages written as ARC archives, converted to WARC, and read back, a row per page.

    A null html is an empty payload, a null url no target, a null page_id none; blanks and
    control characters of a url are percent-encoded.  Repeated rows keep a record each: one
    is the response, the others revisit their own page_id; a response without a page_id is
    referred to by null.  An empty table gives an empty result; further columns are ignored.
    """
    spark = pages.sparkSession
    arcs, warcs = new_folder(spark, "arc"), new_folder(spark, "warc")
    write_arcs(pages, arcs)
    convert(spark, arcs, warcs, least)
    return read_warcs(spark, warcs)


def op11_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), ranked AS (
  SELECT *, row_number() OVER w AS place, first_value(page_id) OVER w AS first
  FROM hashed WINDOW w AS (PARTITION BY payload ORDER BY page_id NULLS LAST)
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((CAST('0x' || substr(hex, i // 4 * 5 + 1, 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN place = 1 OR strlen(payload) < {LEAST_BYTES} THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 AND strlen(payload) >= {LEAST_BYTES} THEN first END AS refers_to
FROM ranked
"""
