"""Web archives: write and read legacy ARC files, convert them to WARC, write and read WARC.

ARC. A file begins with a version block (``filedesc://``) whose second line
names the version and whose third line names the fields of every record's header
line; the header ends with the declared length of the content. Version 1 has
five fields, version 2 ten. Header lines are parsed by the field names of their
own file, from the right, as only the URL may hold spaces.

Conversion. Each ARC record becomes a WARC record with a synthesised identifier
(a UUID from its URL, date and content), ISO date, type and SHA-1 digests. Of
records with equal payloads of at least ``min_bytes`` bytes the one with the
largest page id stays a response, the others become revisits that name it.

Files are written by Spark's text sink (gzip; line separator = record
separator), so they commit like any Spark output and live in any store Spark can
write. Rows go to files where they are, without a shuffle: a task begins a new file
after so many records as hold about ``FILE_BYTES`` of payload (more in very large
archives, which would be millions of files). Files are read back whole, streamed
record by record.

A conversion parses the ARC files twice. The first pass only gives each record's
identity, length and digest; revisits are found among these slim rows. The second
pass reads a file together with the list of its revisits and writes WARC records at
once, so no payload is shuffled. Payloads are bytes throughout, in any encoding.

Defined cases: null html is an empty payload; a null URL is ``about:blank``;
white space and control characters in URLs are percent-encoded; page ids travel
in an HTTP header and a null id in none, a null id is smaller than any other and
rows that share the largest id are all responses; a damaged or cut record ends
its file with one row whose ``problem`` says where, and its file's records before it
are converted; an archive of one file has version 1 only; other columns are ignored;
empty input gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.session import scratch_path

from .storage import materialize, release

FILE_BYTES = 8 << 20
#: Beyond so many files they grow instead, up to MAX_FILE_BYTES.
MANY_FILES, MAX_FILE_BYTES = 100_000, 128 << 20
ARCHIVED_AT = "20240101000000"
ADDRESS = "0.0.0.0"
#: Rows of payload yielded at a time.
BATCH_BYTES = 4 << 20

# Field lines of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def safe_url(url: str | None) -> str:
    if not url:
        return "about:blank"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def http_head(payload_bytes: int, page_id: int | None) -> bytes:
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {payload_bytes}"]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    return "\r\n".join([*lines, "", ""]).encode()


def iso_date(stamp: str) -> str:
    """ISO form of an ARC date of 4 to 14 digits; missing parts are the first of their kind."""
    d = (stamp + "00000101000000"[len(stamp) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


# --- ARC ---------------------------------------------------------------------


def arc_version_block(version: int, name: str) -> str:
    body = f"{version} 0 Spark\n{ARC_FIELDS[version]}\n"
    if version == 1:
        return f"filedesc://{name} {ADDRESS} {ARCHIVED_AT} text/plain {len(body)}\n{body}"
    return f"filedesc://{name} {ADDRESS} {ARCHIVED_AT} text/plain 200 - - 0 {name} {len(body)}\n{body}"


def arc_record(version: int, name: str, offset: int, url: str | None, page_id: int | None, html: str | None) -> str:
    payload = (html or "").encode()
    content = http_head(len(payload), page_id) + payload
    head = f"{safe_url(url)} {ADDRESS} {ARCHIVED_AT} text/html"
    if version == 2:
        head += f" 200 {base32_sha1(content)} - {offset} {name}"
    return f"{head} {len(content)}\n{content.decode()}"


def records_per_file(pages: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """Records that hold about ``file_bytes`` of html."""
    total, n = pages.agg(F.sum(F.octet_length("html")), F.count(F.lit(1))).first()
    total = total or 0
    size = max(file_bytes, min(MAX_FILE_BYTES, total // MANY_FILES))
    return max(1, n * size // max(total, 1))


def write_arc(pages: DataFrame, path: str, records: int | None = None, level: str = "DEFAULT_COMPRESSION") -> str:
    """Pages (page_id, url, html) as gzipped ARC files of ``records`` records, versions 1 and 2 by turns.
    ``level`` is Hadoop's name of the gzip level."""
    records = records or records_per_file(pages)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            out, size = [], 0
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                if at % records == 0:  # the sink begins a file here
                    version = 1 + (part + at // records) % 2
                    name = f"part-{part:05d}-{at // records:05d}.arc"
                    out.append(arc_version_block(version, name))
                    offset = len(out[-1]) + 1
                out.append(arc_record(version, name, offset, url, page_id, html))
                offset += len(out[-1].encode()) + 1
                at += 1
                size += len(out[-1])
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out)], ["value"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out)], ["value"])

    slim = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    lines = slim.mapInArrow(emit, "value string")
    how = {"compression": "gzip", "zlib.compress.level": level, "lineSep": "\n", "maxRecordsPerFile": records + 1}
    lines.write.options(**how).text(path)
    return path


def arc_records(content: bytes) -> Iterator[dict]:
    """Records of one ARC file (plain or gzipped): the header's fields by name and the content."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    fields = ARC_FIELDS[1].split()
    number = 0
    try:
        while True:
            line = stream.readline()
            while line in (b"\n", b"\r\n"):
                line = stream.readline()
            if not line:
                return
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text.startswith("filedesc://"):
                length = int(text.rsplit(" ", 1)[1])
                lines = stream.read(length).decode("utf-8", "replace").splitlines()
                if len(lines) > 1:
                    fields = lines[1].split()
                continue
            number += 1
            values = text.rsplit(" ", len(fields) - 1)
            if len(values) != len(fields) or not values[-1].isdigit() or not re.fullmatch(r"\d{4,14}", values[2]):
                yield {"problem": f"record {number}: header line does not have the fields {' '.join(fields)}"}
                return
            length = int(values[-1])
            block = stream.read(length)
            if len(block) < length:
                yield {"problem": f"record {number}: {len(block)} of {length} declared bytes"}
                return
            yield dict(zip(fields, values)) | {"content": block, "version": 1 if len(fields) == 5 else 2}
    except (OSError, EOFError, ValueError) as error:
        yield {"problem": f"record {number + 1}: {error}"}


ARC_ROWS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("date", pa.string()),
        ("mime", pa.string()),
        ("arc_version", pa.int32()),
        ("warc_type", pa.string()),
        ("record_id", pa.string()),
        ("head", pa.binary()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("digest", pa.string()),
        ("problem", pa.string()),
    ]
)
ARC_DDL = (
    "page_id long, url string, date string, mime string, arc_version int, warc_type string, record_id string, "
    "head binary, payload binary, payload_bytes long, digest string, problem string"
)


def converted(record: dict) -> dict:
    """WARC identity of one ARC record."""
    if "problem" in record:
        return {"problem": record["problem"]}
    block, url = record["content"], record["URL"]
    head, payload, page_id, kind = b"", block, None, "resource"
    if block.startswith(b"HTTP/"):
        cut = block.find(b"\r\n\r\n")
        cut = len(block) if cut < 0 else cut + 4
        head, payload, kind = block[:cut], block[cut:], "response"
        if m := re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head):
            page_id = int(m[1])
    digest = base32_sha1(payload)
    name = f"{url} {record['Archive-date']} {page_id} {digest}"
    return {
        "page_id": page_id,
        "url": url,
        "date": iso_date(record["Archive-date"]),
        "mime": record["Content-type"],
        "arc_version": record["version"],
        "warc_type": kind,
        "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}",
        "head": head,
        "payload": payload,
        "payload_bytes": len(payload),
        "digest": digest,
    }


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def _read(files: DataFrame, parse, schema: pa.Schema, ddl: str) -> DataFrame:
    """Rows of ``parse(content)`` of every file, in batches of bounded size."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for row in parse(content.as_py()):
                    rows.append(row)
                    size += 200 + len(row.get("payload") or b"")
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return files.select("content").mapInArrow(emit, ddl)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """ARC files under ``path`` as rows ready to be WARC records."""
    return _read(_files(spark, path), lambda content: map(converted, arc_records(content)), ARC_ROWS, ARC_DDL)


# --- WARC --------------------------------------------------------------------


IDENTITIES = pa.schema(
    [
        ("path", pa.string()),
        ("number", pa.int64()),
        ("page_id", pa.int64()),
        ("record_id", pa.string()),
        ("payload_bytes", pa.int64()),
        ("digest", pa.string()),
    ]
)


def identities(files: DataFrame) -> DataFrame:
    """(path, number, page_id, record_id, payload_bytes, digest) of every sound response record, without payloads."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows = []
                for number, row in enumerate(map(converted, arc_records(content.as_py()))):
                    if "problem" not in row and row["warc_type"] == "response":
                        rows.append({"path": path, "number": number} | {c: row[c] for c in IDENTITIES.names[2:]})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, IDENTITIES)

    return files.mapInArrow(emit, "path string, number long, page_id long, record_id string, payload_bytes long, digest string")


def revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(path, number, refers_to, refers_to_id): the records whose payload is that of another page."""
    same = (
        records.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("digest")
        .agg(
            F.max("page_id").alias("refers_to"),
            F.max(F.struct(F.col("page_id").isNotNull(), "page_id", "record_id"))["record_id"].alias("refers_to_id"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter("n > 1")
        .drop("n")
    )
    return records.join(same, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select(
        "path", "number", "refers_to", "refers_to_id"
    )


def warc_record(row: dict) -> bytes:
    http = bool(row["head"])
    revisit = row["warc_type"] == "revisit"
    block = row["head"] if revisit else row["head"] + row["payload"]
    lines = ["WARC/1.0", f"WARC-Type: {row['warc_type']}", f"WARC-Record-ID: <{row['record_id']}>"]
    lines += [f"WARC-Date: {row['date']}", f"WARC-Target-URI: {row['url']}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{row['refers_to_id']}>"]
        lines.append(f"X-Refers-To-Page: {row['refers_to']}")
    lines.append("Content-Type: application/http; msgtype=response" if http else f"Content-Type: {row['mime']}")
    lines += [f"WARC-Payload-Digest: sha1:{row['digest']}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n"


WARCINFO = "software: Spark ARC converter\r\nformat: WARC File Format 1.0\r\n"


def warcinfo() -> bytes:
    info = {"warc_type": "warcinfo", "record_id": f"urn:uuid:{uuid.uuid4()}", "mime": "application/warc-fields"}
    info |= {"date": iso_date(ARCHIVED_AT), "url": "urn:warcinfo", "head": b"", "payload": WARCINFO.encode()}
    return warc_record(info | {"digest": base32_sha1(WARCINFO.encode())})


def convert(spark: SparkSession, arc_path: str, path: str, min_bytes: int = 0, records: int | None = None) -> str:
    """ARC files under ``arc_path`` as gzipped WARC files, each beginning with a warcinfo record and holding
    ``records`` records at most (all of a task's if None)."""
    files = _files(spark, arc_path)
    found = materialize(identities(files), "warc-identities")
    entry = F.struct("number", "refers_to", "refers_to_id")
    # at most the records of one file
    told = revisits(found, min_bytes).groupBy("path").agg(F.collect_list(entry).alias("revisits"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            for content, again in zip(batch.column("content"), batch.column("revisits").to_pylist()):
                refers = {r["number"]: r for r in again or ()}
                out, size = [], 0
                for number, row in enumerate(map(converted, arc_records(content.as_py()))):
                    if "problem" in row:
                        continue
                    if number in refers:
                        row |= refers[number] | {"warc_type": "revisit"}
                    if at == 0 or records and at % records == 0:  # the sink begins a file here
                        out.append(warcinfo())
                    out.append(warc_record(row))
                    at += 1
                    size += len(out[-1])
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    lines = files.join(told, "path", "left").select("content", "revisits").mapInArrow(emit, "value binary")
    writer = lines.select(F.col("value").cast("string")).write.options(compression="gzip", lineSep="\r\n")
    (writer.option("maxRecordsPerFile", records + 1) if records else writer).text(path)
    return path


def warc_records(content: bytes) -> Iterator[dict]:
    """Records of one WARC file: headers (lower-case names) and block."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    number = 0
    try:
        while True:
            line = stream.readline()
            while line in (b"\r\n", b"\n"):
                line = stream.readline()
            if not line:
                return
            number += 1
            if not line.startswith(b"WARC/"):
                yield {"problem": f"record {number}: no version line"}
                return
            headers = {}
            while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
                name, _, value = line.decode("utf-8", "replace").partition(":")
                headers[name.strip().lower()] = value.strip()
            length = int(headers["content-length"])
            block = stream.read(length)
            if len(block) < length:
                yield {"problem": f"record {number}: {len(block)} of {length} declared bytes"}
                return
            yield {"headers": headers, "block": block}
    except (OSError, EOFError, ValueError, KeyError) as error:
        yield {"problem": f"record {number + 1}: {error}"}


WARC_ROWS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("url", pa.string()),
        ("date", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("refers_to_id", pa.string()),
        ("problem", pa.string()),
    ]
)
WARC_DDL = (
    "page_id long, record_id string, record_type string, url string, date string, payload binary, payload_bytes long, "
    "payload_digest string, refers_to long, refers_to_id string, problem string"
)


def parsed(record: dict) -> dict | None:
    """One row per record but warcinfo; digests of responses are recomputed and compared."""
    if "problem" in record:
        return {"problem": record["problem"]}
    headers, block = record["headers"], record["block"]
    kind = headers.get("warc-type", "")
    if kind == "warcinfo":
        return None
    declared = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    page_id, payload = None, block
    if headers.get("content-type", "").startswith("application/http"):
        cut = block.find(b"\r\n\r\n") + 4
        head, payload = block[:cut], block[cut:]
        if m := re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head):
            page_id = int(m[1])
        length = re.search(rb"\r\nContent-Length: (\d+)\r\n", head)
    problem = None
    if kind == "revisit":
        size, payload = int(length[1]) if length else None, None
    else:
        size = len(payload)
        if base32_sha1(payload) != declared:
            problem = "payload digest differs"
    refers = headers.get("x-refers-to-page")
    return {
        "page_id": page_id,
        "record_id": headers.get("warc-record-id", "").strip("<>"),
        "record_type": kind,
        "url": headers.get("warc-target-uri"),
        "date": headers.get("warc-date"),
        "payload": payload,
        "payload_bytes": size,
        "payload_digest": declared,
        "refers_to": int(refers) if refers and refers != "None" else None,
        "refers_to_id": headers.get("warc-refers-to", "").strip("<>") or None,
        "problem": problem,
    }


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of WARC files; without ``payloads`` these are still checked, but not returned."""

    def parse(content: bytes) -> Iterator[dict]:
        for row in map(parsed, warc_records(content)):
            if row is not None:
                yield row if payloads else row | {"payload": None}

    return _read(_files(spark, path), parse, WARC_ROWS, WARC_DDL)


def archive(pages: DataFrame, min_bytes: int = 0, path: str | None = None, payloads: bool = True) -> DataFrame:
    """Pages -> ARC files -> WARC files under ``path`` -> rows of ``read_warc``.

    The ARC files and, without ``path``, the WARC files are below spark.checkpoint.dir."""
    spark = pages.sparkSession
    records = records_per_file(pages)
    # read once more and not kept, so the quickest level
    arc = write_arc(pages, scratch_path(spark, "arc") + "/files", records, "BEST_SPEED")
    path = path or scratch_path(spark, "warc") + "/files"
    convert(spark, arc, path, min_bytes, records)
    release(spark)
    return read_warc(spark, path, payloads)
