"""WARC archives from legacy ARC archives.

``to_arc`` writes pages as ARC files of version 1 or 2. ``parse_arc`` reads ARC files by the field line
of their version block and the declared lengths. ``convert`` turns the records into WARC: it makes
record identifiers, ISO timestamps, record types and SHA-256 digests that say what the ARC lines said,
and writes a payload that several records share once, as a response that the others revisit.
``read`` parses WARC files. An archive is a row with a binary column, so Spark commits and repeats it
like any other output; each record is a gzip member of its own, so readers can jump to it.

Payloads of at least LEAST bytes are shared; the response is the record with the smallest id. All that
is grouped by digest is (id, digest). Where the list of revisits is too large to broadcast, records move
once, by id and already in their final form, so copies of one page don't meet in one task.

Any ARC file can be converted: HTTP heads with or without Content-Length and with either line end,
``dns:`` records (responses of type text/dns), and records of other schemes (resources). Records that
``to_arc`` didn't write have no page id and are never revisits.

Defined cases: a null payload is empty; repeated rows of one id and payload are all responses if the id
is the smallest, or else all revisits; a row without id is always a response; a null address becomes
``urn:none`` and white space in an address is percent-encoded; a null archive has no records; what is
damaged (a gzip member, a record cut off or without a length, a file whose field line is of no known version, a record
that isn't what its digests say) is left out, told by ``rejects`` with its place and reason, and the rest is read; with
``strict``, as ``archive`` reads what it wrote itself, it is an error; other columns aren't stored.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from typing import Iterator
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.skew import cut, join_hot, shared_folder

LEAST = 100
#: Bytes of one archive (of payloads, or of compressed records), and the time that records carry (the pages have none).
ARCHIVE_BYTES = 4 << 20
CAPTURED = "20240101000000"
#: Field lines of the two versions of ARC.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARCHIVES = "archive: string, content: binary"
_ARCHIVES = pa.schema([("archive", pa.string()), ("content", pa.binary())])
FOUND = "page_id: bigint, payload_bytes: bigint, payload_digest: string, record_type: string, refers_to: bigint"
_FOUND = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
_ID_HEADER = b"X-Page-Id"
#: A revisit's payload has this many bytes.
_SIZE_HEADER = "X-Payload-Bytes"
_PART = 1 << 13
_GZIP = b"\x1f\x8b\x08"
#: A line that looks like a record's: address, host, time, more fields and a length.
_ARC_LINE = re.compile(rb"\n(?=[A-Za-z][A-Za-z0-9+.-]{0,30}:[^\n]{1,2000}? [0-9A-Fa-f.:]{1,45} \d{8,14} [^\n]{1,300} \d{1,12}\r?\n)")
_REJECTS = pa.schema([("archive", pa.string()), ("place", pa.int64()), ("reason", pa.string())])


def member(data: bytes) -> bytes:
    return gzip.compress(data, 4, mtime=0)


#: What can't be read of an archive: (where it begins, reason). A reader without such a list raises ValueError instead.
Rejects = list[tuple[int, str]]


def content_of(archive: bytes | None, rejects: Rejects | None = None) -> bytes:
    """Uncompressed content of an archive of gzip members, or of one that isn't compressed.

    Members are read from short parts of the archive, so that what follows a member is never copied as a whole. A
    damaged member is left out; reading goes on where the next one begins.
    """
    if not archive or not archive.startswith(_GZIP):
        return archive or b""
    out, at, view = [], 0, memoryview(archive)
    while at < len(view):
        begin, parts, reader = at, [], zlib.decompressobj(31)
        try:
            while not reader.eof:
                part = view[at : at + _PART]
                if not len(part):
                    raise ValueError("the archive ends inside a gzip member")
                parts.append(reader.decompress(part))
                at += len(part) - len(reader.unused_data)
            out += parts
        except (ValueError, zlib.error) as e:
            if rejects is None:
                raise ValueError(str(e)) from e
            rejects.append((begin, f"gzip: {e}"))
            at = archive.find(_GZIP, begin + 1)
            at = len(view) if at < 0 else at
        while at < len(view) and not view[at]:  # padding
            at += 1
    return b"".join(out)


# ARC -----------------------------------------------------------------------------------------------


def arc_file(name: str, version: int, rows: list[tuple[int | None, str | None, bytes]]) -> list[bytes]:
    """An ARC file's parts: a version block, then a header line and so many bytes for each row."""
    intro = f"{version} 0 curator\n{FIELDS[version]}\n".encode()
    tail = f"text/plain {len(intro)}" if version == 1 else f"text/plain 200 - - 0 {name} {len(intro)}"
    out = [f"filedesc://{name} 0.0.0.0 {CAPTURED} {tail}\n".encode() + intro + b"\n"]
    at = len(out[0])
    for key, url, body in rows:
        own = b"" if key is None else _ID_HEADER + f": {key}\r\n".encode()
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + own + b"Content-Length: %d\r\n\r\n" % len(body) + body
        where = quote(url, safe="%/:?#[]@!$&'()*+,;=~-._") if url else "urn:none"
        fields = [where, "0.0.0.0", CAPTURED, "text/html"]
        if version == 2:
            fields += ["200", "-", "-", str(at), name]
        out.append(f"{' '.join(fields)} {len(block)}\n".encode() + block + b"\n")
        at += len(out[-1])
    return out


def parse_arc(data: bytes, rejects: Rejects | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by name, block) of each record, read by the version block's field line and declared lengths.
    Files that follow one another in ``data`` each have a version block. After a record that can't be read, reading goes on at the
    next line that looks like a header: an address, a time and, at its end, a length."""
    names: list[str] = []
    at = 0
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        try:
            record, names, end = _arc_record(data, at, names)
        except (ValueError, IndexError) as e:
            if rejects is None:
                raise ValueError(str(e)) from e
            rejects.append((at, str(e)))
            following = _ARC_LINE.search(data, at)
            at = following.end() if following else len(data)
            continue
        at = end
        if record:
            yield record


def _arc_record(data: bytes, at: int, names: list[str]) -> tuple[tuple[dict[str, str], bytes] | None, list[str], int]:
    """(record, or None for a version block; field names; end) of what begins at ``at``."""
    end = data.find(b"\n", at)
    if end < 0:
        raise ValueError("the archive ends inside a header line")
    line = data[at:end].decode("utf-8", "replace").rstrip("\r")
    length = line.rsplit(" ", 1)[-1]
    if not (length.isascii() and length.isdigit()):
        raise ValueError("a header line without a length")
    size = int(length)
    block = data[end + 1 : end + 1 + size]
    if len(block) < size:
        raise ValueError(f"the archive ends inside a record of {size} bytes")
    if line.startswith("filedesc:") or not names:
        version, fields = [*block.decode("utf-8", "replace").splitlines(), "", ""][:2]
        names = fields.split(" ")
        number = version.split(" ", 1)[0]
        if not number.isdigit() or names != FIELDS.get(int(number), "").split(" "):
            raise ValueError(f"unknown field line {fields[:80]!r}")
        return None, names, end + 1 + size
    values = line.rsplit(" ", len(names) - 1)
    if len(values) < len(names):
        raise ValueError("a header line of too few fields")
    return (dict(zip(names, values, strict=True)), block), names, end + 1 + size


def to_arc(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Archives (archive, gzipped ARC content) of every row of ``pages``; versions 1 and 2 alternate."""
    rows = pages.select(F.col(page_id).cast("bigint"), F.col(url).cast("string"), F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def file() -> pa.RecordBatch:
            name = f"legacy-{part:05d}-{made:05d}.arc.gz"
            content = b"".join(map(member, arc_file(name, 1 + (part + made) % 2, held)))
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], schema=_ARCHIVES)

        for batch in batches:
            for key, where, body in zip(*(batch.column(k) for k in range(3)), strict=True):
                held.append((key.as_py(), where.as_py(), body.as_py()))
                size += len(held[-1][2])
                if size >= ARCHIVE_BYTES:
                    yield file()
                    made, held, size = made + 1, [], 0
        if held:
            yield file()

    return rows.mapInArrow(write, ARCHIVES)


def split_http(block: bytes) -> tuple[bytes, bytes, int | None]:
    """(head with its blank line, payload, page id) of an HTTP message; other blocks are all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block, None
    blank = re.search(rb"\r?\n\r?\n", block)
    head = block[: blank.end()] if blank else block
    found = re.search(rb"\n" + _ID_HEADER + rb": *(-?\d{1,19})\r?\n", head, re.IGNORECASE)
    return head, block[len(head) :], int(found[1]) if found else None


# WARC ----------------------------------------------------------------------------------------------


def record_id(page_id: int | None, digest: str) -> str:
    """A UUID of version 8 that holds the 64-bit id and 58 bits of the digest."""
    low, mark = (page_id or 0) & (1 << 64) - 1, int(digest[:15], 16)
    value = (mark >> 12) << 80 | 8 << 76 | (mark & 0x3FF) << 66 | (low >> 62) << 64 | 2 << 62 | low & (1 << 62) - 1
    text = f"{value:032x}"
    return f"urn:uuid:{text[:8]}-{text[8:12]}-{text[12:16]}-{text[16:20]}-{text[20:]}"


def id_of(record: str) -> int:
    """The id inside a record identifier."""
    value = int(record.removeprefix("urn:uuid:").replace("-", ""), 16)
    low = (value >> 64 & 3) << 62 | value & (1 << 62) - 1
    return low - (1 << 64) if low >> 63 else low


def iso_date(stamp: str) -> str:
    """The time of a stamp of up to 14 digits; what it lacks is taken from the start of 1970."""
    stamp = stamp if stamp.isdigit() else ""
    stamp = stamp[:14] + "19700101000000"[len(stamp[:14]) :]
    return f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:14]}Z"


def warc_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_warc(data: bytes, rejects: Rejects | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of uncompressed WARC content. After a record that can't be read, reading goes on at
    the next version line that follows a blank one."""
    at = 0
    while at < len(data):
        try:
            end = data.index(b"\r\n\r\n", at)
            version, *lines = data[at:end].decode().split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError("no record")
            headers = dict(line.split(": ", 1) for line in lines)
            size = int(headers["Content-Length"])
            block = data[end + 4 : end + 4 + size]
            if len(block) < size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
                raise ValueError("a record doesn't have its declared length")
        except (ValueError, KeyError) as e:
            if rejects is None:
                raise ValueError(f"{e} at byte {at}") from e
            rejects.append((at, str(e)))
            at = data.find(b"\r\n\r\nWARC/", at)
            at = len(data) if at < 0 else at + 4
            continue
        at = end + 8 + size
        yield headers, block


def converted(fields: dict[str, str], block: bytes) -> tuple[int | None, str, int, bytes]:
    """(page id, payload digest, payload bytes, WARC record) of an ARC record: a response, or a resource where no server answered."""
    head, payload, key = split_http(block)
    digest = hashlib.sha256(payload).hexdigest()
    url, mime = fields["URL"], fields["Content-type"]
    kind, content = "response", "application/http; msgtype=response"
    if not head:
        kind, content = ("response", "text/dns") if url.startswith("dns:") else ("resource", mime if "/" in mime else "application/octet-stream")
    own = record_id(key, digest)
    if key is None:  # nothing but its place and time tells it from others of one payload
        mark = hashlib.sha256("\n".join(fields.values()).encode()).digest()
        own = record_id(int.from_bytes(mark[:8], "big"), digest)
    headers = [
        ("WARC-Record-ID", f"<{own}>"), ("WARC-Date", iso_date(fields["Archive-date"])), ("WARC-Target-URI", url), ("WARC-IP-Address", fields["IP-address"]),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Identified-Payload-Type", mime), ("Content-Type", content),
    ]
    return key, digest, len(payload), warc_record(kind, headers, block)


def as_revisit(record: bytes, first: int) -> bytes:
    """A response record as one that revisits the response of another page."""
    headers, block = next(parse_warc(record))
    head, payload, _ = split_http(block)
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    del headers["WARC-Type"], headers["Content-Length"]
    headers["WARC-Block-Digest"] = f"sha256:{hashlib.sha256(head).hexdigest()}"
    headers["WARC-Refers-To"] = f"<{record_id(first, digest)}>"
    headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    headers[_SIZE_HEADER] = str(len(payload))
    return warc_record("revisit", list(headers.items()), head)


RECORDS = "page_id: bigint, digest: string, payload_bytes: bigint, record: binary"
_RECORDS = pa.schema([("page_id", pa.int64()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("record", pa.binary())])


def records(arcs: DataFrame, whole: bool = True, strict: bool = False) -> DataFrame:
    """A row for each record of ARC archives, with its WARC record as a gzip member; without ``whole`` that is null. Damaged parts are
    left out and listed by ``rejects``; with ``strict`` they fail the job."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                bad = None if strict else []
                for fields, block in parse_arc(content_of(content.as_py(), bad), bad):
                    if whole:
                        key, digest, size, record = converted(fields, block)
                        rows.append({"page_id": key, "digest": digest, "payload_bytes": size, "record": member(record)})
                    else:
                        _, body, key = split_http(block)
                        rows.append({"page_id": key, "digest": hashlib.sha256(body).hexdigest(), "payload_bytes": len(body)})
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)

    return arcs.select("content").mapInArrow(parse, RECORDS)


def rejects(archives: DataFrame) -> DataFrame:
    """(archive, place, reason) of what can't be read of ARC or WARC archives: places of bytes in the archive for damaged gzip
    members, in the uncompressed content for records, which may be well formed but not what their digests say."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                bad: Rejects = []
                data = content_of(content.as_py(), bad)
                if data.startswith(b"WARC/"):
                    for headers, block in parse_warc(data, bad):
                        try:
                            found_in(headers, block)
                        except (ValueError, KeyError) as e:
                            bad.append((-1, f"{headers.get('WARC-Record-ID')}: {e}"))
                else:
                    for _ in parse_arc(data, bad):
                        pass
                rows += [{"archive": name, "place": place, "reason": reason} for place, reason in bad]
            yield pa.RecordBatch.from_pylist(rows, schema=_REJECTS)

    return archives.select("archive", "content").mapInArrow(parse, "archive: string, place: bigint, reason: string")


def convert(arcs: DataFrame, strict: bool = False) -> DataFrame:
    """WARC archives (archive, content) of all records of ARC archives; damaged parts as in ``records``."""
    spark = arcs.sparkSession
    narrow = cut(records(arcs, False, strict).filter(F.col("page_id").isNotNull() & (F.col("payload_bytes") >= LEAST)).select("page_id", "digest"), spark)
    shared = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("other")).filter("other > first").select("digest", "first")
    later = join_hot(narrow, cut(shared, spark), "digest").filter(F.col("page_id") > F.col("first")).select(F.col("page_id").alias("key"), "digest", "first").distinct()
    # Written as files, whose size Spark sees: where few records are revisits, their list is broadcast and no payload is shuffled.
    places = f"{shared_folder(spark)}/revisits-{uuid4().hex}"
    later.write.parquet(places)
    later = spark.read.parquet(places)
    # Records without an id meet nobody; a hash of their own deals them over all tasks.
    found = records(arcs, True, strict).withColumn("key", F.coalesce("page_id", F.xxhash64("record"))).withColumn("digest", F.when(F.col("page_id").isNull(), "").otherwise(F.col("digest")))
    rows = found.join(later, ["key", "digest"], "left").select("record", "first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def file() -> pa.RecordBatch:
            name = f"converted-{part:05d}-{made:05d}.warc.gz"
            intro = b"software: curator\r\nformat: WARC File Format 1.1\r\n"
            start = [("WARC-Record-ID", f"<{record_id(made, hashlib.sha256(name.encode()).hexdigest())}>"), ("WARC-Date", iso_date(CAPTURED)), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
            content = b"".join([member(warc_record("warcinfo", start, intro)), *held])
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], schema=_ARCHIVES)

        for batch in batches:
            for record, first in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                held.append(record.as_py() if first is None else member(as_revisit(gzip.decompress(record.as_py()), first)))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield file()
                    made, held, size = made + 1, [], 0
        if held:
            yield file()

    return rows.mapInArrow(write, ARCHIVES)


def found_in(headers: dict[str, str], block: bytes) -> dict | None:
    """The row of a response, revisit or resource record, None for other kinds. Digests of stored payloads and blocks are checked."""
    kind, refers = headers["WARC-Type"], headers.get("WARC-Refers-To")
    if kind not in ("response", "revisit", "resource"):
        return None
    _, body, key = split_http(block)
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if "sha256:" + hashlib.sha256(block).hexdigest() != headers["WARC-Block-Digest"] or kind != "revisit" and hashlib.sha256(body).hexdigest() != digest:
        raise ValueError(f"{headers['WARC-Record-ID']} isn't what its digests say")
    size = int(headers[_SIZE_HEADER]) if kind == "revisit" else len(body)
    return {"page_id": key, "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": id_of(refers.strip("<>")) if refers else None}


def read(warcs: DataFrame, strict: bool = False) -> DataFrame:
    """FOUND: a row for each response, revisit or resource record whose digests are right. Others are left out and
    listed by ``rejects``; with ``strict`` they fail the job."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, bad = [], None if strict else []
                for headers, block in parse_warc(content_of(content.as_py(), bad), bad):
                    try:
                        row = found_in(headers, block)
                    except (ValueError, KeyError):
                        if strict:
                            raise
                        continue
                    if row:
                        rows.append(row)
                yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)

    return warcs.select("content").mapInArrow(parse, FOUND)


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Pages as WARC archives below ``folder`` (the shared checkpoint folder by default), which stay there, read back."""
    spark = pages.sparkSession
    arcs = cut(to_arc(pages), spark)
    path = f"{folder or shared_folder(spark)}/warc-{uuid4().hex}"
    convert(arcs, strict=True).write.parquet(path)
    return read(spark.read.parquet(path), strict=True)
