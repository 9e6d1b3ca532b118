"""Legacy ARC archives and their conversion to WARC.

ARC 1 puts five fields on a record's header line (url, address, date, type, length), ARC 2 ten (url,
address, date, type, status, checksum, location, offset, file, length); the version block that opens a
file says which. The converter reads the declared lengths, and synthesises for each record a WARC
identifier, an ISO timestamp, a type (warcinfo for the version block, response for an HTTP message,
resource for other content, revisit for a payload that another record holds) and SHA-1 digests.
Archives are rows (archive, content): whole files of gzip members, one a record.

Cases: a null payload is an empty one, a null url is `urn:key:<key>`; blanks in a url are escaped when a
file is written, and taken as part of the url or type when one is read; a null key stays null: such a page
is a revisit if its payload has a holder with a key, and a response otherwise; a record that ends before
its declared length keeps what there is, marked truncated, as does a header line cut short by the end of
the file; bytes that are no record up to the next header line are a record of type metadata with an error;
a WARC that cannot be read further is a row of type error; repeated rows are written each; very long pages
are archives of their own; columns beside key, url and payload are ignored, whatever their names; an empty
table gives no archives. Content may be plain or of gzip members, whole or cut.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import arrow_schema, save

#: Header lines of the two versions (fixed values of the format).
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
#: The same lines to read, where a url or a type may hold blanks; the date is what parts them.
HEADER = {
    1: re.compile(rb"(.*) (\S+) (\d{4,14}|-) (.*) (\d+)\r?"),
    2: re.compile(rb"(.*) (\S+) (\d{4,14}|-) (.*) (\d{3}|-) (\S+) (\S+) (\d+|-) (\S+) (\d+)\r?"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "corpusflow:archive")
#: Payloads of at least so many bytes may be revisits; records an archive, bytes of payload an archive.
REVISIT_BYTES, ARCHIVE_ROWS, ARCHIVE_BYTES = 1_000, 1_000, 8 << 20


class ArchiveError(ValueError):
    pass


@dataclass
class ArcRecord:
    url: str
    address: str
    date: str
    kind: str
    body: bytes
    status: str = "-"
    truncated: bool = False
    about: bool = False  # the file's version block
    error: str = ""  # why these bytes are no record


@dataclass
class WarcRecord:
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""


def write_arc(records: list[ArcRecord], version: int, name: str) -> bytes:
    """An uncompressed ARC file of version 1 or 2."""
    out = io.BytesIO()

    def put(r: ArcRecord) -> None:
        checksum = hashlib.sha1(r.body).hexdigest()[:16]
        values = {"URL": r.url, "IP-address": r.address, "Archive-date": r.date, "Content-type": r.kind, "Result-code": r.status, "Checksum": checksum, "Location": "-", "Offset": str(out.tell()), "Filename": name, "Archive-length": str(len(r.body))}
        out.write(" ".join(values[f] for f in FIELDS[version]).encode() + b"\n" + r.body + b"\n")

    about = f"{version} 0 corpusflow\n{' '.join(FIELDS[version])}\n"
    put(ArcRecord(f"filedesc://{name}", "0.0.0.0", records[0].date if records else "19960101000000", "text/plain", about.encode(), "200"))
    for r in records:
        put(r)
    return out.getvalue()


def plain_bytes(content: bytes) -> bytes:
    """content, or what its gzip members hold as far as they go."""
    if content[:2] != b"\x1f\x8b":
        return content
    out, rest = [], content
    while rest[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            out.append(member.decompress(rest))
        except zlib.error:
            break
        rest = member.unused_data
    return b"".join(out)


def read_arc(content: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file, the version block (its first record) first. Never raises: see the module's cases."""
    content = plain_bytes(content)
    version, at, first = 0, 0, True
    lost: int | None = None  # where bytes that are no record began

    def headless(start: int, end: int) -> ArcRecord:
        whole = end < len(content)
        return ArcRecord("", "", "", "", content[start:end], truncated=not whole, error="no header line" if whole else "header line cut short")

    while at < len(content):
        if lost is None and content[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = content.find(b"\n", at)
        line = content[at:end] if end >= 0 else b""
        if not version:  # the version block has five fields or ten, and says which the others have
            found = (HEADER[2].fullmatch(line), HEADER[1].fullmatch(line))
            kind, m = (2, found[0]) if found[0] else (1, found[1])
        else:
            kind, m = version, HEADER[version].fullmatch(line)
        if not m:
            lost = at if lost is None else lost
            at = end + 1 if end >= 0 else len(content)
            continue
        if lost is not None:
            yield headless(lost, at)
            lost, first = None, False
        version = version or kind
        at = end + 1
        v = dict(zip(FIELDS[kind], (x.decode("utf-8", "replace") for x in m.groups())))
        size = int(v["Archive-length"])
        body = content[at : at + size]
        about = first and v["URL"].startswith("filedesc:")  # a later record of such a URL is a page
        if about and body[:2] in (b"1 ", b"2 "):
            version = int(body[:1])
        yield ArcRecord(v["URL"], v["IP-address"], v["Archive-date"], v["Content-type"], body, v.get("Result-code", "-"), len(body) < size, about)
        at, first = at + size, False
    if lost is not None:
        yield headless(lost, len(content))


def record_id(key: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{key}|{digest}')}>"


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def iso_date(date: str) -> str:
    """A 14- or 12-digit ARC date (or a shorter one) as a WARC timestamp."""
    d = "".join(c for c in date if c.isdigit())[:14]
    d += "19960101000000"[len(d) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """Head (with its blank line) and payload of an HTTP message; other content has no head."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    head, mark, payload = body.partition(b"\r\n\r\n")
    return (head + mark, payload) if mark else (body, b"")


def head_field(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        k, colon, v = line.partition(b":")
        if colon and k.strip().lower() == name:
            return v.strip().decode("utf-8", "replace")
    return None


def to_warc(arc: ArcRecord, refers_to: str | None = None, place: str = "") -> WarcRecord:
    """The WARC record of an ARC record; refers_to: the key of the record that holds its payload; place: tells
    records without a key apart."""
    if arc.error:
        h = {"WARC-Type": "metadata", "WARC-Record-ID": record_id(f"{place}|{arc.error}", hashlib.sha1(arc.body).hexdigest()), "WARC-Date": iso_date(arc.date), "WARC-Payload-Digest": sha1_label(arc.body)}
        h |= {"Conversion-Error": arc.error, "Content-Type": "application/octet-stream"} | ({"WARC-Truncated": "length"} if arc.truncated else {})
        return WarcRecord(h | {"WARC-Block-Digest": sha1_label(arc.body), "Content-Length": str(len(arc.body))}, arc.body)
    head, payload = split_http(arc.body)
    digest, key = hashlib.sha1(payload).hexdigest(), head_field(head, b"x-record-key")
    h = {"WARC-Record-ID": record_id(f"{arc.url}|{place}" if key is None else key, digest), "WARC-Date": iso_date(arc.date), "WARC-Payload-Digest": sha1_label(payload)}
    block = arc.body
    if arc.about:
        h |= {"WARC-Type": "warcinfo", "WARC-Filename": arc.url.removeprefix("filedesc://"), "Content-Type": "application/warc-fields"}
        block = f"software: corpusflow\r\nformat: WARC File Format 1.1\r\nconverted-from: ARC {arc.body[:1].decode('latin-1')}\r\n".encode()
    else:
        h |= {"WARC-Target-URI": arc.url, "WARC-IP-Address": arc.address} | ({} if key is None else {"Record-Key": key})
        if head and refers_to is not None:
            h |= {"WARC-Type": "revisit", "WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(refers_to, digest), "Refers-To-Key": refers_to}
            block = head
        else:
            h["WARC-Type"] = "response" if head else "resource"
        h["Content-Type"] = "application/http;msgtype=response" if head else arc.kind
        h["Payload-Length"] = str(len(payload))
    if arc.truncated:
        h["WARC-Truncated"] = "length"
    h |= {"WARC-Block-Digest": sha1_label(block), "Content-Length": str(len(block))}
    return WarcRecord(h, block)


def warc_bytes(r: WarcRecord) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in r.headers.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + r.block + b"\r\n\r\n"


def read_warc(content: bytes) -> Iterator[WarcRecord]:
    """The records of a WARC file, plain or of gzip members."""
    data = io.BytesIO(plain_bytes(content))
    while line := data.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ArchiveError(f"no WARC record at byte {data.tell() - len(line)}")
        r = WarcRecord()
        while (line := data.readline().rstrip(b"\r\n")):
            k, _, v = line.partition(b":")
            r.headers[k.decode("utf-8", "replace")] = v.strip().decode("utf-8", "replace")
        if not r.headers.get("Content-Length", "").isdigit():
            raise ArchiveError(f"a WARC record without a length before byte {data.tell()}")
        r.block = data.read(size := int(r.headers["Content-Length"]))
        if len(r.block) < size:
            raise ArchiveError(f"a WARC record ends {size - len(r.block)} bytes before its length")
        yield r


def http_message(key, html: bytes) -> bytes:
    named = "" if key is None else f"X-Record-Key: {key}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n{named}\r\n".encode() + html


def arc_archives(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", refers: str = "refers_to") -> DataFrame:
    """Pages as ARC files, of version 1 and 2 in turn: (archive, content, refers: array of the pages' refers_to)."""

    def run(batches):
        base, n = TaskContext.get().partitionId(), 0
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("key", "url", "payload", "refers")))
            held, size = [], 0
            for row in rows:
                held.append(row)
                size += len(row[2])
                if len(held) >= ARCHIVE_ROWS or size >= ARCHIVE_BYTES:
                    yield out(held, f"part-{base:05d}-{n:05d}", 1 + n % 2)
                    held, size, n = [], 0, n + 1
            if held:
                yield out(held, f"part-{base:05d}-{n:05d}", 1 + n % 2)
                n += 1

    def out(rows, name: str, version: int) -> pa.RecordBatch:
        records = []
        for k, u, payload, _ in rows:
            u = f"urn:key:{k}" if not u else "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in u)
            records.append(ArcRecord(u, "192.0.2.1", f"2024{1 + n_of(k) % 12:02d}{1 + n_of(k) % 28:02d}120000", "text/html", http_message(k, payload), "200"))
        content = write_arc(records, version, name + ".arc")
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary()), pa.array([[r[3] for r in rows]], pa.list_(pa.string()))], names=["archive", "content", "refers"])

    def n_of(k) -> int:
        return sum(str(k).encode())

    columns = [F.col(key).cast("string").alias("key"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"), F.col(refers).cast("string").alias("refers")]
    return pages.select(*columns).mapInArrow(run, "archive string, content binary, refers array<string>")


def convert_archives(arcs: DataFrame) -> DataFrame:
    """ARC files (archive, content, and perhaps refers: the keys that their records refer to) as WARC files of gzip members."""
    cols = ["archive", "content", *(["refers"] if "refers" in arcs.columns else [])]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                refers = iter((b.column("refers")[i].as_py() or ()) if "refers" in b.schema.names else ())
                out = io.BytesIO()
                for k, r in enumerate(read_arc(b.column("content")[i].as_py() or b"")):
                    to = None if r.about or r.error else next(refers, None)
                    out.write(gzip.compress(warc_bytes(to_warc(r, to, f"{b.column('archive')[i]}:{k}")), compresslevel=1, mtime=0))
                yield pa.RecordBatch.from_arrays([b.column("archive").slice(i, 1), pa.array([out.getvalue()], pa.binary())], names=["archive", "content"])

    return arcs.select(*cols).mapInArrow(run, "archive string, content binary")


RECORD = "archive string, record int, record_type string, record_id string, target_uri string, date string, key string, refers_to_key string, payload_digest string, payload_bytes long, payload binary, truncated boolean, error string"


def read_archives(warcs: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of WARC files, warcinfo records included; a revisit's payload is null, its digest and size are the full payload's.

    What cannot be read is a row of type error that says why; the archive's records before it are kept."""
    schema = arrow_schema(RECORD)

    def row(name: str, k: int, r: WarcRecord) -> tuple:
        h = r.headers
        kind = h.get("WARC-Type", "")
        head, payload = (b"", r.block) if kind == "metadata" else split_http(r.block)
        digest, error = hashlib.sha1(payload).hexdigest(), h.get("Conversion-Error")
        label = h.get("WARC-Payload-Digest", "")
        said = base64.b32decode(label[5:]).hex() if re.fullmatch("sha1:[A-Z2-7]{32}", label) else None
        if kind not in ("revisit", "warcinfo") and said and digest != said:
            error = "the payload does not match its digest"
        size = int(h["Payload-Length"]) if h.get("Payload-Length", "").isdigit() else len(payload)
        return (name, k, kind, h.get("WARC-Record-ID"), h.get("WARC-Target-URI"), h.get("WARC-Date"), h.get("Record-Key"), h.get("Refers-To-Key"), said or digest, size, payload if payloads and kind != "revisit" else None, "WARC-Truncated" in h, error)

    def rows(name: str, content: bytes) -> Iterator[tuple]:
        k = 0
        try:
            for r in read_warc(content):
                yield row(name, k, r)
                k += 1
        except ArchiveError as e:
            yield (name, k, "error", *[None] * 8, False, str(e))

    def run(batches):
        for b in batches:
            for name, content in zip(b.column("archive").to_pylist(), b.column("content")):
                held = []
                for x in rows(name, content.as_py() or b""):
                    held.append(x)
                    if len(held) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    return warcs.select("archive", "content").mapInArrow(run, RECORD)


def with_revisits(pages: DataFrame, key: str = "page_id", html: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """pages with refers_to: the largest key among pages of the same payload, where that is another page and the payload has `least` bytes."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    known = pages.select(F.col(key).alias("_key"), F.sha1(payload).alias("_digest"), F.length(payload).alias("_size")).where(F.col("_size") >= least)
    known = save(known.select("_key", "_digest"), "digests")
    holder = known.groupBy("_digest").agg(F.max("_key").alias("refers_to"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    moved = known.join(holder.where("refers_to is not null"), "_digest").where("_key is null or _key < refers_to").groupBy("_key", "_digest").agg(F.max("refers_to").alias("refers_to"))
    mine = pages.drop("refers_to").withColumn("_mine", F.sha1(payload))
    return mine.join(moved, mine[key].eqNullSafe(moved["_key"]) & (mine["_mine"] == moved["_digest"]), "left").drop("_key", "_digest", "_mine")


def archive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Write pages by way of ARC files as WARC files to the shared folder: (archive, content)."""
    with_key = with_revisits(pages.select(key, url, html), key, html, least)
    return save(convert_archives(arc_archives(with_key, key, url, html)), "warcs")
